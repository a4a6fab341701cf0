import base64
import gzip
import hashlib

import pytest

from tallyhouse.llm import warc

SCHEMA = "page_id bigint, url string, html string, row string, id int, key string, refers_to string, file string"
ROWS = [
    (5, "http://a/5", "same"), (3, "http://a/3", "same"), (9, "http://b/9", "same"), (4, "http://c/4", "é日本 payload"),
    (6, None, ""), (7, "http://x/ä?q=1%20 2", None), (None, "http://n", "same"), (None, "http://n", "alone"),
    (8, "bad\r\nurl: x", "big " * 50_000), (4, "http://c/4", "é日本 payload"), (4, "http://c/other", "another payload"),
    (10, "", "a\r\n\r\nb\x00c\r\n\r\n"),
]


def expected(rows, least=0):
    first = {}
    for i, _, html in rows:
        body = (html or "").encode()
        if i is not None:
            first[body] = min(first.get(body, i), i)
    made = []
    for i, _, html in rows:
        body = (html or "").encode()
        owner = first.get(body, i) if len(body) >= least else i
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        made.append((i, len(body), digest, "response" if i == owner else "revisit", None if i == owner else owner))
    return sorted(made, key=str)


def result(records):
    return sorted(
        (
            (r.id and int(r.id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to and int(r.refers_to))
            for r in records
        ),
        key=str,
    )


@pytest.fixture
def pages(spark):
    return spark.createDataFrame([(*r, "x", 1, "k", "r", "f") for r in ROWS], SCHEMA).repartition(3)


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, pages, least):
    folder = warc.archive_folder(spark)
    index = warc.write(pages, folder, revisit_from=least)
    got = warc.read(index, folder).collect()
    assert result(got) == expected(ROWS, least)
    payloads = {r.id: bytes(r.payload) for r in got if r.record_type == "response" and r.id not in (None, "4")}
    assert payloads["8"].decode() == ROWS[8][2]
    assert payloads["10"].decode() == ROWS[-1][2]
    urls = {r.id: r.url for r in got}
    assert urls["7"] == ROWS[5][1] and urls["6"] is None and urls["8"] == "bad%0D%0Aurl: x"


def test_archives_are_gzip_members_at_the_offsets(spark, pages):
    folder = warc.archive_folder(spark)
    index = warc.write(pages, folder).collect()
    for r in index:
        with open(f"{folder.removeprefix('file://')}/{r.file}", "rb") as file:
            data = file.read()
        record = gzip.decompress(data[r.offset : r.offset + r.length])
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
        assert f"sha1:{r.digest}".encode() in record


def test_selected_records_only(spark, pages):
    folder = warc.archive_folder(spark)
    index = warc.write(pages, folder)
    assert [r.id for r in warc.read(index.where("url = 'http://b/9'"), folder).collect()] == ["9"]


def test_ranges_join_neighbours():
    def rows(*places):
        return [{"file": f, "offset": o, "length": n} for f, o, n in places]

    got = list(warc.ranges(rows(("a", 0, 10), ("a", 10, 5), ("a", 30, 5), ("a", 500, 5), ("b", 505, 5), ("b", 510, 900), ("b", 1410, 200)), gap=20, most=1000))
    assert [[r["offset"] for r in part] for part in got] == [[0, 10, 30], [500], [505, 510], [1410]]


def test_damage_is_noticed(spark):
    record = warc.record_bytes({"id": "1", "url": "u", "digest": warc.base32_sha1(b"abc"), "payload": b"abc", "refers_to": None})
    assert warc.parse_record(record)["payload"] == b"abc"
    with pytest.raises(ValueError):
        warc.parse_record(record.replace(b"abc", b"abd"))


def test_empty_table(spark, pages):
    folder = warc.archive_folder(spark)
    index = warc.write(pages.limit(0), folder)
    assert index.count() == 0 and warc.read(index, folder).count() == 0


def test_reading_is_dealt_by_bytes(spark, monkeypatch):
    """As many tasks as the records ask for, whatever the size of the index; files are closed on the way."""
    pages = spark.range(400).selectExpr("id as page_id", "concat('http://h/', id) as url", "repeat(sha2(string(id), 512), 20) as html")
    monkeypatch.setattr(warc, "FILE_BYTES", 20_000)
    folder = warc.archive_folder(spark)
    index = warc.write(pages.coalesce(1), folder)
    total = index.agg({"length": "sum"}).first()[0]
    assert index.select("file").distinct().count() > 3
    monkeypatch.setattr(warc, "TASK_BYTES", total // 10)
    read = warc.read(index, folder)
    assert read.rdd.getNumPartitions() >= 10 and read.count() == 400
