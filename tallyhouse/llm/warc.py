"""WARC archives with an index that is written first and read instead of the archives.

Writing. Payload digests alone decide which record of equal payloads is the response: the one
with the least id, found by an aggregate that merges in the tasks, so a payload with a third of
all copies arrives as one row per task. Each task then streams its records into archive files of
its own (one gzip member per record) in the shared folder and returns one index row per record:
file, offset, length, URL, digest, type. The index is stored as Parquet and names only files of
tasks that succeeded; what a lost or repeated attempt left behind is never read.

Reading. Selected index rows are ranged by (file, offset) over the tasks. A task joins
neighbouring records to one byte range while the gap and the range stay below limits, reads the
range at once, and takes the records out of it.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.common import checkpointed, stored
from tallyhouse.session import fresh_path

FILE_BYTES = 256_000_000
GAP_BYTES = 64_000
RANGE_BYTES = 8_000_000
TASK_BYTES = 32 << 20  # of archives that one task reads back
LEVEL = 6
DATE = "2024-01-01T00:00:00Z"

# The profile of a revisit by digest, and the prefix of our record ids.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_PREFIX = "urn:page:"

INDEX = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("offset", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("digest", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("refers_to", T.StringType()),
    ]
)
RECORD = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("refers_to", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload", T.BinaryType()),
    ]
)
_INDEX_ARROW = pa.schema(
    [(f.name, pa.int64() if isinstance(f.dataType, T.LongType) else pa.string()) for f in INDEX.fields]
)
_RECORD_ARROW = pa.schema(
    [
        (f.name, {"bigint": pa.int64(), "binary": pa.binary()}.get(f.dataType.simpleString(), pa.string()))
        for f in RECORD.fields
    ]
)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header_text(value: str) -> str:
    """A value on one header line: control characters, which no URL may hold, as percent escapes."""
    return "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in value)


def record_bytes(row: dict) -> bytes:
    """One WARC/1.1 record. A revisit keeps the HTTP header of its payload and leaves the payload out."""
    payload = row["payload"] or b""
    revisit = row["refers_to"] is not None
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if not revisit:
        block += payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Date", DATE),
        ("WARC-Record-ID", f"<{ID_PREFIX}{_header_text(row['id'])}>" if row["id"] is not None else f"<urn:uuid:{uuid.uuid4()}>"),
        ("WARC-Payload-Digest", "sha1:" + row["digest"]),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if row["url"] is not None:
        fields.append(("WARC-Target-URI", _header_text(row["url"])))
    if revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{ID_PREFIX}{_header_text(row['refers_to'])}>")]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """The fields and payload of one record, with its length and digest checked."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError(f"record {fields['WARC-Record-ID']} does not hold the payload of its digest")
    return {
        "id": _id_of(fields["WARC-Record-ID"]),
        "url": fields.get("WARC-Target-URI"),
        "record_type": fields["WARC-Type"],
        "refers_to": _id_of(fields["WARC-Refers-To"]) if revisit else None,
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": None if revisit else payload,
    }


def _id_of(value: str) -> str | None:
    value = value.strip("<>")
    return value.removeprefix(ID_PREFIX) if value.startswith(ID_PREFIX) else None


class _Archive:
    """Archive files of one task, one after the other."""

    def __init__(self, folder: str):
        self.system, self.folder = pafs.FileSystem.from_uri(folder)
        self.system.create_dir(self.folder, recursive=True)
        self.stream = None

    def add(self, row: dict) -> tuple[str, int, int]:
        """Write a record; its file, offset and length."""
        if self.stream is not None and self.at >= FILE_BYTES:
            self.close()
        if self.stream is None:
            self.name, self.at = f"{uuid.uuid4().hex}.warc.gz", 0
            self.stream = self.system.open_output_stream(f"{self.folder}/{self.name}", compression=None)
        packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        member = packer.compress(record_bytes(row)) + packer.flush()
        self.stream.write(member)
        begins, self.at = self.at, self.at + len(member)
        return self.name, begins, len(member)

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()
            self.stream = None


def _writer(folder: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = _Archive(folder)
        made = []

        def finished():
            """The index rows of a file go out when it is complete."""
            archive.close()
            for start in range(0, len(made), 10_000):
                yield pa.RecordBatch.from_pylist(made[start : start + 10_000], _INDEX_ARROW)
            made.clear()

        for batch in batches:
            for row in batch.to_pylist():
                file, offset, length = archive.add(row)
                kind = "response" if row["refers_to"] is None else "revisit"
                made.append(
                    {"file": file, "offset": offset, "length": length, "url": row["url"], "digest": row["digest"],
                     "record_type": kind, "id": row["id"], "refers_to": row["refers_to"]}
                )
                if archive.at >= FILE_BYTES:
                    yield from finished()
        yield from finished()

    return run


def write(
    pages: DataFrame,
    folder: str,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    revisit_from: int = 0,
) -> DataFrame:
    """Write every row of ``pages`` as a record below ``folder``; the stored index.

    Of records with equal payloads of at least ``revisit_from`` bytes, the one with the least id is
    the response and the others are revisits of it. Rows that share this id are all responses. Rows
    without an id are revisits if anyone with their payload has one, else responses. A NULL payload
    is empty, and a very long one is one record, held in memory while it is written. An empty table
    gives an empty index.
    """
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    key = F.sha1(payload)
    size = F.octet_length(payload)
    light = pages.select(F.col(id_col).alias("id"), key.alias("key"), size.alias("size")).where(size >= revisit_from)
    # Behind a checkpoint both sides of the join are plain exchanges, which Spark can split.
    several = checkpointed(
        light.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first")).where("n > 1").drop("n")
    )
    revisits = (
        light.join(several, "key").where(~F.col("id").eqNullSafe(F.col("first")))
        .select(F.col("id").alias("rid"), F.col("key").alias("rkey"), F.col("first").cast("string").alias("refers_to"))
        .distinct()
    )
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"), key.alias("key")
    )
    rows = rows.join(revisits, (rows["key"] == revisits["rkey"]) & rows["id"].eqNullSafe(revisits["rid"]), "left")
    rows = rows.select(F.col("id").cast("string").alias("id"), "url", "payload", F.col("key").alias("digest"), "refers_to")
    return stored(rows.mapInArrow(_with_base32(_writer(folder)), INDEX), "warc-index")


def _with_base32(run):
    """Turn the hexadecimal digests of the rows into base32."""

    def converted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each():
            for batch in batches:
                at = batch.schema.get_field_index("digest")
                digests = [base64.b32encode(bytes.fromhex(x)).decode() for x in batch.column(at).to_pylist()]
                yield batch.set_column(at, "digest", pa.array(digests, pa.string()))

        yield from run(each())

    return converted


def ranges(rows: Iterable[dict], gap: int = GAP_BYTES, most: int = RANGE_BYTES) -> Iterator[list[dict]]:
    """Neighbouring records, in order of (file, offset), that are read at once."""
    part: list[dict] = []
    for row in rows:
        if part:
            end = part[-1]["offset"] + part[-1]["length"]
            far = row["offset"] - end > gap or row["offset"] + row["length"] - part[0]["offset"] > most
            if row["file"] != part[0]["file"] or far:
                yield part
                part = []
        part.append(row)
    if part:
        yield part


def _reader(folder: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = pafs.FileSystem.from_uri(folder)
        opened, name = None, None
        try:
            for part in ranges(row for batch in batches for row in batch.to_pylist()):
                if part[0]["file"] != name:
                    if opened is not None:
                        opened.close()
                    name = part[0]["file"]
                    opened = system.open_input_file(f"{root}/{name}")
                begin = part[0]["offset"]
                opened.seek(begin)
                data = opened.read(part[-1]["offset"] + part[-1]["length"] - begin)
                records = [
                    parse_record(zlib.decompress(data[r["offset"] - begin : r["offset"] - begin + r["length"]], 31))
                    for r in part
                ]
                yield pa.RecordBatch.from_pylist(records, _RECORD_ARROW)
        finally:
            if opened is not None:
                opened.close()

    return run


def read(index: DataFrame, folder: str) -> DataFrame:
    """The records that rows of the index name, read from the archives below ``folder``."""
    # Tasks by what they will read; the index itself is small and would be dealt to one.
    size = index.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    tasks = max(1, -(-size // TASK_BYTES))
    ordered = index.select("file", "offset", "length").repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")
    return ordered.mapInArrow(_reader(folder), RECORD)


def archive_folder(spark) -> str:
    """A new folder for archives in the shared folder."""
    return fresh_path(spark, "warc")
