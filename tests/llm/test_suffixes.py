import hashlib
import random
from collections import Counter

from pyspark.sql import functions as F

from tallyhouse.llm import suffixes
from tallyhouse.llm.queries import queries

LENGTH = suffixes.LENGTH


def brute(texts):
    times = Counter(t[p : p + LENGTH] for t in texts for p in range(len(t) - LENGTH + 1))
    made = []
    for t in texts:
        covered = bytearray(len(t))
        for p in range(len(t) - LENGTH + 1):
            if times[t[p : p + LENGTH]] > 1:
                covered[p : p + LENGTH] = b"\1" * LENGTH
        kept = bytes(b for b, c in zip(t, covered) if not c)
        runs = sum(c and (k == 0 or not covered[k - 1]) for k, c in enumerate(covered))
        made.append((len(t), sum(covered), runs, kept))
    return made


def check(docs):
    rows = docs.select("doc_id", "text").collect()
    want = brute([(r.text or "").encode() for r in rows])
    got = suffixes.without_repeats(docs).select("row.doc_id", "row.text", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256").collect()
    key = lambda x: str(x)
    flat = [(r.doc_id, r.text, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept), r.kept_sha256) for r in got]
    expected = [(r.doc_id, r.text, *w, hashlib.sha256(w[3]).hexdigest()) for r, w in zip(rows, want)]
    assert sorted(flat, key=key) == sorted(expected, key=key)
    return flat


def noise(dice, n):
    return "".join(dice.choice("abcdefgh éß\n") for _ in range(n))


def test_planted_repeats(spark):
    """Copies at every rim: exact length, one byte short, at both ends, overlapping, inside one text."""
    dice = random.Random(9)
    shared = [noise(dice, n) for n in (400, 399, 401, 700, 2000)]
    texts = []
    for passage in shared:
        for _ in range(3):
            texts.append(noise(dice, dice.randrange(300)) + passage + noise(dice, dice.randrange(300)))
    texts += [shared[4], shared[4][100:1500], shared[4][700:] + shared[3]]
    texts += ["z" * 1000, "z" * 450 + noise(dice, 50), "ab" * 400, noise(dice, 500) * 2]
    base = noise(dice, 3000)
    for i in range(20):  # near copies with changes of their own
        p = dice.randrange(2900)
        texts.append(base[:p] + "#%d#" % i + base[p + 3 :])
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))


def test_edges(edge_docs, no_docs):
    small = edge_docs.where("text is null or length(text) < 10000")
    check(small)
    assert suffixes.without_repeats(edge_docs).count() == edge_docs.count()
    assert suffixes.without_repeats(no_docs).count() == 0


def test_no_repeats(spark):
    dice = random.Random(2)
    docs = spark.createDataFrame([(i, noise(dice, 900)) for i in range(5)], "doc_id bigint, text string")
    assert all(r[3] == 0 for r in check(docs))


def test_long_texts_are_cut_into_stretches():
    """Windows of a text above the stretch are represented once, in order, without gaps."""
    dice = random.Random(1)
    text = dice.randbytes(suffixes._STRETCH + 5000)
    bucket, at, first, last = suffixes.suffixes(text)
    assert first[0] == 0 and last[-1] == len(text) - LENGTH
    assert (first[1:] == last[:-1] + 1).all()
    assert ((at >= last) & (at < first + suffixes.REACH)).all()
    again = suffixes.suffixes(text[1000:])[1] + 1000
    assert len(set(at.tolist()) ^ set(again.tolist())) < 40


def test_query_equals_brute_force(spark, small):
    """The registered query, over all documents of the smallest tables."""
    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    want = brute([(r.text or "").encode() for r in rows])
    expected = {r.doc_id: (n, gone, runs, hashlib.sha256(kept).hexdigest()) for r, (n, gone, runs, kept) in zip(rows, want)}
    made = queries()["op6_suffix_dedup"](spark, small).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in made} == expected and len(made) == len(rows)
    assert sum(r.n_removed > 0 for r in made) > 10


def test_registered_query_plans_no_bloom_filters(spark, small, capsys):
    """Seven of them, each carried by the stages behind it, did not fit into a driver of 1.5 GB."""
    names = ("enabled", "applicationSideScanSizeThreshold")
    before = {n: spark.conf.get(f"spark.sql.optimizer.runtime.bloomFilter.{n}") for n in names}
    try:
        frame = queries()["op6_suffix_dedup"](spark, small)
        spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "0")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        frame.explain()
        plan = capsys.readouterr().out
        assert "SortMergeJoin" in plan and "might_contain" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for n, value in before.items():
            spark.conf.set(f"spark.sql.optimizer.runtime.bloomFilter.{n}", value)


def test_large_sub_bucket_stays_spread(spark):
    """The suffixes of one string in nine tenths of all places do not meet in one task."""
    names = ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")
    before = {n: spark.conf.get(n) for n in names}
    # Of 40,000 suffixes every tenth is elsewhere: half of these in pairs, half alone.
    mixed = spark.range(0, 40_000, 1, 8).selectExpr(
        "1L bucket", "if(id % 10 > 0, -1, if(id % 20 = 0, id div 40, 40000 + id)) context", "id doc", "id place"
    )
    contexts = mixed.groupBy("bucket", "context").agg(F.count(F.lit(1)).alias("n"))
    try:
        for n, value in zip(names, ("false", "-1")):
            spark.conf.set(n, value)
        found = suffixes._in_company(mixed, contexts).select("doc", F.spark_partition_id().alias("task")).collect()
    finally:
        for n, value in before.items():
            spark.conf.set(n, value)
    assert sorted(r.doc for r in found) == [i for i in range(40_000) if i % 10 or i % 20 == 0]
    assert max(Counter(r.task for r in found).values()) < 10_000


def test_large_sub_buckets_equal_brute_force(spark, monkeypatch):
    """Lines that repeat within and across texts, so that sub-buckets of one bucket are large and small."""
    monkeypatch.setattr(suffixes, "LARGE", 20)
    dice = random.Random(4)
    line = noise(dice, 450)
    texts = [noise(dice, dice.randrange(200)) + line * dice.randrange(1, 6) + noise(dice, 300) for _ in range(40)]
    texts += [noise(dice, 600)] * 30 + [noise(dice, 50) + line[:420] + noise(dice, 50) for _ in range(3)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert sum(r[3] > 0 for r in check(docs)) == len(texts)
