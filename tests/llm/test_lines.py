import hashlib
import random
from collections import defaultdict

from pyspark.sql import functions as F

from tallyhouse.llm import lines


def chunks_of(text):
    """(first line from 0, lines) of the chunk that begins at each line with words."""
    parts = (text or "").split("\n")
    places = [i for i, x in enumerate(parts) if x.strip(" ")]
    hashes = [int(hashlib.md5(parts[i].encode()).hexdigest()[:8], 16) for i in places]
    made = []
    for start in range(len(places) - 1):
        end = start + 1
        while end < min(start + 15, len(places) - 1) and (hashes[end] + 31 * hashes[end - 1]) % 64 == 0:
            end += 1
        made.append((places[start], parts[places[start] : places[end] + 1]))
    return made


def brute(docs):
    """Kept text, removed lines and runs of lines per (id, text)."""
    places = defaultdict(list)
    order = lambda d: (d[0] is None, d[0] or 0, str(d[2]))
    for doc in docs:
        for first, part in chunks_of(doc[1]):
            places["\n".join(part)].append((*order(doc), first))
    made = {}
    for doc in docs:
        later, stay = set(), set()
        for first, part in chunks_of(doc[1]):
            own = set(range(first, first + len(part)))
            occurrences = places["\n".join(part)]
            if len(set(occurrences)) > 1 or len(occurrences) > 1:
                if min(occurrences) == (*order(doc), first):
                    stay |= own
                else:
                    later |= own
        gone = later - stay
        kept = [x for i, x in enumerate((doc[1] or "").split("\n")) if i not in gone]
        made[doc[:2]] = (None if doc[1] is None else "\n".join(kept), len(gone), sum(i - 1 not in gone for i in gone))
    return made


def check(docs):
    rows = [(r.id, r.text, r.h) for r in docs.select(F.col("doc_id").alias("id"), "text", F.xxhash64("text").alias("h")).collect()]
    want = brute(rows)
    got = lines.remove_repeated_chunks(docs).select("row.doc_id", "row.text", "kept_text", "n_removed_lines", "n_removed_chunks").collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.kept_text, r.n_removed_lines, r.n_removed_chunks) == want[(r.doc_id, r.text)], r.doc_id
    return got


def test_edges(edge_docs, no_docs):
    check(edge_docs)
    made = lines.deduplicated(edge_docs)
    assert made.columns == edge_docs.columns
    assert made.count() == edge_docs.count()
    assert lines.deduplicated(no_docs).count() == 0


def test_a_passage_is_removed_wherever_it_stands(spark):
    passage = [f"line {i} of a passage that many texts share" for i in range(40)]
    texts = []
    for d in range(30):
        own = [f"document {d} says {i}" for i in range(d % 7 + 1)]
        texts.append("\n".join(own + passage + own[:d % 3]))
    texts += ["\n".join(passage)] * 3 + ["one line alone", "one line alone"]
    got = check(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
    by_id = {r.doc_id: r for r in got}
    assert by_id[0].n_removed_lines == 0
    # Some texts end with a repeat of their own first lines besides.
    assert all(39 <= by_id[d].n_removed_lines <= 42 for d in range(1, 33))
    assert by_id[33].kept_text == by_id[34].kept_text == "one line alone"


def test_short_passages_in_unlike_documents(spark):
    """Passages of two to six lines, each in three texts that share nothing else: nine in ten are taken
    out of the later two, and no other line is."""
    dice = random.Random(9)
    line = lambda: " ".join(f"{dice.randrange(10**6)}" for _ in range(9))
    passages = [[line() for _ in range(2 + k % 5)] for k in range(250)]
    texts, inside = [], []
    for copy in range(3):
        for passage in passages:
            before, behind = [line() for _ in range(dice.randrange(4))], [line() for _ in range(dice.randrange(4))]
            texts.append("\n".join(before + passage + behind))
            inside.append((len(before) + len(behind), len(passage), copy))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = defaultdict(list)
    for r in lines.remove_repeated_chunks(docs).select("row.doc_id", "n_removed_lines").collect():
        own, size, copy = inside[r.doc_id]
        assert r.n_removed_lines <= size
        if copy:
            found[size].append(r.n_removed_lines == size)
        else:
            assert r.n_removed_lines == 0
    assert all(sum(x) >= 0.9 * len(x) for x in found.values()), {k: sum(x) / len(x) for k, x in found.items()}


def test_little_is_left_of_repeated_runs(spark):
    """Of the two-line runs of the supplied documents that stand there more than once, at most a tenth
    of the surplus is left."""

    def surplus(df):
        runs = defaultdict(int)
        for r in df.select("text").collect():
            filled = [x for x in (r.text or "").split("\n") if x.strip()]
            for pair in zip(filled, filled[1:]):
                runs[pair] += 1
        return sum(n - 1 for n in runs.values())

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    before, after = surplus(docs), surplus(lines.deduplicated(docs))
    assert before > 500 and after < 0.1 * before, (before, after)


def test_repeats_that_overlap_themselves(spark):
    texts = ["a b\n" * 20 + "c", "x y\nx y", "q r\n\n  \ns t\nq r\n\n  \ns t\nu v", "one\ntwo\none\ntwo\none\ntwo\nthree"]
    got = check(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
    assert {r.doc_id: r.kept_text for r in got}[1] == "x y\nx y"


def test_equal_hashes_of_different_bytes_are_told_apart(spark, monkeypatch):
    """With a hash that gives every chunk the same value, bytes decide."""
    monkeypatch.setattr(lines.F, "xxhash64", lambda *c: F.crc32(F.lit("x")) if c == ("text",) else xx(*c))
    texts = ["a b\nc d\ne f", "g h\ni j\nk l", "a b\nc d\ne f", "m\nn", "g h\ni j\nk l"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    made = {r.doc_id: r.kept_text for r in lines.remove_repeated_chunks(docs).select("row.doc_id", "kept_text").collect()}
    want = brute([(i, t, 0) for i, t in enumerate(texts)])
    assert made == {i: want[(i, t)][0] for i, t in enumerate(texts)}


xx = F.xxhash64
