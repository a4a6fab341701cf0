import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from tallyhouse.llm import collocations as col

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows, most):
    """All phrases of up to ``most`` words by language, and the words of each."""
    f, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOW)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, most + 1):
                f.setdefault(lang, Counter()).update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    return f, n


def expected(rows, least=10, most=3, top=2000):
    f, n = counted(rows, most)
    made = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in candidates.items():
            score, _, left, right = min(
                (10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p))
            )
            gone = any(
                len(q) > len(p) and 100 * b >= 50 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in candidates.items()
            )
            if not gone:
                scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            made.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(made)


def found(df, **options):
    rows = col.collocations(df, **options).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()
    return sorted(tuple(r) for r in rows)


def texts(n, seed):
    dice = random.Random(seed)
    words = [f"w{i}" for i in range(12)] + ["É", "日本", "The", "x-y"]
    rows = []
    for i in range(n):
        body = []
        for _ in range(dice.randrange(0, 60)):
            body.append(dice.choice(words))
            if dice.random() < 0.3:
                body.append("hot pair")
            if dice.random() < 0.1:
                body.append("one fixed phrase")
        rows.append((dice.choice(["en", "de", None, "und"]), dice.choice([" ", "  ", "\t"]).join(body).replace("w3", "w3.").replace("w4", "w4\n")))
    return rows + [("en", None), ("en", ""), ("fr", "..."), (None, " \t ")]


SCHEMA = "lang string, text string"


@pytest.mark.parametrize("part_rows", [10**6, 150])
def test_equals_brute_force(spark, part_rows):
    rows = texts(200, 5)
    assert found(spark.createDataFrame(rows, SCHEMA), part_rows=part_rows) == expected(rows)


def test_more_words_and_few_kept(spark):
    rows = texts(120, 6)
    options = {"least_count": 5, "max_words": 4, "top": 7}
    assert found(spark.createDataFrame(rows, SCHEMA), part_rows=100, **options) == expected(rows, 5, 4, 7)
    pairs = found(spark.createDataFrame(rows, SCHEMA), max_words=2)
    assert pairs == expected(rows, most=2)


def test_a_pair_in_a_third_of_all_words_is_spread(spark):
    """Suffixes behind a heavy pair go to parts by their third word."""
    dice = random.Random(1)
    rows = [("en", " ".join(f"hot pair v{dice.randrange(2000)}" for _ in range(300))) for _ in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(df, part_rows=2000) == expected(rows)
    docs = df.select("lang", "text")
    sent = spark.sparkContext.broadcast(col.cloudpickle.dumps(col.Heavy([("en", 1, "hot"), ("en", 1, "pair"), ("en", 2, "hot pair")])))
    parts = docs.mapInArrow(col._routed(3, 16, sent), "part int, lang string, block binary").collect()
    sizes = Counter()
    for r in parts:
        sizes[r.part] += len(r.block)
    assert len(sizes) == 16 and max(sizes.values()) < 3 * min(sizes.values())


@given(st.lists(st.tuples(st.integers(-1, 4), st.integers(-1, 4), st.integers(-1, 4)), max_size=60), st.integers(1, 6))
def test_quicksort_counts_prefixes(rows, least):
    rows = [r for r in rows if r[0] >= 0]
    rows = [(a, b, c if b >= 0 else -1) for a, b, c in rows]
    weights = np.array([1 + i % 3 for i in range(len(rows))], np.int64)
    columns = np.array(rows, np.int32).reshape(-1, 3).T
    truth = Counter()
    for row, weight in zip(rows, weights):
        for k in range(1, 4):
            if row[k - 1] >= 0:
                truth[row[:k]] += weight
    made = {}
    for depth, places, counts in col.frequent_prefixes(columns, weights, least):
        for place, n in zip(places, counts):
            assert rows[place][:depth] not in made
            made[rows[place][:depth]] = n
    assert made == {k: v for k, v in truth.items() if v >= least}


def test_scores_beyond_64_bits(spark, monkeypatch):
    big = 3_000_000_000
    counts = spark.createDataFrame(
        [("en", 1, "a", 2 * big), ("en", 1, "b", 2 * big + 1), ("en", 2, "a b", big)], "lang string, words int, phrase string, n bigint"
    )
    totals = spark.createDataFrame([("en", 9 * big)], "lang string, n bigint")
    monkeypatch.setattr(col, "phrase_counts", lambda *a, **k: (counts, totals))
    row = col.collocations(counts).first()
    assert row.score == 10**6 * big * big // (2 * big * (2 * big + 1)) == 249999


def test_awkward_documents(spark, edge_docs, no_docs):
    rows = [(r.lang, r.text) for r in edge_docs.select("lang", "text").collect()]
    assert found(edge_docs) == expected(rows)
    assert found(no_docs) == []


def test_blocks_of_any_size(spark, monkeypatch):
    rows = texts(100, 8)
    whole = [r for r in col._by_language(iter([col.pa.RecordBatch.from_arrays([col.pa.array(c, col.pa.string()) for c in zip(*rows[:50] * 2)][:2], names=["lang", "text"])]), 10**6) if r[0]]
    small = [r for r in col._by_language(iter([col.pa.RecordBatch.from_arrays([col.pa.array(c, col.pa.string()) for c in zip(*rows[:50] * 2)][:2], names=["lang", "text"])]), 500) if r[0]]
    tally = lambda blocks: Counter(w for _, data in blocks for w in data.split())
    assert len(small) > len(whole) and tally(small) == tally(whole)
