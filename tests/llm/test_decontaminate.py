import hashlib
import re
import tracemalloc
from types import SimpleNamespace

from tallyhouse.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return WORD.findall((text or "").translate(UPPER))


def brute(text, items):
    words = words_of(text)
    hit, owners = set(), set()
    for item, body in items:
        other = words_of(body)
        size = min(13, len(other))
        windows = {tuple(other[i : i + size]) for i in range(len(other) - size + 1)} if other else set()
        for i in range(len(words) - size + 1 if size else 0):
            if tuple(words[i : i + size]) in windows:
                hit |= set(range(i, i + size))
                owners.add(str(item))
    return (
        len(words), len(hit), len(owners), hashlib.sha256(",".join(sorted(owners)).encode()).hexdigest(),
        bool(hit) and 20 * len(hit) >= len(words),
    )


def check(docs, items, spark):
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    known = [(i, t) for i, t in items if i is not None]
    got = decontaminate.scan(docs, benchmark).select("row.text", "hits.*").collect()
    assert len(got) == docs.count()
    for r in got:
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == brute(r.text, known)
    return got


ITEMS = [
    (1, "What is the answer to the great question of life the universe and all of everything"),
    (2, "Short ITEM, with punctuation!"),
    (3, "naïve école"),
    (4, None),
    (5, ""),
    (None, "an item without an id"),
    (2, "Short item with punctuation"),
    (11, "one"),
]


def test_windows_spans_and_short_items(spark):
    texts = [
        "Say: what IS the answer; to the great question of life the universe and all of everything? Yes.",
        "the great question of life the universe and",
        "a short-item with punctuation and a second short item with punctuation",
        "une NAÏVE École",  # capital letters beyond A-Z differ
        "une naïve École naïve école",
        "one " * 50,
        "x " * 500 + "one",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = check(docs, ITEMS, spark)
    by_text = {r.text: r for r in got}
    r = by_text[texts[0]]
    assert [r.text[s.first : s.last] for s in r.spans] == [texts[0][5:-6]]
    assert [texts[4][s.first : s.last] for s in by_text[texts[4]].spans] == ["naïve école"]
    kept = decontaminate.clean(docs, spark.createDataFrame(ITEMS, "item_id bigint, text string"))
    assert sorted(x.doc_id for x in kept.collect()) == [1, 3, 6]


def test_edges(spark, edge_docs, no_docs):
    check(edge_docs, ITEMS, spark)
    empty = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.clean(edge_docs, empty).columns == edge_docs.columns
    assert decontaminate.clean(edge_docs, empty).count() == edge_docs.count()
    assert decontaminate.scan(no_docs, empty).count() == 0


def test_a_benchmark_of_several_blocks_gives_the_same(spark, monkeypatch):
    texts = ["one short item with punctuation", ITEMS[0][1] + " and " + ITEMS[2][1]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 30)
    check(docs, ITEMS, spark)


def test_words_are_held_for_one_text_at_a_time():
    passage = b"an item of the benchmark with so many words that it makes more than one window of it"
    block = [(next(decontaminate._numbers), SimpleNamespace(value=[("7", passage)]))]
    texts = [b" ".join(b"w%d" % (i * n % 5003) for i in range(2000)) + b" " + passage for n in range(1, 201)]
    tracemalloc.start()
    try:
        made = decontaminate._scan(texts, block)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert made["n_words"] == [2018] * 200 and made["n_hit"] == [18] * 200
    assert peak < sum(map(len, texts)) / 2
