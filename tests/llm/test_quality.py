import math
import random
from collections import Counter

import numpy as np
import zstandard
from pyspark.sql import functions as F

from tallyhouse.llm import quality
from tallyhouse.llm.queries import queries

BLANK = " \t\n\x0b\x0c\r"


def words_of(text):
    for c in BLANK:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def brute_base(text):
    text = text or ""
    words = words_of(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words_of(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return (
        n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside),
        n < 50 or 100 * len(inside) > 50 * n,
    )


def above_curve(curve, size, ratio):
    """Spreads above the curve, from its heights at the powers of two and straight lines between them."""
    heights, at = [curve.pieces[0]], 0.0
    for slope in np.cumsum(curve.pieces[1:]):
        heights.append(heights[-1] + slope)
    length = math.log2(size)
    first = 9
    if length < first:
        at = heights[0] + (length - first) * curve.pieces[1]
    else:
        piece = min(int(length) - first, len(heights) - 2)
        at = heights[piece] + (length - first - piece) * (heights[piece + 1] - heights[piece])
    spread = max(curve.spread[0] + curve.spread[1] * length, 0.012) * math.sqrt(math.pi / 2)
    return (math.log(ratio) - at) / spread


def brute_kept(text, lang=None, known=None):
    raw = (text or "").encode()
    if brute_base(text)[-1]:
        return False
    pack = zstandard.ZstdCompressor(level=3).compress
    band = [b for b in quality.DOCUMENT_BANDS if len(raw) < b.below][0]
    ratio = len(raw) / len(pack(raw))
    if not band.least <= ratio <= band.most:
        return False
    curve = (known or {}).get(lang or "", (known or {}).get(None))
    if curve and len(raw) >= 256 and above_curve(curve, len(raw), ratio) > 3.5:
        return False
    if len(raw) <= 4096:
        return True
    chunks = [raw[i : i + 4096] for i in range(0, len(raw), 4096)]
    chunks = [c for c in chunks if len(c) >= 1024]
    bad = sum(len(c) for c in chunks if not 1.3 <= len(c) / len(pack(c)) <= 4.0)
    return bad <= 0.3 * sum(map(len, chunks))


def check(judged, docs):
    got = judged.select("row.text", "quality.*").collect()
    assert len(got) == docs.count()
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_base(r.text)
        assert r.kept == brute_kept(r.text)  # too few documents for a curve


def test_query_equals_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    lang = {r.doc_id: r.lang for r in docs.collect()}
    known = quality.curves(docs)
    assert None in known and "en" in known
    got = queries()["op2_quality_rules"](spark, small).collect()
    assert len(got) == len(text)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_base(text[r.doc_id])
        assert r.kept == brute_kept(text[r.doc_id], lang[r.doc_id], known)


def test_junk_is_rejected_and_clean_texts_stay(spark):
    """Labels that the curves have never seen, by language: of what the base rules pass, 70 % of the
    junk goes and no more than 1.5 % of the clean texts."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    judged = quality.judge(docs).select("row.doc_id", "row.lang", "quality.base_failed", "quality.kept").join(labels, "doc_id")
    rows = judged.where("not base_failed").groupBy("lang", "label").agg(F.avg((~F.col("kept")).cast("int")).alias("gone"), F.count("*").alias("n"))
    for r in rows.collect():
        assert r.n >= 30 and (r.gone >= 0.7 if r.label == 0 else r.gone <= 0.015), r


def test_cells_count_all_documents(spark, small, monkeypatch):
    seen = {}
    monkeypatch.setattr(quality.Curve, "fit", classmethod(lambda cls, lengths, ratios, counts: seen.update({len(seen): sum(counts)})))
    docs = spark.read.parquet(f"{small}/documents.parquet")
    known = quality.curves(docs)
    long = docs.where("octet_length(text) >= 256")
    sizes = {r.lang: r["count"] for r in long.groupBy("lang").count().collect()}
    assert list(seen.values())[0] == long.count()
    assert set(known) == {None} | {k for k, n in sizes.items() if n >= 50}
    assert set(list(seen.values())[1:]) == {n for n in sizes.values() if n >= 50}


def test_a_curve_goes_on_as_it_ends():
    lengths = np.linspace(8.1, 13, 200)
    curve = quality.Curve.fit(lengths, 0.1 * lengths - 0.3 + 0.02 * np.sin(np.arange(200)), np.ones(200))
    for size in (300, 5000, 1 << 19, 1 << 24):
        usual = 2.718281828 ** (0.1 * math.log2(size) - 0.3)
        assert abs(curve.excess(size, usual)) < 2 and curve.excess(size, usual * 1.3) > 3.5


def test_edges(edge_docs, no_docs):
    check(quality.judge(edge_docs), edge_docs)
    kept = quality.passing(edge_docs)
    assert kept.columns == edge_docs.columns
    assert quality.passing(no_docs).count() == 0


def test_repetitive_and_random_texts_are_rejected(spark):
    dice = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"
    noise = " ".join("".join(dice.choice(letters) for _ in range(70)) for _ in range(100))
    # Repeated in whole sentences of which no three words in a row repeat often enough for the base rule.
    common = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "re") for b in ("ta", "so", "vi", "du", "pe")]
    prose = " ".join(dice.choice(common) + dice.choice(["", "ly", "ing", "ed"]) + dice.choice(["", ",", "."]) for _ in range(900))
    menu = " ".join(f"Item {i} costs very little today and ships in {i} days;" for i in range(150))
    docs = spark.createDataFrame([("noise", noise), ("prose", prose), ("menu", menu)], "doc_id string, text string")
    reasons = {r.doc_id: r.reason for r in quality.judge(docs).select("row.doc_id", "quality.reason").collect()}
    assert reasons["noise"] == "incompressible"
    assert reasons["prose"] is None
    assert reasons["menu"] in ("base", "repetitive", "chunks")


def test_long_repetitive_part_is_found_by_chunks():
    compressor = zstandard.ZstdCompressor(level=3)
    dice = random.Random(4)
    prose = "".join(dice.choice("abcdefghij klmnop qrstu") for _ in range(60_000)).encode()
    whole, bad = quality.compression(prose, compressor)
    assert bad == 0
    whole, bad = quality.compression(prose + b"spam eggs " * 6000, compressor)
    assert bad > quality.MOST_BAD_CHUNKS


def test_random_text_behind_prose_is_found(spark):
    """Half-random documents and random letters of every kind; the prose alone stays."""
    dice = random.Random(5)
    some = ["an", "er", "in", "th", "o", "re", "st", "la", "u", "mi", "ble", "ing", "ou", "ti", "ne", "ha"]
    prose = " ".join("".join(dice.choices(some, k=dice.randrange(1, 5))) for _ in range(1600))[:8192]
    lower, upper, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"

    def noise(letters, size):
        return " ".join("".join(dice.choices(letters, k=70)) for _ in range(size // 71))

    texts = {"prose": prose, "long prose": prose + "\n" + " ".join(dice.sample(prose.split(), 800))}
    for share in (0.4, 0.5, 0.6):
        texts[f"base64 {share}"] = prose + "\n" + noise(lower + upper + digits + "+/", int(8192 * share / (1 - share)))
    for name, letters in (("lower", lower), ("mixed", lower + upper), ("alnum", lower + digits)):
        texts[name] = noise(letters, 30_000)
        texts[f"half {name}"] = prose + "\n" + noise(letters, 8192)
    texts["long"] = prose * 2 + "\n" + noise(lower + upper + digits + "+/", 60_000)
    docs = spark.createDataFrame(list(texts.items()), "doc_id string, text string")
    kept = {r.doc_id for r in quality.judge(docs).where("quality.kept").select("row.doc_id").collect()}
    assert kept == {"prose", "long prose"}


def test_scripts_of_several_bytes_keep_their_limits():
    dice = random.Random(6)
    signs = [chr(0x4E00 + dice.randrange(3000)) for _ in range(700)]
    text = " ".join("".join(dice.choices(signs, k=12)) for _ in range(600))
    compressor = zstandard.ZstdCompressor(level=3)
    whole, bad = quality.compression(text.encode(), compressor)
    assert 1.5 <= whole < quality.DOCUMENT_BANDS[-1].least
    assert bad == 0
    assert quality._judge([text.encode()], [""], {})["kept"] == [True]
