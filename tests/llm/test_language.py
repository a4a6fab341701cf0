import math
import random
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import language
from tallyhouse.llm.queries import queries
from tallyhouse.sources.tables import table


@pytest.fixture(scope="module")
def reader():
    return language.Reader()


def symbols(text):
    """Letters and marks, lower-cased, and single blanks (0) for what is between; none leads."""
    row = []
    for char in text:
        if unicodedata.category(char)[0] in "LM":
            point = ord(char.lower()[0])
            row.append(point if point < 4096 else 1 + point % 4095)
        elif row and row[-1]:
            row.append(0)
    return row


def windows(text):
    row = [0] * (language.ORDER - 1) + symbols(text)
    return [tuple(row[i : i + language.ORDER]) for i in range(len(row) - language.ORDER + 1)]


class KneserNey:
    """The textbook recursion over dictionaries of tuples."""

    def __init__(self, texts):
        self.counts = [Counter(w for t in texts for w in windows(t))]
        for _ in range(language.ORDER - 1):
            self.counts.append(Counter(gram[1:] for gram in self.counts[-1]))
        self.discounts = []
        for level in self.counts:
            times = Counter(level.values())
            self.discounts.append(times[1] / (times[1] + 2 * times[2]) if times[1] and times[2] else 0.75)

    def probability(self, gram, level=0):
        if level == language.ORDER:
            return 1 / 4096
        lower = self.probability(gram[1:], level + 1)
        own = {g: n for g, n in self.counts[level].items() if g[:-1] == gram[:-1]}
        if not own:
            return lower
        total, discount = sum(own.values()), self.discounts[level]
        share = own[gram] - discount if gram in own else 0
        return share / total + discount * len(own) / total * lower


def test_probabilities_are_kneser_ney(reader):
    dice = random.Random(4)
    texts = ["".join(dice.choice("aab c'é") for _ in range(60)) for _ in range(5)]
    grams, counts = np.unique(reader.grams(texts)[0], return_counts=True)
    model, truth = language.LanguageModel.of(grams, counts), KneserNey(texts)
    asked = "acab zéb"
    found = model.log_probabilities(reader.grams([asked])[0])
    assert np.allclose(found, [math.log(truth.probability(g)) for g in windows(asked)], rtol=1e-4)


def test_probabilities_sum_to_one(reader):
    grams, counts = np.unique(reader.grams(["the cat sat on the mat", "that hat"])[0], return_counts=True)
    model = language.LanguageModel.of(grams, counts)
    for text in ("th", "zzz", "a h"):
        context = reader.grams([text])[0][-1] << np.uint64(12) & np.uint64((1 << 60) - 1)
        every = context | np.arange(4096, dtype=np.uint64)
        assert np.exp(model.log_probabilities(every)).sum() == pytest.approx(1, abs=1e-5)


def test_grams(reader):
    texts = ["Ab, c", "", None or "", "!!", "é日本😀x", "ก็", "𠀀b"]
    grams, owner, lettered = reader.grams(texts)
    for i, text in enumerate(texts):
        packed = [sum(s << 12 * (4 - k) for k, s in enumerate(w)) for w in windows(text)]
        assert grams[owner == i].tolist() == packed
    assert lettered.tolist() == [True, False, False, False, True, True, True]


def test_long_texts_are_read_whole(reader, monkeypatch):
    made = language.Identifier({"x": language.LanguageModel.of(*np.unique(reader.grams(["ab ab ba"])[0], return_counts=True))})
    whole = made.entropies(["ab " * 50 + "zz " * 50], reader)[0][0, 0]
    monkeypatch.setattr(language, "BLOCK", 30)
    assert made.entropies(["ab " * 50 + "zz " * 50], reader)[0][0, 0] == pytest.approx(whole, rel=0.05)
    assert made.entropies(["ab " * 50], reader)[0][0, 0] < whole / 2


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries()["op13_language_id"](spark, sf).join(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id")
    late = rows.where("held_out").collect()
    assert len(late) > 150 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in late)
    assert np.mean([r.lang == r.lang_pred for r in late]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows.collect())


def test_counts_of_all_documents(spark, small, reader):
    docs = table(spark, small, "documents")
    expected = Counter()
    for r in docs.where(~language.held_out()).collect():
        expected.update((r.lang, sum(s << 12 * (4 - k) for k, s in enumerate(w))) for w in windows(r.text or ""))
    found = {(r.lang, r.gram): r.counted for r in language.gram_counts(docs).collect()}
    assert found == dict(expected)


def test_held_out_languages_are_never_read(spark, small):
    docs = table(spark, small, "documents")
    turned = docs.withColumn("lang", F.when(language.held_out(), F.lit("xx")).otherwise(F.col("lang")))
    one, other = language.learn(docs), language.learn(turned)
    assert list(one.models) == list(other.models) and one.limits == other.limits and one.sharpness == other.sharpness
    assert all(np.array_equal(a.grams, b.grams) for k in one.models for a, b in zip(one.models[k].levels, other.models[k].levels))


def test_noise_is_rejected(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    made = language.learn(docs)
    dice = random.Random(2)
    noise = ["".join(dice.choice("qxzjkvwyh ") for _ in range(300)) for _ in range(20)]
    strange = ["Ζώα και φυτά της μεσογείου και του κόσμου", "привет мир как дела сегодня", "日本語の文章です"]
    rows = language.identify(spark.createDataFrame([(t,) for t in noise + strange], "text string"), made).collect()
    assert all(r.rejected and r.lang in made.models for r in rows)
    assert language.identify(docs, made).where("rejected").count() < 0.02 * docs.count()


def test_awkward_documents(spark, edge_docs, no_docs):
    made = language.learn(edge_docs)
    assert set(made.models) <= {"en", "de", "fr"} and "en" in made.models
    rows = language.identify(edge_docs, made).select("row.doc_id", "row.text", "lang", "score", "rejected", "cross_entropy").collect()
    assert len(rows) == 13
    for r in rows:
        blank = not r.text or not any(c.isalpha() for c in r.text)
        assert (r.lang == "und") == blank and (r.cross_entropy is None) == blank
        assert 0 <= r.score <= 1 and (not blank or r.rejected and r.score == 0)
    nothing = language.learn(no_docs)
    assert nothing.models == {} and language.identify(no_docs, nothing).count() == 0
    assert {(r.lang, r.score, r.rejected) for r in language.identify(edge_docs, nothing).collect()} == {("und", 0.0, True)}


def test_bound_of_the_models(spark, small):
    made = language.learn(table(spark, small, "documents"), model_grams=1000)
    sizes = [len(m.levels[-1].grams) for m in made.models.values()]
    assert sum(sizes) == 1000 and max(sizes) - min(sizes) <= 1


def test_grams_beyond_the_models_are_not_lost(spark, small):
    """With models that hold 400 grams the answers are those of models that hold all of them."""
    docs = table(spark, small, "documents").limit(60).select("doc_id", "text", "lang")
    docs = docs.union(docs.limit(2)).union(spark.createDataFrame([(-1, None, "en"), (-2, "!!", "en"), (-3, "xq " * 30, None)], docs.schema))
    docs = docs.localCheckpoint()
    whole, bounded = language.learn(docs), language.learn(docs, model_grams=400)
    assert list(whole.models) == list(bounded.models) and whole.counts is None and bounded.counts is not None
    assert sum(len(m.levels[-1].grams) for m in bounded.models.values()) == 400
    assert bounded.sharpness == whole.sharpness and bounded.least_score == pytest.approx(whole.least_score, rel=1e-4)
    one, other = (
        sorted(language.identify(docs, made).select("row.doc_id", "lang", "rejected", "score", "cross_entropy").collect(), key=str)
        for made in (whole, bounded)
    )
    assert [r[:3] for r in one] == [r[:3] for r in other] and len(one) == len(other) == docs.count()
    for a, b in zip(one, other):
        assert (a.cross_entropy is None) == (b.cross_entropy is None)
        assert a.cross_entropy is None or a.cross_entropy == pytest.approx(b.cross_entropy, rel=1e-4)
        assert a.score == pytest.approx(b.score, abs=1e-3)
