import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import toxicity
from tallyhouse.sources.tables import table

BAD = ["vile", "rotten", "foulmouthed"]


def texts(n, seed):
    dice = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(n):
        body = [dice.choice(words) for _ in range(dice.randrange(5, 120))]
        label = int(i % 4 == 0)
        if label:
            body.insert(dice.randrange(len(body)), dice.choice(BAD))
        rows.append((i, " ".join(body), "en" if i % 3 else "de", label))
    return rows


@pytest.fixture(scope="module")
def learned(spark):
    rows = texts(600, 1)
    docs = spark.createDataFrame([(i, t, lang, "x") for i, t, lang, _ in rows], "doc_id bigint, text string, lang string, row string")
    labels = spark.createDataFrame([(i, x) for i, _, _, x in rows], "doc_id bigint, toxic int")
    return docs, labels, {i: x for i, _, _, x in rows}, toxicity.learn(docs, labels)


def test_held_out_accuracy(learned):
    docs, _, label, net = learned
    rows = toxicity.score(docs, net).select("row.doc_id", "score", "flagged").collect()
    late = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert 60 < len(late) < 200
    assert np.mean([(r.score >= 0.5) == bool(label[r.doc_id]) for r in late]) > 0.95
    assert np.mean([r.flagged == bool(label[r.doc_id]) for r in late]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_labels_are_never_read(spark, learned):
    docs, labels, label, net = learned
    turned = labels.selectExpr("doc_id", "if(pmod(crc32(cast(cast(doc_id as string) as binary)), 5) = 0, 1 - toxic, toxic) as toxic")
    other = toxicity.learn(docs, turned)
    assert np.array_equal(net.embedding, other.embedding) and net.thresholds == other.thresholds
    assert [r.h for r in docs.select(toxicity.held_out("doc_id").alias("h")).collect()] == [
        zlib.crc32(str(i).encode()) % 5 == 0 for i in range(600)
    ]


def test_query_on_held_out_labels(spark):
    """The registered query: its columns, its folds, and the ranking of labels that it has not read."""
    from tallyhouse.llm.queries import queries

    sf = "/root/testdata/sf0.01"
    made = queries()["op7_toxicity"](spark, sf)
    labels = table(spark, sf, "labels").select("doc_id", F.col("toxic").alias("label"))
    rows = made.join(labels, "doc_id").where("held_out").collect()
    assert made.count() == table(spark, sf, "documents").count()
    assert all(r.predicted == int(r.score >= 0.5) and zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    high, low = ([r.score for r in rows if r.label == x] for x in (1, 0))
    assert high and np.mean([a > b for a in high for b in low]) > 0.95


def test_given_labels(spark):
    """Ranking of held-out documents of the supplied tables."""
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    net = toxicity.learn(docs, labels)
    late = docs.join(labels, "doc_id").where(toxicity.held_out("doc_id"))
    rows = toxicity.score(late, net).select("row.toxic", "score").collect()
    order = np.argsort([r.score for r in rows])
    truth = np.array([r.toxic for r in rows])[order]
    ranks = np.arange(1, len(truth) + 1)
    auc = (ranks[truth == 1].sum() - truth.sum() * (truth.sum() + 1) / 2) / (truth.sum() * (1 - truth).sum())
    assert auc > 0.95


def test_edges(spark, learned, edge_docs, no_docs):
    net = learned[3]
    rows = toxicity.score(edge_docs, net).collect()
    assert len(rows) == edge_docs.count()
    by_text = {}
    for r in rows:
        assert 0 <= r.score <= 1 and r.flagged is not None
        by_text.setdefault(r.row.text or "", set()).add(r.score)
    assert all(len(s) == 1 for s in by_text.values())
    assert toxicity.score(no_docs, net).count() == 0


def test_a_text_scores_alike_alone_and_in_a_batch(learned):
    net = learned[3]
    parts = [toxicity.word_numbers(t.encode()) for t in ("", "vile", "w1 w2", "w3 rotten w4 " * 50)]
    together = net.scores(parts)
    alone = np.concatenate([net.scores([p]) for p in parts])
    assert np.allclose(together, alone)


@pytest.mark.parametrize("rows, share", [([], 0.0), ([(1, 0), (2, 0)], 0.0), ([(1, 1)], 1.0), ([(None, 1), (3, None)], 0.0)])
def test_labels_of_one_class(spark, edge_docs, rows, share):
    labels = spark.createDataFrame(rows, "doc_id bigint, toxic int")
    scores = {round(r.score, 6) for r in toxicity.score(edge_docs, toxicity.learn(edge_docs, labels)).collect()}
    assert scores == {share}


def test_every_label_is_learned_from_in_parts(spark):
    """Texts of several parts: words that only a few texts show are learned wherever those are."""
    rows = texts(3000, 2)
    docs = spark.createDataFrame([(i, t, lang) for i, t, lang, _ in rows], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(i, x) for i, _, _, x in rows], "doc_id bigint, toxic int")
    label = {i: x for i, _, _, x in rows}
    net = toxicity.learn(docs, labels, one_part=800)
    held = toxicity.score(docs, net).select("row.doc_id", "score", "flagged").where(toxicity.held_out("doc_id")).collect()
    high, low = ([r.score for r in held if label[r.doc_id] == x] for x in (1, 0))
    assert np.mean([a > b for a in high for b in low]) > 0.9 and set(net.thresholds) == {"en", "de"}
    early = [t for i, t, _, _ in rows if zlib.crc32(str(i).encode()) % 5]
    held_words = {n for t in early for n in toxicity.word_numbers(t.encode())[0].tolist()}
    assert np.mean([net.embedding[n].any() for n in held_words]) == 1.0
    again = toxicity.learn(docs, labels, one_part=800)
    assert np.array_equal(net.embedding, again.embedding) and net.thresholds == again.thresholds
