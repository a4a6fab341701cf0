"""The corpus pipeline: its stages in order, each over its predecessor's rows."""

import corpus_pipeline
from tallyhouse.llm import quality
from tests.llm.test_decontaminate import brute as brute_hits
from tests.llm.test_lines import brute as brute_lines
from tests.llm.test_mixing import words
from tests.llm.test_quality import brute_kept
from tests.llm.test_simhash import brute_groups_of_alike

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_equal_brute_force(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    before, frames = docs.collect(), {}
    for name, stage in corpus_pipeline.STAGES:
        path = f"{tmp_path}/{name}"
        stage(spark, docs, small).write.parquet(path)
        docs = spark.read.parquet(path)
        after = docs.collect()
        frames[name] = (before, after)
        if name != "mix_to_weights":
            assert docs.columns == COLUMNS
        before = after
    assert list(frames) == ["quality_rules", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "mix_to_weights"]

    before, after = frames["quality_rules"]
    known = quality.curves(spark.read.parquet(f"{small}/documents.parquet"))
    assert sorted(after) == sorted(r for r in before if brute_kept(r.text, r.lang, known))

    before, after = frames["line_dedup"]
    want = brute_lines([(r.doc_id, r.text, 0) for r in before])
    assert {r.doc_id: (r.text, r.n_chars) for r in after} == {
        r.doc_id: (want[(r.doc_id, r.text)][0], len(want[(r.doc_id, r.text)][0])) for r in before
    }

    before, after = frames["simhash_near_dedup"]
    kept = {r.doc_id for r in after}
    root = brute_groups_of_alike([r.text for r in before])
    groups = {}
    for i, r in enumerate(before):
        groups.setdefault(root[i], []).append(r.doc_id)
    assert kept == {min(g) for g in groups.values()}

    before, after = frames["benchmark_decontamination"]
    assert {r.doc_id for r in after} == {r.doc_id for r in before if not brute_hits(r.text, items)[-1]}

    before, after = frames["mix_to_weights"]
    size = sum(words(r.text) for r in before)
    assert abs(sum(words(r.text) for r in after) - size) < 0.2 * size
    assert {r.doc_id for r in after} <= {r.doc_id for r in before}
    assert sorted(set(after)) == sorted(after)  # each copy once


def test_run_equals_the_stages(spark, small):
    rows = corpus_pipeline.run(spark, small)
    assert rows.columns == [*COLUMNS, "copy"]
    assert rows.count() == len(set(map(tuple, rows.select("doc_id", "copy").collect())))


def test_empty_documents(spark, no_docs, small):
    docs = no_docs.select(*COLUMNS)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, small)
        assert docs.count() == 0
        docs = docs.select(*COLUMNS)


def test_awkward_documents(spark, edge_docs, small, tmp_path):
    docs = edge_docs.select(*COLUMNS)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, small).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    assert docs.count() > 0
