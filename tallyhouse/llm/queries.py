"""The registered queries of the corpus operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import (
    collocations, decontaminate, fill_middle, language, lines, mixing, quality, simhash, suffixes, token_rollup, toxicity, urls, warc,
)
from tallyhouse.session import apply_settings, fresh_path
from tallyhouse.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]

# The rules that the URL query applies.
URL_RULES = (
    urls.Rule("block", "net", "/"),
    urls.Rule("allow", "example.net", "/en/"),
    urls.Rule("block", "example.com", "/de/"),
    urls.Rule("allow", "org", "/fr/"),
)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.linked_within(_documents(spark, sf_dir))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and the compression verdict of every document."""
    judged = quality.judge(_documents(spark, sf_dir).select("doc_id", "text", "lang"))
    return judged.select("row.doc_id", "quality.*")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive every page, then read all records back by the index."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    folder = warc.archive_folder(spark)
    index = warc.write(pages, folder)
    return warc.read(index, folder).select(
        F.col("id").cast("bigint").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("bigint").alias("refers_to"),
    )


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its repeated chunks of lines."""
    made = lines.remove_repeated_chunks(_documents(spark, sf_dir).select("doc_id", "text"))
    return made.select(
        "row.doc_id",
        "n_lines",
        "n_removed_lines",
        "n_removed_chunks",
        F.coalesce(F.length("kept_text"), F.lit(0)).cast("bigint").alias("kept_chars"),
        F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"),
    )


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie inside benchmark windows."""
    found = decontaminate.scan(_documents(spark, sf_dir).select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("row.doc_id", "hits.n_words", "hits.n_hit", "hits.n_items", "hits.items_sha256", "hits.contaminated")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its repeated 400-byte strings."""
    made = suffixes.without_repeats(_documents(spark, sf_dir).select("doc_id", "text"), with_text=False)
    return made.select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from the labels that are not held out."""
    docs = _documents(spark, sf_dir).select("doc_id", "text", "lang")
    net = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, net).select(
        "row.doc_id",
        toxicity.held_out("row.doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "flagged",
    )


TOKENIZERS = (
    token_rollup.Tokenizer("words-1"),
    token_rollup.Tokenizer("byte_bpe_50k-1", f"{token_rollup.TOKENIZER_FOLDER}/byte_bpe_50k.tiktoken"),
)


def op8_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after three batches: all documents loaded, texts with long numbers (telephones, cards,
    keys) revised to masked ones, and documents labelled toxic deleted. The last arrives twice."""
    docs = _documents(spark, sf_dir).select(F.col("doc_id").alias("id"), "source", "lang", "text")
    loaded = docs.select(F.lit("insert").alias("op"), "*")
    masked = F.regexp_replace("text", "[0-9]{4,}", "0000")
    revised = docs.where(masked != F.col("text")).select(F.lit("revise").alias("op"), "id", "source", "lang", masked.alias("text"))
    nothing = F.lit(None).cast("string")
    deleted = (
        table(spark, sf_dir, "labels").where("toxic = 1")
        .select(F.lit("delete").alias("op"), F.col("doc_id").alias("id"), *[nothing.alias(c) for c in ("source", "lang", "text")])
    )
    rollup = token_rollup.Rollup(spark, fresh_path(spark, "token-rollup"), TOKENIZERS)
    for batch, changes in (("1-load", loaded), ("2-masked", revised), ("3-toxic", deleted), ("3-toxic", deleted)):
        rollup.commit(batch, changes)
    return rollup.totals()


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    mixed = mixing.mix(_documents(spark, sf_dir).select("doc_id", "text", "source"))
    return mixed.select("row.doc_id", "row.source", "size", "source_size", "target", "taken")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's URL."""
    judged = urls.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("row.page_id", "host", "path", "rule", "verdict", "template", "block_rate")


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's cuts, and digests of what was made of it and of what is made of that again."""
    turned = fill_middle.transform(_documents(spark, sf_dir).select("doc_id", "text"))
    return turned.select(
        "row.doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(), 256).alias("restored_sha256"),
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The phrases of two and three words that stand together most firmly, by language."""
    return collocations.collocations(_documents(spark, sf_dir).select("text", "lang"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    docs = _documents(spark, sf_dir).select("doc_id", "text", "lang")
    found = language.identify(docs, language.learn(docs))
    return found.select(
        "row.doc_id",
        language.held_out("row.doc_id").alias("held_out"),
        F.col("lang").alias("lang_pred"),
        "score",
        "cross_entropy",
        "rejected",
    )


_REGISTERED: dict[str, Query] = {
    "op1_simhash": op1_simhash,
    "op2_quality_rules": op2_quality_rules,
    "op3_warc": op3_warc,
    "op4_line_dedup": op4_line_dedup,
    "op5_decontaminate": op5_decontaminate,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_toxicity": op7_toxicity,
    "op8_token_rollup": op8_token_rollup,
    "op9_mix_sources": op9_mix_sources,
    "op10_url_filter": op10_url_filter,
    "op11_fill_middle": op11_fill_middle,
    "op12_collocations": op12_collocations,
    "op13_language_id": op13_language_id,
}


# Its seven Bloom filters do not fit into a driver of 1.5 GB together.
_WITHOUT_BLOOM_FILTERS = {"op6_suffix_dedup"}


def queries() -> dict[str, Query]:
    """Name → query."""

    def over(name: str, query: Query) -> Query:
        return lambda spark, sf_dir: query(apply_settings(spark, bloom_filters=name not in _WITHOUT_BLOOM_FILTERS), sf_dir)

    return {name: over(name, query) for name, query in _REGISTERED.items()}
