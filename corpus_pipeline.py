"""A corpus pipeline of five operators, each stage over all that its predecessor kept.

Every stage takes NULLs in any column, empty and very long texts, ties, repeated rows and an empty
table, and reads no columns but those of ``documents``; what each of them does with such rows is said
below and, in full, where its operator is defined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import decontaminate, lines, mixing, quality, simhash
from tallyhouse.llm.common import stored
from tallyhouse.session import apply_settings
from tallyhouse.sources.tables import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the compression bands. NULL and empty texts go, repeated
    rows are judged alike."""
    return quality.passing(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the line chunks that stand in an earlier one; ``n_chars`` follows. No row
    goes; a NULL text stays NULL, and a text may end up empty."""
    return lines.deduplicated(docs).withColumn("n_chars", F.length("text").cast("bigint"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles are alike to 0.8 or more: the one with the
    least id, without copies. Texts without words are one group."""
    return simhash.one_of_each(docs, words=5, similarity=0.8)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with benchmark windows. Those without words are clean."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents as often as they are taken, with their size and copy number. NULL sources are
    one source, the last; documents without words are not taken."""
    mixed = mixing.mix(docs)
    return mixed.where("copies > 0").select(
        *[F.col(f"row.{c}").alias(c) for c in ("doc_id", "text", "lang", "source", "n_chars")],
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("copy"),
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mix_to_weights", mix_to_weights),
]

# Compression ratios and fingerprints have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the documents in turn, each result written and read again."""
    docs = table(apply_settings(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
