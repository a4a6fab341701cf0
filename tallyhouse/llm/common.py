"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.session import fresh_path, shared_folder

# The six white-space characters that end a word, as bytes and as a pattern.
BLANKS = b" \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column | str) -> Column:
    """A-Z to a-z; every other character stays as it is."""
    return F.translate(text, UPPER, LOWER)


def word_count(text: Column | str) -> Column:
    """Number of words of a text; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def packed(df: DataFrame, **columns: Column) -> DataFrame:
    """All columns of ``df`` as one struct ``row`` beside computed columns.

    Names of the computed columns cannot clash with names in the data.
    """
    return df.select(F.struct("*").alias("row"), *[c.alias(name) for name, c in columns.items()])


def text_udf(function: Callable[[Iterable[bytes]], dict[str, list]], schema: pa.StructType, ddl: str) -> Callable:
    """An Arrow function of a text column: ``function`` gets the UTF-8 bytes of the texts (NULL: empty).

    Arrow hands over some thousand rows or 64 MB at a time. The result is a struct column.
    It is marked as not repeatable so that a filter on it does not run it a second time.
    """

    def run(texts: pa.Array) -> pa.Array:
        made = function([x or b"" for x in texts.cast(pa.binary()).to_pylist()])
        return pa.StructArray.from_arrays(
            [pa.array(made[f.name], f.type) for f in schema], fields=list(schema)
        )

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, ddl).asNondeterministic()


@contextmanager
def _no_shuffle_left(spark: SparkSession) -> Iterator[None]:
    """Frames made and run within leave no shuffle files; otherwise these stay until the driver collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    with _no_shuffle_left(df.sparkSession):
        return df.select("*").checkpoint()


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder once and read back; later steps read the files."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int, limit: int = 100_000) -> DataFrame:
    """Broadcast a side whose counted rows are within ``limit``; beyond it Spark plans the join."""
    return F.broadcast(df) if rows <= limit else df
