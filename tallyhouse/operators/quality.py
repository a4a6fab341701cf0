"""Data profile and constraint audits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions.scalar import number, rounded
from tallyhouse.operators.quantiles import exact_quantiles


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``(column_name, null_count)`` for the columns, counted in one pass."""
    columns = columns or df.columns
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "null_count")


def basic_stats(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum of the numeric columns.

    Mean, deviation and quartiles are given to four places. The quartiles are exact and are found in
    a few counted passes when this is called; the rest is one more pass.
    """
    columns = columns or [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    measures = {
        "value_count": F.count,
        "mean": lambda c: rounded(F.avg(c), 4),
        "stddev": lambda c: rounded(F.stddev_samp(c), 4),
        "min": lambda c: number(F.min(c)),
        "max": lambda c: number(F.max(c)),
    }
    totals = df.agg(*[F.struct(*[made(c).alias(name) for name, made in measures.items()]).alias(c) for c in columns])
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            *[F.col(c)[name].alias(name) for name in measures],
            *[rounded(F.lit(q).cast("double"), 4).alias(name) for q, name in zip(quartiles[c], ("q1", "median", "q3"))],
        )
        for c in columns
    ]
    return totals.select(F.inline(F.array(*rows)))


def audit_unique(df: DataFrame, *key: str) -> DataFrame:
    """Key values that occur more than once, with their number of rows."""
    return df.groupBy(*key).agg(F.count("*").alias("row_count")).filter("row_count > 1")


def audit_orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose key is set but has no parent."""
    keys = parent.select(F.col(parent_key or key).alias(key))
    return child.filter(F.col(key).isNotNull()).join(keys, key, "left_anti")


def audit_not_null(df: DataFrame, required: list[str]) -> DataFrame:
    """Required columns that hold NULLs, with how many."""
    return null_counts(df, required).filter("null_count > 0")


def repeated_keys(df: DataFrame, table: str, key: str) -> DataFrame:
    """One row: how many values of a key that should be unique occur more than once."""
    return audit_unique(df, key).agg(
        F.lit(table).alias("table_name"), F.lit(key).alias("key_name"), F.count("*").alias("repeated")
    )


def orphan_count(child: DataFrame, name: str, parent: DataFrame, parent_name: str, key: str) -> DataFrame:
    """One row: how many rows of a child table refer to no row of the parent table. Rows are
    counted by key before they meet the parent."""
    used = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("rows"))
    return audit_orphans(used, parent, key).agg(
        F.lit(name).alias("table_name"),
        F.lit(key).alias("key_name"),
        F.lit(parent_name).alias("parent_name"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("orphans"),
    )


def required_nulls(df: DataFrame, table: str, required: list[str]) -> DataFrame:
    """One row per required column: how many NULLs it holds."""
    return null_counts(df, required).select(F.lit(table).alias("table_name"), "column_name", "null_count")


def stacked(frames: list[DataFrame]) -> DataFrame:
    """All frames below each other."""
    return reduce(DataFrame.unionByName, frames)


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Fill columns that the frame does not have; a NULL that was given stays NULL."""
    missing: dict[str, Column] = {c: F.lit(v) for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df
