"""Top-k, ranks, growth and running totals.

A window without partitions, or one partitioned by a few categories, puts many
rows into one task. These helpers avoid that: cut to k rows first, compare
groups through a join with their small totals, and give an un-partitioned
window only rows that are bounded by the calendar.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions.scalar import percent_change


def top_k(df: DataFrame, measure: str, k: int, *ties: str) -> DataFrame:
    """The k rows with the largest ``measure``; ``ties`` settle equal ones, so runs agree."""
    return df.orderBy(F.desc(measure), *ties).limit(k)


def ranked_top_k(df: DataFrame, measure: str, k: int, rank: str, *ties: str) -> DataFrame:
    """Top k with a global rank column. Only the k kept rows reach the un-partitioned window."""
    order = Window.orderBy(F.desc(measure), *ties)
    return top_k(df, measure, k, *ties).withColumn(rank, F.row_number().over(order))


def top_per_group(
    df: DataFrame, group: str | Sequence[str], measure: str, k: int, rank: str, *ties: str
) -> DataFrame:
    """The k largest rows of every group. Spark keeps at most k rows per group and task
    before the shuffle (WindowGroupLimit), so a group of any size is safe."""
    keys = [group] if isinstance(group, str) else list(group)
    order = Window.partitionBy(*keys).orderBy(F.desc(measure), *ties)
    return df.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) <= k)


def with_group_totals(df: DataFrame, group: str, totals: Mapping[str, Column]) -> DataFrame:
    """Add totals of the row's group to every row.

    This is ``agg(...).over(partitionBy(group))`` without collecting a group in one task:
    the totals are aggregated on both sides of the shuffle and joined back. AQE broadcasts
    them when they measure small, and splits a hot group otherwise.
    """
    return df.join(df.groupBy(group).agg(*[c.alias(n) for n, c in totals.items()]), group)


def with_growth(df: DataFrame, order: Sequence[str], measures: Mapping[str, tuple[str, str | None, str]]) -> DataFrame:
    """Compare each period with the one before it.

    ``measures`` maps a column to the names of its previous value, its difference
    (``None``: leave out) and its percentage. ``df`` holds one row per period.
    """
    window = Window.orderBy(*order)
    for measure, (previous, difference, percent) in measures.items():
        df = df.withColumn(previous, F.lag(measure, 1).over(window))
        if difference:
            df = df.withColumn(difference, F.col(measure) - F.col(previous))
        df = df.withColumn(percent, percent_change(measure, previous))
    return df


def with_running_totals(
    df: DataFrame, order: Sequence[str], totals: Mapping[str, str], ties_share: bool = True
) -> DataFrame:
    """Add running totals over one row per period.

    ``ties_share`` is the default frame of SQL (rows with an equal order key share a
    total); without it rows are added one by one.
    """
    window = Window.orderBy(*order)
    if not ties_share:
        window = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({name: F.sum(measure).over(window) for measure, name in totals.items()})
