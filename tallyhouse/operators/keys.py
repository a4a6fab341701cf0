"""Surrogate keys without a global sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.sources.files import staged

PLACES = 1 << 33  # the lower part of a generated id counts the rows of a partition


def with_sequence_key(df: DataFrame, key: str, order: str, *more_order: str, after=0) -> DataFrame:
    """Number rows 1, 2, 3 ... in the order of ``order`` and ``more_order``.

    The same numbers as ``row_number()`` over one global window, but spread out: rows are ranged
    over partitions by their order, sorted there, and stored with their place. The un-partitioned
    window sees one row per partition, however the values are spread, and what a lost executor
    held is read again from the store. ``order`` with ``more_order`` must be unique per row;
    ``after`` (a number or a scalar column) is the last key already in use.
    """
    ranged = df.repartitionByRange(order, *more_order).sortWithinPartitions(order, *more_order)
    placed = staged(ranged.withColumn("_at", F.monotonically_increasing_id()), "sequence")
    part = F.floor(F.col("_at") / PLACES)
    placed = placed.withColumns({"_part": part, "_place": F.pmod("_at", F.lit(PLACES))})
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    after = after if not isinstance(after, int) else F.lit(after)
    number = F.col("_offset") + F.col("_place") + 1 + after
    return placed.join(offsets, "_part").select(number.cast("bigint").alias(key), *df.columns)
