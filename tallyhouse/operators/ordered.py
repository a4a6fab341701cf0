"""Running totals, lags and global ranks over any number of rows.

A window without partitions puts all rows into one task. Here rows are ranged over partitions by
their order, sorted there and stored with their place. What a row needs from other partitions is
little: what all earlier ones hold together, and how far the first and the last key of its own
partition go on in its neighbours. Both come from one summary row per partition, and only those
rows meet an un-partitioned window. Equal keys are spread over partitions by a tie breaker, so one
value may be in any share of the rows.

NULL keys come first in ascending and last in descending order, as Spark sorts them. Without ties
shared, equal keys are added in an order that is fixed once the rows are stored.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.operators.keys import PLACES
from tallyhouse.sources.files import staged


class OrderedRows:
    """The rows of ``df`` in a global order.

    ``order`` names columns; a leading minus sorts that one downwards. Rows that agree in the first
    ``peers`` of them (in all, if it is not given) are ties. The rows are computed and stored when the
    object is made; every question reads them from the store.
    """

    def __init__(self, df: DataFrame, *order: str, peers: int | None = None, partitions: int | None = None):
        self.columns = df.columns
        keys = [F.col(c.lstrip("-")).alias(f"_k{i}") for i, c in enumerate(order)]
        self.sort = [F.desc(f"_k{i}") if c.startswith("-") else F.asc(f"_k{i}") for i, c in enumerate(order)]
        tied = df.select("*", *keys).withColumn("_tie", F.monotonically_increasing_id())
        spread = [partitions] if partitions else []
        ranged = tied.repartitionByRange(*spread, *self.sort, "_tie").sortWithinPartitions(*self.sort, "_tie")
        placed = staged(ranged.drop("_tie").withColumn("_at", F.monotonically_increasing_id()), "ordered")
        self.peers = peers or len(order)
        self.key = F.struct(*[f"_k{i}" for i in range(self.peers)])
        self.rows = placed.withColumns({"_part": F.floor(F.col("_at") / PLACES), "_place": F.pmod("_at", F.lit(PLACES))})

    @cached_property
    def _inside(self):
        """The window over the rows of one partition, by their place and by their keys."""
        own = Window.partitionBy("_part")
        return own.orderBy(*self.sort, "_place"), own.orderBy(*self.sort[: self.peers])

    def _summary(self, sums: list[str], last: list[str]) -> DataFrame:
        """One row per partition: what it holds, what all earlier ones hold, and what their ends share
        with its ends."""
        held = {"_rows": F.count(F.lit(1)), "_first": F.min_by(self.key, "_place"), "_last": F.max_by(self.key, "_place")}
        held |= {f"_sum_{c}": F.sum(c) for c in sums}
        held |= {f"_end_{c}": F.max_by(F.struct(c), "_place") for c in last}
        parts = self.rows.groupBy("_part").agg(*[made.alias(name) for name, made in held.items()])
        met = self.rows.join(parts.select("_part", "_first", "_last"), "_part")
        head, tail = self.key == F.col("_first"), self.key == F.col("_last")
        edges = {"_head": F.count_if(head), "_tail": F.count_if(tail)}
        edges |= {f"_head_{c}": F.sum(F.when(head, F.col(c))) for c in sums}
        ends = met.where(head | tail).groupBy("_part").agg(*[made.alias(name) for name, made in edges.items()])
        parts = parts.join(ends, "_part")

        earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        before = {"_before": F.coalesce(F.sum("_rows").over(earlier), F.lit(0))}
        before |= {f"_before_{c}": F.sum(f"_sum_{c}").over(earlier) for c in sums}
        before |= {f"_previous_{c}": F.lag(f"_end_{c}").over(Window.orderBy("_part")) for c in last}
        before |= {"_all": F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))}
        parts = parts.withColumns(before)

        # Partitions that end with one key, and those that begin with it, are neighbours. Rows of
        # the first key that lie before a partition, and of the last key that lie behind it:
        ending = Window.partitionBy("_last").orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        starting = Window.partitionBy("_first").orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        whole = F.col("_first") == F.col("_last")
        sizes = {"_head": "_after"} | {f"_head_{c}": f"_after_{c}" for c in sums}
        parts = parts.withColumns({"_tails": F.sum("_tail").over(ending)} | {f"_to{h}": F.sum(h).over(starting) for h in sizes})
        all_tails = parts.groupBy(F.col("_last").alias("_first")).agg(F.sum("_tail").alias("_all_tails"))
        all_heads = parts.groupBy(F.col("_first").alias("_last")).agg(*[F.sum(h).alias(f"_all{h}") for h in sizes])
        parts = parts.join(all_tails, "_first", "left").join(all_heads, "_last", "left")
        shared = {"_begun": F.coalesce(F.when(whole, F.col("_tails") - F.col("_tail")).otherwise(F.col("_all_tails")), F.lit(0))}
        for h, name in sizes.items():
            behind = F.when(whole, F.col(f"_all{h}") - F.coalesce(f"_to{h}", F.lit(0))).otherwise(F.col(f"_all{h}"))
            shared[name] = F.coalesce(behind, F.lit(0))
        kept = ["_part", "_first", "_last", "_all", "_before", "_begun", *sizes.values()]
        return parts.withColumns(shared).select(*kept, *[f"_before_{c}" for c in sums], *[f"_previous_{c}" for c in last])

    def with_columns(
        self,
        *,
        totals: Mapping[str, str] | None = None,
        row_totals: Mapping[str, str] | None = None,
        previous: Mapping[str, str] | None = None,
        row_number: str | None = None,
        rank: str | None = None,
        dense_rank: str | None = None,
        percent_rank: str | None = None,
        cume_dist: str | None = None,
    ) -> DataFrame:
        """The rows with the columns asked for.

        ``totals`` maps measures to running totals in which rows of equal key share one value (the
        default frame of SQL), ``row_totals`` to totals that add row by row, ``previous`` to the
        value of the row before. Sums skip NULLs and are NULL as long as there is nothing else;
        give whole numbers or decimals where they must not depend on the order of addition.
        """
        totals, row_totals, previous = dict(totals or {}), dict(row_totals or {}), dict(previous or {})
        sums = list(dict.fromkeys([*totals, *row_totals]))
        parts = self._summary(sums, list(previous))
        by_place, by_key = self._inside
        so_far = by_place.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        inner = {"_row": F.row_number().over(by_place), "_rank": F.rank().over(by_key)}
        inner |= {f"_run_{c}": F.sum(c).over(so_far) for c in row_totals}
        inner |= {f"_lag_{c}": F.lag(c).over(by_place) for c in previous}
        inner |= {f"_peers_{c}": F.sum(c).over(by_key) for c in totals}
        if cume_dist:
            inner["_through"] = F.count(F.lit(1)).over(by_key)
        if dense_rank:
            inner["_dense"] = F.dense_rank().over(by_key)
            parts = parts.join(self._different(parts), "_part")
        met = self.rows.withColumns(inner).join(parts, "_part")

        at_first, at_last = self.key == F.col("_first"), self.key == F.col("_last")
        place = F.col("_before") + F.col("_rank") - F.when(at_first, F.col("_begun")).otherwise(F.lit(0))
        made: dict[str, Column] = {}
        for c, name in totals.items():
            made[name] = _plus(F.col(f"_before_{c}"), F.col(f"_peers_{c}"), F.when(at_last & (F.col("_after") > 0), F.col(f"_after_{c}")))
        for c, name in row_totals.items():
            made[name] = _plus(F.col(f"_before_{c}"), F.col(f"_run_{c}"))
        for c, name in previous.items():
            made[name] = F.when(F.col("_row") == 1, F.col(f"_previous_{c}")[c]).otherwise(F.col(f"_lag_{c}"))
        if row_number:
            made[row_number] = F.col("_before") + F.col("_row")
        if rank:
            made[rank] = place
        if dense_rank:
            made[dense_rank] = F.col("_different") + F.col("_dense") - F.when(F.col("_begun") > 0, F.lit(1)).otherwise(F.lit(0))
        if percent_rank:
            made[percent_rank] = F.coalesce(F.try_divide((place - 1).cast("double"), F.col("_all") - 1), F.lit(0.0))
        if cume_dist:
            through = F.col("_before") + F.col("_through") + F.when(at_last, F.col("_after")).otherwise(F.lit(0))
            made[cume_dist] = through.cast("double") / F.col("_all")
        return met.select(*self.columns, *[value.alias(name) for name, value in made.items()])

    def _different(self, parts: DataFrame) -> DataFrame:
        """(_part, _different): keys that begin in earlier partitions. Each partition's keys are counted
        within it, and one that has begun before is not new."""
        keys = self.rows.groupBy("_part", self.key.alias("_key")).agg(F.lit(1).alias("_one"))
        counts = keys.groupBy("_part").agg(F.count("_one").alias("_keys")).join(parts.select("_part", "_begun"), "_part")
        new = F.col("_keys") - F.when(F.col("_begun") > 0, F.lit(1)).otherwise(F.lit(0))
        earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        return counts.select("_part", F.coalesce(F.sum(new).over(earlier), F.lit(0)).alias("_different"))


def _plus(*terms: Column) -> Column:
    """The sum of the terms that are not NULL; NULL if none is."""
    known = F.coalesce(*terms)
    total = sum((F.coalesce(t, F.lit(0)) for t in terms[1:]), F.coalesce(terms[0], F.lit(0)))
    return F.when(known.isNotNull(), total)
