"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import checkpointed


def _large_star(links: DataFrame) -> DataFrame:
    """Tie every larger neighbour of a node to the node's least neighbour."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return (
        both.where("b > a")
        .join(least, "a")
        .select(F.col("b").alias("a"), F.col("least").alias("b"))
        .where("a <> b")
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Tie every smaller neighbour of a node, and the node, to the least of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    tied = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b")
    return tied.union(least.select("a", F.col("least").alias("b"))).distinct()


def _state(links: DataFrame) -> tuple[int, int]:
    row = links.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1_000_000_007))), F.lit(0))
    ).first()
    return row[0], row[1]


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); component is its least node.

    Each round is a few joins on node ids with the lineage cut by a checkpoint; links, nodes and
    components stay distributed. The number of rounds grows with the logarithm of the longest
    chain. Links of a node to itself and repeated links do no harm.
    """
    links = checkpointed(links.select("a", "b").where("a <> b").distinct())
    before = _state(links)
    while True:
        links = checkpointed(_small_star(_large_star(links)))
        after = _state(links)
        if after == before:
            break
        before = after
    stars = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(stars.select(F.col("component").alias("node"), "component").distinct())
