"""Mix sources to target weights by capped water-filling.

Every source gets words in proportion to its weight. A source whose share is above
``max_epochs`` times its own size is clamped there, and what it cannot use is shared among
the others by weight, until no share is above its cap. A share of 2.3 times a source's size
means every document twice and a seeded three tenths of the documents once more.

The three tenths are chosen by a seeded hash of the document id that puts each document into
one of ``BINS`` bins. Documents are stratified by size class; going from the largest class to
the smallest, each class takes its first bins up to its part of the target and hands what is
missing or too much to the next one. The difference that remains is that of one bin of the
smallest class, at any corpus size.

Only sums per (source, size class, bin) leave the tasks, so a source that holds a third of all
rows costs no more than any other. One row per source reaches the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import packed, small_side, stored, word_count

BINS = 4096


def water_fill(
    sizes: Mapping[str | None, int],
    weights: Mapping[str | None, float],
    total: float,
    max_epochs: float,
) -> dict[str | None, float]:
    """Target per source: by weight, at most ``max_epochs`` times its size, adding up to ``total``.

    A source with no words gets 0. If all sources are clamped the sum stays below ``total``.
    """
    caps = {s: float(max_epochs * n) for s, n in sizes.items()}
    open_sources = [s for s in sizes if sizes[s] > 0 and weights[s] > 0]
    target = {s: 0.0 for s in sizes}
    left = float(total)
    while open_sources:
        weight = sum(weights[s] for s in open_sources)
        share = {s: left * weights[s] / weight for s in open_sources}
        above = [s for s in open_sources if share[s] > caps[s]]
        if not above:
            target.update(share)
            break
        for s in above:
            target[s] = caps[s]
            left -= caps[s]
        open_sources = [s for s in open_sources if s not in above]
    return target


def cycled_weights(sources: Sequence[str | None], cycle: Sequence[float]) -> dict[str | None, float]:
    """The weights of ``cycle`` in turn over the sources by code point, NULL last."""
    ordered = sorted((s for s in sources if s is not None)) + [s for s in sources if s is None]
    return {s: cycle[i % len(cycle)] for i, s in enumerate(ordered)}


def _cuts(bins: pd.DataFrame) -> pd.DataFrame:
    """Per size class of one source, the number of leading bins that are taken once more."""
    wanted = bins["fraction"].iloc[0]
    taken, seen, rows = 0.0, 0, []
    for size_class, part in sorted(bins.groupby("size_class"), key=lambda x: -x[0]):
        part = part.sort_values("bin")
        running = part["words"].cumsum().to_numpy()
        seen += int(running[-1])
        goal = wanted * seen - taken
        at = int(running.searchsorted(goal, side="right"))
        if at < len(running) and running[at] - goal < goal - (running[at - 1] if at else 0):
            at += 1
        cut = int(part["bin"].iloc[at - 1]) + 1 if at else 0
        taken += float(running[at - 1]) if at else 0.0
        rows.append((bins["source_key"].iloc[0], int(size_class), cut))
    return pd.DataFrame(rows, columns=["source_key", "size_class", "cut"])


def _source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Mapping[str | None, float] | Sequence[float] = (1, 2, 3),
    share_of_total: float = 1.0,
    max_epochs: float = 3,
    seed: int = 17,
) -> DataFrame:
    """Every row of ``docs`` as struct ``row`` with size, source_size, target, copies, taken.

    ``weights`` maps sources to weights, or is a cycle dealt over the sources by code point
    (NULL last). ``copies`` is how often the mix takes the document, ``taken`` its words in the
    mix. NULL and empty texts have size 0 and take 0 words. A NULL source is a source of its
    own. Rows with the same id share one bin, so repeated rows are taken alike; rows without an
    id are dealt by their text. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    spread = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("text "), F.col(text_col)), F.lit("none"))
    sized = packed(
        docs,
        source_key=_source_key(F.col(source_col).cast("string")),
        size=word_count(text_col),
        bin=F.pmod(F.xxhash64(F.lit(seed), spread), F.lit(BINS)).cast("int"),
    ).withColumn("size_class", F.when(F.col("size") > 0, F.floor(F.log2("size"))).otherwise(-1).cast("int"))

    per_bin = sized.groupBy("source_key", "size_class", "bin").agg(F.sum("size").alias("words"))
    per_bin = stored(per_bin, "mix-bins")  # read for the totals and for the cuts
    totals = {
        (r["source_key"][1:] if r["source_key"] else None): int(r["words"])
        for r in per_bin.groupBy("source_key").agg(F.sum("words").alias("words")).collect()
    }
    if not isinstance(weights, Mapping):
        weights = cycled_weights(list(totals), weights)
    target = water_fill(totals, weights, share_of_total * sum(totals.values()), max_epochs)

    plan = []
    for source, size in totals.items():
        epochs = target[source] / size if size else 0.0
        whole = int(epochs)
        plan.append(("" if source is None else "=" + source, size, float(target[source]), whole, epochs - whole))
    plan = spark.createDataFrame(
        plan, "source_key string, source_size bigint, target double, whole int, fraction double"
    )
    plan = small_side(plan, len(totals))
    cuts = (
        per_bin.where("size_class >= 0")
        .join(plan.select("source_key", "fraction"), "source_key")
        .groupBy("source_key")
        .applyInPandas(_cuts, "source_key string, size_class int, cut int")
    )
    # One row per source and size class, of which there are at most 64.
    cuts = small_side(cuts, 64 * len(totals))
    return (
        sized.join(plan.drop("fraction"), "source_key", "left")
        .join(cuts, ["source_key", "size_class"], "left")
        .withColumn("copies", F.when(F.col("size") > 0, F.col("whole") + F.when(F.col("bin") < F.col("cut"), 1).otherwise(0)).otherwise(0))
        .select(
            "row", "size", "source_size", "target", F.col("copies").cast("bigint").alias("copies"),
            (F.col("size") * F.col("copies")).cast("bigint").alias("taken"),
        )
    )


def sampled(mixed: DataFrame) -> DataFrame:
    """The mix itself: each document as often as it is taken, with ``copy`` counting from 1."""
    return (
        mixed.where("copies > 0")
        .select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
        .select("row.*", "copy")
    )
