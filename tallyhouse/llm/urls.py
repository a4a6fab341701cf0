"""URL filter: rules first, then a tree of path templates learned per host.

Template tree. The path of a URL is cut into segments; digits in a segment are written ``#``.
Per host the segments form a tree whose levels are worked from the root down:

* a node whose children are mostly different values holds variable segments, and they become
  one wildcard child;
* children that carry labels and whose labelled block rates do not differ from the pooled rate
  of their labelled siblings by more than ``Z`` standard errors are one branch, too.

Segments below ``DEPTH`` are one tail, which is worked as the last level. A template is rejected when its
smoothed block rate over labelled URLs is at least ``REJECT``. The labels are the decisions of
the rules (and any ``label`` column given); URLs under a template that no rule reaches inherit
its purity. A template without labels is allowed.

Only counts per (host, segments) pass the shuffle, after partial sums in the tasks: a host with
a third of all URLs costs as many rows as it has templates. All steps are Spark functions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import checkpointed, lower_ascii, packed

DEPTH = 4
VARIABLE_LEAST = 8  # URLs below a node before its children can be called variable
VARIABLE_SHARE = 0.5  # different children per URL from which they are
Z = 2.0
SMOOTHING = 2.0  # pseudo-counts, half of them on each side
REJECT = 0.8
WILD = "*"


@dataclass(frozen=True)
class Rule:
    """Block or allow a host, its subdomains, and paths that start with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column | str) -> Column:
    """Lower-cased host: behind the first ``://`` up to ``/``, ``?``, ``#`` or the end."""
    return lower_ascii(F.regexp_extract(_behind_scheme(url), r"^[^/?#]*", 0))


def path_of(url: Column | str) -> Column:
    """Path up to ``?``, ``#`` or the end; empty without a scheme."""
    return F.regexp_extract(_behind_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _behind_scheme(url: Column | str) -> Column:
    url = F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit(""))
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def _fits(rule: Rule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))


def _first_fit(rules: Sequence[Rule], host: Column, path: Column, part: str) -> Column:
    """Name or verdict of the longest rule that fits, else NULL."""
    chosen = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):  # the longest is tried first
        chosen = F.when(_fits(rule, host, path), F.lit(getattr(rule, part))).otherwise(chosen)
    return chosen


def _segments(path: Column) -> Column:
    """Segments of a path with digits as ``#``; those below ``DEPTH`` joined to one tail."""
    parts = F.split(F.regexp_replace(F.regexp_replace(path, "^/", ""), "[0-9]+", "#"), "/", -1)
    head = F.slice(parts, 1, DEPTH)
    tail = F.array_join(F.slice(parts, DEPTH + 1, 1_000_000), "/")
    return F.when(F.size(parts) > DEPTH, F.concat(head, F.array(tail))).otherwise(head)


def _level(shapes: DataFrame, depth: int) -> DataFrame:
    """Work one level of the tree: replace segment ``depth`` of the template where it generalises."""
    node = ["host", "node"]
    at = shapes.withColumn("node", F.array_join(F.slice("template", 1, depth), "/")).withColumn(
        "child", F.when(F.size("template") > depth, F.element_at("template", depth + 1))
    )
    here = at.where("child is not null")
    children = here.groupBy(*node, "child").agg(
        F.sum("urls").alias("urls"), F.sum("blocked").alias("blocked"), F.sum("labelled").alias("labelled")
    )
    parents = children.groupBy(*node).agg(
        F.sum("urls").alias("all_urls"),
        F.count(F.lit(1)).alias("different"),
        F.sum(F.when(F.col("labelled") > 0, 1).otherwise(0)).alias("with_labels"),
        F.sum("blocked").alias("all_blocked"),
        F.sum("labelled").alias("all_labelled"),
    )
    variable = (F.col("all_urls") >= VARIABLE_LEAST) & (F.col("different") >= VARIABLE_SHARE * F.col("all_urls"))
    pooled = F.try_divide("all_blocked", "all_labelled")
    error = F.sqrt(F.try_divide(pooled * (1 - pooled), F.col("labelled")))
    rate = F.try_divide("blocked", "labelled")  # NULL without labels
    similar = (F.col("with_labels") > 1) & (F.abs(rate - pooled) <= Z * error)
    decided = children.join(parents, node).select(
        *node, "child", F.when(variable | similar, F.lit(WILD)).otherwise(F.col("child")).alias("becomes")
    )
    replaced = F.concat(
        F.slice("template", 1, depth), F.array("becomes"), F.slice("template", depth + 2, DEPTH + 2)
    )
    return (
        at.join(decided, [*node, "child"], "left")
        .withColumn("template", F.when(F.col("becomes").isNotNull(), replaced).otherwise(F.col("template")))
        .drop("node", "child", "becomes")
    )


def templates(urls: DataFrame) -> DataFrame:
    """Template and verdict per (host, segments) from rows (host, segments, label).

    ``label`` is ``block``, ``allow`` or NULL.
    """
    shapes = urls.groupBy("host", "segments").agg(
        F.count(F.lit(1)).alias("urls"),
        F.sum(F.when(F.col("label") == "block", 1).otherwise(0)).alias("blocked"),
        F.count("label").alias("labelled"),
    )
    shapes = shapes.withColumn("template", F.col("segments"))
    shapes = checkpointed(shapes)  # each level reads the one above it several times
    for depth in range(DEPTH + 1):
        shapes = checkpointed(_level(shapes, depth))
    shapes = shapes.withColumn("template", F.array_join("template", "/"))
    totals = shapes.groupBy("host", "template").agg(
        F.sum("blocked").alias("blocked"), F.sum("labelled").alias("labelled")
    )
    purity = (F.col("blocked") + SMOOTHING / 2) / (F.col("labelled") + SMOOTHING)
    return shapes.select("host", "segments", "template").join(
        totals.select("host", "template", purity.alias("block_rate")), ["host", "template"]
    )


def filter_urls(
    pages: DataFrame, rules: Sequence[Rule], *, url_col: str = "url", label_col: str | None = None
) -> DataFrame:
    """Every row of ``pages`` as struct ``row`` with host, path, rule, template, block_rate, verdict.

    The table may be empty, and URLs of any length are read whole. A NULL url, or one without ``://``, has an empty host and path; such rows share one template
    and are allowed unless labelled otherwise. Repeated rows are judged alike. ``label_col`` may
    name a column with further ``block``/``allow`` labels; rules go before it.
    """
    rows = packed(pages, host=host_of(url_col), path=path_of(url_col), given=F.col(label_col) if label_col else F.lit(None).cast("string"))
    host, path = F.col("host"), F.col("path")
    rows = rows.select(
        "row", "host", "path",
        _first_fit(rules, host, path, "name").alias("rule"),
        _first_fit(rules, host, path, "verdict").alias("ruled"),
        _segments(path).alias("segments"),
        "given",
    )
    learned = templates(rows.select("host", "segments", F.coalesce("ruled", "given").alias("label")))
    # An inner join would lose nothing either, every shape is there; left keeps the plan free to split the large side.
    return rows.join(learned, ["host", "segments"], "left").select(
        "row", "host", "path", "rule", "template", "block_rate",
        F.coalesce("ruled", F.when(F.col("block_rate") >= REJECT, "block").otherwise("allow")).alias("verdict"),
    )


def allowed(pages: DataFrame, rules: Sequence[Rule], *, url_col: str = "url") -> DataFrame:
    """The rows of ``pages`` whose URL is allowed, with their own columns."""
    return filter_urls(pages, rules, url_col=url_col).where("verdict = 'allow'").select("row.*")
