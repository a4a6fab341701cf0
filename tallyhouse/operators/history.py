"""Slowly changing dimensions of types 1, 2 and 3, in batches.

A change is ``(customer_id, new_tier, effective_date)``. A batch may hold many
changes per customer, also the same one several times; there is at most one per
customer and day to apply, which bounds the lists below by the calendar.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.calendar import OPEN_END
from tallyhouse.operators.keys import with_sequence_key
from tallyhouse.sources.files import staged

_CHANGE = ("customer_id", "new_tier", "effective_date")


def _asked(dim: DataFrame, changes: DataFrame) -> DataFrame:
    """One row per known customer and day: the tier asked for, the version it meets, and why the
    day's changes cannot be applied (NULL if they can). The same change given twice is one."""
    days = changes.groupBy("customer_id", "effective_date").agg(
        F.min("new_tier").alias("new_tier"), (F.min("new_tier") != F.max("new_tier")).alias("_differ")
    )
    held = dim.filter("is_current").select("customer_id", F.col("valid_from").alias("_since"))
    reason = F.when(F.col("_differ"), "several tiers on one date").when(
        F.col("effective_date") <= F.col("_since"), "not after the current version"
    )
    return days.join(held, "customer_id").withColumn("reason", reason)


def rejected_changes(dim: DataFrame, changes: DataFrame) -> DataFrame:
    """Changes that no type applies: two tiers on one day, or not later than the current version."""
    refused = _asked(dim, changes).filter("reason is not null").select("customer_id", "effective_date", "reason")
    return changes.join(refused, ["customer_id", "effective_date"]).select(*_CHANGE, "reason")


def _lists(changes: DataFrame) -> DataFrame:
    """The changes of each customer in a list by date, at most one element per day; ``tiers`` is the
    one tier asked for on that day, or NULL."""
    days = changes.groupBy("customer_id", "effective_date").agg(
        F.when(F.min("new_tier") == F.max("new_tier"), F.min("new_tier")).alias("tier")
    )
    return days.groupBy("customer_id").agg(
        F.sort_array(F.collect_list(F.struct(F.col("effective_date").alias("day"), "tier"))).alias("_asked")
    )


def _applied(dim: DataFrame, changes: DataFrame) -> DataFrame:
    """The dimension with ``_steps``: the changes that take effect on a current version, by date.

    The changes are grouped by customer and met once by the dimension. What is not later than the
    version or ambiguous is left out, and so is a step to the tier already held.
    """
    met = dim.join(_lists(changes), "customer_id", "left")
    usable = F.filter(
        F.coalesce("_asked", F.array().cast("array<struct<day: date, tier: string>>")),
        lambda c: F.col("is_current") & (c["day"] > F.col("valid_from")) & c["tier"].isNotNull(),
    )
    met = met.withColumn("_usable", usable)
    held = lambda i: F.when(i == 0, F.col("customer_tier")).otherwise(F.get("_usable", i - 1)["tier"])
    return met.withColumn("_steps", F.filter("_usable", lambda c, i: ~c["tier"].eqNullSafe(held(i)))).drop("_asked", "_usable")


def scd2_apply(dim: DataFrame, changes: DataFrame, last_key: int | None = None) -> DataFrame:
    """The dimension after a batch of tier changes: closed versions, new versions, the rest.

    ``last_key`` is the last key in use, if ``dim`` is a part of a dimension.

    One join by customer and no window: a current version and its steps make the list of its
    versions, which is unfolded. The outcome is stored, and only the added versions are numbered.
    A change to an unknown customer, or to the tier already held, does nothing; see
    ``rejected_changes``.
    """

    def version(place, tier, since, key):
        following = F.get("_steps", place)["day"]
        return F.struct(
            key.alias("_key"), tier.alias("_tier"), since.alias("_since"),
            F.when(following.isNull() & (place == 0), F.col("valid_to"))
            .otherwise(F.coalesce(F.date_sub(following, 1), F.lit(OPEN_END))).alias("_until"),
            (F.col("is_current") & following.isNull()).alias("_open"),
        )

    base = version(F.lit(0), F.col("customer_tier"), F.col("valid_from"), F.col("customer_key"))
    steps = F.transform("_steps", lambda c, i: version(i + 1, c["tier"], c["day"], F.lit(None).cast("bigint")))
    kind = "array<struct<_key: bigint, _tier: string, _since: date, _until: date, _open: boolean>>"
    unfolded = _applied(dim, changes).select("*", F.inline(F.concat(F.array(base).cast(kind), steps.cast(kind))))
    renamed = {
        "customer_key": "_key", "customer_tier": "_tier", "valid_from": "_since", "valid_to": "_until", "is_current": "_open",
    }
    versions = staged(unfolded.select(*[F.col(renamed.get(c, c)).alias(c) for c in dim.columns]), "versions")
    last_key = versions.agg(F.max("customer_key")).scalar() if last_key is None else last_key
    added = versions.filter("customer_key is null").drop("customer_key")
    added = with_sequence_key(added, "customer_key", "customer_id", "valid_from", after=last_key)
    return versions.filter("customer_key is not null").unionByName(added)


def scd1_apply(dim: DataFrame, changes: DataFrame) -> DataFrame:
    """Current customers with the tier overwritten by the latest change; no history. The changes
    that type 2 refuses are refused here, too."""
    last = F.element_at("_steps", -1)["tier"]
    current_rows = _applied(dim.filter("is_current"), changes)
    latest = F.when(F.size("_steps") > 0, last).otherwise(F.col("customer_tier"))
    return current_rows.withColumn("customer_tier", latest).select(*dim.columns)


def scd3_apply(dim: DataFrame, changes: DataFrame) -> DataFrame:
    """Like type 1, keeping the replaced tier in ``previous_tier`` (NULL where nothing changed)."""
    renamed = scd1_apply(dim.withColumn("_old", F.col("customer_tier")), changes)
    previous = F.when(F.col("_old") != F.col("customer_tier"), F.col("_old"))
    return renamed.withColumn("previous_tier", previous).withColumnRenamed("customer_tier", "current_tier").drop("_old")


def valid_on(dim: DataFrame, day) -> DataFrame:
    """The versions valid on a date (both ends count)."""
    return dim.filter(F.lit(day).cast("date").between(F.col("valid_from"), F.col("valid_to")))


def current(dim: DataFrame) -> DataFrame:
    return dim.filter("is_current")


def versions_of(dim: DataFrame, customer_ids: list[int]) -> DataFrame:
    """All versions of the listed customers."""
    return dim.filter(F.col("customer_id").isin(customer_ids)).orderBy("customer_id", "valid_from")


MANY_VERSIONS = 64


def as_of_join(facts: DataFrame, dim: DataFrame, key: str, day: str, many: int = MANY_VERSIONS) -> DataFrame:
    """Each fact with the dimension version valid on its date.

    The date range is a test that follows the equality on ``key``. A key of more than ``many``
    versions is also met by month: its versions stand under every month they touch, its facts under
    their own, so a key with many versions and many facts is spread over the calendar and a fact
    meets the versions of one month. Months behind the start of a key's last version count as that
    month, which keeps open ends short. The keys with many versions are few: at most (all versions /
    ``many``).
    """
    month = lambda c: F.year(c) * 12 + F.month(c)
    busy = dim.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), month(F.max("valid_from")).alias("_last")).where(F.col("_n") > many)
    busy = busy.select(key, "_last")
    many_versions = F.col("_last").isNotNull()
    placed = facts.join(busy, key, "left").withColumn(
        "_month", F.when(many_versions, F.least(month(F.col(day)), F.col("_last"))).otherwise(F.lit(0))
    )
    months = F.sequence(F.least(month(F.col("valid_from")), F.col("_last")), F.least(month(F.col("valid_to")), F.col("_last")))
    unfolded = dim.join(busy, key, "left").withColumn(
        "_month", F.explode(F.when(many_versions, months).otherwise(F.array(F.lit(0))))
    )
    placed, unfolded = placed.drop("_last").alias("f"), unfolded.drop("_last").alias("d")
    on = (
        (F.col(f"f.{key}") == F.col(f"d.{key}"))
        & (F.col("f._month") == F.col("d._month"))
        & F.col(f"f.{day}").between(F.col("d.valid_from"), F.col("d.valid_to"))
    )
    return placed.join(unfolded, on).drop(F.col(f"d.{key}")).drop("_month")
