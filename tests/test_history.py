"""Type 1, 2 and 3 changes on hand-made dimensions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyhouse.functions.calendar import OPEN_END
from tallyhouse.operators.history import (
    as_of_join,
    current,
    rejected_changes,
    scd1_apply,
    scd2_apply,
    scd3_apply,
    valid_on,
)

DIM = "customer_key bigint, customer_id bigint, first_name string, customer_tier string, valid_from date, valid_to date, is_current boolean"
CHANGE = "customer_id bigint, new_tier string, effective_date date"


def day(text):
    return dt.date.fromisoformat(text)


@pytest.fixture
def dim(spark):
    start = day("2024-01-01")
    rows = [(1, 1, "Alice", "Bronze", start, OPEN_END, True), (2, 2, "Bob", "Gold", start, OPEN_END, True)]
    return spark.createDataFrame(rows, DIM)


def changes(spark, *rows):
    return spark.createDataFrame([(c, t, day(d)) for c, t, d in rows], CHANGE)


def versions(df, customer):
    rows = df.filter(F.col("customer_id") == customer).orderBy("valid_from").collect()
    return [(r.customer_key, r.first_name, r.customer_tier, str(r.valid_from), str(r.valid_to), r.is_current) for r in rows]


def test_one_change_closes_and_opens(spark, dim):
    after = scd2_apply(dim, changes(spark, (1, "Silver", "2024-06-15")))
    assert versions(after, 1) == [
        (1, "Alice", "Bronze", "2024-01-01", "2024-06-14", False),
        (3, "Alice", "Silver", "2024-06-15", "9999-12-31", True),
    ]
    assert versions(after, 2) == [(2, "Bob", "Gold", "2024-01-01", "9999-12-31", True)]
    assert valid_on(after, "2024-06-01").filter("customer_id = 1").first().customer_tier == "Bronze"
    assert current(after).filter("customer_id = 1").first().customer_tier == "Silver"


@pytest.mark.parametrize("change", [(1, "Bronze", "2024-06-15"), (99, "Gold", "2024-06-15")])
def test_same_tier_and_unknown_customer_do_nothing(spark, dim, change):
    after = scd2_apply(dim, changes(spark, change))
    assert sorted(after.collect()) == sorted(dim.collect())
    assert rejected_changes(dim, changes(spark, change)).isEmpty()


def test_several_changes_in_a_batch(spark, dim):
    batch = changes(
        spark, (1, "Gold", "2024-09-01"), (1, "Silver", "2024-03-01"), (1, "Silver", "2024-05-01"), (1, "Gold", "2025-01-01")
    )
    assert [v[2:] for v in versions(scd2_apply(dim, batch), 1)] == [
        ("Bronze", "2024-01-01", "2024-02-29", False),
        ("Silver", "2024-03-01", "2024-08-31", False),
        ("Gold", "2024-09-01", "9999-12-31", True),
    ]


def test_back_dated_and_conflicting_changes_are_rejected(spark, dim):
    batch = changes(
        spark,
        (1, "Gold", "2024-01-01"),
        (1, "Gold", "2023-05-05"),
        (2, "Silver", "2024-07-01"),
        (2, "Bronze", "2024-07-01"),
    )
    assert sorted(scd2_apply(dim, batch).collect()) == sorted(dim.collect())
    reasons = [r.reason for r in rejected_changes(dim, batch).orderBy("customer_id", "effective_date").collect()]
    assert reasons == ["not after the current version"] * 2 + ["several tiers on one date"] * 2


def test_a_change_delivered_twice_is_one(spark, dim):
    """All three types take it once, and refuse what is not after the current version."""
    batch = changes(spark, (1, "Gold", "2024-05-01"), (1, "Gold", "2024-05-01"), (2, "Bronze", "2020-05-01"))
    after = scd2_apply(dim, batch)
    assert [v[2:4] for v in versions(after, 1)] == [("Bronze", "2024-01-01"), ("Gold", "2024-05-01")]
    assert {r.customer_id: r.customer_tier for r in scd1_apply(dim, batch).collect()} == {1: "Gold", 2: "Gold"}
    assert {r.customer_id: r.previous_tier for r in scd3_apply(dim, batch).collect()} == {1: "Bronze", 2: None}
    assert [(r.customer_id, r.reason) for r in rejected_changes(dim, batch).collect()] == [(2, "not after the current version")]


def test_type_2_reads_its_inputs_once(spark, dim):
    from tallyhouse.operators.history import _applied

    plan = _applied(dim, changes(spark, (1, "Gold", "2024-05-01")))._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and plan.count("LogicalRDD") + plan.count("LocalRelation") == 2


def test_later_batch_keeps_closed_versions(spark, dim):
    first = scd2_apply(dim, changes(spark, (1, "Silver", "2024-06-15")))
    second = scd2_apply(first, changes(spark, (1, "Gold", "2024-08-01"), (2, "Silver", "2024-08-01")))
    assert [v[0] for v in versions(second, 1)] == [1, 3, 4]
    assert [v[3:5] for v in versions(second, 1)] == [
        ("2024-01-01", "2024-06-14"),
        ("2024-06-15", "2024-07-31"),
        ("2024-08-01", "9999-12-31"),
    ]
    assert versions(second, 2)[1][0] == 5


def test_versions_neither_overlap_nor_gap(spark, small):
    from tallyhouse.plans.registry import _after_changes

    rows = _after_changes(spark, small).orderBy("customer_id", "valid_from").collect()
    assert len({r.customer_key for r in rows}) == len(rows)
    for before, after in zip(rows, rows[1:]):
        if before.customer_id == after.customer_id:
            assert after.valid_from - before.valid_to == dt.timedelta(days=1)
            assert before.customer_tier != after.customer_tier
            assert not before.is_current
        else:
            assert before.is_current and before.valid_to == OPEN_END


def test_type_1_and_3(spark, dim):
    batch = changes(spark, (1, "Silver", "2024-06-15"), (1, "Gold", "2024-07-15"), (2, "Gold", "2024-07-15"))
    assert {r.customer_id: r.customer_tier for r in scd1_apply(dim, batch).collect()} == {1: "Gold", 2: "Gold"}
    third = {r.customer_id: (r.current_tier, r.previous_tier) for r in scd3_apply(dim, batch).collect()}
    assert third == {1: ("Gold", "Bronze"), 2: ("Gold", None)}


def test_as_of_join_finds_the_version_of_the_day(spark, dim):
    after = scd2_apply(dim, changes(spark, (1, "Silver", "2024-06-15")))
    facts = spark.createDataFrame(
        [(10, 1, day("2024-06-14")), (11, 1, day("2024-06-15")), (12, 2, day("2023-12-31"))],
        "fact bigint, customer_id bigint, order_date date",
    )
    joined = as_of_join(facts, after.select("customer_id", "customer_tier", "valid_from", "valid_to"), "customer_id", "order_date")
    assert {r.fact: r.customer_tier for r in joined.collect()} == {10: "Bronze", 11: "Silver"}
