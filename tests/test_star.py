"""The star in buckets: no shuffle between facts and customers."""

import pytest
from pyspark.sql import functions as F

from tallyhouse.plans import registry, star, warehouse
from tests.test_plans import settings

NO_BROADCAST = {"spark__sql__autoBroadcastJoinThreshold": "-1", "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1"}


@pytest.fixture(scope="module")
def stored(spark, small):
    return registry.stored_star(spark, small)


def exchanges(df):
    """The shuffles of the plan, by what they deal by."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.split("Exchange ")[1] for line in plan.splitlines() if "Exchange " in line and "Broadcast" not in line]


def test_customers_meet_facts_without_an_exchange(spark, small, stored):
    with settings(spark, **NO_BROADCAST):
        for query in (warehouse.dw_tier_revenue, warehouse.vw_sales_complete):
            assert not [e for e in exchanges(query(stored)) if e.startswith("hashpartitioning(customer_key")]
            assert any("customer_key" in e for e in exchanges(query(registry.stored_house(spark, small))))


def test_buckets_hold_the_same_rows(spark, small, stored):
    house = registry.stored_house(spark, small)
    for name in ("fact_sales", "dim_customer"):
        own, plain = getattr(stored, name), getattr(house, name)
        assert own.select(plain.columns).exceptAll(plain).isEmpty() and own.count() == plain.count()


def test_a_customer_with_a_third_of_the_facts_is_refused(spark):
    house = warehouse.Warehouse(None)
    for name in warehouse.TABLES:
        house.__dict__[name] = spark.range(100).withColumnRenamed("id", "customer_key")
    house.__dict__["fact_sales"] = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("customer_key"))
    assert star.store_star(house, "refused", "/nowhere") is None
    assert star.largest_bucket(house.fact_sales.where("customer_key < 0"), "customer_key", 8) == (0, 0)
