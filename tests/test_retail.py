"""Retail queries on a tiny shop, and properties over the supplied tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators.ranking import with_running_totals
from tallyhouse.plans import basics, retail
from tallyhouse.sources.views import Retail


@pytest.fixture(scope="module")
def shop(spark):
    """The queries run over any frames with these columns, not only over the supplied tables."""
    day = dt.date(2024, 1, 1)
    frames = {
        "customers": spark.createDataFrame(
            [(1, "Ann", "Lee", "Gold"), (2, "Bob", "Ray", "Gold"), (3, "Cy", "Fox", "Bronze")],
            "customer_id bigint, first_name string, last_name string, customer_tier string",
        ),
        "orders": spark.createDataFrame(
            [
                (1, 1, day, "Completed", 600.0),
                (2, 1, day + dt.timedelta(40), "Completed", 500.1),
                (3, 2, day, "Completed", 499.99),
                (4, 2, day, "Cancelled", 900.0),
                (5, 3, day, "Pending", 10.0),
            ],
            "order_id bigint, customer_id bigint, order_date date, order_status string, total_amount double",
        ),
        "order_items": spark.createDataFrame(
            [(1, 1, 2, 10.0, 20.0), (1, 2, 1, 30.0, 30.0), (2, 1, 3, 10.0, 30.0), (3, 1, 1, 10.0, 10.0), (5, 2, 1, 30.0, 30.0)],
            "order_id bigint, product_id bigint, quantity bigint, unit_price double, line_total double",
        ),
        "products": spark.createDataFrame(
            [(1, "Cup", "Home", 10.0, 5), (2, "Pan", "Home", 30.0, 6), (3, "Hat", "Wear", 7.0, 0)],
            "product_id bigint, product_name string, category_name string, unit_price double, stock_quantity bigint",
        ),
    }
    return Retail(**frames)


def test_segments_and_top_customers(shop):
    value = {r.customer_name: (r.value_segment, float(r.avg_order_value), r.customer_lifespan_days) for r in retail.customer_ltv(shop).collect()}
    assert value == {"Ann Lee": ("High Value", 550.05, 40.0), "Bob Ray": ("Low Value", 499.99, 0.0)}
    assert [(r.customer_name, r.spending_rank) for r in retail.top_customers(shop, 1).collect()] == [("Ann Lee", 1)]
    assert [r.customer_id for r in retail.above_average(shop).collect()] == [1]


def test_category_counts_orders_once(shop):
    row = retail.category_performance(shop).first()
    assert (row.category_name, row.orders, row.units_sold, float(row.revenue), float(row.avg_price)) == ("Home", 3, 7, 90.0, 15.0)
    tier = retail.tier_category_sales(shop).first()
    assert (tier.customer_tier, tier.order_count, float(tier.avg_line_value)) == ("Gold", 3, 22.5)


def test_customers_without_orders_count(shop, spark):
    lone = Retail(customers=shop.customers, orders=shop.orders.filter("customer_id = 1"))
    expected = {1: 2, 2: 0, 3: 0}
    for query in (retail.orders_per_customer, retail.orders_per_customer_corr):
        assert {r.customer_id: r.order_count for r in query(lone).collect()} == expected


def test_order_totals(shop):
    assert {r.order_id: float(r.total_amount) for r in retail.order_totals(shop).collect()} == {1: 50, 2: 30, 3: 10, 4: 0, 5: 30}


def _ids(df):
    return {r.product_id for r in df.collect()}


def test_never_ordered_follows_not_in(shop, spark):
    sold = shop.order_items.select("product_id")
    assert _ids(retail.never_ordered(shop.products, sold)) == {3}
    with_null = sold.unionByName(spark.createDataFrame([(None,)], "product_id bigint"))
    assert _ids(retail.never_ordered(shop.products, with_null)) == set()
    assert _ids(retail.never_ordered_anti(shop.products, with_null)) == {3}
    nameless = shop.products.unionByName(
        spark.createDataFrame([(None, "?", "Wear", 1.0, 1)], shop.products.schema)
    )
    assert _ids(retail.never_ordered(nameless, sold)) == {3}
    assert _ids(retail.never_ordered(nameless, sold.limit(0))) == {1, 2, 3, None}
    for left, right in ((shop.products, sold), (nameless, with_null), (nameless, sold.limit(0))):
        left.createOrReplaceTempView("p")
        right.createOrReplaceTempView("s")
        literal = spark.sql("SELECT * FROM p WHERE product_id NOT IN (SELECT product_id FROM s)")
        assert _ids(retail.never_ordered(left, right)) == _ids(literal)


def test_running_total_frames_differ_on_ties(spark):
    rows = spark.createDataFrame([(1, 10), (1, 20), (2, 5)], "day int, amount int")
    shared = with_running_totals(rows, ["day"], {"amount": "total"})
    assert sorted(r.total for r in shared.collect()) == [30, 30, 35]
    single = with_running_totals(rows, ["day"], {"amount": "total"}, ties_share=False)
    assert sorted(r.total for r in single.collect())[-2:] == [30, 35]
    assert {r.total for r in single.collect()} != {30, 35}


def test_running_total_ends_at_the_grand_total(spark, small):
    source = Retail(spark, small)
    last = retail.running_total(source).orderBy(F.desc("order_date")).first().running_total
    assert float(last) == pytest.approx(source.completed.agg(F.sum("total_amount")).first()[0], abs=0.005)


def test_shares_add_up_to_the_category(spark, small):
    shares = retail.pct_of_category(Retail(spark, small)).groupBy("category_name")
    rows = shares.agg(F.sum("product_revenue").alias("a"), F.first("category_revenue").alias("b"), F.sum("pct_of_category").alias("p"))
    for row in rows.collect():
        assert row.a == row.b
        assert float(row.p) == pytest.approx(100, abs=0.5)


def test_explicit_schema_refuses_null(spark):
    good = spark.createDataFrame([("Al", 30, 100.5)], "name string, age int, salary double")
    assert basics.explicit_schema(good).schema == basics.STAFF_SCHEMA
    bad = spark.createDataFrame([(None, 30, 100.5)], "name string, age int, salary double")
    with pytest.raises(Exception, match="NULL in name"):
        basics.explicit_schema(bad).collect()


def test_timing_compare(spark):
    runs = spark.createDataFrame(
        [("q", "before", 2.0), ("q", "before", 4.0), ("q", "after", 1.5)], "query string, phase string, seconds double"
    )
    row = retail.timing_compare(runs).first()
    assert (row.before_avg, row.after_avg, row.speedup, row.improvement_pct) == (3.0, 1.5, 2.0, 50.0)
