"""What the plans look like, and that heavy keys do not break or slow them."""

import contextlib

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators.ranking import top_per_group, with_group_totals
from tallyhouse.plans import players, registry, retail, trips, warehouse
from tallyhouse.sources import views
from tallyhouse.sources.views import Retail


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def pushed(df):
    text = df._jdf.queryExecution().toString()
    return [part.split("]")[0] for part in text.split("PushedFilters: [")[1:]]


def read_schema(df):
    return plan(df).split("ReadSchema: struct<")[1].split(">")[0]


@contextlib.contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def source(spark, small):
    return Retail(spark, small)


def test_filters_reach_the_scan(spark, small, source):
    assert any("EqualTo(o_orderstatus,F)" in p for p in pushed(retail.project(source)))
    assert any("GreaterThanOrEqual(o_orderdate" in p for p in pushed(retail.date_range_daily(source)))
    assert any("EqualTo(c_name" in p for p in pushed(retail.point_lookup(source, registry.EMAIL)))
    assert not any("EqualTo(c_name" in p for p in pushed(retail.lower_lookup(source, registry.EMAIL)))
    assert any("LessThanOrEqual(value,500" in p for p in pushed(trips.trip_hourly(trips.trip_features(views.trips(spark, small)))))


def test_only_needed_columns_are_read(spark, small, source):
    assert read_schema(retail.project(source)) == (
        "o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_totalprice:double,o_orderdate:timestamp_ntz"
    )
    assert read_schema(retail.product_sales(source.order_items)) == "l_partkey:bigint,l_quantity:double,l_extendedprice:double"


def test_top_k_and_top_per_group_cut_before_the_shuffle(source):
    best = plan(retail.top_customers(source))
    assert "TakeOrderedAndProject" in best and "SinglePartition" not in best
    assert plan(retail.top3_per_category(source)).count("WindowGroupLimit") == 2


def test_correlated_count_becomes_a_join(source):
    assert "LeftOuter" in plan(retail.orders_per_customer_corr(source))


def test_no_forced_broadcast_cross_join_or_python(spark, small):
    for name in registry._REGISTERED:
        if name in {"html_stats", "convert_formats", "write_modes"} or name.startswith("scan_"):
            continue
        df = registry._REGISTERED[name](spark, small)
        logical = df._jdf.queryExecution().analyzed().toString()
        assert "ResolvedHint" not in logical and "Python" not in logical, name
        assert "CartesianProduct" not in plan(df), name


def test_two_part_not_in_does_not_broadcast_null_aware(spark, small):
    assert "null aware" not in plan(registry.never_ordered(spark, small)).lower()


# A third of all lines on one order, and a third on one product.

HOT = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "64k",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "64k",
    "spark__sql__shuffle__partitions": "16",
}


@pytest.fixture(scope="module")
def heavy(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("heavy"))
    frames = {
        "customers": spark.range(100).selectExpr(
            "id as customer_id", "'A' as first_name", "cast(id as string) as last_name", "if(id % 2 = 0, 'Gold', 'Silver') as customer_tier"
        ),
        "orders": spark.range(3000).selectExpr(
            "id as order_id", "if(id % 3 = 0, 7, id % 100) as customer_id", "date_add(date'2024-01-01', int(id % 60)) as order_date",
            "if(id % 4 = 1, 'Pending', 'Completed') as order_status", "id * 1.25D as total_amount",
        ),
        "order_items": spark.range(0, 120000, 1, 8).selectExpr(
            "if(id % 3 = 0, 0, id % 3000) as order_id", "if(id % 3 = 1, 5, id % 400) as product_id", "id % 7 + 1 as quantity",
            "(id % 1000) / 4.0D as unit_price", "(id % 1000) / 2.0D as line_total",
            "date_add(date'2024-01-03', int(id % 50)) as ship_date", "cast(id as string) as order_item_id",
        ),
        "products": spark.range(400).selectExpr(
            "id as product_id", "concat('p', id) as product_name", "if(id % 3 = 0, 'big', concat('c', id % 5)) as category_name",
            "1.5D as unit_price", "id as stock_quantity",
        ),
    }
    for name, df in frames.items():
        df.write.parquet(f"{folder}/{name}")
        frames[name] = spark.read.parquet(f"{folder}/{name}")
        frames[name].createOrReplaceTempView(f"hot_{name}")
    return Retail(**frames)


def test_heavy_keys_are_split_at_run_time(spark, heavy):
    with settings(spark, **HOT):
        sales = retail.completed_product_revenue(heavy)
        rows = {r.product_id: (r.units_sold, r.revenue) for r in sales.collect()}
        assert "skew=true" in plan(sales)
    expected = spark.sql(
        "SELECT product_id, sum(quantity) AS u, cast(round(sum(line_total) * 100) as bigint) AS r FROM hot_order_items"
        " JOIN hot_orders USING (order_id) WHERE order_status = 'Completed' GROUP BY product_id"
    )
    assert rows == {r.product_id: (r.u, r.r) for r in expected.collect()}


def test_heavy_keys_shrink_before_the_shuffle(spark, heavy):
    with settings(spark, **HOT):
        got = {r.category_name: (r.orders, r.units_sold, float(r.revenue)) for r in retail.category_performance(heavy).collect()}
    expected = spark.sql(
        "SELECT category_name, count(DISTINCT order_id) AS o, sum(quantity) AS u, sum(line_total) AS r FROM hot_order_items"
        " JOIN hot_orders USING (order_id) JOIN hot_products USING (product_id) WHERE order_status = 'Completed' GROUP BY 1"
    )
    assert got == {r.category_name: (r.o, r.u, r.r) for r in expected.collect()}


def test_heavy_order_in_ship_dates(spark, heavy):
    days = heavy.order_items.select("order_id", "ship_date").distinct()
    assert days.filter("order_id = 0").count() == 50  # 40,000 lines, one row per day
    got = {r.order_id: r.ship_date for r in heavy.ship_dates.collect()}
    expected = spark.sql(
        "SELECT order_id, min(ship_date) AS d FROM hot_orders JOIN hot_order_items USING (order_id)"
        " WHERE ship_date >= order_date GROUP BY order_id"
    )
    assert got == {r.order_id: r.d for r in expected.collect()}


def test_heavy_category_totals_equal_the_window(spark, heavy):
    sales = retail.product_sales(heavy.order_items).join(heavy.products.select("product_id", "category_name"), "product_id")
    sales.createOrReplaceTempView("hot_sales")
    got = with_group_totals(sales, "category_name", {"t": F.sum("revenue")}).select("product_id", "t")
    expected = spark.sql("SELECT product_id, sum(revenue) OVER (PARTITION BY category_name) AS t FROM hot_sales")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def test_heavy_group_top_k(spark):
    rows = spark.range(100000).selectExpr("if(id % 3 = 0, 'hot', concat('g', id % 50)) as g", "id", "id % 1000 as v")
    best = top_per_group(rows, "g", "v", 2, "place", "id")
    assert [(r.id, r.v) for r in best.filter("g = 'hot'").orderBy("place").collect()] == [(999, 999), (3999, 999)]


def test_heavy_customer_in_tier_revenue(spark, heavy):
    house = warehouse.Warehouse(None)
    house.__dict__["dim_customer"] = heavy.customers.selectExpr("customer_id as customer_key", "customer_tier", "true as is_current")
    house.__dict__["fact_sales"] = heavy.order_items.join(heavy.completed, "order_id").selectExpr(
        "customer_id as customer_key", "order_id", "cast(line_total as decimal(25,4)) as net_revenue", "quantity"
    )
    got = {r.customer_tier: (r.customers, r.orders, r.total_units) for r in warehouse.dw_tier_revenue(house).collect()}
    expected = spark.sql(
        "SELECT customer_tier, count(DISTINCT customer_id) AS c, count(DISTINCT order_id) AS o, sum(quantity) AS u"
        " FROM hot_order_items JOIN hot_orders USING (order_id) JOIN hot_customers USING (customer_id)"
        " WHERE order_status = 'Completed' GROUP BY 1"
    )
    assert got == {r.customer_tier: (r.c, r.o, r.u) for r in expected.collect()}


def test_player_steps_aggregate_before_the_shuffle(spark, small):
    raw = players.player_standardize(views.raw_player_totals(spark, small))
    text = plan(players.player_dedupe(raw))
    assert "Window" not in text and "partial_min_by" in text
