"""Files, warehouse, keys, calendar and audits."""

import datetime as dt
import json
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tallyhouse.functions.calendar import calendar, date_dimension
from tallyhouse.operators.keys import with_sequence_key
from tallyhouse.operators.quality import (
    audit_not_null,
    audit_orphans,
    audit_unique,
    basic_stats,
    null_counts,
    with_defaults,
)
from tallyhouse.plans import warehouse
from tallyhouse.plans.warehouse import Warehouse, build_warehouse
from tallyhouse.session import fresh_path, shared_folder
from tallyhouse.sources import files, sql
from tallyhouse.sources.tables import table
from tallyhouse.sources.views import Retail


def test_scratch_goes_to_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == named
    assert fresh_path(spark, "x").startswith(named) and fresh_path(spark, "x") != fresh_path(spark, "x")


@pytest.mark.parametrize("fmt", files.FORMATS)
def test_round_trip_is_exact(spark, tmp_path, fmt):
    when = dt.datetime(2024, 2, 29, 23, 59, 59, 123456)
    rows = [(1, 'a "quoted", text\nwith lines', 0.1, when, when.date()), (2, "ünï", 1e-9, when, when.date()), (3, None, None, None, None)]
    df = spark.createDataFrame(rows, "id bigint, text string, x double, at timestamp_ntz, day date")
    if fmt == "csv":  # a record per line
        df = df.withColumn("text", F.translate("text", "\n", " "))
    path = files.write(df, str(tmp_path / fmt), fmt)
    back = files.scan(spark, path, fmt, df.schema)
    assert back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()
    assert files.differences(df, back, fmt).first()[1:] == (3, 5, 0, 0)
    fewer = back.filter("id > 1").unionByName(back.filter("id = 3"))
    assert files.differences(df, fewer, fmt).first()[1:] == (3, 5, 1, 1)


def test_json_array_and_inferred_csv(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"id": 1, "x": 2.5}, {"id": 2, "x": None}], indent=1))
    rows = files.scan(spark, str(tmp_path / "a.json"), "json", "id int, x double", json_array=True).collect()
    assert [(r.id, r.x) for r in rows] == [(1, 2.5), (2, None)]
    (tmp_path / "e.csv").write_text("name,age,salary\nJohn,30,75000\nJane,28,82000\n")
    assert files.scan(spark, str(tmp_path / "e.csv"), "csv").dtypes == [("name", "string"), ("age", "int"), ("salary", "int")]


def test_season_runs_and_preview(spark, tmp_path):
    df = spark.createDataFrame([(1,), (2,)], "n int")
    files.write_run(df, str(tmp_path), 2025, "20250101_000000")
    files.write_run(df, str(tmp_path), 2025, "20250102_000000")
    back = files.scan(spark, str(tmp_path), "csv", "n int, season int, run string")
    assert back.count() == 4 and back.select("run").distinct().count() == 2


def test_sequence_key_equals_a_global_row_number(spark):
    few = [5, -3, 17, 40, 41, 42, 1_000_000, 39]
    dice = random.Random(4)
    sparse = [dice.randrange(1 << 63) for _ in range(5000)]
    for values in (few, sparse, few[:1], []):
        ids = spark.createDataFrame([(i,) for i in values], "id bigint")
        numbered = with_sequence_key(ids, "k", "id", after=100).collect()
        assert {r.id: r.k for r in numbered} == {i: 101 + n for n, i in enumerate(sorted(values))}


def test_warehouse_build(spark, small, tmp_path):
    source, path = Retail(spark, small), str(tmp_path / "house")
    counts = {r.table_name: r.row_count for r in build_warehouse(source, path).collect()}
    again = {r.table_name: r.row_count for r in build_warehouse(source, path).collect()}
    assert counts == again  # a filled table is left alone
    assert counts["dim_customer"] == 150 and counts["dim_date"] == 2557 and counts["dim_order_status"] == 4
    house = Warehouse.saved(spark, path)
    facts = house.fact_sales
    assert facts.select("sales_key").distinct().count() == counts["fact_sales"] == facts.count()
    for key, dim in (("customer_key", "dim_customer"), ("product_key", "dim_product"), ("date_key", "dim_date")):
        assert audit_orphans(facts, getattr(house, dim), key).isEmpty()
        assert audit_unique(getattr(house, dim), key).isEmpty()
    # The stored tables give the same answers as the lazy ones.
    lazy = Warehouse(source)
    for query in (warehouse.dw_tier_revenue, warehouse.dw_weekend, warehouse.dw_top_products, warehouse.dw_monthly_category):
        assert query(house).collect() == query(lazy).collect() or sorted(query(house).collect()) == sorted(query(lazy).collect())
    plan = facts.filter("month_key = 199601").select("net_revenue")._jdf.queryExecution().toString()
    assert "month_key#" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_load_times_are_those_of_the_load(spark, small, tmp_path):
    before = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    path = str(tmp_path / "house")
    build_warehouse(Retail(spark, small), path)
    after = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    house = Warehouse.saved(spark, path)
    for name, column in (("dim_customer", "created_at"), ("dim_customer", "updated_at"), ("dim_product", "created_at"), ("fact_sales", "loaded_at")):
        text = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        low, high, n, every = getattr(house, name).agg(F.min(text), F.max(text), F.count(column), F.count("*")).first()
        assert n == every > 0
        assert before <= dt.datetime.fromisoformat(low) <= dt.datetime.fromisoformat(high) <= after


def test_unknown_keys_stay_null(spark, small):
    source = Retail(spark, small)
    house = Warehouse(source)
    house.__dict__["dim_customer"] = house.dim_customer.filter("customer_id > 20")
    facts = house.fact_sales
    assert facts.filter("customer_key is null").count() > 0
    assert facts.count() == Warehouse(source).fact_sales.count()


def test_sql_over_registered_names(spark, small):
    source = Retail(spark, small)
    names = sql.register(source.frames()) + sql.register(Warehouse(source).frames())
    assert {"customers", "order_items", "dim_date", "vw_sales_complete"} <= set(names)
    by_month = sql.run(
        spark,
        "SELECT date_format(order_date, 'yyyy-MM') AS month, avg(datediff(ship_date, order_date)) AS days FROM orders"
        " WHERE ship_date IS NOT NULL GROUP BY 1",
    )
    assert by_month.count() == 79
    unsold = sql.run(
        spark,
        "SELECT product_name, c.category_name FROM products AS p JOIN categories AS c USING (category_id)"
        " WHERE product_id NOT IN (SELECT product_id FROM {sold})",
        sold=source.order_items.filter("product_id < 150"),
    )
    assert unsold.count() == 50
    view = sql.run(spark, "SELECT sum(quantity) AS units, count(DISTINCT sales_key) AS n, count(*) AS m FROM vw_sales_complete").first()
    facts = Warehouse(source).fact_sales.agg(F.sum("quantity"), F.count("*")).first()
    assert (view.units, view.n, view.m) == (facts[0], facts[1], facts[1])
    with pytest.raises(AnalysisException):
        sql.run(spark, "SELECT nothing FROM orders")


def test_default_calendar(spark):
    dim = date_dimension(calendar(spark, "2023-01-01", "2025-12-31"))
    assert dim.count() == 1096 and len(dim.columns) == 15
    rows = {str(r.full_date): r for r in dim.collect()}
    assert (rows["2024-12-30"].week_of_year, rows["2024-12-31"].day_of_year) == (1, 366)
    assert (rows["2024-06-30"].fiscal_year, rows["2024-06-30"].fiscal_quarter) == (2023, 4)
    assert (rows["2024-07-01"].fiscal_year, rows["2024-07-01"].fiscal_quarter) == (2024, 1)
    assert (rows["2025-01-05"].day_name, rows["2025-01-05"].day_of_week, rows["2025-01-05"].is_weekend) == ("Sunday", 6, True)


def test_audits(spark):
    df = spark.createDataFrame([(1, None, 2.0), (1, "x", None), (2, "y", 4.0)], "id int, name string, v double")
    assert {r.column_name: r.null_count for r in null_counts(df).collect()} == {"id": 0, "name": 1, "v": 1}
    assert [r.column_name for r in audit_not_null(df, ["id", "name"]).collect()] == ["name"]
    assert [tuple(r) for r in audit_unique(df, "id").collect()] == [(1, 2)]
    assert [r.id for r in audit_orphans(df, df.filter("id = 1"), "id").collect()] == [2]
    stats = {r.column_name: r for r in basic_stats(df).collect()}["v"]
    assert (stats.value_count, float(stats.mean), float(stats.stddev), float(stats.min), float(stats.max)) == (2, 3.0, 1.4142, 2.0, 4.0)
    filled = with_defaults(df, {"name": "none", "tier": "Bronze"})
    assert {r.name for r in filled.collect()} == {None, "x", "y"} and filled.select("tier").first()[0] == "Bronze"


def test_explicit_schemas_match_the_files(spark, small):
    from tallyhouse.sources.tables import SCHEMAS

    for name in SCHEMAS:
        assert table(spark, small, name).dtypes == spark.read.parquet(f"{small}/{name}.parquet").dtypes
