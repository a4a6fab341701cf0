"""How often fact lines are dealt anew while facts are keyed, and that repeated ids lose nothing."""

import datetime as dt

import pytest

from tallyhouse.plans.increments import LINE, _facts
from tallyhouse.plans.warehouse import FACT_COLUMNS, Warehouse, fact_sales
from tallyhouse.sources.views import Retail


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lines_are_dealt_by_order_and_by_product_alone(spark, small, no_broadcast, capsys):
    house = Warehouse(Retail(spark, small))
    house.__dict__["customer_keys"] = spark.createDataFrame([(1, 1)], "customer_key bigint, customer_id bigint")
    house.__dict__["product_keys"] = spark.createDataFrame([(1, 1)], "product_key bigint, product_id bigint")
    fact_sales(house, FACT_COLUMNS).explain()
    plan = capsys.readouterr().out
    assert "hashpartitioning(order_item_id" not in plan
    # Orders and keys by customer, lines and orders by order, lines and keys by product.
    assert plan.count("Exchange hashpartitioning") <= 6


def test_increment_lines_are_dealt_once(spark, no_broadcast, capsys):
    kinds = "order_item_id string, arrival bigint, order_id bigint, customer_id bigint, order_date date, quantity bigint, line_total double"
    lines = spark.createDataFrame([("1-1", 1, 1, 5, dt.date(2024, 1, 1), 1, 1.0)], kinds)
    keys = spark.createDataFrame([(1, 5)], "customer_key bigint, customer_id bigint")
    _facts(lines.select(*LINE).join(keys, "customer_id", "left")).explain()
    assert capsys.readouterr().out.count("Exchange hashpartitioning") == 2


def test_repeated_customers_and_alike_lines(spark):
    orders = spark.createDataFrame(
        [(1, 7, dt.date(2024, 1, 1), "Completed", 9.0), (2, None, dt.date(2024, 1, 2), "Completed", 9.0)],
        "order_id bigint, customer_id bigint, order_date date, order_status string, total_amount double",
    )
    items = spark.createDataFrame(
        [(1, 3, 1, 2.0, 2.0, dt.date(2024, 1, 3), 1, 4)] * 2 + [(2, 3, 1, 2.0, 2.0, dt.date(2024, 1, 3), None, 4)],
        "order_id bigint, product_id bigint, quantity bigint, unit_price double, line_total double, ship_date date, line_number int, supplier_id bigint",
    )
    house = Warehouse(Retail(orders=orders, order_items=items))
    house.__dict__["customer_keys"] = spark.createDataFrame([(10, 7), (11, 7)], "customer_key bigint, customer_id bigint")
    house.__dict__["product_keys"] = spark.createDataFrame([(30, 3)], "product_key bigint, product_id bigint")
    rows = fact_sales(house, FACT_COLUMNS).collect()
    assert sorted((r.order_item_id, r.customer_key or 0, r.product_key) for r in rows) == [
        ("1-1-3-4", 10, 30), ("1-1-3-4", 10, 30), ("1-1-3-4", 11, 30), ("1-1-3-4", 11, 30), ("2-3-4", 0, 30),
    ]
    assert len({r.sales_key for r in rows}) == 3
    assert all(r.status_key == 3 and float(r.net_revenue) == 2.16 for r in rows)
