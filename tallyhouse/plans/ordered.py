"""Running totals, lags and ranks over all rows of a table, not only over its days or months."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.scalar import cents, percent_change, rounded, scaled
from tallyhouse.operators.ordered import OrderedRows
from tallyhouse.plans.retail import customer_spend
from tallyhouse.sources.views import Retail

_LINE = ("ship_date", "order_id", "line_number", "product_id", "supplier_id", "revenue")


def line_running_revenue(retail: Retail) -> DataFrame:
    """Every order line in the order of shipping: revenue so far through its day (lines of one day
    share it) and through the line itself, the line before, and the change from it."""
    lines = retail.order_items.select(*_LINE[:-1], cents("line_total").alias("revenue"))
    made = OrderedRows(lines, *_LINE, peers=1).with_columns(
        totals={"revenue": "through_day"}, row_totals={"revenue": "through_line"}, previous={"revenue": "previous"}
    )
    return retail.with_item_id(made).select(
        "order_item_id",
        "ship_date",
        scaled("revenue").alias("revenue"),
        scaled("through_day").alias("running_through_day"),
        scaled("through_line").alias("running_through_line"),
        scaled("previous").alias("previous_revenue"),
        rounded(percent_change("revenue", "previous")).alias("change_percentage"),
    )


def customer_spend_rank(retail: Retail) -> DataFrame:
    """Every customer by what completed orders came to: place, rank, dense rank and percent rank.
    Customers without such an order have spent nothing and share the last rank."""
    spend = retail.customers.select("customer_id").join(customer_spend(retail.completed), "customer_id", "left")
    spend = spend.select("customer_id", F.coalesce("spent", F.lit(0)).alias("spent"))
    return OrderedRows(spend, "-spent", "customer_id", peers=1).with_columns(
        row_number="place", rank="spend_rank", dense_rank="spend_dense_rank", percent_rank="spend_percentile"
    ).withColumn("spent", scaled("spent"))


def line_price_rank(retail: Retail) -> DataFrame:
    """Every order line by its price a unit: rank, percent rank and cumulative distribution."""
    lines = retail.order_items.select("order_id", "line_number", "product_id", "supplier_id", "unit_price")
    made = OrderedRows(lines, "-unit_price").with_columns(rank="price_rank", percent_rank="price_percentile", cume_dist="price_share")
    return retail.with_item_id(made).select("order_item_id", "unit_price", "price_rank", "price_percentile", "price_share")
