"""Retail questions over customers, orders, order lines, products and categories.

Sums are taken per customer, product or order before a join wherever the answer
allows it: the shuffle then carries one partial row per key and task, however
many rows a single key holds. No broadcast is forced; AQE chooses one when it has
measured the small side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.scalar import (
    at_least,
    cents_total,
    days_between,
    full_name,
    mean_of,
    money_mean,
    money_total,
    month_label,
    number,
    percent_change,
    rounded,
    scaled,
)
from tallyhouse.operators.ranking import (
    ranked_top_k,
    top_k,
    top_per_group,
    with_group_totals,
    with_growth,
    with_running_totals,
)
from tallyhouse.sources.views import Retail

# Spending at which a customer's value segment starts.
VALUE_STEPS = [(1000, "High Value"), (500, "Medium Value")]
VALUE_FLOOR = "Low Value"


# Building blocks


def customer_spend(orders: DataFrame) -> DataFrame:
    """Per customer: number of orders, their sum in cents, first and last date."""
    return orders.groupBy("customer_id").agg(
        F.count("*").alias("order_count"),
        cents_total("total_amount").alias("spent"),
        F.min("order_date").alias("first_order"),
        F.max("order_date").alias("last_order"),
    )


def product_sales(items: DataFrame) -> DataFrame:
    """Per product: units, and revenue in cents."""
    return items.groupBy("product_id").agg(
        F.sum("quantity").alias("units_sold"), cents_total("line_total").alias("revenue")
    )


def order_category_sales(retail: Retail, orders: DataFrame) -> DataFrame:
    """Per order (with its other columns) and category: lines, units, revenue and sum of unit prices
    in cents, for the lines of the given orders.

    The orders are met first, so that lines of other orders go no further. At most one row per
    order and category is left, so counting these rows counts distinct orders.
    """
    return (
        retail.order_items.select("order_id", "product_id", "quantity", "line_total", "unit_price")
        .join(orders, "order_id")
        .join(retail.products.select("product_id", "category_name"), "product_id")
        .groupBy(*orders.columns, "category_name")
        .agg(
            F.count("*").alias("lines"),
            F.sum("quantity").alias("units"),
            cents_total("line_total").alias("revenue"),
            cents_total("unit_price").alias("prices"),
        )
    )


def completed_product_revenue(retail: Retail) -> DataFrame:
    """Per product: units, and revenue in cents, in completed orders."""
    lines = retail.order_items.select("order_id", "product_id", "quantity", "line_total")
    return product_sales(lines.join(retail.completed.select("order_id"), "order_id"))


# Rankings and shares


def top_customers(retail: Retail, k: int = 10) -> DataFrame:
    spend = customer_spend(retail.completed).select("customer_id", scaled("spent").alias("total_spent"))
    named = retail.customers.join(spend, "customer_id").select(
        "customer_id", full_name().alias("customer_name"), "customer_tier", "total_spent"
    )
    return ranked_top_k(named, "total_spent", k, "spending_rank", "customer_id")


def running_total(retail: Retail) -> DataFrame:
    """Daily revenue with its running total: one row per calendar day enters the window."""
    daily = retail.completed.groupBy("order_date").agg(
        F.count("*").alias("orders_count"), money_total("total_amount").alias("daily_revenue")
    )
    return with_running_totals(daily, ["order_date"], {"daily_revenue": "running_total"}).orderBy("order_date")


def product_vs_category(retail: Retail) -> DataFrame:
    sales = product_sales(retail.order_items).join(
        retail.products.select("product_id", "product_name", "category_name"), "product_id"
    )
    compared = with_group_totals(
        sales, "category_name", {"_units": F.sum("units_sold"), "_products": F.count("*")}
    )
    average = mean_of("_units", "_products")
    return compared.select(
        "product_id",
        "product_name",
        "category_name",
        "units_sold",
        rounded(average).alias("category_avg_sales"),
        rounded(number("units_sold") - average).alias("vs_category_avg"),
    ).orderBy("category_name", F.desc("units_sold"), "product_id")


def monthly_growth(retail: Retail) -> DataFrame:
    monthly = retail.completed.groupBy(month_label("order_date").alias("month")).agg(
        F.count("*").alias("order_count"), money_total("total_amount").alias("monthly_revenue")
    )
    grown = with_growth(
        monthly, ["month"], {"monthly_revenue": ("prev_month_revenue", None, "growth_percentage")}
    )
    return grown.withColumn("growth_percentage", rounded("growth_percentage")).orderBy("month")


def pct_of_category(retail: Retail) -> DataFrame:
    sales = product_sales(retail.order_items).join(
        retail.products.select("product_id", "product_name", "category_name"), "product_id"
    )
    # Units are summed for the groups, too: with the same columns on both sides the lines are read once.
    totals = {"_category": F.sum("revenue"), "_units": F.sum("units_sold")}
    compared = with_group_totals(sales, "category_name", totals).filter("_units is not null")
    return compared.select(
        "product_id",
        "product_name",
        "category_name",
        "units_sold",
        scaled("revenue").alias("product_revenue"),
        scaled("_category").alias("category_revenue"),
        rounded(F.try_divide(number("revenue"), number("_category")) * 100).alias("pct_of_category"),
    ).orderBy("category_name", F.desc("product_revenue"), "product_id")


def top3_per_category(retail: Retail, k: int = 3) -> DataFrame:
    sales = completed_product_revenue(retail).join(
        retail.products.select("product_id", "product_name", "category_name"), "product_id"
    )
    best = top_per_group(sales, "category_name", "revenue", k, "rank_in_category", "product_id")
    return best.select(
        "category_name", "product_id", "product_name", scaled("revenue").alias("revenue"), "rank_in_category"
    )


# Customer value


def customer_ltv(retail: Retail, k: int = 20) -> DataFrame:
    value = customer_spend(retail.completed).withColumn("spent", scaled("spent"))
    named = retail.customers.join(value, "customer_id").select(
        "customer_id",
        full_name().alias("customer_name"),
        "customer_tier",
        at_least("spent", VALUE_STEPS, VALUE_FLOOR).alias("value_segment"),
        "order_count",
        F.col("spent").alias("total_spent"),
        rounded(mean_of("spent", "order_count")).alias("avg_order_value"),
        days_between("last_order", "first_order").alias("customer_lifespan_days"),
    )
    return top_k(named, "total_spent", k, "customer_id")


def customer_ltv_min3(retail: Retail, least: int = 3, k: int = 15) -> DataFrame:
    value = customer_spend(retail.completed).filter(F.col("order_count") >= least).withColumn("spent", scaled("spent"))
    named = retail.customers.join(value, "customer_id").select(
        "customer_id",
        full_name().alias("customer_name"),
        "customer_tier",
        "order_count",
        F.col("spent").alias("lifetime_value"),
        rounded(mean_of("spent", "order_count")).alias("avg_order_value"),
        days_between("last_order", "first_order").alias("days_as_customer"),
    )
    return top_k(named, "lifetime_value", k, "customer_id")


def frequent_customers(retail: Retail, least: int = 5, k: int = 20) -> DataFrame:
    value = customer_spend(retail.completed).filter(F.col("order_count") >= least).withColumn("spent", scaled("spent"))
    named = retail.customers.join(value, "customer_id").select(
        "customer_id",
        full_name().alias("customer_name"),
        F.col("order_count").alias("total_orders"),
        F.col("spent").alias("lifetime_value"),
    )
    return top_k(named, "lifetime_value", k, "customer_id")


def gold_customers(retail: Retail, tier: str = "Gold") -> DataFrame:
    """Orders of one tier's customers, any status."""
    members = retail.customers.filter(F.col("customer_tier") == tier)
    return members.join(customer_spend(retail.orders), "customer_id").select(
        "customer_id",
        full_name().alias("customer_name"),
        "order_count",
        scaled("spent").alias("total_spent"),
    )


def above_average(retail: Retail) -> DataFrame:
    """Customers who spent more than the average spending customer."""
    spend = customer_spend(retail.completed).select("customer_id", scaled("spent").alias("spent"))
    average = spend.agg(mean_of(F.sum("spent"), F.count("*")).alias("average")).scalar()
    rich = spend.filter(number("spent") > average)
    return rich.join(retail.customers, "customer_id").select(
        "customer_id",
        full_name().alias("customer_name"),
        F.col("spent").alias("total_spent"),
        rounded(average).alias("avg_customer_spend"),
    ).orderBy(F.desc("total_spent"), "customer_id")


def cohort_analysis(retail: Retail) -> DataFrame:
    """By month of registration; customers without a completed order still count."""
    spend = customer_spend(retail.completed).select("customer_id", "order_count", "spent")
    return (
        retail.registrations.join(spend, "customer_id", "left")
        .groupBy(month_label("registration_date").alias("cohort_month"))
        .agg(
            F.count("*").alias("customers_in_cohort"),
            F.coalesce(F.sum("order_count"), F.lit(0)).alias("total_orders"),
            rounded(mean_of(scaled(F.sum("spent")), F.sum("order_count"))).alias("avg_order_value"),
            scaled(F.sum("spent")).alias("cohort_revenue"),
        )
        .orderBy("cohort_month")
    )


def orders_per_customer(retail: Retail) -> DataFrame:
    """Number of orders of every customer, 0 for none."""
    counts = retail.orders.groupBy("customer_id").agg(F.count("order_id").alias("order_count"))
    return retail.customers.join(counts, "customer_id", "left").select(
        "customer_id", "first_name", F.coalesce("order_count", F.lit(0)).alias("order_count")
    )


def orders_per_customer_corr(retail: Retail) -> DataFrame:
    """The same by a correlated subquery, which Catalyst turns into the same left join."""
    spark = retail.customers.sparkSession
    return spark.sql(
        "SELECT customer_id, first_name,"
        " (SELECT count(*) FROM {o} AS o WHERE o.customer_id = c.customer_id) AS order_count"
        " FROM {c} AS c",
        c=retail.customers,
        o=retail.orders,
    )


def distinct_customers(retail: Retail) -> DataFrame:
    return retail.orders.select("customer_id").distinct()


# Categories and products


def category_performance(retail: Retail) -> DataFrame:
    return (
        order_category_sales(retail, retail.completed.select("order_id"))
        .groupBy("category_name")
        .agg(
            F.count("*").alias("orders"),
            F.sum("units").alias("units_sold"),
            scaled(F.sum("revenue")).alias("revenue"),
            rounded(mean_of(scaled(F.sum("prices")), F.sum("lines"))).alias("avg_price"),
        )
        .orderBy(F.desc("revenue"), "category_name")
    )


def tier_category_sales(retail: Retail) -> DataFrame:
    tiers = retail.customers.select("customer_id", "customer_tier")
    orders = retail.completed.select("order_id", "customer_id").join(tiers, "customer_id")
    return (
        order_category_sales(retail, orders.select("order_id", "customer_tier"))
        .groupBy("customer_tier", "category_name")
        .agg(
            F.count("*").alias("order_count"),
            F.sum("units").alias("units_sold"),
            scaled(F.sum("revenue")).alias("total_revenue"),
            rounded(mean_of(scaled(F.sum("revenue")), F.sum("lines"))).alias("avg_line_value"),
        )
        .orderBy("customer_tier", F.desc("total_revenue"), "category_name")
    )


def product_sales_since(retail: Retail, months: int | None, k: int) -> DataFrame:
    """Best-selling product names; ``months`` counts back from the last order date."""
    orders = retail.completed
    if months is not None:
        orders = orders.filter(F.col("order_date") >= F.add_months(last_order_date(retail), -months))
    lines = retail.order_items.select("order_id", "product_id", "quantity", "line_total")
    names = retail.products.select("product_id", "product_name", "category_name")
    # One row per product name and customer first: the customers are then plain row counts.
    per_customer = (
        lines.join(orders.select("order_id", "customer_id"), "order_id")
        .join(names, "product_id")
        .groupBy("category_name", "product_name", "customer_id")
        .agg(F.sum("quantity").alias("units"), cents_total("line_total").alias("spent"))
    )
    sales = per_customer.groupBy("category_name", "product_name").agg(
        F.count("customer_id").alias("unique_customers"),
        F.sum("units").alias("units_sold"),
        scaled(F.sum("spent")).alias("revenue"),
    )
    return top_k(sales, "revenue", k, "category_name", "product_name")


def recent_product_sales(retail: Retail) -> DataFrame:
    return product_sales_since(retail, months=3, k=15)


def product_sales_top10(retail: Retail) -> DataFrame:
    return product_sales_since(retail, months=None, k=10)


def sold(retail: Retail) -> DataFrame:
    """Product ids of all order lines."""
    return retail.order_items.select("product_id")


def sold_in(retail: Retail, start: str, end: str) -> DataFrame:
    """Product ids of lines in completed orders of a period."""
    days = F.col("order_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    orders = retail.completed.filter(days).select("order_id")
    return retail.order_items.select("order_id", "product_id").join(orders, "order_id").select("product_id")


def never_ordered(products: DataFrame, sold: DataFrame) -> DataFrame:
    """Products ``NOT IN`` the sold ones, with SQL's rule for NULL: a NULL among the sold ids
    leaves no row, and a product without an id is left out unless nothing was sold.

    A literal NOT IN makes Spark broadcast the sold side whole; here it is reduced to
    distinct ids and met by a hash anti-join, and the NULL rule is a scalar test.
    """
    ids = sold.select("product_id").distinct()
    # One row: is there a NULL among the sold ids, and is there any id at all.
    facts = ids.agg(
        F.struct(
            F.coalesce(F.bool_or(F.col("product_id").isNull()), F.lit(False)).alias("has_null"),
            (F.count("*") > 0).alias("any_sold"),
        ).alias("facts")
    ).scalar()
    keep = ~facts["has_null"] & (F.col("product_id").isNotNull() | ~facts["any_sold"])
    return _product_listing(products.join(ids, "product_id", "left_anti").filter(keep))


def never_ordered_anti(products: DataFrame, sold: DataFrame) -> DataFrame:
    """Products without a sold line (NOT EXISTS): NULL ids among the sold ones do not matter."""
    ids = sold.select("product_id").distinct()
    return _product_listing(products.join(ids, "product_id", "left_anti"))


def _product_listing(products: DataFrame) -> DataFrame:
    listed = products.select("product_id", "product_name", "category_name", "unit_price", "stock_quantity")
    return listed.orderBy("category_name", "product_name", "product_id")


# Dates


def day_of_week_sales(retail: Retail) -> DataFrame:
    daily = retail.completed.groupBy(F.date_format("order_date", "EEEE").alias("day_of_week"))
    return daily.agg(
        F.count("*").alias("order_count"),
        money_total("total_amount").alias("total_revenue"),
        rounded(money_mean("total_amount")).alias("avg_order_value"),
        F.min(F.dayofweek("order_date")).alias("_sunday_first"),
    ).orderBy("_sunday_first").drop("_sunday_first")


def shipping_performance(retail: Retail) -> DataFrame:
    waited = days_between("ship_date", "order_date")
    return retail.ship_dates.groupBy(month_label("order_date").alias("month")).agg(
        F.count("*").alias("orders_shipped"),
        rounded(F.avg(waited)).alias("avg_days_to_ship"),
        F.min(waited).alias("fastest_ship"),
        F.max(waited).alias("slowest_ship"),
    ).orderBy("month")


def last_order_date(retail: Retail):
    """The newest order date, standing for "today" so that results can be repeated."""
    return retail.orders.agg(F.max("order_date")).scalar()


def recent_monthly(retail: Retail, months: int = 6) -> DataFrame:
    recent = retail.completed.filter(F.col("order_date") >= F.add_months(last_order_date(retail), -months))
    return recent.groupBy(month_label("order_date").alias("month")).agg(
        F.count("*").alias("order_count"), money_total("total_amount").alias("monthly_revenue")
    ).orderBy("month")


def date_range_daily(retail: Retail, start: str = "1997-01-01", end: str = "1997-12-31") -> DataFrame:
    days = F.col("order_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return retail.completed.filter(days).groupBy("order_date").agg(
        F.count("*").alias("orders"), money_total("total_amount").alias("revenue")
    ).orderBy("order_date")


# Look-ups and projections


def point_lookup(retail: Retail, email: str) -> DataFrame:
    return retail.customers_by_email(email).drop("place_id")


def lower_lookup(retail: Retail, email: str) -> DataFrame:
    """Look-up that ignores case; no filter on a function of a column reaches the scan."""
    return retail.customers_placed.filter(F.lower("email") == email.lower()).drop("place_id")


def city_orders(retail: Retail, city: str) -> DataFrame:
    people = retail.customers_placed.filter(F.col("city") == city)
    return people.join(retail.orders, "customer_id").select(
        "first_name", "last_name", "order_id", "total_amount"
    )


def project(retail: Retail) -> DataFrame:
    return retail.completed.select("order_id", "customer_id", "order_date", "total_amount")


def order_totals(retail: Retail) -> DataFrame:
    """Every order with its total recomputed from its lines, 0 without lines."""
    sums = retail.order_items.groupBy("order_id").agg(cents_total("line_total").alias("lines_total"))
    return retail.orders.join(sums, "order_id", "left").select(
        "order_id", scaled(F.coalesce("lines_total", F.lit(0))).alias("total_amount")
    )


def timing_compare(runs: DataFrame) -> DataFrame:
    """Before/after comparison of run times: ``runs(query, phase, seconds)``, to a hundredth."""
    averages = runs.groupBy("query").agg(
        *[
            mean_of(
                money_total(F.when(F.col("phase") == phase, F.col("seconds"))),
                F.count_if(F.col("phase") == phase),
            ).alias(f"{phase}_avg")
            for phase in ("before", "after")
        ]
    )
    return averages.select(
        "query",
        "before_avg",
        "after_avg",
        F.try_divide("before_avg", "after_avg").alias("speedup"),
        (-percent_change("after_avg", "before_avg")).alias("improvement_pct"),
    )
