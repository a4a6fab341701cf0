"""Star-schema warehouse: dimensions, sales facts, the joined view and its questions."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.functions.calendar import OPEN_END, calendar_of, date_dimension
from tallyhouse.functions.scalar import cents, cents_total, date_key, full_name, mean_of, relabel, rounded, scaled
from tallyhouse.operators.keys import with_sequence_key
from tallyhouse.operators.ranking import top_k
from tallyhouse.sources.versions import VersionedStore
from tallyhouse.sources.views import Retail

# Order states.
ORDER_STATUS = [
    (1, "PENDING", "Pending", "Order placed, awaiting processing", False),
    (2, "SHIPPED", "Shipped", "Order shipped to customer", False),
    (3, "COMPLETED", "Completed", "Order delivered and completed", True),
    (4, "CANCELLED", "Cancelled", "Order cancelled", True),
]

# Payment methods with their processing fee in percent.
PAYMENT_METHODS = [
    (1, "CC", "Credit Card", 2.9),
    (2, "DC", "Debit Card", 1.5),
    (3, "PP", "PayPal", 3.5),
    (4, "AP", "Apple Pay", 2.5),
]

# Payment method by order id modulo 4, and the tax in percent.
PAYMENT_BY_REMAINDER = {0: "Credit Card", 1: "Debit Card", 2: "PayPal", 3: "Apple Pay"}
TAX_PERCENT = 8

TABLES = ["dim_date", "dim_customer", "dim_product", "dim_order_status", "dim_payment_method", "fact_sales"]

# The fact columns, in order.
FACT_COLUMNS = [
    "sales_key", "date_key", "customer_key", "product_key", "status_key", "payment_method_key", "order_id",
    "order_item_id", "quantity", "unit_price", "line_total", "discount_amount", "tax_amount", "net_revenue",
    "gross_profit", "loaded_at",
]

# When rows were written; these differ from load to load.
LOAD_TIMES = ("created_at", "updated_at", "loaded_at")


class Warehouse:
    """The six tables as lazy frames over a retail source; ``saved`` reads stored ones instead."""

    def __init__(self, retail: Retail | None):
        self.retail = retail
        self.path: str | None = None  # of a stored one
        self._given_facts = False

    def with_facts(self, facts: DataFrame) -> Warehouse:
        """Use these facts instead of loading them."""
        self.__dict__["fact_sales"] = facts
        self._given_facts = True
        return self

    @classmethod
    def saved(cls, spark: SparkSession, path: str) -> Warehouse:
        """The last finished version under ``path``."""
        house, store = cls(None), VersionedStore(spark, path)
        house.path = path
        rows = store.manifest()
        for name in TABLES:
            house.__dict__[name] = store.frame(rows, name)
        return house

    @cached_property
    def dim_date(self) -> DataFrame:
        return date_dimension(calendar_of(self.retail.orders, "order_date"))

    @cached_property
    def dim_customer(self) -> DataFrame:
        return dim_customer(self.retail.customers_registered)

    @cached_property
    def dim_product(self) -> DataFrame:
        return dim_product(self.retail.products, self.retail.categories)

    @cached_property
    def dim_order_status(self) -> DataFrame:
        return dim_order_status(self.retail.orders.sparkSession)

    @cached_property
    def dim_payment_method(self) -> DataFrame:
        return dim_payment_method(self.retail.orders.sparkSession)

    @cached_property
    def customer_keys(self) -> DataFrame:
        """Current surrogate keys alone. Before the dimension is stored they need no more than the
        customer ids, so a fact load does not compute the whole dimension."""
        if self.retail is None or "dim_customer" in self.__dict__:
            return self.dim_customer.filter("is_current").select("customer_key", "customer_id")
        return with_sequence_key(self.retail.customers.select("customer_id"), "customer_key", "customer_id")

    @cached_property
    def product_keys(self) -> DataFrame:
        if self.retail is None or "dim_product" in self.__dict__:
            return self.dim_product.select("product_key", "product_id")
        return with_sequence_key(self.retail.products.select("product_id"), "product_key", "product_id")

    @cached_property
    def fact_sales(self) -> DataFrame:
        return fact_sales(self, FACT_COLUMNS)

    def frames(self) -> dict[str, DataFrame]:
        """The tables and the sales view by the names that SQL text uses."""
        return {name: getattr(self, name) for name in TABLES} | {"vw_sales_complete": vw_sales_complete(self)}

    def facts(self, *columns: str) -> DataFrame:
        """Some columns of the facts. While the facts are not stored, only the keys asked for are
        looked up: Catalyst cannot know that an unused look-up adds no rows."""
        if self.retail is None or self._given_facts:
            return self.fact_sales.select(*columns)
        return fact_sales(self, list(columns))


# Dimensions


def dim_customer(customers: DataFrame) -> DataFrame:
    """First load: one open, current version per customer, starting at registration.

    ``valid_from`` may not be NULL, so a customer without a registration date is valid
    from 1900-01-01.
    """
    since = F.coalesce("registration_date", F.lit("1900-01-01").cast("date"))
    rows = customers.select(
        "customer_id",
        "first_name",
        "last_name",
        "email",
        "phone",
        "city",
        "state",
        "customer_tier",
        "registration_date",
        since.alias("valid_from"),
        F.lit(OPEN_END).alias("valid_to"),
        F.lit(True).alias("is_current"),
        *_written(),
    )
    return with_sequence_key(rows, "customer_key", "customer_id")


def dim_product(products: DataFrame, categories: DataFrame) -> DataFrame:
    rows = products.join(categories, "category_name").select(
        "product_id",
        "product_name",
        "category_id",
        "category_name",
        "category_description",
        "unit_price",
        "is_active",
        *_written(),
    )
    return with_sequence_key(rows, "product_key", "product_id")


def _written() -> list[Column]:
    return [F.current_timestamp().alias("created_at"), F.current_timestamp().alias("updated_at")]


def dim_order_status(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        ORDER_STATUS,
        "status_key int, status_code string, status_name string, status_description string, is_final_state boolean",
    )


def dim_payment_method(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        PAYMENT_METHODS,
        "payment_method_key int, payment_method_code string, payment_method_name string, processing_fee_pct double",
    )


# Facts


def _each(keys: DataFrame, key: str, by: str) -> DataFrame:
    """One row per id with the list of its surrogate keys: one, unless the source repeats the id."""
    return keys.groupBy(by).agg(F.collect_list(key).alias(f"_{key}s"))


def keyed_lines(house: Warehouse, columns: list[str]) -> DataFrame:
    """Lines of completed orders with the keys that ``columns`` ask for, in the few narrow columns that
    ``fact_columns`` derives the others from. Keys that are not found stay NULL.

    ``_alike`` is the place among the lines that share an id. Customers are met by the orders, which
    are fewer and narrower than lines, and the lines of an order are numbered where the join by order
    has put them, so lines are dealt once by order and, if asked for, once by product.
    """
    retail = house.retail
    # Two fixed lists of four: their keys are mapped, as a join would meet on a few heavy values.
    status = {name: number for number, _, name, *_ in ORDER_STATUS}
    orders = retail.completed.select(
        "order_id", "customer_id", date_key("order_date").alias("date_key"), relabel("order_status", status).alias("status_key")
    )
    if "customer_key" in columns:
        orders = orders.join(_each(house.customer_keys, "customer_key", "customer_id"), "customer_id", "left")
    items = retail.order_items.drop("ship_date")
    given = "order_item_id" in items.columns
    # An id that is made here begins with the order, so it is numbered within the order's lines.
    one_id = ["order_item_id"] if given else ["order_id", "order_item_id"]
    alike = Window.partitionBy(*one_id).orderBy("quantity", "unit_price", "line_total")
    lines = retail.with_item_id(items.join(orders, "order_id")).withColumn("_alike", F.row_number().over(alike))
    if not given:
        lines = lines.drop("order_item_id")  # a long text, made again behind the shuffles
    if "customer_key" in columns:
        lines = lines.select("*", F.explode_outer("_customer_keys").alias("customer_key")).drop("_customer_keys")
    if "product_key" in columns:
        lines = lines.join(house.product_keys, "product_id", "left")
    return lines


def fact_columns(house: Warehouse, lines: DataFrame) -> DataFrame:
    """Keyed lines with id, sales key, payment method, tax and net revenue.

    The key is a hash of the line's id and its place among the lines that share it, so a line has
    the same key in every load. There is no cost in the source, so the gross profit is NULL.
    """
    amount, discount = cents("line_total"), F.lit(0)
    # Whole cents times percent: ten-thousandths, exact.
    net = (amount - discount) * 100 + amount * TAX_PERCENT
    payment = {name: number for number, _, name, _ in PAYMENT_METHODS}
    return house.retail.with_item_id(lines).withColumns(
        {
            "sales_key": F.xxhash64("order_item_id", "_alike"),
            "gross_profit": F.lit(None).cast("decimal(25,4)"),
            "loaded_at": F.current_timestamp(),
            "payment_method_key": relabel(relabel(F.col("order_id") % 4, PAYMENT_BY_REMAINDER), payment),
            "discount_amount": scaled(discount),
            "tax_amount": scaled(amount * TAX_PERCENT, 4),
            "net_revenue": scaled(net, 4),
        }
    )


def fact_sales(house: Warehouse, columns: list[str]) -> DataFrame:
    """One row per line of a completed order. Keys that are not found stay NULL."""
    return fact_columns(house, keyed_lines(house, columns)).select(*columns)


def vw_sales_complete(house: Warehouse) -> DataFrame:
    """Facts with the attributes of all their dimensions; only the payment method may be missing."""
    days = house.dim_date.select(
        "date_key", "full_date", "year", "quarter", "month", "month_name", "day_name", "is_weekend"
    )
    customers = house.dim_customer.select(
        "customer_key", "customer_id", full_name().alias("customer_name"), "email", "city", "state", "customer_tier"
    )
    products = house.dim_product.select("product_key", "product_id", "product_name", "category_name")
    status = house.dim_order_status.select("status_key", "status_name")
    payment = house.dim_payment_method.select("payment_method_key", "payment_method_name")
    return (
        house.fact_sales.join(customers, "customer_key")
        .join(products, "product_key")
        .join(days, "date_key")
        .join(status, "status_key")
        .join(payment, "payment_method_key", "left")
        .drop("date_key", "customer_key", "product_key", "status_key", "payment_method_key", "tax_amount")
        .drop("month_key", "gross_profit", "loaded_at")
    )


# Questions


def dw_monthly_category(house: Warehouse, today: Column | None = None, months: int = 6, k: int = 15) -> DataFrame:
    """Revenue by month and category for the months up to ``today`` (else the last day sold), 15 rows.

    The first day wanted is also put as a bound on the facts' own date key (and on the month
    they are stored by), so that older facts are left out before any join.
    """
    if today is None:
        last = house.facts("date_key").agg(F.max("date_key")).scalar()
        today = F.to_date(last.cast("string"), "yyyyMMdd")
    first_day = F.add_months(today, -months)
    facts = house.facts("date_key", "product_key", "customer_key", "net_revenue", "quantity")
    if house.retail is None and "month_key" in house.fact_sales.columns:
        facts = house.fact_sales.filter(F.col("month_key") >= F.floor(date_key(first_day) / 100))
    days = house.dim_date.select("date_key", "full_date", "year", "month", "month_name")
    per_customer = (
        facts.filter(F.col("date_key") >= date_key(first_day))
        .join(days.filter(F.col("full_date") >= first_day), "date_key")
        .join(house.dim_product.select("product_key", "category_name"), "product_key")
        .groupBy("year", "month", "month_name", "category_name", "customer_key")
        .agg(F.sum("net_revenue").alias("net"), F.sum("quantity").alias("units"))
    )
    groups = per_customer.groupBy("year", "month", "month_name", "category_name").agg(
        F.sum("net").alias("revenue"),
        F.sum("units").alias("units_sold"),
        F.count("customer_key").alias("unique_customers"),
    )
    return groups.orderBy("year", "month", F.desc("revenue"), "category_name").limit(k).drop("month")


def dw_tier_revenue(house: Warehouse) -> DataFrame:
    """By tier of the current version. Facts go to one row per order, then per customer, so
    both distinct counts become plain counts of rows."""
    facts = house.facts("customer_key", "order_id", "net_revenue", "quantity")
    per_order = facts.groupBy("customer_key", "order_id").agg(*_fact_sums())
    per_customer = per_order.groupBy("customer_key").agg(
        F.count("*").alias("orders"), *[F.sum(c).alias(c) for c in ("net", "lines", "units")]
    )
    tiers = house.dim_customer.filter("is_current").select("customer_key", "customer_tier")
    return (
        per_customer.join(tiers, "customer_key")
        .groupBy("customer_tier")
        .agg(
            F.count("*").alias("customers"),
            F.sum("orders").alias("orders"),
            F.round(F.sum("net"), 2).alias("total_revenue"),
            rounded(mean_of(F.sum("net"), F.sum("lines"))).alias("avg_transaction"),
            F.sum("units").alias("total_units"),
        )
    )


def dw_weekend(house: Warehouse) -> DataFrame:
    """Facts are summed per day first: the date dimension then meets one row per day."""
    per_day = house.facts("date_key", "net_revenue", "quantity").groupBy("date_key").agg(*_fact_sums())
    day_type = F.when(F.col("is_weekend"), "Weekend").otherwise("Weekday")
    return (
        per_day.join(house.dim_date.select("date_key", "is_weekend"), "date_key")
        .groupBy(day_type.alias("day_type"))
        .agg(
            F.sum("lines").alias("transactions"),
            F.round(F.sum("net"), 2).alias("revenue"),
            rounded(mean_of(F.sum("net"), F.sum("lines"))).alias("avg_transaction"),
            F.sum("units").alias("units_sold"),
        )
    )


def dw_top_products(house: Warehouse, k: int = 10) -> DataFrame:
    facts = house.facts("product_key", "net_revenue", "quantity", "unit_price")
    per_product = facts.groupBy("product_key").agg(*_fact_sums(), cents_total("unit_price").alias("prices"))
    named = per_product.join(
        house.dim_product.select("product_key", "product_name", "category_name"), "product_key"
    ).select(
        "product_key",
        "product_name",
        "category_name",
        F.col("units").alias("units_sold"),
        F.round("net", 2).alias("total_revenue"),
        rounded(mean_of(scaled("prices"), "lines")).alias("avg_price"),
    )
    return top_k(named, "total_revenue", k, "product_key")


def _fact_sums():
    return [
        F.sum("net_revenue").alias("net"),
        F.count("*").alias("lines"),
        F.sum("quantity").alias("units"),
    ]


# Build and check


FIRST_LOAD = "first load"
_FACTS_A_FILE = 1_000_000


def build_warehouse(retail: Retail, path: str) -> DataFrame:
    """Write the dimensions, then the facts on the stored dimension keys; return row counts.

    All tables become visible in one commit. A finished load is not done again, one that was killed
    leaves nothing that counts. Facts are stored by month.
    """
    spark = retail.orders.sparkSession
    store = VersionedStore(spark, path)
    if not store.has_batch(FIRST_LOAD):
        change, house = store.change(FIRST_LOAD), Warehouse(retail)
        change.replace_all({name: getattr(house, name) for name in TABLES[:-1]})
        for name in TABLES[:-1]:
            house.__dict__[name] = change.read(name)
        lines = by_month(keyed_lines(house, FACT_COLUMNS), retail.order_items.count())
        change.replace("fact_sales", fact_columns(house, lines).select(*FACT_COLUMNS, "month_key"), partitions=["month_key"])
        change.commit()
    return table_counts(Warehouse.saved(spark, path))


def by_month(keyed: DataFrame, lines: int) -> DataFrame:
    """Keyed lines dealt by month, and by order and product where ``lines`` are so many that a month
    needs several files. Months are not alike, so the number is taken as if a tenth held all."""
    monthly = keyed.withColumn("month_key", F.floor(F.col("date_key") / 100).cast("int"))
    spread = max(1, lines // (10 * _FACTS_A_FILE))
    return monthly.repartition("month_key", F.pmod(F.xxhash64("order_id", "product_id", "line_total"), F.lit(spread)))


def table_counts(house: Warehouse) -> DataFrame:
    """One row per table with its number of rows."""
    counts = [
        getattr(house, name).agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count")) for name in TABLES
    ]
    total = counts[0]
    for one in counts[1:]:
        total = total.unionByName(one)
    return total
