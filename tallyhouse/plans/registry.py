"""Every query by name, run over the supplied tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions.scalar import money_total
from tallyhouse.operators import history, quality
from tallyhouse.operators.key_index import KeyIndex
from tallyhouse.operators.stored_history import StoredHistory
from tallyhouse.plans import basics, increments, ordered, players, retail, star, trips, warehouse
from tallyhouse.plans.increments import IncrementalWarehouse
from tallyhouse.plans.warehouse import Warehouse
from tallyhouse.session import apply_settings, fresh_path
from tallyhouse.sources import files, inference, sql, views
from tallyhouse.sources.html_tables import stats_records
from tallyhouse.sources.player_columns import RAW_COLUMNS
from tallyhouse.sources.tables import SCHEMAS, table
from tallyhouse.sources.versions import VersionedStore
from tallyhouse.sources.views import Retail

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries that depend on the supplied data.
CITY = "NATION_7"
EMAIL = "Customer#000000042@email.com"
POINT_IN_TIME = "1998-06-01"
SOLD_PERIOD = ("1995-01-01", "1995-01-31")
SHOWN_CUSTOMERS = [1, 2, 3, 4, 5]
ROUTE_MIN_TRIPS = 5
STATS_SITE = "https://stats.example.com"
SEASON = 2025
NULLABLE_TRIP_COLUMNS = ["pickup_datetime", "dropoff_datetime", "passenger_count", "pickup_latitude", "fare_amount"]


def plain(df: DataFrame) -> DataFrame:
    """Result columns in the few types every client knows: bigint, double, boolean, text.

    Dates and times become ISO text. This is done here, at the edge, and not in the library.
    """

    def cast(field: T.StructField) -> str:
        if isinstance(field.dataType, T.IntegralType):
            kind = "bigint"
        elif isinstance(field.dataType, T.NumericType):
            kind = "double"
        elif isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            kind = "string"
        else:
            return f"`{field.name}`"
        return f"cast(`{field.name}` as {kind}) as `{field.name}`"

    return df.selectExpr(*[cast(f) for f in df.schema])


def _retail(query, *args) -> Query:
    return lambda spark, sf: query(Retail(spark, sf), *args)


def _first(query, k: int) -> Query:
    """The first rows of an ordered answer."""
    return lambda spark, sf: query(Retail(spark, sf)).limit(k)


def _house(query, *args) -> Query:
    """A table of the warehouse as it is loaded."""
    return lambda spark, sf: query(Warehouse(Retail(spark, sf)), *args)


_stores: dict[tuple, VersionedStore] = {}
_HOUSE_TABLES = ("region", "nation", "customer", "part", "orders", "lineitem")


def _store(spark: SparkSession, sf: str, name: str, fill: Callable[[VersionedStore], None]) -> VersionedStore:
    """A store derived from the supplied tables, filled on first use in an application and again when
    a table has changed."""
    state = tuple(files.file_state(spark, f"{sf}/{t}.parquet") for t in _HOUSE_TABLES)
    key = (spark.sparkContext.applicationId, sf, name, state)
    if key not in _stores:
        store = VersionedStore(spark, fresh_path(spark, name))
        fill(store)
        _stores[key] = store
    return _stores[key]


def stored_house(spark: SparkSession, sf: str) -> Warehouse:
    """The warehouse over the supplied tables."""
    store = _store(spark, sf, "warehouse", lambda new: warehouse.build_warehouse(Retail(spark, sf), new.path))
    return Warehouse.saved(spark, store.path)


def stored_history(spark: SparkSession, sf: str) -> StoredHistory:
    """The customer dimension of the warehouse in buckets: as loaded, and after a batch of changes."""

    def fill(new):
        made = StoredHistory(new)
        made.create(stored_house(spark, sf).dim_customer)
        made.apply(views.tier_changes(Retail(spark, sf)), "changes")

    return StoredHistory(_store(spark, sf, "history", fill))


_stars: dict[str, Warehouse] = {}


def stored_star(spark: SparkSession, sf: str) -> Warehouse:
    """The warehouse with facts and customers in buckets, or as it is if one customer holds too much."""
    house = stored_house(spark, sf)
    path = house.path
    if path not in _stars:
        _stars[path] = star.store_star(house, f"star_{uuid.uuid4().hex}", fresh_path(spark, "star")) or house
    return _stars[path]


LATE = 1_000_000_000


def stored_increments(spark: SparkSession, sf: str) -> IncrementalWarehouse:
    """A warehouse loaded in three batches. At first a tenth of the customers is not known, and their
    lines and the last lines of orders come late, in the second batch, which is delivered twice. In
    the third, half of the missing customers arrive."""

    def fill(new):
        source, made = Retail(spark, sf), IncrementalWarehouse(spark, new.path)
        customers = source.customers.select("customer_id", *increments.ATTRIBUTES)
        lines = source.with_item_id(source.order_items.drop("ship_date").join(
            source.completed.select("order_id", "customer_id", "order_date"), "order_id"))
        late = (F.col("line_number") >= 6) | (F.col("customer_id") % 10 == 0)
        lines = lines.withColumn("arrival", F.col("order_id") + F.when(late, LATE).otherwise(0))
        # Every load reads the lines again, so they are joined and landed once.
        lines = files.staged(lines.select(*increments.LINE), "lines")
        known = customers.where("customer_id % 10 <> 0")
        made.load("1", known, lines.where(F.col("arrival") < LATE))
        for _ in range(2):
            made.load("2", known.limit(0), lines)
        made.load("3", customers.where("customer_id % 20 = 0"), lines)

    return IncrementalWarehouse(spark, _store(spark, sf, "increments", fill).path)


def _asked(query, *args) -> Query:
    """A question to the stored warehouse."""
    return lambda spark, sf: query(stored_house(spark, sf), *args)


def _features(query, *args) -> Query:
    return lambda spark, sf: query(trips.trip_features(views.trips(spark, sf)), *args)


def _trips(query, *args) -> Query:
    return lambda spark, sf: query(views.trips(spark, sf), *args)


def _months(query) -> Query:
    return lambda spark, sf: query(trips.pickup_calendar(views.monthly_trips(spark, sf)))


def _staff(query, *args) -> Query:
    return lambda spark, sf: query(views.staff(spark, sf), *args)


def _players(*steps) -> Query:
    """The raw player rows put through the given steps in turn.

    Removing duplicates reads the records twice, so they are landed first, as captured
    records are.
    """

    def run(spark, sf):
        df = views.raw_player_totals(spark, sf)
        if len(steps) > 1 or players.clean_players in steps:
            df = files.staged(df, "player-records")
        for step in steps:
            df = df.transform(step)
        return df

    return run


def _stored(fmt: str, name: str) -> Query:
    """Store a supplied table in a format and scan it back with its known schema."""

    def run(spark, sf):
        path = files.write(table(spark, sf, name), fresh_path(spark, f"scan-{fmt}"), fmt)
        return files.scan(spark, path, fmt, SCHEMAS[name])

    return run


def _order_parts(spark: SparkSession, sf: str) -> str:
    """Orders written as CSV by three sources that do not agree on types: whole prices and days, broken
    prices and times, and customer numbers with a letter. The folder of all files."""
    orders, path = table(spark, sf, "orders"), fresh_path(spark, "order-parts")
    price, at = F.col("o_totalprice"), F.col("o_orderdate")
    sources = [
        {"o_totalprice": F.floor(price), "o_orderdate": F.date_format(at, "yyyy-MM-dd")},
        {"o_totalprice": price, "o_orderdate": F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss")},
        {"o_totalprice": F.lit(None).cast("string"), "o_custkey": F.concat(F.lit("C"), "o_custkey"), "o_orderdate": F.date_format(at, "yyyy-MM-dd")},
    ]
    for place, columns in enumerate(sources):
        files.write(orders.where(F.col("o_orderkey") % 3 == place).withColumns(columns), f"{path}/source{place}", "csv")
    return path


def _history(spark, sf) -> tuple[DataFrame, DataFrame]:
    """The stored customer dimension and a batch of changes to it."""
    return stored_house(spark, sf).dim_customer, views.tier_changes(Retail(spark, sf))


def _after_changes(spark, sf) -> DataFrame:
    return stored_history(spark, sf).versions()


_VERSION = ("customer_key", "customer_id", "first_name", "last_name", "customer_tier", "valid_from", "valid_to", "is_current")
_AS_OF = ("customer_id", "first_name", "last_name", "customer_tier", "valid_from", "valid_to")


def never_ordered(spark, sf):
    source = Retail(spark, sf)
    return retail.never_ordered(source.listed_products, retail.sold(source))


def never_ordered_anti(spark, sf):
    source = Retail(spark, sf)
    return retail.never_ordered_anti(source.listed_products, retail.sold(source))


def unsold_in_period(spark, sf):
    source = Retail(spark, sf)
    return retail.never_ordered(source.products, retail.sold_in(source, *SOLD_PERIOD))


def dim_order_status(spark, sf):
    """The fixed states, each with the number of orders in it."""
    used = Retail(spark, sf).orders.groupBy(F.col("order_status").alias("status_name")).agg(F.count("*").alias("orders"))
    return warehouse.dim_order_status(spark).join(used, "status_name", "left").fillna(0, ["orders"])


def dim_payment_method(spark, sf):
    """The fixed methods, each with the completed orders paid that way."""
    method = F.col("order_id") % 4
    paid = Retail(spark, sf).completed.groupBy(
        warehouse.relabel(method, warehouse.PAYMENT_BY_REMAINDER).alias("payment_method_name")
    ).agg(F.count("*").alias("orders"), money_total("total_amount").alias("paid"))
    return warehouse.dim_payment_method(spark).join(paid, "payment_method_name", "left").fillna(0, ["orders"])


def dw_monthly_category(spark, sf):
    return warehouse.dw_monthly_category(stored_house(spark, sf), retail.last_order_date(Retail(spark, sf)))


def fact_asof_customer(spark, sf):
    """Stored sales facts with the tier the customer held on the day of the order."""
    house = stored_house(spark, sf)
    ids = house.dim_customer.select(F.col("customer_key").alias("_first_key"), "customer_id")
    facts = house.fact_sales.select(
        "order_id", "order_item_id", "net_revenue", F.col("customer_key").alias("_first_key"),
        F.to_date(F.col("date_key").cast("string"), "yyyyMMdd").alias("order_date"),
    )
    lines = facts.join(ids, "_first_key").select(
        "order_id", "order_item_id", "customer_id", "order_date", "net_revenue"
    )
    versions = _after_changes(spark, sf).select("customer_id", "customer_key", "customer_tier", "valid_from", "valid_to")
    return history.as_of_join(lines, versions, "customer_id", "order_date")


def html_stats(spark, sf):
    """Statistics tables found in the supplied pages and in pages set from the player records."""
    shown = views.stats_pages(views.raw_player_totals(spark, sf))
    pages = table(spark, sf, "pages").unionByName(shown)
    cells = [c for c in RAW_COLUMNS if c not in ("season_year", "player_url")]
    return stats_records(pages, cells, STATS_SITE, SEASON).drop("scraped_at")


def player_run_summary(spark, sf):
    return players.player_run_summary(spark, views.raw_player_totals(spark, sf), SEASON)


def inline_rows(spark, sf):
    # A floor and a budget per department.
    offices = basics.inline_rows(
        spark,
        [("AUTOMOBILE", 1), ("BUILDING", 2), ("FURNITURE", 3), ("HOUSEHOLD", 4), ("MACHINERY", 5)],
        ["department", "floor"],
    )
    budgets = basics.inline_pandas(
        spark,
        pd.DataFrame(
            {
                "department": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
                "budget": [100.0, 200.0, 300.0, 400.0, 500.0],
            }
        ),
    )
    return basics.department_sizes(views.staff(spark, sf), offices, budgets)


def null_counts(spark, sf):
    return quality.null_counts(views.trips(spark, sf), NULLABLE_TRIP_COLUMNS)


def basic_stats(spark, sf):
    numeric = ["passenger_count", "trip_distance", "fare_amount", "tip_amount", "total_amount"]
    return quality.basic_stats(views.trips(spark, sf), numeric)


def audit_unique(spark, sf):
    lines = table(spark, sf, "lineitem")
    return quality.audit_unique(lines, "l_orderkey", "l_linenumber")


def category_defaults(spark, sf):
    """Categories from a source that has neither their state nor their place: both get the defaults,
    while a description that is there, or NULL, stays."""
    given = Retail(spark, sf).categories.withColumn(
        "category_description", F.when(F.col("category_id") % 2 == 0, F.col("category_description"))
    )
    return quality.with_defaults(given, {"is_active": True, "sort_order": 0, "category_description": "none"})


def audit_orphans(spark, sf):
    source = Retail(spark, sf)
    return quality.audit_orphans(views.tier_changes(source), source.customers, "customer_id")


def _order_index(spark, sf) -> tuple[KeyIndex, DataFrame]:
    """An index of the orders up to nine tenths of the greatest number, taken in two batches, and that
    number. What comes next begins at 85 hundredths."""
    orders = table(spark, sf, "orders").select("o_orderkey")
    greatest = orders.agg(F.max("o_orderkey")).first()[0]

    def fill(new):
        made = KeyIndex(new)
        made.add("1", orders.where(F.col("o_orderkey") * 2 <= greatest), 8)
        made.add("2", orders.where((F.col("o_orderkey") * 2 > greatest) & (F.col("o_orderkey") * 10 <= 9 * greatest)), 8)

    return KeyIndex(_store(spark, sf, "order-keys", fill)), greatest


def audit_new_keys(spark, sf):
    """Orders of a new batch that are there already."""
    index, greatest = _order_index(spark, sf)
    batch = table(spark, sf, "orders").where(F.col("o_orderkey") * 100 > 85 * greatest)
    return index.known(batch, "o_orderkey")[0]


def audit_new_references(spark, sf):
    """Orders that lines of a new batch refer to and that are not there, with the number of lines."""
    index, greatest = _order_index(spark, sf)
    batch = table(spark, sf, "lineitem").where(F.col("l_orderkey") * 100 > 85 * greatest)
    return index.unknown(batch, "l_orderkey")[0]


# Unique keys, references and required columns of the retail and warehouse tables.
KEYS = {
    "customers": "customer_id", "orders": "order_id", "products": "product_id", "categories": "category_id",
    "dim_date": "date_key", "dim_customer": "customer_key", "dim_product": "product_key", "fact_sales": "sales_key",
}
REFERENCES = [
    ("products", "category_id", "categories"), ("orders", "customer_id", "customers"),
    ("order_items", "order_id", "orders"), ("order_items", "product_id", "products"),
    ("fact_sales", "date_key", "dim_date"), ("fact_sales", "customer_key", "dim_customer"),
    ("fact_sales", "product_key", "dim_product"), ("fact_sales", "status_key", "dim_order_status"),
    ("fact_sales", "payment_method_key", "dim_payment_method"),
]
REQUIRED = {
    "categories": ["category_name"],
    "products": ["product_name", "unit_price"],
    "customers": ["first_name", "last_name", "email"],
    "orders": ["customer_id", "order_date", "total_amount"],
    "order_items": ["order_id", "product_id", "quantity", "unit_price", "line_total"],
    "fact_sales": [
        "date_key", "customer_key", "product_key", "status_key", "order_id", "order_item_id", "quantity",
        "unit_price", "line_total", "net_revenue",
    ],
}


def _schema_frames(spark, sf) -> dict[str, DataFrame]:
    house = stored_house(spark, sf)
    return Retail(spark, sf).frames() | {name: getattr(house, name) for name in warehouse.TABLES}


def audit_keys(spark, sf):
    frames = _schema_frames(spark, sf)
    return quality.stacked([quality.repeated_keys(frames[name], name, key) for name, key in KEYS.items()])


def audit_references(spark, sf):
    frames = _schema_frames(spark, sf)
    return quality.stacked(
        [quality.orphan_count(frames[child], child, frames[parent], parent, key) for child, key, parent in REFERENCES]
    )


def audit_required(spark, sf):
    frames = _schema_frames(spark, sf)
    return quality.stacked([quality.required_nulls(frames[name], name, columns) for name, columns in REQUIRED.items()])


def sql_monthly_orders(spark, sf):
    sql.register(Retail(spark, sf).frames())
    return sql.run(
        spark,
        "SELECT date_format(order_date, 'yyyy-MM') AS month, count(*) AS order_count,"
        " sum(CAST(total_amount AS DECIMAL(18,2))) AS revenue"
        " FROM orders WHERE order_status = 'Completed' GROUP BY 1 ORDER BY month",
    )


def sql_tier_orders(spark, sf):
    sql.register(Retail(spark, sf).frames())
    return sql.run(
        spark,
        "SELECT customer_tier, count(DISTINCT c.customer_id) AS customers, count(o.order_id) AS orders"
        " FROM customers AS c LEFT JOIN orders AS o ON o.customer_id = c.customer_id"
        " GROUP BY customer_tier ORDER BY customer_tier",
    )


def sql_stored_scorers(spark, sf):
    """SQL against the loaded store of player records."""
    stored = files.staged(_players(players.clean_players)(spark, sf), "player-totals")
    sql.register({"player_totals": stored})
    return sql.run(
        spark,
        "SELECT player, team_id, pts_per_game FROM player_totals WHERE pts_per_game > 25"
        " ORDER BY pts_per_game DESC, source_pos LIMIT 10",
    )


def scan_json_array(spark, sf):
    """Customers kept as files that hold one array of records each, one for every market segment."""
    path = fresh_path(spark, "json-arrays")
    customers = table(spark, sf, "customer")
    files.write_json_arrays(customers, path, "c_mktsegment")
    return files.scan(spark, path, "json", SCHEMAS["customer"], json_array=True)


def season_runs(spark, sf):
    """Two runs of a season written into folders of their own, and the rows found in each."""
    records = views.raw_player_totals(spark, sf)
    base = fresh_path(spark, "seasons")
    for stamp in ("20250101_000000", "20250102_000000"):
        files.write_run(records, base, SEASON, stamp)
    schema = T.StructType([*records.schema.fields, T.StructField("season", T.IntegerType()), T.StructField("run", T.StringType())])
    return files.scan(spark, base, "csv", schema).groupBy("season", "run").agg(F.count("*").alias("row_count"))


def convert_formats(spark, sf):
    return files.round_trip(table(spark, sf, "orders"), fresh_path(spark, "convert"))


def write_modes(spark, sf):
    return files.write_mode_steps(table(spark, sf, "customer"), fresh_path(spark, "write-modes"))


def timing_compare(spark, sf):
    """Event types as queries, even events before a change and odd ones after it."""
    phase = F.when(F.col("event_id") % 2 == 0, "before").otherwise("after")
    runs = table(spark, sf, "events").select(
        F.col("event_type").alias("query"),
        phase.alias("phase"),
        F.col("value").alias("seconds"),
    )
    return retail.timing_compare(runs)


def preview(spark, sf, rows: int = 10):
    return Retail(spark, sf).orders.orderBy("order_id").limit(rows)


_REGISTERED: dict[str, Query] = {
    # Scans and sinks
    "scan_csv": _stored("csv", "orders"),
    "scan_json": _stored("json", "customer"),
    "scan_parquet": _stored("parquet", "events"),
    "scan_csv_inferred": lambda spark, sf: inference.scan_inferred(spark, _order_parts(spark, sf)),
    "schema_drift": lambda spark, sf: inference.schema_drift(spark, _order_parts(spark, sf)).select("column_name", "type", "common_type"),
    "scan_json_array": scan_json_array,
    "inline_rows": inline_rows,
    "explicit_schema": _staff(basics.explicit_schema),
    "html_stats": html_stats,
    "convert_formats": convert_formats,
    "write_modes": write_modes,
    "preview": preview,
    # Projections and filters
    "project": _retail(retail.project),
    "computed_columns": _staff(basics.computed_columns),
    "filter_basic": _staff(basics.filter_basic),
    "filter_like": _staff(basics.filter_like, "Customer#_______1%"),
    "salary_level": _staff(basics.salary_level),
    "department_stats": _staff(basics.department_stats),
    "point_lookup": _retail(retail.point_lookup, EMAIL),
    "lower_lookup": _retail(retail.lower_lookup, EMAIL),
    "city_orders": _retail(retail.city_orders, CITY),
    "distinct_customers": _retail(retail.distinct_customers),
    # Retail
    "top_customers": _retail(retail.top_customers),
    "running_total": _retail(retail.running_total),
    "product_vs_category": _retail(retail.product_vs_category),
    "monthly_growth": _retail(retail.monthly_growth),
    "customer_ltv": _retail(retail.customer_ltv),
    "customer_ltv_min3": _retail(retail.customer_ltv_min3),
    "pct_of_category": _retail(retail.pct_of_category),
    "tier_category_sales": _retail(retail.tier_category_sales),
    "cohort_analysis": _retail(retail.cohort_analysis),
    "above_average": _retail(retail.above_average),
    "never_ordered": never_ordered,
    "never_ordered_anti": never_ordered_anti,
    "unsold_in_period": unsold_in_period,
    "monthly_growth_first12": _first(retail.monthly_growth, 12),
    "running_total_first30": _first(retail.running_total, 30),
    "product_vs_category_first20": _first(retail.product_vs_category, 20),
    "pct_of_category_first20": _first(retail.pct_of_category, 20),
    "above_average_first15": _first(retail.above_average, 15),
    "day_of_week_sales": _retail(retail.day_of_week_sales),
    "shipping_performance": _retail(retail.shipping_performance),
    "category_performance": _retail(retail.category_performance),
    "gold_customers": _retail(retail.gold_customers),
    "date_range_daily": _retail(retail.date_range_daily),
    "orders_per_customer": _retail(retail.orders_per_customer),
    "orders_per_customer_corr": _retail(retail.orders_per_customer_corr),
    "top3_per_category": _retail(retail.top3_per_category),
    "frequent_customers": _retail(retail.frequent_customers),
    "recent_monthly": _retail(retail.recent_monthly),
    "recent_product_sales": _retail(retail.recent_product_sales),
    "product_sales_top10": _retail(retail.product_sales_top10),
    "order_totals": _retail(retail.order_totals),
    "global_revenue": _retail(basics.global_revenue),
    "group_basic": _retail(basics.group_basic),
    "timing_compare": timing_compare,
    "line_running_revenue": _retail(ordered.line_running_revenue),
    "customer_spend_rank": _retail(ordered.customer_spend_rank),
    "line_price_rank": _retail(ordered.line_price_rank),
    # Trips
    "date_range_profile": _trips(trips.date_range_profile),
    "null_counts": null_counts,
    "basic_stats": basic_stats,
    "trip_cleaning": _trips(trips.trip_cleaning),
    "trip_cleaning_stats": _trips(trips.trip_cleaning_stats),
    "trip_features": _features(lambda df: df),
    "trip_hourly": _features(trips.trip_hourly),
    "peak_hour": _features(trips.peak_hour),
    "weekend_hourly": _features(trips.weekend_hourly),
    "weekend_pivot": _features(trips.weekend_pivot),
    "weekend_summary": _features(trips.weekend_summary),
    "trip_monthly": _months(trips.trip_monthly),
    "hour_rank": _features(trips.hour_rank),
    "trip_mom_growth": _months(trips.trip_mom_growth),
    "cumulative_monthly": _months(trips.cumulative_monthly),
    "top_hours_per_day": _features(trips.top_hours_per_day),
    "tips_by_payment": _features(trips.tips_by_payment),
    "tips_pivot": _features(trips.tips_pivot),
    "by_passenger_count": _features(trips.by_passenger_count),
    "distance_buckets": _features(trips.distance_buckets),
    "pickup_zones": _features(trips.pickup_zones),
    "dropoff_zones": _features(trips.dropoff_zones),
    "popular_routes": _features(trips.popular_routes, ROUTE_MIN_TRIPS),
    # Warehouse
    "dim_date": _house(lambda house: house.dim_date),
    # Load times differ between loads, so they are left out of the compared results.
    "dim_customer": _house(lambda house: house.dim_customer.drop(*warehouse.LOAD_TIMES)),
    "dim_product": _house(lambda house: house.dim_product.drop(*warehouse.LOAD_TIMES)),
    "dim_order_status": dim_order_status,
    "dim_payment_method": dim_payment_method,
    # The sales key is a hash that SQL cannot repeat.
    "fact_sales": _house(lambda house: house.fact_sales.drop("sales_key", *warehouse.LOAD_TIMES)),
    "vw_sales_complete": _asked(lambda house: warehouse.vw_sales_complete(house).drop("sales_key")),
    "table_counts": _asked(warehouse.table_counts),
    "dw_monthly_category": dw_monthly_category,
    "dw_tier_revenue": _asked(warehouse.dw_tier_revenue),
    "dw_weekend": _asked(warehouse.dw_weekend),
    "dw_top_products": _asked(warehouse.dw_top_products),
    "star_tier_revenue": lambda spark, sf: warehouse.dw_tier_revenue(stored_star(spark, sf)),
    "star_sales_complete": lambda spark, sf: warehouse.vw_sales_complete(stored_star(spark, sf)).drop("sales_key"),
    "incremental_facts": lambda spark, sf: stored_increments(spark, sf).fact_sales.drop("sales_key"),
    "incremental_customers": lambda spark, sf: stored_increments(spark, sf).dim_customer,
    "load_versions": lambda spark, sf: increments.table_history(stored_increments(spark, sf)),
    # History
    "scd2_apply": lambda spark, sf: _after_changes(spark, sf).select(*_VERSION),
    "scd2_rejects": lambda spark, sf: history.rejected_changes(*_history(spark, sf)),
    "scd1_apply": lambda spark, sf: history.scd1_apply(*_history(spark, sf)).select("customer_id", "customer_tier"),
    "scd3_apply": lambda spark, sf: history.scd3_apply(*_history(spark, sf)).select(
        "customer_id", "current_tier", "previous_tier"
    ),
    "scd_show_current": lambda spark, sf: stored_history(spark, sf).versions_of(SHOWN_CUSTOMERS).select(*_VERSION),
    "scd_point_in_time": lambda spark, sf: history.valid_on(_after_changes(spark, sf), POINT_IN_TIME).select(*_AS_OF),
    "scd_current": lambda spark, sf: history.current(_after_changes(spark, sf)).select(*_AS_OF),
    "fact_asof_customer": fact_asof_customer,
    # Players
    "player_standardize": _players(players.player_standardize),
    "duplicate_entities": _players(players.player_standardize, players.duplicate_entities),
    "player_dedupe": _players(players.player_standardize, players.player_dedupe),
    "player_types": _players(players.player_standardize, players.player_types),
    "player_fill": _players(players.player_standardize, players.player_types, players.player_fill),
    "player_derived": _players(players.clean_players),
    "quality_report": _players(players.clean_players, players.quality_report),
    "top_scorers": _players(players.clean_players, players.top_scorers),
    "top_scorers_5": _players(players.clean_players, lambda df: players.top_scorers(df, above=None, k=5)),
    "season_runs": season_runs,
    "player_run_summary": player_run_summary,
    # Audits
    "audit_unique": audit_unique,
    "audit_orphans": audit_orphans,
    "category_defaults": category_defaults,
    "audit_new_keys": audit_new_keys,
    "audit_new_references": audit_new_references,
    "audit_keys": audit_keys,
    "audit_references": audit_references,
    "audit_required": audit_required,
    # SQL text
    "sql_monthly_orders": sql_monthly_orders,
    "sql_tier_orders": sql_tier_orders,
    "sql_stored_scorers": sql_stored_scorers,
}


def queries() -> dict[str, Query]:
    """Name → query, with results in plain column types."""

    def over(query: Query) -> Query:
        return lambda spark, sf_dir: plain(query(apply_settings(spark), sf_dir))

    return {name: over(query) for name, query in _REGISTERED.items()}
