"""The analytics schemas laid over the supplied tables.

Every view is a projection, or a projection over small lookups, so filters and
column choices made by a query reach the Parquet scan.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.functions.scalar import at_least, relabel
from tallyhouse.sources.player_columns import RAW_COLUMNS, TOTAL_TEAM
from tallyhouse.sources.tables import table

# Order states, and account balances at which a customer tier starts.
STATUS_BY_CODE = {"F": "Completed", "O": "Pending", "P": "Shipped"}
TIER_STEPS = [(8500, "Platinum"), (5500, "Gold"), (2500, "Silver")]
TIER_FLOOR = "Bronze"
EMAIL_HOST = "@email.com"

SUCCESSOR = 10_000_000_000


class Retail:
    """Customers, orders, order lines, products and categories.

    Built over the supplied tables by default. Give any of the frames to run the
    same queries over tables that already have these columns.
    """

    def __init__(self, spark: SparkSession | None = None, sf_dir: str | None = None, **frames: DataFrame):
        self.spark, self.sf_dir = spark, sf_dir
        for name, df in frames.items():
            self.__dict__[name] = df

    def _read(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    def frames(self) -> dict[str, DataFrame]:
        """The tables by the names that SQL text uses; customers with place and registration date."""
        customers = self.customers if self.spark is None else self.customers_registered.drop("place_id")
        products = self.products
        if "category_id" not in products.columns:
            ids = self.categories.select("category_id", "category_name")
            products = products.join(ids, "category_name").drop("category_name")
        return {
            "customers": customers,
            "orders": self.orders if self.spark is None else self.orders_shipped,
            "order_items": self.with_item_id(self.order_items),
            "products": products,
            "categories": self.categories,
        }

    @cached_property
    def customers(self) -> DataFrame:
        return _customer_columns(self._read("customer"))

    @cached_property
    def places(self) -> DataFrame:
        """City and state by nation key: as many rows as there are nations."""
        nation, region = self._read("nation"), self._read("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey, "left").select(
            F.col("n_nationkey").alias("place_id"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
        )

    @cached_property
    def customers_placed(self) -> DataFrame:
        """Customers with city and state."""
        return self.customers.join(self.places, "place_id", "left")

    def customers_by_email(self, email: str) -> DataFrame:
        """Placed customers with this address. Over the supplied tables the address is the stored
        name and a host, so the test is put on the name, where the scan can use it."""
        if self.spark is None:
            return self.customers_placed.filter(F.col("email") == email)
        name = email.removesuffix(EMAIL_HOST) if email.endswith(EMAIL_HOST) else None
        found = _customer_columns(self._read("customer").filter(F.col("c_name") == F.lit(name)))
        return found.join(self.places, "place_id", "left")

    @cached_property
    def customers_registered(self) -> DataFrame:
        """Placed customers with the date of their first order as registration date."""
        first = self.orders.groupBy("customer_id").agg(F.min("order_date").alias("registration_date"))
        return self.customers_placed.join(first, "customer_id", "left")

    @cached_property
    def registrations(self) -> DataFrame:
        """Customer ids with their registration date alone, without looking up places."""
        if "customers_registered" in self.__dict__:
            return self.customers_registered.select("customer_id", "registration_date")
        first = self.orders.groupBy("customer_id").agg(F.min("order_date").alias("registration_date"))
        return self.customers.select("customer_id").join(first, "customer_id", "left")

    @cached_property
    def listed_products(self) -> DataFrame:
        """Products and, for each one that is no longer active, the successor that is listed for it.
        A successor has the number of its product raised by ten billion, and no stock."""
        successors = self.products.filter("not is_active").withColumns(
            {"product_id": F.col("product_id") + SUCCESSOR, "stock_quantity": F.lit(0).cast("bigint"), "is_active": F.lit(True)}
        )
        return self.products.unionByName(successors)

    @cached_property
    def orders(self) -> DataFrame:
        return _order_columns(self._read("orders"))

    @cached_property
    def completed(self) -> DataFrame:
        """Completed orders. Over the supplied tables the test is on the stored code, so that
        it is pushed to the scan (a test on the mapped label would not be)."""
        if "orders" in self.__dict__ and self.spark is None:
            return self.orders.filter(F.col("order_status") == "Completed")
        return _order_columns(self._read("orders").filter(F.col("o_orderstatus") == "F"))

    @cached_property
    def order_items(self) -> DataFrame:
        return _item_columns(self._read("lineitem"))

    def with_item_id(self, items: DataFrame) -> DataFrame:
        """Add ``order_item_id`` where the source has none. Line numbers repeat within an order, so
        product and supplier are added; lines alike in all four share an id, and the sales key of
        the facts tells them apart. Adding it late keeps the text out of shuffles."""
        if "order_item_id" in items.columns:
            return items
        parts = ("order_id", "line_number", "product_id", "supplier_id")
        return items.withColumn("order_item_id", F.concat_ws("-", *[F.col(c).cast("string") for c in parts]))

    @cached_property
    def products(self) -> DataFrame:
        return self._read("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category_name"),
            F.col("p_retailprice").alias("unit_price"),
            F.col("p_size").cast("bigint").alias("stock_quantity"),
            (F.col("p_size") % 10 != 0).alias("is_active"),
        )

    @cached_property
    def categories(self) -> DataFrame:
        """One row per product type, numbered by name: the window runs over the distinct names only."""
        names = self._read("part").select(F.col("p_type").alias("category_name")).distinct()
        return names.select(
            F.row_number().over(Window.orderBy("category_name")).alias("category_id"),
            "category_name",
            F.concat(F.lit("Products of type "), F.col("category_name")).alias("category_description"),
        )

    @cached_property
    def ship_dates(self) -> DataFrame:
        """First shipping date on or after the order date, for the orders that have one.

        Lines are first reduced to one row per order and day, so an order holding very
        many lines brings no more rows to the join than there are days.
        """
        days = self.order_items.select("order_id", "ship_date").distinct()
        return (
            self.orders.join(days, "order_id")
            .filter(F.col("ship_date") >= F.col("order_date"))
            .groupBy("order_id", "order_date")
            .agg(F.min("ship_date").alias("ship_date"))
        )


    @property
    def orders_shipped(self) -> DataFrame:
        """Orders with their shipping date, NULL where there is none."""
        return self.orders.join(self.ship_dates.drop("order_date"), "order_id", "left")


def _customer_columns(customer: DataFrame) -> DataFrame:
    return customer.select(
        F.col("c_custkey").alias("customer_id"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
        F.concat(F.col("c_name"), F.lit(EMAIL_HOST)).alias("email"),
        F.concat(F.lit("555-"), F.lpad((F.col("c_custkey") % 10000).cast("string"), 4, "0")).alias("phone"),
        F.col("c_nationkey").alias("place_id"),
        at_least("c_acctbal", TIER_STEPS, TIER_FLOOR).alias("customer_tier"),
    )


def _order_columns(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("order_date"),
        relabel("o_orderstatus", STATUS_BY_CODE).alias("order_status"),
        F.col("o_totalprice").alias("total_amount"),
    )


def _item_columns(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        # To the cent, in plain double arithmetic.
        (F.floor(F.col("l_extendedprice") / F.col("l_quantity") * 100 + 0.5) / 100).alias("unit_price"),
        F.col("l_extendedprice").alias("line_total"),
        F.to_date("l_shipdate").alias("ship_date"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_suppkey").alias("supplier_id"),
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Taxi trips out of the events table; each trip depends on its own event row only.

    The fare is the stored value, so bounds on it reach the scan. Some drop-off times and
    pickup positions are NULL, so that cleaning and NULL groups have work to do.
    """
    k = F.col("event_id") * 37 % 100
    fare = F.col("value")
    tip = F.floor(fare * (k % 30)) / F.lit(100.0)
    arrival = F.timestamp_add("SECOND", ((k * 97 + F.col("event_id") * 31) % 5400).cast("int"), "ts")
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("pickup_datetime"),
        F.when(F.col("event_id") % 67 != 0, arrival).alias("dropoff_datetime"),
        (k % 9).alias("passenger_count"),
        (k / F.lit(5.0)).alias("trip_distance"),
        fare.alias("fare_amount"),
        tip.alias("tip_amount"),
        (fare + tip).alias("total_amount"),
        F.col("event_type").alias("payment_type"),
        F.when(F.col("user_id") % 50 != 0, 40 + F.col("user_id") % 20 / F.lit(100.0)).alias("pickup_latitude"),
        (-74 + k % 10 / F.lit(100.0)).alias("pickup_longitude"),
        (40 + F.col("event_id") % 15 / F.lit(100.0)).alias("dropoff_latitude"),
        (-74 + k % 7 / F.lit(100.0)).alias("dropoff_longitude"),
    )


def monthly_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips spread over many months, out of the orders table (events span one month)."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").alias("pickup_datetime"), F.col("o_totalprice").alias("total_amount")
    )


def staff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Employees (name, age, department, salary) out of the customer table."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"),
        (F.col("c_custkey") % 45 + 20).alias("age"),
        F.col("c_mktsegment").alias("department"),
        (F.rint(F.col("c_acctbal") * 1000) / 100 + 20000).alias("salary"),
    )


def raw_player_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scraped-looking player season rows, all text, out of the line items.

    A part is a player and a return flag is a team; one player in four stays with team A. One
    player in three has a ``TOT`` row summing the teams; some pairs of players share a name; a
    few values are damaged on purpose. ``source_pos`` carries the input order.
    """
    quantity, line = "cast(l_quantity as bigint)", "l_linenumber"
    sums = {
        "games": "1",
        "games_started": f"int({quantity} > 25)",
        "mp": quantity,
        "fg2": f"{quantity} % 7",
        "fg2_miss": f"{quantity} % 5",
        "fg3": f"{line} % 3",
        "fg3_miss": f"{line} % 2",
        "ft": f"{quantity} % 4",
        "ft_miss": f"{quantity} % 2",
        "orb": line,
        "drb": f"{quantity} % 9",
        "ast": f"{quantity} % 11",
        "stl": f"{quantity} % 3",
        "blk": "int(l_linestatus = 'F')",
        "tov": f"{line} % 4",
        "pf": f"{quantity} % 6",
    }
    stints = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.expr("l_partkey as id"), F.expr("if(l_partkey % 4 = 1, 'A', l_returnflag) as team"))
        .agg(*[F.expr(f"sum({expr}) as {name}") for name, expr in sums.items()])
    )
    # Every team row also counts towards its player's total, where there is one.
    teams = f"explode(if(id % 3 = 0, array(team, '{TOTAL_TEAM}'), array(team))) as team"
    rows = (
        stints.selectExpr("id", teams, *sums)
        .groupBy("id", "team")
        .agg(F.expr("count(*) as teams"), *[F.expr(f"sum({name}) as {name}") for name in sums])
        .filter(f"team <> '{TOTAL_TEAM}' or teams > 1")
        .drop("teams")
    )
    return _player_text(rows)


def _player_text(rows: DataFrame) -> DataFrame:
    def share(made: str, tried: str) -> str:
        ratio = f"cast({made} as double) / nullif(cast({tried} as double), 0)"
        return f"coalesce(cast(cast(round(cast({ratio} as decimal(38,6)), 3) as decimal(9,3)) as string), '')"

    totals = rows.selectExpr(
        "*",
        "fg2 + fg2_miss as fg2a",
        "fg3 + fg3_miss as fg3a",
        "ft + ft_miss as fta",
        "orb + drb as trb",
        "fg2 + fg3 as fg",
        "fg2 + fg2_miss + fg3 + fg3_miss as fga",
        "(fg2 * 2 + fg3 * 3 + ft) * if(id % 67 = 0, 10, 1) as pts",
    )
    text = {
        "season_year": "2025",
        "player": "concat('Player ', id - if(id % 97 = 0, 1, 0))",
        "player_url": "concat('/players/', id, '.html')",
        "games": "cast(games - 1 as string)",
        "team_name_abbr": "team",
        "pos": "element_at(array('PG', 'SG', 'SF', 'PF', 'C'), cast(id % 5 + 1 as int))",
        "age": "if(id % 41 = 0, 'n/a', cast(id % 37 + 16 as string))",
        "mp": "if(id % 53 = 0, '', cast(mp as string))",
        "fg_pct": share("fg", "fga"),
        "fg3_pct": share("fg3", "fg3a"),
        "fg2_pct": share("fg2", "fg2a"),
        "efg_pct": share("(cast(fg as double) + cast(fg3 as double) * 0.5D)", "fga"),
        "ft_pct": f"if(id % 61 = 0, '120', {share('ft', 'fta')})",
        "stl": "if(id % 59 = 0, '-3', cast(stl as string))",
    }
    columns = [f"{text.get(c, f'cast({c} as string)')} as {c}" for c in RAW_COLUMNS]
    position = "id * 10 + case team when 'A' then 1 when 'N' then 2 when 'R' then 3 else 0 end as source_pos"
    return totals.selectExpr(*columns, position)


def tier_changes(retail: Retail) -> DataFrame:
    """Requested tier changes: one per order, dated by the order.

    Every fiftieth names a customer that does not exist.
    """
    stray = F.when(F.col("order_id") % 50 == 0, 10_000_000_000).otherwise(0)
    return retail.orders.select(
        (F.col("customer_id") + stray).alias("customer_id"),
        at_least(
            "total_amount", [(475000, "Platinum"), (425000, "Gold"), (350000, "Silver")], TIER_FLOOR
        ).alias("new_tier"),
        F.col("order_date").alias("effective_date"),
    )


def stats_pages(records: DataFrame, per_page: int = 50) -> DataFrame:
    """Player records set as web pages with a statistics table.

    A page takes the records of ``per_page`` neighbouring players, a handful of rows each. It
    also carries a repeated header row and a row without a player, as such pages do.
    """
    names = [c for c in RAW_COLUMNS if c not in ("season_year", "player_url", "player")]
    cells = [F.concat(F.lit(f'<td data-stat="{c}"> '), F.col(c), F.lit("</td>")) for c in names]
    row = F.concat(
        F.lit('<tr><th scope="row" data-stat="ranker">'),
        F.col("source_pos").cast("string"),
        F.lit('</th><td data-stat="name_display"><a href="'),
        F.col("player_url"),
        F.lit('">'),
        F.col("player"),
        F.lit("</a></td>"),
        *cells,
        F.lit("</tr>\n"),
    )
    header = "".join(f'<th data-stat="{c}">{c}</th>' for c in ["ranker", "name_display", *names])
    top = (
        '<html><body><table id="other"><tbody><tr><td data-stat="player">Nobody</td></tr></tbody></table>'
        f'<table id="totals_stats"><thead><tr><th colspan="3">Totals</th></tr><tr>{header}</tr></thead><tbody>\n'
    )
    bottom = (
        f'<tr class="thead">{header}</tr><tr><td data-stat="name_display"></td><td data-stat="g">3</td></tr>'
        "</tbody></table></body></html>"
    )
    return (
        records.withColumn("page_id", F.floor(F.col("source_pos") / (10 * per_page)))
        .groupBy("page_id")
        .agg(F.sort_array(F.collect_list(F.struct("source_pos", row.alias("html")))).alias("rows"))
        .select(
            "page_id",
            F.concat(F.lit("/totals/"), F.col("page_id").cast("string"), F.lit(".html")).alias("url"),
            F.concat(F.lit(top), F.concat_ws("", F.col("rows.html")), F.lit(bottom)).alias("html"),
        )
    )
