"""A warehouse that is loaded batch by batch.

A load takes the customers and order lines that arrived since the last one. Lines are read from a
high-water mark on, so nothing is loaded twice or all over again; a line may arrive long after the
day it belongs to. A line of a customer who is not known yet gets an inferred member: a row with a
key and no more, which is filled in when the customer arrives. Dimension, facts and marks become
visible in one commit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.functions.scalar import cents, date_key, scaled
from tallyhouse.operators.keys import with_sequence_key
from tallyhouse.plans.warehouse import TAX_PERCENT
from tallyhouse.sources.files import staged
from tallyhouse.sources.versions import VersionedStore, bucket_of

BUCKETS = 16
ATTRIBUTES = ("first_name", "last_name", "email", "customer_tier")
_CUSTOMER = ("customer_key", "customer_id", *ATTRIBUTES, "is_inferred")
LINE = ("order_item_id", "arrival", "order_id", "customer_id", "order_date", "quantity", "line_total")  # what a load reads
_FACT = (
    "sales_key", "date_key", "customer_key", "order_id", "order_item_id", "arrival", "quantity", "line_total", "net_revenue",
)


class IncrementalWarehouse:
    def __init__(self, spark: SparkSession, path: str):
        self.store = VersionedStore(spark, path)

    @property
    def dim_customer(self) -> DataFrame:
        if "dim_customer" not in self.store.tables():
            empty = "customer_key bigint, customer_id bigint, first_name string, last_name string, email string, customer_tier string, is_inferred boolean"
            return self.store.spark.createDataFrame([], empty)
        return self.store.read("dim_customer")

    @property
    def fact_sales(self) -> DataFrame:
        return self.store.read("fact_sales")

    def load(self, batch: str, customers: DataFrame, lines: DataFrame) -> bool:
        """Take a batch; tells whether it was new.

        ``customers`` holds new or now known customers, each once; ``lines`` order lines with
        ``arrival``, a number that grows with each delivery. Lines up to the mark are not read again.
        """
        store = self.store
        if store.has_batch(batch):
            return False
        change = store.change(batch)
        mark, last_key = store.marked("arrival", -1), store.marked("customer_key", 0)
        fresh = lines.select(*LINE).where(F.col("arrival") > mark)
        held = self.dim_customer

        # New members: customers that arrive, and ids that only lines know.
        ids = fresh.select("customer_id").where("customer_id is not null").distinct()
        arriving = customers.select("customer_id", *ATTRIBUTES, F.lit(False).alias("is_inferred"))
        inferred = ids.join(customers.select("customer_id"), "customer_id", "left_anti").select(
            "customer_id", *[F.lit(None).cast("string").alias(c) for c in ATTRIBUTES], F.lit(True).alias("is_inferred")
        )
        unknown = arriving.unionByName(inferred).join(held.select("customer_id"), "customer_id", "left_anti")
        added = staged(with_sequence_key(unknown, "customer_key", "customer_id", after=last_key).select(*_CUSTOMER), "members")

        # Inferred members whose customer has come: their buckets are written anew.
        waiting = held.where("is_inferred").select("customer_key", "customer_id")
        filled = staged(waiting.join(arriving, "customer_id").select(*_CUSTOMER), "filled")
        bucket = bucket_of("customer_id", BUCKETS)
        touched = [r[0] for r in filled.select(bucket.alias("b")).distinct().collect()]
        if touched:
            rest = store.read("dim_customer", touched).join(filled.select("customer_key"), "customer_key", "left_anti")
            change.replace("dim_customer", rest.select(*_CUSTOMER).unionByName(filled), bucket, touched)
        change.append("dim_customer", added, bucket)

        keys = held.select("customer_key", "customer_id").unionByName(added.select("customer_key", "customer_id"))
        facts = change.append("fact_sales", _facts(fresh.join(keys, "customer_id", "left")))
        marks = facts.agg(F.max("arrival")).first()[0], added.agg(F.max("customer_key")).first()[0]
        change.mark("arrival", mark if marks[0] is None else max(mark, marks[0]))
        change.mark("customer_key", marks[1] or last_key)
        change.commit()
        return True


def _facts(lines: DataFrame) -> DataFrame:
    """The fact columns of keyed lines. The sales key is a hash of line, arrival, customer and content; lines
    alike in all of these are told apart by a count, which Spark takes where the join by customer has
    put them."""
    amount = cents("line_total")
    net = amount * 100 + amount * TAX_PERCENT
    alike = F.row_number().over(Window.partitionBy("customer_id", "order_item_id", "arrival").orderBy("quantity", "line_total"))
    return lines.withColumns(
        {
            "date_key": date_key("order_date"),
            "net_revenue": scaled(net, 4),
            "sales_key": F.xxhash64("order_item_id", "arrival", "customer_id", alike),
        }
    ).select(*_FACT)


def table_history(warehouse: IncrementalWarehouse) -> DataFrame:
    """Rows of every table in every version."""
    store, counts = warehouse.store, []
    for version in store.versions():
        for name in sorted(store.tables(version)):
            counts.append(
                store.read(name, version=version).agg(
                    F.lit(version).alias("version"), F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count")
                )
            )
    total = counts[0]
    for one in counts[1:]:
        total = total.unionByName(one)
    return total
