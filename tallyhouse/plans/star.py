"""The star stored in buckets, so that facts meet customers without a shuffle.

Facts and customers are saved as tables of a database in a shared folder, both in buckets of the
customer key. Rows of one customer are in buckets of one number on both sides, so joins and groups
by the customer read bucket by bucket. A customer with very many facts makes one bucket large; such a
star is better joined by the shuffle, which AQE splits, so ``store_star`` refuses it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.plans.warehouse import TABLES, Warehouse

BUCKETS = 32
MOST_SHARE = 4  # a bucket may hold so many times the average


def largest_bucket(facts: DataFrame, key: str, buckets: int) -> tuple[int, int]:
    """Rows of the largest bucket by this key, and all rows."""
    sizes = facts.groupBy(F.pmod(F.hash(key), F.lit(buckets)).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    row = sizes.agg(F.coalesce(F.max("n"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    return row[0], row[1]


def store_star(house: Warehouse, database: str, folder: str, buckets: int = BUCKETS) -> Warehouse | None:
    """The warehouse with bucketed facts and customers in ``database``, kept in ``folder``; None if one bucket would hold
    more than ``MOST_SHARE`` times the average."""
    spark = house.fact_sales.sparkSession
    largest, rows = largest_bucket(house.fact_sales, "customer_key", buckets)
    if largest * buckets > MOST_SHARE * max(rows, buckets):
        return None
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{folder}'")
    made = Warehouse(None)
    for name in TABLES:
        made.__dict__[name] = getattr(house, name)
    for name in ("fact_sales", "dim_customer"):
        table = f"{database}.{name}"
        # One task for each bucket and one file: the deal is the one that the table declares.
        dealt = getattr(house, name).repartition(buckets, "customer_key")
        dealt.write.bucketBy(buckets, "customer_key").sortBy("customer_key").mode("overwrite").saveAsTable(table)
        made.__dict__[name] = spark.table(table)
    return made
