"""Everyday DataFrame work: inline rows, schemas, filters, levels, group sums."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions.scalar import at_least, cents, cents_total, mean_of, money_mean, rounded, scaled
from tallyhouse.sources.views import Retail

# Salaries above which a level starts.
LEVEL_STEPS = [(90000, "Senior"), (75000, "Mid")]
LEVEL_FLOOR = "Junior"

STAFF_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType(), False),
        T.StructField("age", T.IntegerType(), False),
        T.StructField("salary", T.FloatType(), False),
    ]
)


def inline_rows(spark: SparkSession, rows: list[tuple], columns: list[str] | str) -> DataFrame:
    """A table from Python rows; types are inferred when only names are given."""
    return spark.createDataFrame(rows, columns)


def inline_pandas(spark: SparkSession, frame: pd.DataFrame) -> DataFrame:
    return spark.createDataFrame(frame)


def department_sizes(staff: DataFrame, offices: DataFrame, budgets: DataFrame) -> DataFrame:
    """Inline lookups beside the number of employees; staff is counted before it is joined."""
    sizes = staff.groupBy("department").agg(F.count("*").alias("employee_count"))
    return sizes.join(offices, "department").join(budgets, "department")


def explicit_schema(rows: DataFrame, schema: T.StructType = STAFF_SCHEMA) -> DataFrame:
    """Rows in the columns, order and types of ``schema``; a NULL where none is allowed is an error."""

    def conform(field: T.StructField):
        value = F.col(field.name).cast(field.dataType)
        if not field.nullable:
            refusal = F.raise_error(F.lit(f"NULL in {field.name}")).cast(field.dataType)
            # The last value is never reached; it marks the column as never NULL.
            value = F.coalesce(value, refusal, F.lit(0).cast(field.dataType))
        return value.alias(field.name)

    return rows.select(*[conform(f) for f in schema.fields])


def filter_basic(staff: DataFrame) -> DataFrame:
    return staff.filter((F.col("age") > 30) & (F.col("salary") > 80000))


def filter_like(staff: DataFrame, pattern: str) -> DataFrame:
    """Names that do not match an SQL pattern."""
    return staff.filter(~F.col("name").like(pattern))


def computed_columns(staff: DataFrame) -> DataFrame:
    return staff.withColumn("bonus", F.col("salary") * 0.10)


def salary_level(staff: DataFrame, older_than: int = 28) -> DataFrame:
    return staff.filter(F.col("age") > older_than).select(
        "name", "department", "salary", at_least("salary", LEVEL_STEPS, LEVEL_FLOOR, strict=True).alias("level")
    )


def department_stats(staff: DataFrame) -> DataFrame:
    return staff.groupBy("department").agg(
        F.count("*").alias("employee_count"),
        money_mean("salary").alias("avg_salary"),
        F.max("salary").alias("max_salary"),
    )


def global_revenue(retail: Retail) -> DataFrame:
    """Sum of price times quantity over all lines."""
    lines = retail.order_items.withColumn("revenue", cents("unit_price") * F.col("quantity"))
    return lines.agg({"revenue": "sum"}).select(scaled("sum(revenue)").alias("total_revenue"))


def group_basic(retail: Retail) -> DataFrame:
    """Per category: sold lines, revenue, and lowest, highest and average price.

    Lines are summed per product before the category is looked up.
    """
    per_product = retail.order_items.groupBy("product_id").agg(
        F.count("*").alias("lines"),
        F.sum(cents("unit_price") * F.col("quantity")).alias("revenue"),
        F.min("unit_price").alias("lowest"),
        F.max("unit_price").alias("highest"),
        cents_total("unit_price").alias("prices"),
    )
    return (
        per_product.join(retail.products.select("product_id", "category_name"), "product_id")
        .groupBy("category_name")
        .agg(
            F.sum("lines").alias("products"),
            scaled(F.sum("revenue")).alias("total_revenue"),
            F.min("lowest").alias("min_price"),
            F.max("highest").alias("max_price"),
            rounded(mean_of(scaled(F.sum("prices")), F.sum("lines"))).alias("avg_price"),
        )
    )
