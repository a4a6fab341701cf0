"""Types of CSV columns, found file by file and widened where files disagree.

Every file is read as text, and for each of its columns the values that each type could hold are
counted; the narrowest type that holds them all is the column's type in that file. Types of several
files meet in a lattice:

    long -> double -> text,    date -> timestamp -> text,    nothing below all of them

so a column that is whole in one file and broken in another is double, and one that holds dates here
and numbers there is text. Counting is one grouped pass; only (column, type) totals reach the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NOTHING, LONG, DOUBLE, DATE, TIMESTAMP, TEXT = "nothing", "long", "double", "date", "timestamp", "text"
_SPARK = {NOTHING: T.StringType(), LONG: T.LongType(), DOUBLE: T.DoubleType(), DATE: T.DateType(), TIMESTAMP: T.TimestampNTZType(), TEXT: T.StringType()}

_ORDER = (LONG, DOUBLE, DATE, TIMESTAMP)  # from narrow to wide, numbers first


def widened(one: str, other: str) -> str:
    """The least type that holds what both hold."""
    if one == other or other == NOTHING:
        return one
    if one == NOTHING:
        return other
    for pair, upper in (({LONG, DOUBLE}, DOUBLE), ({DATE, TIMESTAMP}, TIMESTAMP)):
        if {one, other} == pair:
            return upper
    return TEXT


def value_as(text: Column, kind: str) -> Column:
    """A text as a value of a type; NULL if it is none. White space around it does not count.

    Numbers are plain decimal ones, with an exponent if need be; dates are ISO dates and times ISO
    times without a zone, a date alone being its midnight.
    """
    text = F.trim(text)
    if kind == LONG:
        return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("bigint"))
    if kind == DOUBLE:
        return F.when(text.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), text.try_cast("double"))
    if kind == DATE:
        return F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), text.try_cast("date"))
    if kind == TIMESTAMP:
        return F.when(
            text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?)?$"),
            text.try_cast("timestamp_ntz"),
        )
    return text


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """CSV files with a header, all columns as text; an empty field is NULL."""
    return spark.read.option("header", True).option("escape", '"').option("recursiveFileLookup", True).csv(path)


def file_types(spark: SparkSession, path: str, one_in: int = 1) -> DataFrame:
    """(column_name, type, files): how many files have a column in that type.

    ``one_in`` states the sample: every row of each file (1), or one of so many, chosen by a hash of
    the row. A value outside the sample that does not fit the type is NULL when it is read.
    """
    rows = read_text(spark, path)
    if not rows.columns:
        return spark.createDataFrame([], "column_name string, type string, files bigint")
    names = rows.columns
    if one_in > 1:
        rows = rows.where(F.pmod(F.xxhash64(*names), F.lit(one_in)) == 0)
    counts = []
    for i, name in enumerate(names):
        text = F.when(F.trim(F.col(f"`{name}`")) != "", F.col(f"`{name}`"))
        kinds = [F.count(value_as(text, kind)).alias(kind) for kind in _ORDER]
        counts.append(F.struct(F.count(text).alias("all"), *kinds).alias(f"c{i}"))
    by_file = rows.withColumn("_file", F.col("_metadata.file_path")).groupBy("_file").agg(*counts)

    def narrowest(count: Column) -> Column:
        found = F.when(count["all"] == 0, F.lit(NOTHING))
        for kind in _ORDER:
            found = found.when(count[kind] == count["all"], F.lit(kind))
        return found.otherwise(F.lit(TEXT))

    types = [F.struct(F.lit(n).alias("column_name"), narrowest(F.col(f"c{i}")).alias("type")) for i, n in enumerate(names)]
    return by_file.select(F.inline(F.array(*types))).groupBy("column_name", "type").agg(F.count(F.lit(1)).alias("files"))


def inferred_schema(spark: SparkSession, path: str, one_in: int = 1) -> T.StructType:
    """The schema that holds all files."""
    found: dict[str, list[str]] = {}
    for r in file_types(spark, path, one_in).collect():  # at most six types for each column
        found.setdefault(r["column_name"], []).append(r["type"])
    return T.StructType([T.StructField(n, _SPARK[reduce(widened, found.get(n, [NOTHING]))]) for n in read_text(spark, path).columns])


def scan_inferred(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The rows of all files in the inferred types (or in a schema found before)."""
    schema = schema or inferred_schema(spark, path)
    kinds = {kind: name for name, kind in reversed(_SPARK.items())}
    return read_text(spark, path).select(
        *[(F.col(f"`{f.name}`") if f.dataType == T.StringType() else value_as(F.col(f"`{f.name}`"), kinds[f.dataType])).alias(f.name) for f in schema]
    )


def schema_drift(spark: SparkSession, path: str, one_in: int = 1) -> DataFrame:
    """Columns whose type is not the same in all files: (column_name, type, files, common_type)."""
    types = file_types(spark, path, one_in)
    kinds = types.where(F.col("type") != NOTHING).groupBy("column_name").agg(F.array_sort(F.collect_set("type")).alias("_kinds"))
    several = kinds.where(F.size("_kinds") > 1)
    common = (
        F.when(F.col("_kinds") == F.array(F.lit(DOUBLE), F.lit(LONG)), DOUBLE)
        .when(F.col("_kinds") == F.array(F.lit(DATE), F.lit(TIMESTAMP)), TIMESTAMP)
        .otherwise(TEXT)
    )
    return types.join(several.select("column_name", common.alias("common_type")), "column_name")
