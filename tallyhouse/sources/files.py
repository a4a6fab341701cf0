"""CSV, JSON and Parquet: scans, writes, conversion, comparison and write modes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.session import fresh_path

FORMATS = ("csv", "json", "parquet")

# ISO dates and times in text formats, down to the microsecond that a timestamp holds.
_TEXT_TIMES = {
    "dateFormat": "yyyy-MM-dd",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def scan(spark: SparkSession, path: str, fmt: str, schema=None, json_array: bool = False) -> DataFrame:
    """Read a file or folder in any format Spark knows by name.

    Without a ``schema`` the types of text formats are inferred, which costs one more pass.
    ``json_array`` reads files that hold one array of records; such a file is not split.
    """
    reader = spark.read.format(fmt)
    if fmt in ("csv", "json"):
        reader = reader.options(**_TEXT_TIMES)
    if fmt == "csv":
        reader = reader.option("header", True).option("escape", '"')
        if schema is None:
            reader = reader.option("inferSchema", True)
    if fmt == "json" and json_array:
        reader = reader.option("multiLine", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def write(df: DataFrame, path: str, fmt: str, mode: str = "errorifexists", *partitions: str) -> str:
    """Write one folder of files. ``mode`` is errorifexists, overwrite or append."""
    writer = df.write.format(fmt).mode(mode)
    if fmt in ("csv", "json"):
        writer = writer.options(**_TEXT_TIMES)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    if fmt == "json":
        writer = writer.option("ignoreNullFields", False)
    if fmt == "parquet":
        writer = writer.option("compression", "snappy")
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.save(path)
    return path


def write_json_arrays(df: DataFrame, path: str, by: str, records: int = 100_000) -> str:
    """Write files that hold one array of records each. Rows are dealt by ``by`` and a hash into arrays
    of about ``records``, since a file of one array is read by one task."""
    parts = max(1, df.count() // records)
    dealt = df.groupBy(by, F.pmod(F.xxhash64(*df.columns), F.lit(parts)).alias("_part")).agg(
        F.collect_list(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false", **_TEXT_TIMES})).alias("_rows")
    )
    dealt.select(F.concat(F.lit("["), F.concat_ws(",", "_rows"), F.lit("]"))).write.option("maxRecordsPerFile", 1).text(path)
    return path


def write_run(df: DataFrame, base: str, season: int, stamp: str, fmt: str = "csv") -> str:
    """Write one run of one season into its own, time-stamped folder."""
    return write(df, f"{base}/season={season}/run={stamp}", fmt)


def convert(df: DataFrame, folder: str, formats=FORMATS) -> dict[str, str]:
    """Write one frame in several formats; returns the path of each."""
    return {fmt: write(df, f"{folder}/{fmt}", fmt) for fmt in formats}


def has_rows(spark: SparkSession, path: str) -> bool:
    """Whether a stored table exists and holds a row."""
    try:
        return not spark.read.parquet(path).limit(1).isEmpty()
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def load_once(spark: SparkSession, build: Callable[[], DataFrame], path: str, *partitions: str) -> bool:
    """Fill a table unless it already holds rows; tells whether it was written."""
    if has_rows(spark, path):
        return False
    write(build(), path, "parquet", "append", *partitions)
    return True


def file_state(spark: SparkSession, path: str) -> tuple:
    """Name, size and time of change of a file, or of the files of a folder: equal as long as the table
    has not changed."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = there.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(there)
    return tuple(sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in listed))


def staged(df: DataFrame, label: str) -> DataFrame:
    """Store a frame in the shared folder and read it back, so that several uses of it cost one
    computation and a lost executor does not bring it back."""
    path = write(df, fresh_path(df.sparkSession, label), "parquet")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def differences(left: DataFrame, right: DataFrame, label: str) -> DataFrame:
    """One row: rows of each side, and rows found more often on one side than on the other.

    Equal rows meet after being counted inside each task, so a row repeated any number of
    times stays one partial count.
    """
    columns = left.columns
    sides = left.select(*columns, F.lit(1).alias("_side")).unionByName(
        right.select(*columns, F.lit(-1).alias("_side"))
    )
    per_row = sides.groupBy(*columns).agg(
        F.sum("_side").alias("_surplus"), F.count_if(F.col("_side") == 1).alias("_left")
    )
    return per_row.agg(
        F.lit(label).alias("format"),
        F.coalesce(F.sum("_left"), F.lit(0)).alias("row_count"),
        F.lit(len(columns)).alias("column_count"),
        F.coalesce(F.sum(F.greatest("_surplus", F.lit(0))), F.lit(0)).alias("missing_rows"),
        F.coalesce(F.sum(F.greatest(-F.col("_surplus"), F.lit(0))), F.lit(0)).alias("extra_rows"),
    )


def round_trip(df: DataFrame, folder: str, formats=FORMATS) -> DataFrame:
    """Write ``df`` in every format and compare each copy, read back, with the original."""
    spark = df.sparkSession
    checks = [
        differences(df, scan(spark, path, fmt, df.schema), fmt) for fmt, path in convert(df, folder, formats).items()
    ]
    result = checks[0]
    for check in checks[1:]:
        result = result.unionByName(check)
    return result


def write_mode_steps(df: DataFrame, path: str) -> DataFrame:
    """Row counts read back after each way of writing the same rows to one table."""
    spark = df.sparkSession

    def rows() -> int:
        return spark.read.parquet(path).count()

    steps = []
    write(df, path, "parquet", "errorifexists")
    steps.append(("create", rows()))
    try:
        write(df, path, "parquet", "errorifexists")
        steps.append(("create again", rows()))
    except AnalysisException:
        steps.append(("create again refused", rows()))
    write(df, path, "parquet", "append")
    steps.append(("append", rows()))
    write(df, path, "parquet", "overwrite")
    steps.append(("replace", rows()))
    load_once(spark, lambda: df, path)
    steps.append(("load once", rows()))
    return spark.createDataFrame(steps, "step string, row_count bigint")
