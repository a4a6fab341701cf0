"""SQL text over named frames."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def register(frames: Mapping[str, DataFrame]) -> list[str]:
    """Give frames the names that SQL text may use, for the life of the session."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return list(frames)


def run(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    """A query as a lazy frame. ``{name}`` in the text stands for a frame given by that name;
    registered names are used as they are. A faulty query raises."""
    return spark.sql(text, **frames)
