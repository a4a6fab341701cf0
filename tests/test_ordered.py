"""Running totals, lags, ranks and quantiles over all rows at once."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyhouse.functions.scalar import rounded
from tallyhouse.operators import quantiles
from tallyhouse.operators.ordered import OrderedRows
from tallyhouse.operators.quality import basic_stats
from tallyhouse.operators.quantiles import exact_quantiles

SCHEMA = "id bigint, k int, j int, v bigint"


def frame(spark, rows, parts=5):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts, "id")


def some_rows(n, hot, seed=3):
    """``hot`` of ten rows have one key; some keys and measures are NULL."""
    dice = random.Random(seed)
    key = lambda: 50 if dice.randrange(10) < hot else dice.choice([None, *range(40), *range(60, 100)])
    return [(i, key(), dice.randrange(3), dice.choice([None, *range(-5, 50)])) for i in range(n)]


def by_window(df, *order):
    """The same questions to one window over all rows."""
    w = Window.orderBy(*order)
    return df.select(
        "id", F.sum("v").over(w).alias("total"), F.rank().over(w).alias("rank"), F.dense_rank().over(w).alias("dense"),
        F.percent_rank().over(w).alias("percent"), F.cume_dist().over(w).alias("cume"),
    )


ASKED = {"totals": {"v": "total"}, "rank": "rank", "dense_rank": "dense", "percent_rank": "percent", "cume_dist": "cume"}


@pytest.mark.parametrize("n, hot, parts", [(400, 0, 7), (400, 4, 7), (400, 9, 16), (400, 10, 6), (5, 3, 9), (1, 0, 3), (0, 0, 3)])
def test_equals_one_window(spark, n, hot, parts):
    df = frame(spark, some_rows(n, hot))
    for names, order in ((["k"], [F.asc("k")]), (["-k", "j"], [F.desc("k"), F.asc("j")])):
        made = OrderedRows(df, *names, partitions=parts).with_columns(**ASKED).select("id", *["total", "rank", "dense", "percent", "cume"])
        assert sorted(made.collect(), key=lambda r: r.id) == sorted(by_window(df, *order).collect(), key=lambda r: r.id)


def test_row_by_row(spark):
    df = frame(spark, some_rows(300, 3))
    made = OrderedRows(df, "k", "id", partitions=8).with_columns(row_totals={"v": "total"}, previous={"v": "before", "k": "key_before"}, row_number="n")
    w = Window.orderBy("k", "id")
    truth = df.select(
        "*", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("total"),
        F.lag("v").over(w).alias("before"), F.lag("k").over(w).alias("key_before"), F.row_number().over(w).alias("n"),
    )
    assert sorted(made.collect(), key=lambda r: r.id) == sorted(truth.collect(), key=lambda r: r.id)


def test_one_value_is_spread_over_partitions(spark):
    df = spark.range(0, 30_000, 1, 6).selectExpr("id", "if(id % 3 = 0, 7, id % 100) as k", "1L as v")
    rows = OrderedRows(df, "k", partitions=12)
    sizes = [r["count"] for r in rows.rows.groupBy("_part").count().collect()]
    assert len(sizes) == 12 and max(sizes) < 2 * 30_000 / 12
    made = rows.with_columns(totals={"v": "total"}, percent_rank="percent")
    hot = made.where("k = 7").select("total", "percent").distinct().collect()
    below = df.where("k < 7").count()
    assert [(r.total, r.percent) for r in hot] == [(below + df.where("k = 7").count(), below / 29_999)]


def test_only_summaries_meet_an_unpartitioned_window(spark):
    df = spark.range(1000).selectExpr("id", "id % 10 as k", "id as v")
    asked = {**ASKED, "row_totals": {"v": "running"}, "previous": {"v": "before"}, "row_number": "n"}
    plan = OrderedRows(df, "k").with_columns(**asked)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if line.strip(" :+-").startswith("Window ")]
    unpartitioned = [w for w in windows if w.split("windowspecdefinition(")[1].startswith("_part#") and "], [_part#" not in w]
    assert windows and len(unpartitioned) < len(windows)
    for line in windows:
        assert "_part#" in line or "_first#" in line or "_last#" in line


@pytest.mark.parametrize("kind", ["spread", "hot", "two", "one", "wide", "ties"])
def test_quantiles_equal_pandas(spark, kind, monkeypatch):
    monkeypatch.setattr(quantiles, "_FETCHED", 20)
    monkeypatch.setattr(quantiles, "_ACCURACY", 50)
    dice = random.Random(5)
    values = {
        "spread": [dice.gauss(0, 1) for _ in range(4001)],
        "hot": [7.0 if dice.random() < 0.4 else dice.uniform(0, 10) for _ in range(3000)],
        "two": [1.0] * 1000 + [2.0] * 1000,
        "one": [3.0] * 500,
        "wide": [dice.choice([-1, 1]) * 10 ** dice.uniform(-300, 300) for _ in range(2000)],
        "ties": [float(dice.randrange(30)) for _ in range(2000)],
    }[kind]
    dice.shuffle(values)
    df = spark.createDataFrame([(v,) for v in [*values, None, float("nan")]], "x double").repartition(6)
    shares = [0, 0.01, 0.25, 0.5, 0.75, 0.999, 1]
    made = exact_quantiles(df, ["x"], shares)["x"]
    assert np.allclose(made, pd.Series(values).quantile(shares).to_numpy(), rtol=1e-12, atol=0)


def test_rounding_by_decimal_text(spark):
    values = [0.285, 1.005, -0.285, 2.5, 1e300, 0.125, -0.001, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r[0] for r in df.select(rounded("x")).collect()] == [0.29, 1.01, -0.29, 2.5, 1e300, 0.13, 0.0, None]


def test_describe(spark):
    rows = [(1, 2.0), (2, None), (3, 4.5), (4, 1.0)]
    df = spark.createDataFrame(rows, "n bigint, x double")
    stats = {r.column_name: r for r in basic_stats(df).collect()}
    truth = pd.DataFrame(rows, columns=["n", "x"]).describe()
    for c in ("n", "x"):
        found = [stats[c][k] for k in ("value_count", "mean", "stddev", "min", "q1", "median", "q3", "max")]
        assert np.allclose(found, truth[c].to_numpy(), atol=1e-4)
    empty = basic_stats(df.where("n < 0")).first()
    assert empty.value_count == 0 and empty.median is None
    assert exact_quantiles(df, [], [0.5]) == {}
