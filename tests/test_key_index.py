"""Audits of a new batch against stored keys."""

import random

import pytest

from tallyhouse.operators.key_index import KeyIndex
from tallyhouse.plans import registry
from tallyhouse.sources.tables import table
from tallyhouse.sources.versions import VersionedStore
from pyspark.sql import functions as F


def frame(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "k bigint")


@pytest.fixture
def index(spark, tmp_path):
    dice = random.Random(1)
    made = KeyIndex(VersionedStore(spark, str(tmp_path / "i")))
    first = [dice.randrange(10**6) for _ in range(4000)]
    second = [10**6 + dice.randrange(10**6) for _ in range(4000)]
    assert made.add("1", frame(spark, [*first, None]), 10) and not made.add("1", frame(spark, [5]), 1)
    assert made.add("2", frame(spark, second), 10)
    made.all = set(first) | set(second)
    return made


def test_known_and_unknown_are_exact(spark, index):
    dice = random.Random(2)
    batch = [dice.choice(sorted(index.all)) for _ in range(300)] + [dice.randrange(-(10**6), 3 * 10**6) for _ in range(300)] + [None]
    known, _ = index.known(frame(spark, batch), "k")
    unknown, _ = index.unknown(frame(spark, batch), "k")
    count = {k: batch.count(k) for k in set(batch) if k is not None}
    assert {r.k: r.row_count for r in known.collect()} == {k: n for k, n in count.items() if k in index.all}
    assert {r.k: r.row_count for r in unknown.collect()} == {k: n for k, n in count.items() if k not in index.all}


def test_files_out_of_range_are_not_opened(spark, index):
    assert index.files() == 20
    some = sorted(index.all)
    known, opened = index.known(frame(spark, some[-20:]), "k")
    assert known.count() == len(set(some[-20:])) and opened <= 2
    assert index.known(frame(spark, [5 * 10**6, -7]), "k")[1] == 0
    assert index.unknown(frame(spark, [5 * 10**6, -7]), "k")[0].count() == 2
    assert index.known(frame(spark, []), "k")[0].count() == 0


def test_the_filter_keeps_files_shut(spark, index):
    """Keys within the range of every file that hardly any filter admits."""
    absent = [k for k in range(100, 2 * 10**6, 100_003) if k not in index.all]
    known, opened = index.known(frame(spark, absent), "k")
    assert known.count() == 0 and opened <= 3


def test_one_key_in_a_third_of_the_batch(spark, index):
    hot = min(index.all)
    batch = spark.range(3000).select(F.when(F.col("id") % 3 == 0, hot).otherwise(F.col("id") + 10**8).alias("k"))
    known, opened = index.known(batch, "k")
    assert [tuple(r) for r in known.collect()] == [(hot, 1000)] and opened == 1


def test_supplied_batches_skip_files(spark, small):
    index, greatest = registry._order_index(spark, small)
    batch = table(spark, small, "orders").where(F.col("o_orderkey") * 100 > 85 * greatest)
    known, opened = index.known(batch, "o_orderkey")
    assert known.count() > 0 and opened < index.files() / 3
