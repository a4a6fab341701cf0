"""Committed versions: loads that are killed, repeated, extended, and changes of a few buckets."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators.history import as_of_join, scd2_apply
from tallyhouse.operators.stored_history import StoredHistory
from tallyhouse.plans import registry, warehouse
from tallyhouse.plans.increments import IncrementalWarehouse, table_history
from tallyhouse.plans.warehouse import Warehouse, build_warehouse
from tallyhouse.sources import files
from tallyhouse.sources.versions import VersionedStore, bucket_of
from tallyhouse.sources.views import Retail


def numbers(spark, low, high):
    return spark.range(low, high).withColumnRenamed("id", "n")


def test_versions_marks_and_batches(spark, tmp_path):
    store = VersionedStore(spark, str(tmp_path / "s"))
    assert store.version() == 0 and store.tables() == [] and not store.has_batch("a") and store.marked("m", 7) == 7
    change = store.change("a")
    change.replace("t", numbers(spark, 0, 10))
    change.mark("m", [1, "x"])
    assert store.version() == 0  # nothing is seen before the commit
    assert change.commit() == 1
    change = store.change("b")
    change.append("t", numbers(spark, 10, 15))
    assert change.commit() == 2 and store.versions() == [1, 2]
    assert (store.read("t").count(), store.read("t", version=1).count()) == (15, 10)
    assert store.marked("m") == [1, "x"] and store.has_batch("a") and store.has_batch("b")
    change = store.change("c")
    change.replace("t", numbers(spark, 0, 3))
    change.commit()
    assert store.read("t").count() == 3 and store.read("t", version=2).count() == 15
    with pytest.raises(ValueError):
        store.read("other")


def test_only_touched_buckets_are_written(spark, tmp_path):
    store = VersionedStore(spark, str(tmp_path / "s"))
    change = store.change("a")
    change.replace("t", numbers(spark, 0, 1000), bucket_of("n", 8))
    change.commit()
    before = {r["bucket"]: r["value"] for r in store.manifest() if r["kind"] == "files"}
    assert set(before) == set(range(8))
    change = store.change("b")
    change.replace("t", store.read("t", [2, 5]).withColumn("n", F.col("n") * 1).where("n > 500"), bucket_of("n", 8), [2, 5])
    change.commit()
    after = {r["bucket"]: r["value"] for r in store.manifest() if r["kind"] == "files"}
    assert {b for b in after if after[b] != before[b]} == {2, 5}
    kept = {r.n for r in store.read("t").collect()}
    two_five = {r.n for r in numbers(spark, 0, 1000).where(bucket_of("n", 8).isin(2, 5)).collect()}
    assert kept == set(range(1000)) - {n for n in two_five if n <= 500}
    assert all("_bucket=2/" in f or "_bucket=5/" in f for f in store.read("t", [2, 5]).inputFiles())
    change = store.change("c")
    change.replace("t", store.read("t", [2]).where("n < 0"), bucket_of("n", 8), [2])  # a bucket that ends empty
    change.commit()
    assert store.read("t", [2]).count() == 0 and store.read("t").count() == len([n for n in kept if n not in two_five]) + store.read("t", [5]).count()


def test_a_killed_commit_leaves_the_version_before_it(spark, tmp_path):
    store = VersionedStore(spark, str(tmp_path / "s"))
    change = store.change("a")
    change.replace("t", numbers(spark, 0, 10))
    change.commit()
    unfinished = store.change("b")
    unfinished.replace("t", numbers(spark, 0, 99))
    folder = tmp_path / "s" / "manifests" / "version=00000002" / "_temporary" / "0"
    folder.mkdir(parents=True)
    (folder / "part-0.json").write_text('{"kind": "batch", "na')
    assert store.version() == 1 and store.read("t").count() == 10 and not store.has_batch("b")
    again = store.change("b")
    again.replace("t", numbers(spark, 0, 20))
    assert again.commit() == 3 and store.read("t").count() == 20 and store.has_batch("b")


def test_a_killed_warehouse_load_can_be_repeated(spark, small, tmp_path, monkeypatch):
    source, path = Retail(spark, small), str(tmp_path / "house")

    def killed(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as patched:
        patched.setattr(warehouse, "by_month", killed)
        with pytest.raises(RuntimeError):
            build_warehouse(source, path)
    assert VersionedStore(spark, path).version() == 0
    with pytest.raises(ValueError):
        Warehouse.saved(spark, path)
    first = {r.table_name: r.row_count for r in build_warehouse(source, path).collect()}
    second = {r.table_name: r.row_count for r in build_warehouse(source, path).collect()}
    assert first == second and first["fact_sales"] > 0 and VersionedStore(spark, path).versions() == [1]


def customers(*ids):
    return [(i, f"F{i}", f"L{i}", f"{i}@x", "Gold") for i in ids]


def lines(*rows):
    return [(c, dt.date(2024, 1, day), o, f"{o}-{n}", arrival, 2, 10.0 * n) for c, day, o, n, arrival in rows]


C = "customer_id bigint, first_name string, last_name string, email string, customer_tier string"
L = "customer_id bigint, order_date date, order_id bigint, order_item_id string, arrival bigint, quantity bigint, line_total double"


def test_late_members_and_late_lines(spark, tmp_path):
    house = IncrementalWarehouse(spark, str(tmp_path / "w"))

    def load(batch, people, sold):
        return house.load(batch, spark.createDataFrame(people, C), spark.createDataFrame(sold, L))

    one = lines((1, 5, 100, 1, 1), (2, 6, 101, 1, 2))
    two = one + lines((7, 7, 102, 1, 3), (1, 4, 100, 2, 4), (None, 7, 103, 1, 5))  # unknown, late, without customer
    assert load("1", customers(1, 2), one)
    assert load("2", [], two) and not load("2", [], two)
    assert not load("1", customers(1, 2), one)
    members = {r.customer_id: r for r in house.dim_customer.collect()}
    assert {i: r.customer_key for i, r in members.items()} == {1: 1, 2: 2, 7: 3}
    assert members[7].is_inferred and members[7].first_name is None
    facts = {r.order_item_id: r for r in house.fact_sales.collect()}
    assert len(facts) == 5 and facts["102-1"].customer_key == 3 and facts["100-2"].date_key == 20240104
    assert facts["103-1"].customer_key is None and float(facts["100-2"].net_revenue) == 21.6
    assert load("3", customers(7, 9), two)  # the customer arrives; no line is read again
    members = {r.customer_id: r for r in house.dim_customer.collect()}
    assert (members[7].customer_key, members[7].first_name, members[7].is_inferred) == (3, "F7", False)
    assert members[9].customer_key == 4 and house.fact_sales.count() == 5 and house.dim_customer.count() == 4
    assert house.fact_sales.select("sales_key").distinct().count() == 5
    counts = [(r.version, r.table_name, r.row_count) for r in table_history(house).collect()]
    assert counts == [(1, "dim_customer", 2), (1, "fact_sales", 2), (2, "dim_customer", 3), (2, "fact_sales", 5), (3, "dim_customer", 4), (3, "fact_sales", 5)]


def test_a_load_does_not_touch_older_files(spark, tmp_path):
    house = IncrementalWarehouse(spark, str(tmp_path / "w"))
    house.load("1", spark.createDataFrame(customers(1, 2), C), spark.createDataFrame(lines((1, 5, 1, 1, 1)), L))
    before = {r["value"] for r in house.store.manifest() if r["kind"] == "files"}
    house.load("2", spark.createDataFrame([], C), spark.createDataFrame(lines((5, 5, 2, 1, 9)), L))
    assert before <= {r["value"] for r in house.store.manifest() if r["kind"] == "files"}
    empty = house.load("3", spark.createDataFrame([], C), spark.createDataFrame([], L))
    assert empty and house.fact_sales.count() == 2 and house.store.marked("arrival") == 9


DIM = "customer_key bigint, customer_id bigint, first_name string, customer_tier string, valid_from date, valid_to date, is_current boolean"


def test_history_in_buckets_equals_history_in_one(spark, tmp_path):
    start, end = dt.date(2024, 1, 1), dt.date(9999, 12, 31)
    dim = spark.createDataFrame([(i, i, f"C{i}", "Bronze", start, end, True) for i in range(1, 201)], DIM)
    made = StoredHistory(VersionedStore(spark, str(tmp_path / "h")), buckets=16)
    assert made.create(dim) and not made.create(dim)
    batch = spark.createDataFrame(
        [(5, "Gold", dt.date(2024, 3, 1)), (5, "Silver", dt.date(2024, 5, 1)), (9, "Gold", dt.date(2024, 2, 1)), (999, "Gold", dt.date(2024, 2, 1))],
        "customer_id bigint, new_tier string, effective_date date",
    )
    assert made.apply(batch, "b1") and not made.apply(batch, "b1")
    assert sorted(made.versions().collect()) == sorted(scd2_apply(dim, batch).collect())
    touched = made.touched(batch)
    old = {r["bucket"]: r["value"] for r in made.store.manifest(1) if r["kind"] == "files"}
    new = {r["bucket"]: r["value"] for r in made.store.manifest(2) if r["kind"] == "files"}
    assert len(touched) <= 3 and {b for b in new if new[b] != old.get(b)} <= set(touched)
    later = spark.createDataFrame([(9, "Bronze", dt.date(2024, 9, 1))], "customer_id bigint, new_tier string, effective_date date")
    assert made.apply(later, "b2")
    assert sorted(made.versions().collect()) == sorted(scd2_apply(scd2_apply(dim, batch), later).collect())
    assert made.versions(version=1).count() == 200
    few = made.versions_of([5, 9])
    assert few.count() == 6 and len({f.split("_bucket=")[1].split("/")[0] for f in few.inputFiles()}) <= 2


def test_shown_customers_read_their_buckets(spark, small):
    read = registry._REGISTERED["scd_show_current"](spark, small).inputFiles()
    whole = registry._REGISTERED["scd2_apply"](spark, small).inputFiles()
    assert len(read) <= 5 < len(whole)


def test_as_of_with_very_many_versions(spark):
    """A customer with thousands of versions and a third of the facts."""
    dice = random.Random(3)
    day = lambda n: dt.date(2000, 1, 1) + dt.timedelta(days=n)
    rows = [(1, i, day(2 * i), day(2 * i + 1)) for i in range(2000)]
    rows[-1] = (1, 1999, day(3998), dt.date(9999, 12, 31))
    for c in range(2, 60):
        rows += [(c, 0, day(10), day(99)), (c, 1, day(100), dt.date(9999, 12, 31))]
    dim = spark.createDataFrame(rows, "customer_id bigint, version bigint, valid_from date, valid_to date")
    sold = [(n, 1 if n % 3 == 0 else dice.randrange(1, 61), day(dice.randrange(-5, 5000))) for n in range(6000)] + [(6000, 1, None), (6001, None, day(5))]
    facts = spark.createDataFrame(sold, "fact bigint, customer_id bigint, order_date date")
    made = as_of_join(facts, dim, "customer_id", "order_date")
    truth = {}
    by_customer = {}
    for c, v, low, high in rows:
        by_customer.setdefault(c, []).append((low, high, v))
    for n, c, at in sold:
        truth |= {n: v for low, high, v in by_customer.get(c, []) if at and low <= at <= high}
    found = made.select("fact", "version").collect()
    assert {r.fact: r.version for r in found} == truth and len(found) == len(truth)
    assert made.columns == ["fact", "customer_id", "order_date", "version", "valid_from", "valid_to"] or "version" in made.columns
    spread = dim.join(dim.groupBy("customer_id").count().where("count > 64"), "customer_id").select("valid_from").distinct().count()
    assert spread == 2000


def test_stores_follow_their_tables(spark, tmp_path):
    """A table that changes is seen; one that does not is not built again."""
    for name in registry._HOUSE_TABLES:
        (tmp_path / f"{name}.parquet").mkdir()
        (tmp_path / f"{name}.parquet" / "a").write_text("x")
    filled = []
    first = registry._store(spark, str(tmp_path), "test", lambda new: filled.append(new.path))
    assert registry._store(spark, str(tmp_path), "test", lambda new: filled.append(new.path)) is first and len(filled) == 1
    (tmp_path / "orders.parquet" / "b").write_text("y")
    assert registry._store(spark, str(tmp_path), "test", lambda new: filled.append(new.path)) is not first and len(filled) == 2
    assert files.file_state(spark, str(tmp_path / "orders.parquet"))[0][1] == 1
