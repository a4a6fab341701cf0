"""Types of CSV columns over several files."""

import itertools

import pytest
from pyspark.sql import functions as F

from tallyhouse.sources import files, inference
from tallyhouse.sources.inference import DATE, DOUBLE, LONG, NOTHING, TEXT, TIMESTAMP, widened


def test_the_lattice():
    kinds = [NOTHING, LONG, DOUBLE, DATE, TIMESTAMP, TEXT]
    for a, b, c in itertools.product(kinds, repeat=3):
        assert widened(a, b) == widened(b, a) and widened(a, a) == a
        assert widened(widened(a, b), c) == widened(a, widened(b, c))
    assert widened(LONG, DOUBLE) == DOUBLE and widened(DATE, TIMESTAMP) == TIMESTAMP
    assert widened(LONG, DATE) == TEXT and widened(NOTHING, DATE) == DATE


def put(path, name, *rows):
    (path / name).write_text("\n".join(rows) + "\n")


def test_files_that_disagree(spark, tmp_path):
    put(tmp_path, "a.csv", "n,x,d,t,s,e", "1,2,2024-01-01,2024-01-01,7,", "2,-3,2024-02-29,2024-01-02, 8 ,")
    put(tmp_path, "b.csv", "n,x,d,t,s,e", "3,2.5,2024-01-03,2024-01-01T10:00:00,abc,", '4,1e3,,2024-01-01 10:00:01.25,"q ""x"", y",')
    schema = inference.inferred_schema(spark, str(tmp_path))
    assert [f.dataType.simpleString() for f in schema] == ["bigint", "double", "date", "timestamp_ntz", "string", "string"]
    rows = {r.n: r for r in inference.scan_inferred(spark, str(tmp_path)).collect()}
    assert (rows[1].x, rows[4].x, str(rows[2].d), rows[4].d) == (2.0, 1000.0, "2024-02-29", None)
    assert str(rows[1].t) == "2024-01-01 00:00:00" and str(rows[4].t) == "2024-01-01 10:00:01.250000"
    assert rows[4].s == 'q "x", y' and rows[1].s == "7" and rows[1].e is None
    drift = sorted(tuple(r) for r in inference.schema_drift(spark, str(tmp_path)).collect())
    assert drift == [("s", "long", 1, "text"), ("s", "text", 1, "text"), ("t", "date", 1, "timestamp"), ("t", "timestamp", 1, "timestamp"),
                     ("x", "double", 1, "double"), ("x", "long", 1, "double")]


@pytest.mark.parametrize("text, kind, fits", [
    ("9223372036854775807", LONG, True), ("9223372036854775808", LONG, False), ("9223372036854775808", DOUBLE, True), ("1.", DOUBLE, True),
    (".5", DOUBLE, True), (".", DOUBLE, False), ("NaN", DOUBLE, False), ("1d", DOUBLE, False), ("2023-02-29", DATE, False),
    ("2024-1-1", DATE, False), ("2024-01-01T25:00", TIMESTAMP, False), ("2024-01-01T05:00", TIMESTAMP, True), ("1 2", LONG, False),
])
def test_what_a_type_holds(spark, text, kind, fits):
    assert (spark.range(1).select(inference.value_as(F.lit(text), kind)).first()[0] is not None) == fits


def test_a_stated_sample(spark, tmp_path):
    df = spark.range(5000).selectExpr("id", "id / 2 as half").coalesce(1)
    path = files.write(df, str(tmp_path / "x"), "csv")
    types = {r.column_name: r.type for r in inference.file_types(spark, path, one_in=50).collect()}
    assert types == {"id": LONG, "half": DOUBLE}
    assert inference.scan_inferred(spark, path).exceptAll(df).isEmpty()


def test_json_arrays(spark, tmp_path):
    df = spark.createDataFrame([(i, None if i % 5 == 0 else f'a "{i}"', i % 3) for i in range(100)], "id bigint, s string, k int")
    path = files.write_json_arrays(df, str(tmp_path / "j"), "k", records=20)
    back = files.scan(spark, path, "json", df.schema, json_array=True)
    assert back.exceptAll(df).isEmpty() and back.count() == 100 and len(back.inputFiles()) > 3
