"""Compare registered queries with their SQL on DuckDB: columns, types, rows and values.

Run as a script for a whole data set: ``python tests/oracle_check.py /root/testdata/sf0.01 [name ...]``.
"""

from __future__ import annotations

import os
import re
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyhouse.sources.tables import SCHEMAS  # noqa: E402

KINDS = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in SCHEMAS:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def has_order(sql: str) -> bool:
    """Whether an answer is an ordered list: its SQL ends with ORDER BY, perhaps with a limit behind it."""
    return re.search(r"\bORDER BY [^()]*(\([^()]*\)[^()]*)*$", sql.strip()) is not None


def _ordered(rows):
    return sorted(rows, key=lambda row: [(v is None, str(v)) for v in row])


def problems(df, sql: str, db) -> tuple[list[str], int]:
    """What differs between a Spark result and the SQL's, and the number of rows. Rows of ordered answers
    are compared in their order."""
    found = []
    arrange = list if has_order(sql) else _ordered
    result = db.execute(sql)
    expected_types = {d[0]: str(d[1]) for d in result.description}
    expected_rows = result.fetchall()
    expected_names = [d[0] for d in result.description]
    types = {name: KINDS.get(kind, kind) for name, kind in df.dtypes}
    if types != expected_types:
        odd = {
            n: (types.get(n), expected_types.get(n))
            for n in types.keys() | expected_types.keys()
            if types.get(n) != expected_types.get(n)
        }
        found.append(f"types (Spark, SQL): {odd}")
    names = sorted(types.keys() & expected_types.keys())
    actual = arrange([tuple(row[n] for n in names) for row in df.collect()])
    places = [expected_names.index(n) for n in names]
    expected = arrange([tuple(row[i] for i in places) for row in expected_rows])
    if len(actual) != len(expected):
        found.append(f"rows: Spark {len(actual)}, SQL {len(expected)}")
    wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
    if wrong:
        a, e = wrong[0]
        cells = {n: (x, y) for n, x, y in zip(names, a, e) if x != y}
        found.append(f"{len(wrong)} rows differ, first: {cells}")
    return found, len(actual)


def main(sf_dir: str, *only: str) -> int:
    from __spark_entry__ import oracle_sql, queries
    from tallyhouse.session import build_session

    spark = build_session(
        "oracle-check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    db, sql, bad = connect(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            if name in sql:
                found, rows = problems(df, sql[name], db)
            else:
                found, rows = [], len(df.collect())
        except Exception as error:  # report and go on with the next query
            found, rows = [str(error)[:600]], -1
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok':5}{name:28}{rows:8} rows {time.time() - start:6.2f}s", *found, sep="\n     " if found else " ")
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(*sys.argv[1:]) else 0)
