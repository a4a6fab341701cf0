"""A folder of tables that change in committed versions.

Files are staged in folders that no reader knows. A commit writes one manifest, a single small file
that names the folders of every table, the batches taken so far and the marks (last key, last row
read). A version is there when its manifest is, so a load that is killed leaves the version before
it, and a batch that is given again is known. Nothing is ever changed in place; a table may be cut
into buckets so that a change rewrites only the buckets it touches.

One writer at a time. The number of manifest rows is bounded by tables, buckets and batches.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MANIFEST = "kind string, name string, bucket int, value string"
_BUCKET = "_bucket"


class Change:
    """What one commit will do: gather it with ``replace``, ``append`` and ``mark``."""

    def __init__(self, store: VersionedStore, batch: str):
        self.store, self.batch = store, batch
        rows = store.manifest()
        self.rows = [r for r in rows if r["kind"] != "schema"]
        self.schemas = {r["name"]: r for r in rows if r["kind"] == "schema"}

    def _staged(self, df: DataFrame, table: str, bucket: Column | None, partitions: tuple[str, ...]) -> dict[int, str]:
        folder = f"data/{table}/{self.batch}-{uuid.uuid4().hex}"
        path = f"{self.store.path}/{folder}"
        schema = df.schema
        if bucket is None:
            df.write.partitionBy(*partitions).parquet(path) if partitions else df.write.parquet(path)
            found = {0: folder}
        else:
            df.withColumn(_BUCKET, bucket).repartition(_BUCKET).write.partitionBy(_BUCKET).parquet(path)
            reader = self.store.spark.read.schema(T.StructType([*schema.fields, T.StructField(_BUCKET, T.IntegerType())]))
            found = {r[0]: f"{folder}/{_BUCKET}={r[0]}" for r in reader.parquet(path).select(_BUCKET).distinct().collect()}
        self.schemas[table] = {"kind": "schema", "name": table, "bucket": None, "value": schema.json()}
        return found

    def replace(self, table: str, df: DataFrame, bucket: Column | None = None, buckets: Iterable[int] | None = None, partitions=()) -> None:
        """Store ``df`` as the whole table, or as these buckets of it."""
        found = self._staged(df, table, bucket, tuple(partitions))
        gone = None if buckets is None else set(buckets)
        self.rows = [r for r in self.rows if not (r["kind"] == "files" and r["name"] == table and (gone is None or r["bucket"] in gone))]
        self.rows += [{"kind": "files", "name": table, "bucket": b, "value": f} for b, f in found.items()]

    def append(self, table: str, df: DataFrame, bucket: Column | None = None, partitions=()) -> DataFrame:
        """Store ``df`` as more rows of the table; the rows as they are stored."""
        found = self._staged(df, table, bucket, tuple(partitions))
        more = [{"kind": "files", "name": table, "bucket": b, "value": f} for b, f in found.items()]
        self.rows += more
        return self.store.frame([*more, *self.schemas.values()], table)

    def replace_all(self, frames: dict[str, DataFrame]) -> None:
        """Store whole tables that do not depend on each other, side by side."""
        with ThreadPoolExecutor(len(frames)) as pool:
            found = dict(zip(frames, pool.map(lambda name: self._staged(frames[name], name, None, ()), frames)))
        self.rows = [r for r in self.rows if not (r["kind"] == "files" and r["name"] in frames)]
        self.rows += [{"kind": "files", "name": n, "bucket": b, "value": f} for n, of in found.items() for b, f in of.items()]

    def read(self, table: str) -> DataFrame:
        """A table as it will be after the commit."""
        return self.store.frame([*self.rows, *self.schemas.values()], table)

    def mark(self, name: str, value) -> None:
        """Keep a value (anything JSON can hold) with the version."""
        self.rows = [r for r in self.rows if not (r["kind"] == "mark" and r["name"] == name)]
        self.rows.append({"kind": "mark", "name": name, "bucket": None, "value": json.dumps(value)})

    def commit(self) -> int:
        """Make the change visible, at once and whole; the number of the new version."""
        rows = [*self.rows, *self.schemas.values()]
        rows.append({"kind": "batch", "name": self.batch, "bucket": None, "value": None})
        version = self.store.version() + 1
        frame = self.store.spark.createDataFrame([tuple(r[c] for c in ("kind", "name", "bucket", "value")) for r in rows], _MANIFEST)
        while True:
            try:
                frame.coalesce(1).write.json(f"{self.store.path}/manifests/version={version:08d}")
                return version
            except AnalysisException as taken:  # the empty folder of a commit that was killed
                if taken.getCondition() != "PATH_ALREADY_EXISTS" or version in self.store.versions():
                    raise
                version += 1


class VersionedStore:
    """The tables under ``path``. Without a version number, questions are to the last one."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> list[int]:
        """Numbers of the versions that are there, in order."""
        try:
            files = self.spark.read.schema(_MANIFEST).json(f"{self.path}/manifests").inputFiles()
        except AnalysisException as missing:
            if missing.getCondition() == "PATH_NOT_FOUND":
                return []
            raise
        return sorted({int(re.search(r"/version=(\d+)/", f).group(1)) for f in files})

    def version(self) -> int:
        return max(self.versions(), default=0)

    def manifest(self, version: int | None = None) -> list[dict]:
        version = version or self.version()
        if not version:
            return []
        return [r.asDict() for r in self.spark.read.schema(_MANIFEST).json(f"{self.path}/manifests/version={version:08d}").collect()]

    def has_batch(self, batch: str) -> bool:
        return any(r["kind"] == "batch" and r["name"] == batch for r in self.manifest())

    def marked(self, name: str, default=None):
        found = [r["value"] for r in self.manifest() if r["kind"] == "mark" and r["name"] == name]
        return json.loads(found[0]) if found else default

    def tables(self, version: int | None = None) -> list[str]:
        return [r["name"] for r in self.manifest(version) if r["kind"] == "schema"]

    def read(self, table: str, buckets: Iterable[int] | None = None, version: int | None = None) -> DataFrame:
        """A table, or some buckets of it; no file of another bucket is opened."""
        return self.frame(self.manifest(version), table, buckets)

    def frame(self, rows: list[dict], table: str, buckets: Iterable[int] | None = None) -> DataFrame:
        schema = next((r["value"] for r in rows if r["kind"] == "schema" and r["name"] == table), None)
        if schema is None:
            raise ValueError(f"no table {table} in {self.path}")
        wanted = None if buckets is None else set(buckets)
        folders = [
            f"{self.path}/{r['value']}" for r in rows
            if r["kind"] == "files" and r["name"] == table and (wanted is None or r["bucket"] in wanted)
        ]
        schema = T.StructType.fromJson(json.loads(schema))
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def change(self, batch: str) -> Change:
        return Change(self, batch)


def bucket_of(column: str | Column, buckets: int) -> Column:
    """The bucket of a key: the CRC-32 of its text, which clients can compute, too."""
    column = F.col(column) if isinstance(column, str) else column
    return F.pmod(F.crc32(column.cast("string").cast("binary")), F.lit(buckets)).cast("int")
