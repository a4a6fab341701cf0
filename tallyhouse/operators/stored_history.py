"""A type 2 dimension kept in a versioned store, in buckets by the hash of the customer.

A batch of changes reads and writes the buckets of the customers it names; the other buckets go
over into the next version as they are. A batch that was taken before is left alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators import history
from tallyhouse.sources.versions import VersionedStore, bucket_of

BUCKETS = 32
_LAST_KEY = "last customer_key"


class StoredHistory:
    def __init__(self, store: VersionedStore, table: str = "dim_customer", buckets: int = BUCKETS):
        self.store, self.table, self.buckets = store, table, buckets

    def _bucket(self):
        return bucket_of("customer_id", self.buckets)

    def create(self, dim: DataFrame, batch: str = "first") -> bool:
        """Store a dimension as the first version."""
        if self.store.has_batch(batch):
            return False
        change = self.store.change(batch)
        change.replace(self.table, dim, self._bucket())
        change.mark(_LAST_KEY, dim.agg(F.coalesce(F.max("customer_key"), F.lit(0))).first()[0])
        change.commit()
        return True

    def touched(self, changes: DataFrame) -> list[int]:
        """The buckets of the customers that changes name; there are no more than buckets."""
        return sorted(r[0] for r in changes.select(self._bucket().alias("b")).distinct().collect())

    def apply(self, changes: DataFrame, batch: str) -> bool:
        """Take a batch of tier changes; tells whether it was new."""
        if self.store.has_batch(batch):
            return False
        touched, last = self.touched(changes), self.store.marked(_LAST_KEY)
        after = history.scd2_apply(self.store.read(self.table, touched), changes, last_key=last)
        change = self.store.change(batch)
        change.replace(self.table, after, self._bucket(), touched)
        stored = [r["value"] for r in change.rows if r["kind"] == "files" and r["name"] == self.table and r["bucket"] in touched]
        keys = self.store.spark.read.schema("customer_key bigint").parquet(*[f"{self.store.path}/{f}" for f in stored])
        change.mark(_LAST_KEY, max(last, keys.agg(F.coalesce(F.max("customer_key"), F.lit(0))).first()[0]) if stored else last)
        change.commit()
        return True

    def versions(self, version: int | None = None) -> DataFrame:
        """The whole dimension."""
        return self.store.read(self.table, version=version)

    def versions_of(self, customer_ids: Iterable[int]) -> DataFrame:
        """All versions of the listed customers, out of their buckets alone."""
        customer_ids = list(customer_ids)
        buckets = {zlib.crc32(str(i).encode()) % self.buckets for i in customer_ids}
        return history.versions_of(self.store.read(self.table, buckets), customer_ids)
