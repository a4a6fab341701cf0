"""Key audits of a new batch that open only the files that may hold its keys.

Keys are kept in files sorted by range. For each file the index holds its least and greatest key and
a Bloom filter (one hash, in ``SEGMENTS`` bitmaps). A key of a batch is looked up by its cell of the
key range and its segment, an equality that Spark joins by shuffle; files whose range and filter
admit a key are read, and the keys are compared exactly. So an answer never rests on the filter, and
files that cannot hold any key are not opened.

Keys are whole numbers. The number of index rows follows from the files and not from the keys; a
file's row stands under every cell that its range touches, and cells are as wide as a file's range is
on average when the index is made.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.sources.versions import Change, VersionedStore

SEGMENTS = 16
_BITS = 32768  # of one bitmap
_KEYS, _INDEX, _WIDTH = "keys", "key_index", "key cell width"


def _segment(key: str):
    return F.pmod(F.xxhash64(key), F.lit(SEGMENTS)).cast("int")


def _bit(key: str):
    return F.pmod(F.shiftright(F.xxhash64(key), 8), F.lit(_BITS))


def _is_set(bitmap: str, bit: str):
    """Whether a bit of a binary bitmap is set, low bits first."""
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(F.col(bit) / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.pmod(F.floor(byte / F.pow(F.lit(2), F.pmod(F.col(bit), F.lit(8)))), F.lit(2)) == 1


class KeyIndex:
    """The keys of a table, taken batch by batch, in a versioned store."""

    def __init__(self, store: VersionedStore):
        self.store = store

    def add(self, batch: str, keys: DataFrame, files: int) -> bool:
        """Store the keys of a batch (one whole-number column, NULLs left out) in ``files`` files."""
        if self.store.has_batch(batch):
            return False
        name = keys.columns[0]
        named = keys.where(F.col(name).isNotNull()).select(F.col(name).cast("bigint").alias("key"))
        change = self.store.change(batch)
        change.append(_KEYS, named.repartitionByRange(files, "key").sortWithinPartitions("key"))
        index = self._described(change, batch)
        width = self.store.marked(_WIDTH)
        if width is None:
            row = index.agg(F.min("low"), F.max("high"), F.count_distinct("file")).first()
            width = max(1, (row[1] - row[0]) // row[2]) if row[2] else 1
            change.mark(_WIDTH, width)
        change.append(_INDEX, index)
        change.commit()
        return True

    def _described(self, change: Change, batch: str) -> DataFrame:
        """(file, segment, low, high, bits) of the files that the batch has staged."""
        folder = [r["value"] for r in change.rows if r["kind"] == "files" and r["name"] == _KEYS][-1]
        rows = self.store.spark.read.schema("key bigint").parquet(f"{self.store.path}/{folder}")
        rows = rows.select("key", F.col("_metadata.file_path").alias("file"))
        ends = rows.groupBy("file").agg(F.min("key").alias("low"), F.max("key").alias("high"))
        filters = rows.groupBy("file", _segment("key").alias("segment")).agg(F.bitmap_construct_agg(_bit("key")).alias("bits"))
        return filters.join(ends, "file")

    def files(self) -> int:
        return self.store.read(_INDEX).select("file").distinct().count()

    def _admitted(self, wanted: DataFrame) -> list[str]:
        """The files that may hold one of the keys; there are no more than files."""
        width = F.lit(self.store.marked(_WIDTH))
        cell = lambda c: F.floor(F.col(c) / width)
        index = self.store.read(_INDEX).withColumn("cell", F.explode(F.sequence(cell("low"), cell("high"))))
        asked = wanted.select("key", cell("key").alias("cell"), _segment("key").alias("segment"), _bit("key").alias("bit"))
        met = asked.join(index, ["cell", "segment"]).where(F.col("key").between(F.col("low"), F.col("high")) & _is_set("bits", "bit"))
        return [r[0] for r in met.select("file").distinct().collect()]

    def _held(self, wanted: DataFrame) -> tuple[DataFrame, list[str]]:
        """The keys of the admitted files, and these files."""
        opened = self._admitted(wanted)
        if not opened:
            return self.store.spark.createDataFrame([], "key bigint"), []
        return self.store.spark.read.schema("key bigint").parquet(*opened), opened

    def known(self, batch: DataFrame, key: str) -> tuple[DataFrame, int]:
        """(key, row_count) of the batch's keys that are stored already, and how many files were opened."""
        wanted = batch.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("bigint").alias("key")).agg(F.count(F.lit(1)).alias("row_count"))
        held, opened = self._held(wanted)
        return wanted.join(held, "key", "left_semi").withColumnRenamed("key", key), len(opened)

    def unknown(self, batch: DataFrame, key: str) -> tuple[DataFrame, int]:
        """(key, row_count) of the batch's references that no stored key answers, and the files opened."""
        wanted = batch.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("bigint").alias("key")).agg(F.count(F.lit(1)).alias("row_count"))
        held, opened = self._held(wanted)
        return wanted.join(held, "key", "left_anti").withColumnRenamed("key", key), len(opened)
