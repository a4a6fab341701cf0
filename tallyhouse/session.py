"""Spark session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# AQE does three jobs for us: it picks broadcast joins from measured sizes, splits
# skewed join partitions, and merges small shuffle partitions. Forcing the skew rule
# lets it act even where the split costs one more exchange. Before a join by shuffle with
# a filtered table, a Bloom filter of its keys (4 MB, whatever the size) keeps most rows
# that cannot match out of the shuffle.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "64MB",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "100GB",
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "4000000",
    "spark.sql.optimizer.runtime.bloomFilter.numBits": "33554432",
    "spark.sql.session.timeZone": "UTC",
}
_OURS = ("spark.sql.adaptive.", "spark.sql.optimizer.runtime.")

_local_scratch: dict[str, str] = {}


def build_session(app: str = "tallyhouse", master: str | None = None, **extra: str) -> SparkSession:
    """Session with the settings above; on a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession, *, bloom_filters: bool = True) -> SparkSession:
    """Set the AQE and Bloom filter settings above on a session made elsewhere, keeping what its owner chose.

    A plan of many joins does without Bloom filters: every stage behind one carries its 4 MB, which
    the driver holds for all stages at once.
    """
    chosen = spark.sparkContext.getConf()
    enabled = {"spark.sql.optimizer.runtime.bloomFilter.enabled": str(bloom_filters).lower()}
    for key, value in (SETTINGS | enabled).items():
        if key.startswith(_OURS) and not chosen.contains(key):
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a local temporary one only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_scratch:
        folder = tempfile.mkdtemp(prefix="tallyhouse-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _local_scratch[app] = folder
    return _local_scratch[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
