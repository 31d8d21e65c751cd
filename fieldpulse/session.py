"""Spark session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Skewed join partitions (one hot device) are split at run time; small ones are merged.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # INT96, the default, carries no min/max statistics, so time filters could not skip row groups.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Streaming dedup state lives on executor disks, and checkpoints ship only what changed.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app_name: str = "fieldpulse", master: str | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder: on a cluster, other
    machines could not read it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        root = tempfile.mkdtemp(prefix="fieldpulse-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


# For frames that are cached: partitions as AQE finds fit, and columns as they are. Trying the encodings of a column on rows that
# are read a few times takes longer than making the rows, for a fifth less memory.
CACHE_SETTINGS = {
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
    "spark.sql.inMemoryColumnarStorage.compressed": "false",
}


def cached(rows: DataFrame) -> DataFrame:
    """Rows cached, at once, in as many partitions as AQE finds fit. By default a cached plan that ends in a shuffle keeps one per shuffle partition,
    and each shuffle that starts from the rows then opens a file per pair of partitions. Blocks of a lost executor are computed again."""
    conf = rows.sparkSession.conf
    before = {name: conf.get(name) for name in CACHE_SETTINGS}
    for name, value in CACHE_SETTINGS.items():
        conf.set(name, value)  # one is read when the plan is cached, the other when its rows are
    try:
        kept = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            kept.count()
        except BaseException:
            kept.unpersist()
            raise
        return kept
    finally:
        for name, value in before.items():
            conf.set(name, value)
