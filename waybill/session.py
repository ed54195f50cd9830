"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# State on disk: its changes are written per micro-batch, and its rows are not counted, for which
# each write would read first.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def build(app: str = "waybill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the streaming jobs need.

    Shuffle partitions are left to the cluster; adaptive execution coalesces
    them and splits skewed join partitions.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **STATE,
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return use_utc(builder.getOrCreate())


def use_utc(spark: SparkSession) -> SparkSession:
    """Instants are rendered in the session zone, so every job runs in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def use_rocksdb(spark: SparkSession) -> SparkSession:
    """Keep streaming state on disk; ``transformWithState`` needs this store."""
    for key, value in STATE.items():
        spark.conf.set(key, value)
    return spark


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder named by ``spark.checkpoint.dir``.

    Executors must be able to read what other executors wrote, so a machine's own
    temporary folder is taken only for a local master.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        checkpoint = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = checkpoint.get() if checkpoint.isDefined() else None
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="waybill-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
