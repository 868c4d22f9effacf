"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app_name: str = "pulsegrid", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the library is written for.

    Dotted Spark keys go in ``settings`` through dict expansion and win over the defaults.
    """
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Window state outgrows the heap at scale, so it lives in RocksDB with changelog checkpoints.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> None:
    """Event times are UTC; a session in another zone would shift epoch values and printed bounds."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


@lru_cache(maxsize=1)
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="pulsegrid-")


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder for streaming progress, landed results or models.

    The cluster names its shared folder in ``spark.checkpoint.dir``. Only a local session may go without.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
        root = _local_root()
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
