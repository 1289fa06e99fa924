"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume (UTC, AQE, Arrow)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    }
    for name, value in {**defaults, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` or the
    session's checkpoint dir. Only a local master may fall back to /tmp."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="millrace-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh path for one run under the shared folder."""
    return f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}"


def plan_size(df: DataFrame) -> int:
    """Catalyst's size estimate in bytes; no job is run."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
