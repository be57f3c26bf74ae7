"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

UTC_SETTING = ("spark.sql.session.timeZone", "UTC")


def local_session(cores: int | str = "*", app: str = "fleetpulse", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config(*UTC_SETTING)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.memory", "8g")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        .getOrCreate()
    )


def use_utc(spark: SparkSession) -> SparkSession:
    """Epoch-to-wall-clock text and date parts are defined in UTC."""
    if spark.conf.get(UTC_SETTING[0]) != UTC_SETTING[1]:
        spark.conf.set(*UTC_SETTING)
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    A machine-local folder is used only on a local master whose checkpoint
    folder is unset.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="fleetpulse-")
    return f"{root.rstrip('/')}/fleetpulse/{label}-{uuid.uuid4().hex}"
