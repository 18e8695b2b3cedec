"""Session defaults and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "schedlytics", cores: str | int = "*", shuffle_partitions: int | None = None) -> SparkSession:
    """A local session for tests and benches; on a cluster pass your own session instead.

    Adaptive execution stays on: it coalesces small shuffle partitions, splits
    skewed join partitions and turns joins into broadcasts only when the
    measured size of a side is under the threshold.
    """
    builder = (
        SparkSession.builder.appName(app)
        .master(f"local[{cores}]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    Only a local master may fall back to a machine-local folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/schedlytics-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before writing stages on a cluster")
    return tempfile.mkdtemp(prefix="schedlytics-")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``checkpoint()`` usable without overriding the cluster's folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or work_dir(spark))
