"""Session settings the package relies on."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", app: str = "plantwatch") -> SparkSession:
    """A session for tests and the benchmark; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> SparkSession:
    """Zone-free times are UTC, so casts to and from zoned timestamps must use UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="plantwatch-")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """New folder under the cluster's checkpoint folder; a local one only where none is named."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return os.path.join(root or _local_root(), purpose, uuid.uuid4().hex)
