"""Session helpers: a local session for tests and the shared scratch folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

_CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "tidemark") -> SparkSession:
    """A local session configured like the tests and the bench expect.

    ``spark.checkpoint.dir`` is left as configured; when it is unset,
    ``checkpoint_root`` creates a local folder (local masters only).
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        # streaming state (open windows) off the JVM heap, spills to disk
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared file system folder and is read
    from the session; a cluster session without it is an error (a machine-
    local folder would not survive the loss of that machine). Only a local
    session (``local[...]`` master, as in tests) gets a folder created.
    """
    sc = spark.sparkContext
    root = spark.conf.get(_CHECKPOINT_CONF, None) or sc.getConf().get(_CHECKPOINT_CONF, None)
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, S3, ...)")
        root = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        sc.setCheckpointDir(root)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root for one run of ``name``."""
    return f"{checkpoint_root(spark)}/tidemark/{name}/{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per Spark context: what runs in Python workers
    is found there by module name, whether or not the executors have the package installed."""
    context = spark.sparkContext
    if getattr(context, "_tidemark_shipped", False):
        return
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="tidemark-")  # Spark serves the file from here
    context.addPyFile(shutil.make_archive(f"{folder}/tidemark-code", "zip", package.parent, package.name))
    context._tidemark_shipped = True
