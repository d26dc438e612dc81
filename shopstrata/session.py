"""Session settings and the shared folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(cores: int | str = 8, app: str = "shopstrata", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        # Wide rows make generated methods that the JVM would otherwise leave uncompiled.
        .config("spark.driver.extraJavaOptions", "-XX:-DontCompileHugeMethods")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder. Only a local session without one gets a folder of its own, deleted at its end."""
    folder = spark.conf.get(_CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_DIR} to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="shopstrata-", dir="/tmp")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.conf.set(_CHECKPOINT_DIR, folder)
    return folder
