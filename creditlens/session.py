"""Spark session helpers.

The library never creates a session on its own inside an operator; callers
pass one in.  ``get_spark`` is for tests, the bench and ad-hoc use.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "creditlens") -> SparkSession:
    """A session for tests, the bench and ad-hoc use.

    Under ``spark-submit`` (or when a session is active) the submitted master
    and shuffle partitions stay; without either a local master with 8 shuffle
    partitions is used.
    """
    given = SparkSession.getActiveSession() is not None or "SPARK_ENV_LOADED" in os.environ
    master = master or os.environ.get("CREDITLENS_MASTER") or (None if given else "local[8]")
    parts = shuffle_partitions or os.environ.get("CREDITLENS_SHUFFLE_PARTITIONS") or (None if given else 8)
    builder = SparkSession.builder if master is None else SparkSession.builder.master(master)
    if parts:
        builder = builder.config("spark.sql.shuffle.partitions", str(parts))
    builder = (
        builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("CREDITLENS_DRIVER_MEMORY", "16g"))
    )
    if master and master.startswith("local"):
        # one executor: waiting for a "more local" slot only idles cores
        builder = builder.config("spark.locality.wait", "0s")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared file system folder and is read
    as is.  Only when it is unset (local tests) a scratch folder is created.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not path and sc.getCheckpointDir():
        path = sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder on shared storage "
                               "(a machine-local folder does not survive executor loss)")
        path = tempfile.mkdtemp(prefix="creditlens-ckpt-")  # local mode only (tests, bench)
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def ship(spark: SparkSession) -> None:
    """Send this package's sources to the executors' Python workers, once per Spark context."""
    sc = spark.sparkContext
    if getattr(sc, "_creditlens_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="creditlens-src-"), "creditlens_src.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    sc._creditlens_shipped = True
