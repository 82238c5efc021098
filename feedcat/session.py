"""Session helpers: one place for the configs the operators assume."""
from __future__ import annotations

import os
import re

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",  # a checkpoint goes when its DataFrame does
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}
# Local runs only: the driver JVM is the whole cluster.
LOCAL_CONF = {
    "spark.driver.memory": os.environ.get("FEEDCAT_DRIVER_MEMORY", "12g"),
}


def get_spark(app: str = "feedcat", master: str | None = None,
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library relies on.

    On a cluster the master, memory and shuffle width come from the launcher;
    locally we default to ``local[*]`` and a shuffle width near the core count.
    """
    b = SparkSession.builder.appName(app)
    if master or not os.environ.get("SPARK_MASTER"):
        b = b.master(master or "local[*]")
        for k, v in LOCAL_CONF.items():
            b = b.config(k, v)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables that the driver and every executor see.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset, a folder in the session's
    warehouse is taken and named in the setting; a warehouse on the driver's own disk serves a local master only.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_intermediate"
        if d.startswith(("file:", "/")) and not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master")):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share; {d} is the driver's own")
        spark.conf.set("spark.checkpoint.dir", d)
    return d.rstrip("/")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder, also set as the checkpoint folder of the Spark context."""
    d = shared_dir(spark)
    try:
        spark.sparkContext.setCheckpointDir(d)
    except Exception:  # noqa: BLE001 - no SparkContext handle (e.g. Spark Connect): the conf is enough
        pass
    return d


def materialize(df):
    """Cut lineage at a pipeline stage boundary: a reliable checkpoint written under the
    shared ``spark.checkpoint.dir`` (never a machine-local temporary folder)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def versions(spark: SparkSession, table_dir: str) -> list[int]:
    """Version numbers of the ``v=N`` folders under ``table_dir``, through Hadoop's file system."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table_dir)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(path)]
    return sorted(int(n[2:]) for n in names if n.startswith("v="))
