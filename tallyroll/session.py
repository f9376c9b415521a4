"""Session helpers: a local session for tests, and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every run of this package wants, whatever the cluster.
CORE_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A join may hash its smaller side instead of sorting both, once every partition of it is measured to fit.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # Recording a Python call site for every column slows plan building.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cpus: int | None = None, app: str = "tallyroll") -> SparkSession:
    """A session on this machine; on a cluster use spark-submit's own settings."""
    cpus = cpus or os.cpu_count() or 4
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in CORE_SETTINGS.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def check_settings(spark: SparkSession) -> None:
    """Refuses a session under which a bad cast would turn into NULL without a word."""
    if spark.conf.get("spark.sql.ansi.enabled") != "true":
        raise ValueError("set spark.sql.ansi.enabled to true")


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables that all executors reach.

    That is the one given to ``setCheckpointDir``, else the session's
    ``spark.checkpoint.dir``; a folder of our own only for local runs.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tallyroll-"))
        folder = context.getCheckpointDir()
    return folder


def new_folder(spark: SparkSession) -> str:
    """A new path in the shared folder; what is there goes when the application ends."""
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return path


@contextmanager
def written_once(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` computed now, as Parquet in the shared folder, and deleted after use.

    It survives lost executors, and each read takes only its own columns.
    """
    spark = df.sparkSession
    path = new_folder(spark)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)
