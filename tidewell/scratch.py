"""Intermediate tables in a folder that all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where that is unset, a temporary folder in local mode and the (shared) warehouse on a cluster."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        return "file://" + tempfile.gettempdir() + "/tidewell-scratch"
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below :func:`scratch_root`, removed when the driver's Python ends."""
    path = f"{scratch_root(spark)}/tidewell/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"

    def remove() -> None:
        try:
            jvm = spark.sparkContext._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # the JVM may be gone already; the folder is scratch space
            pass

    atexit.register(remove)
    return path


def stash(df: DataFrame, label: str, codec: str = "lz4_raw", files: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared scratch folder and read it back: cuts lineage, survives lost executors.

    The codec runs on the JVM's heap.  ``files`` bounds the files (and the tasks of the last stage) of a table that is small
    beside the input, but never below the cores there are; callers derive it from their rows, so that a task's share doesn't
    grow with the data.  Without it there is a file for each partition.
    """
    path = scratch_path(df.sparkSession, label)
    if files:
        df = df.coalesce(max(files, df.sparkSession.sparkContext.defaultParallelism))
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
