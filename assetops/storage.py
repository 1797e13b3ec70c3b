"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

LOCAL_FOLDER = "/tmp/checkpoints"  # only where the session runs in one process and names no folder

_written: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``.  A session in
    a single process that names none uses ``LOCAL_FOLDER``; on a cluster a
    missing setting is an error."""
    context = spark.sparkContext
    folder = (
        spark.conf.get("spark.checkpoint.dir", None)
        or context.getConf().get("spark.checkpoint.dir")
        or context.getCheckpointDir()
    )
    if folder is not None:
        return folder
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return LOCAL_FOLDER


def run_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder of this run in the shared folder."""
    folder = f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
    _written.append(folder)
    return folder


def cut(df: DataFrame, codec: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later passes scan
    the columns they need instead of repeating the scans below, also after
    executors are lost, and the optimizer knows the real size.  The folder
    stays until ``release``."""
    folder = run_folder(df.sparkSession, "cut")
    writer = df.write if codec is None else df.write.option("compression", codec)
    writer.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def release(spark: SparkSession) -> int:
    """Delete every folder this process has written by ``run_folder`` and
    ``cut``; frames that read them must not be used afterwards."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    count = len(_written)
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(conf).delete(path, True)
    return count
