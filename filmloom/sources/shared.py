"""The folder that driver and executors share, and what the library leaves there."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir as the cluster names it, else the context's checkpoint folder.

    Where neither is set, a local master gets a temporary folder; a cluster must name one.
    """
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not found:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="filmloom-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(found)
    return found


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def kept(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read back: what was dealt or numbered once stays so, whatever is lost later."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Delete the intermediate tables that this driver wrote; call it when no result that reads them is needed any more."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    while _written:
        path = hadoop(_written.pop())
        n += path.getFileSystem(conf).delete(path, True)
    return n
