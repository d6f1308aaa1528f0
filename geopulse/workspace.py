"""Where intermediate tables go: the shared folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The shared scratch root; a local folder is made only for a ``local`` master."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(root)
    return root


def run_root(spark: SparkSession) -> str:
    """The folder of this application under the shared root; it owns everything written to scratch."""
    return f"{shared_root(spark)}/geopulse-{spark.sparkContext.applicationId}"


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in this application's folder, never reused between runs."""
    return f"{run_root(spark)}/{name}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Delete all that this application wrote to scratch; frames that were not written elsewhere are gone with it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(run_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write once and read back, so later branches share the result and survive lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
