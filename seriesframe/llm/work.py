"""Tables written between jobs, in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def root(spark: SparkSession) -> str:
    """`spark.checkpoint.dir` of the session. Only a local session may leave it unset: it gets a folder of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _own.setdefault(context.applicationId, tempfile.mkdtemp(prefix="seriesframe-llm-"))


def fresh(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; its files go when the session's JVM ends."""
    path = f"{root(spark)}/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: later jobs neither repeat nor lose its work."""
    spark = df.sparkSession
    path = fresh(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
