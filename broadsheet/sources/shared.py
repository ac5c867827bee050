"""Tables that a query reads several times, written once to the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where that is unset, one of this machine for a local master, an error otherwise."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    spark.sparkContext.setCheckpointDir(f"/tmp/checkpoints/{uuid.uuid4().hex}")
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


def stored(df: DataFrame, what: str) -> DataFrame:
    """df written and read again: computed once however often it is used, and not again when an executor is lost."""
    path = fresh_path(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, size: int = 16 << 20) -> None:
    """Bound the bytes of an Arrow batch, unless the session already asks for less: pages and files may be of any size."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key, None) or ""
    if not now.isdigit() or not 0 < int(now) <= size:
        spark.conf.set(key, str(size))


def small_splits(spark: SparkSession, size: int = 16 << 20) -> None:
    """Bound the bytes of files that a task reads, unless the session already asks for less: what a task holds to add up its rows
    before the shuffle grows with what it reads."""
    key = "spark.sql.files.maxPartitionBytes"
    now = spark.conf.get(key)
    if int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(now)) > size:
        spark.conf.set(key, str(size))


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that no later plan reads."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
