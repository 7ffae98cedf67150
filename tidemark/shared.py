"""Shared scratch storage: folders, and what all drivers can see of them."""

from __future__ import annotations

import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``, or else the one
    set with ``SparkContext.setCheckpointDir``.

    Only a local session without either falls back to a new temporary folder; on
    a cluster such a folder would exist on one machine only.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
        return context.getCheckpointDir().rstrip("/")
    raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")


def now() -> int:
    """Seconds since 1970 by the driver's clock."""
    return int(time.time())


def new_folder(spark: SparkSession, label: str) -> str:
    """A folder that nobody else uses; its name tells when it was begun."""
    return f"{shared_folder(spark)}/{label}-{now():08x}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as one of its own."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of what is in a folder; none if there is no such folder."""
    folders, path = file_system(spark, folder)
    return [found.getPath().getName() for found in folders.listStatus(path)] if folders.exists(path) else []


def staged(df: DataFrame) -> DataFrame:
    """Write the rows once as parquet in the shared folder and read them back.

    Cuts the lineage like a checkpoint, survives executor loss, and keeps
    column pruning and filter pushdown for the readers.
    """
    spark = df.sparkSession
    path = new_folder(spark, "staged")
    df.write.parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)
