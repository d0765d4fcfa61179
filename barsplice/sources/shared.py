"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder.  A temporary one is made only for a local master; elsewhere a missing one is an error."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="spark-")
        sc.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Materialise a small frame in the shared folder and cut its lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def new_folder(spark: SparkSession) -> str:
    """A name in the shared folder that nothing has yet."""
    return f"{shared_folder(spark).rstrip('/')}/barsplice-{uuid.uuid4().hex}"


def table(df: DataFrame) -> DataFrame:
    """Materialise a large frame as compressed Parquet in the shared folder and reread it."""
    path = new_folder(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
