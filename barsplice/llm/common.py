"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import cut, shared_folder, table

__all__ = ["cut", "fold", "read", "shared_folder", "table"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id, folds: int = 5):
    """crc32 of the id as text, modulo the number of folds."""
    return F.crc32(doc_id.cast("string")) % folds
