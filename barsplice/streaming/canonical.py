"""Canonical counting as reads arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import matching


def counts_stream(reads: DataFrame, barcodes: DataFrame, **layout: str) -> DataFrame:
    """Running counts of a read stream; counts add up, so the last state equals the batch result."""
    classified = matching.canonical_single(reads, barcodes, **layout)
    return matching.canonical_counts(classified, F.lit("reads"))


def start(reads: DataFrame, barcodes: DataFrame, name: str, checkpoint: str, **layout: str) -> StreamingQuery:
    """Counts into an in-memory table, complete after every trigger."""
    stream = counts_stream(reads, barcodes, **layout)
    return stream.writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", checkpoint).start()


_KEYS = ("read_ref", "var_id", "barcode", "ref_type")


def start_table(reads: DataFrame, barcodes: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, **layout: str) -> StreamingQuery:
    """Counts into a table in ``path``: each batch writes its own counts under its number, and nothing else.

    A batch that is run again, after a lost driver or by a restart, replaces what it wrote,
    so the sums never count a read twice.  No state is held between batches and nothing goes through the
    driver.  The last variants of the barcodes are found once, at the start.  One stream writes to one path; ``trigger`` is that of the writer, such as
    ``{"availableNow": True}``.  Read the sums with ``current``, fold old batches with ``compact``.
    """
    known = matching.known_barcodes(barcodes)

    def write(batch: DataFrame, number: int) -> None:
        classified = matching.classified_single(batch, known, **layout)
        matching.canonical_counts(classified, F.lit("reads")).write.mode("overwrite").parquet(f"{path}/batches/batch={number}")

    stream = reads.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return (stream.trigger(**trigger) if trigger else stream).start()


def _finished(spark: SparkSession, folder: str, prefix: str) -> list[int]:
    """Numbers of the parts whose write was committed."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found = jvm.org.apache.hadoop.fs.Path(f"{folder}/{prefix}*/_SUCCESS")
    names = [f.getPath().getParent().getName() for f in found.getFileSystem(conf).globStatus(found) or []]
    return sorted(int(n[len(prefix) :]) for n in names)


def _parts(spark: SparkSession, path: str) -> list[str]:
    """Folders that together hold every committed batch once."""
    totals = _finished(spark, f"{path}/totals", "through=")
    through = totals[-1] if totals else -1
    batches = [n for n in _finished(spark, f"{path}/batches", "batch=") if n > through]
    return [f"{path}/totals/through={through}"] * bool(totals) + [f"{path}/batches/batch={n}" for n in batches]


def current(spark: SparkSession, path: str) -> DataFrame:
    """Sums of all committed batches, as ``counts_stream`` has them at the same point; empty before the first."""
    folders = _parts(spark, path)
    if not folders:
        return spark.createDataFrame([], "read_ref string, var_id string, barcode string, ref_type string, count bigint")
    return spark.read.parquet(*folders).groupBy(*_KEYS).agg(F.sum("count").alias("count"))


def compact(spark: SparkSession, path: str) -> int:
    """Write the sums of all but the last committed batch as one part that readers take from then on; its number, -1 if there is none.

    The last batch stays apart because only it can be run again.  Folded folders
    stay where they are, for readers that have begun; they may be deleted at any later time.
    """
    totals = _finished(spark, f"{path}/totals", "through=")
    through = totals[-1] if totals else -1
    folded = [n for n in _finished(spark, f"{path}/batches", "batch=") if n > through][:-1]
    if not folded:
        return through
    folders = [f"{path}/totals/through={through}"] * bool(totals) + [f"{path}/batches/batch={n}" for n in folded]
    sums = spark.read.parquet(*folders).groupBy(*_KEYS).agg(F.sum("count").alias("count"))
    sums.write.mode("overwrite").parquet(f"{path}/totals/through={folded[-1]}")
    return folded[-1]
