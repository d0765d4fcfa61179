"""Variant and barcode association from read pairs and from long reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import sequence as S

MISMATCHES, BARCODE_MISMATCHES, LEAST_COVERAGE = 2, 1, 2


def first_reason(steps: Sequence[tuple[str, Column]]) -> Column:
    """Name of the first step whose condition holds; null if all pass."""
    out = F.lit(None).cast("string")
    for name, condition in reversed(steps):
        out = F.when(F.coalesce(condition, F.lit(False)), name).otherwise(out)
    return out


def step_statistics(rows: DataFrame, steps: Sequence[str]) -> DataFrame:
    """``(step, n)``: reads rejected at each step and accepted, in one aggregation; steps without reads are 0."""
    cells = [F.coalesce(F.sum(F.when(F.coalesce("reason", F.lit("accepted")) == s, F.col("count"))), F.lit(0)).cast("bigint").alias(s) for s in (*steps, "accepted")]
    names = [*steps, "accepted"]
    return rows.agg(*cells).unpivot([], names, "step", "n")


def top_by_barcode(rows: DataFrame, tie: Sequence[str]) -> DataFrame:
    """The most frequent row of each barcode; ties go to the smallest sequences."""
    order = Window.partitionBy("barcode_seq").orderBy(F.col("count").desc(), *tie)
    return rows.withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n")


PAIR_STEPS = ("variant_up", "variant_down", "barcode_up", "barcode_down", "variant_length", "barcode_template", "coverage")


def associate_pairs(
    pairs: DataFrame, variant_flanks: tuple[str, str], barcode_flanks: tuple[str, str], template: str, variant_length: int, least: int = LEAST_COVERAGE
) -> tuple[DataFrame, DataFrame]:
    """``(associations, rows with reasons)``: the variant from read 1, the barcode from read 2.

    Reads are counted by both sequences first, so checks run once for each distinct pair.
    """
    found = pairs.select(
        S.extract(F.col("s1"), F.lit(variant_flanks[0]), F.lit(variant_flanks[1]), MISMATCHES).alias("v"),
        S.extract(F.col("s2"), F.lit(barcode_flanks[0]), F.lit(barcode_flanks[1]), MISMATCHES).alias("b"),
    )
    counted = found.groupBy(
        F.col("v.value").alias("variant_seq"), F.col("v.status").alias("variant_status"), F.col("b.value").alias("raw_barcode"), F.col("b.status").alias("barcode_status")
    ).agg(F.count(F.lit(1)).alias("n"))
    checked = counted.withColumn("barcode_seq", S.check_barcode(F.col("raw_barcode"), F.lit(template.upper()), BARCODE_MISMATCHES))
    early = first_reason([
        ("variant_up", F.col("variant_status") == S.UP_MISSING),
        ("variant_down", F.col("variant_status") == S.DOWN_MISSING),
        ("barcode_up", F.col("barcode_status") == S.UP_MISSING),
        ("barcode_down", F.col("barcode_status") == S.DOWN_MISSING),
        ("variant_length", F.length("variant_seq") < variant_length),
        ("barcode_template", F.col("barcode_seq").isNull()),
    ])
    # Corrected barcodes may fall together.
    rows = checked.withColumn("early", early).groupBy("variant_seq", "barcode_seq", "early").agg(F.sum("n").alias("count"))
    rows = rows.withColumn("reason", F.coalesce("early", first_reason([("coverage", F.col("count") < least)]))).drop("early")
    best = top_by_barcode(rows.where("reason is null").select("barcode_seq", "variant_seq", "count"), ["variant_seq"])
    return best, rows


LONG_STEPS = ("barcode_up", "barcode_down", "barcode_template", "vhh_up", "vhh_down", "vhh_length", "target_up", "target_down", "target_length", "coverage")


def associate_long_reads(
    reads: DataFrame, barcode: tuple[str, str], vhh: tuple[str, str], target: tuple[str, str], template: str,
    vhh_lengths: Sequence[int], target_lengths: Sequence[int], least: int = LEAST_COVERAGE,
) -> tuple[DataFrame, DataFrame]:
    """``(associations, rows with reasons)`` of three fields of each read.

    A read that lacks at least two fields is taken as its reverse complement, all three
    fields anew.  Only sequences of the listed lengths stay.
    """
    parts = {"barcode": barcode, "vhh": vhh, "target": target}
    take = lambda c, p: S.extract(c, F.lit(p[0]), F.lit(p[1]), MISMATCHES)
    rows = reads.select("seq", *(take(F.col("seq"), p).alias(n) for n, p in parts.items()))
    missing = sum((F.col(f"{n}.status") != "ok").cast("int") for n in parts)
    rows = rows.withColumn("again", missing >= 2)
    turned = F.when(F.col("again"), S.revcomp(F.col("seq")))
    rows = rows.select("*", *(take(turned, p).alias(f"{n}_rc") for n, p in parts.items()))
    for n in parts:
        rows = rows.withColumn(n, F.when(F.col("again"), F.col(f"{n}_rc")).otherwise(F.col(n)))
    keys = [F.col(f"{n}.{f}").alias(f"{n}_{f}") for n in parts for f in ("value", "status")]
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    checked = counted.withColumn("barcode_seq", S.check_barcode(F.col("barcode_value"), F.lit(template.upper()), BARCODE_MISMATCHES))
    status = lambda n, s: F.col(f"{n}_status") == s
    early = first_reason([
        ("barcode_up", status("barcode", S.UP_MISSING)),
        ("barcode_down", status("barcode", S.DOWN_MISSING)),
        ("barcode_template", F.col("barcode_seq").isNull()),
        ("vhh_up", status("vhh", S.UP_MISSING)),
        ("vhh_down", status("vhh", S.DOWN_MISSING)),
        ("vhh_length", ~F.length("vhh_value").isin(*vhh_lengths)),
        ("target_up", status("target", S.UP_MISSING)),
        ("target_down", status("target", S.DOWN_MISSING)),
        ("target_length", ~F.length("target_value").isin(*target_lengths)),
    ])
    same = checked.withColumn("early", early).groupBy("barcode_seq", F.col("vhh_value").alias("vhh_seq"), F.col("target_value").alias("target_seq"), "early")
    rows = same.agg(F.sum("n").alias("count"))
    rows = rows.withColumn("reason", F.coalesce("early", first_reason([("coverage", F.col("count") < least)]))).drop("early")
    kept = rows.where("reason is null").select("barcode_seq", "vhh_seq", "target_seq", "count")
    return top_by_barcode(kept, ["vhh_seq", "target_seq"]), rows
