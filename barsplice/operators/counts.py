"""Event counts of every variant, from canonical barcodes and classified junctions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import EVENTS, REF_TYPES


def pivot_canonical(canonical: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``var_id, canonical_inclusion, canonical_skipping``; rows without a variant are left out."""
    total = lambda kind: F.coalesce(F.sum(F.when(F.col("ref_type") == kind, F.col("count"))), F.lit(0)).cast("bigint")
    return canonical.where("var_id <> 'NA'").groupBy(*by, "var_id").agg(*(total(k).alias(c) for c, k in REF_TYPES.items()))


def pivot_events(junctions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``var_id`` and one column per event; a junction with several labels counts fully in each."""
    labels = junctions.select(*by, F.col("chrom").alias("var_id"), "coverage", F.explode(F.split("annotation", ";")).alias("event"))
    total = lambda e: F.coalesce(F.sum(F.when(F.col("event") == e, F.col("coverage"))), F.lit(0)).cast("bigint")
    return labels.where(F.col("event").isin(*EVENTS)).groupBy(*by, "var_id").agg(*(total(e).alias(e) for e in EVENTS))


def splicing_counts(variants: DataFrame, canonical: DataFrame, junctions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per distinct variant (and ``by``, such as the sample) with all counts, zero where nothing was seen."""
    keys = [*by, "var_id"]
    known = variants.select(*keys).distinct()
    joined = known.join(pivot_canonical(canonical, by), keys, "left").join(pivot_events(junctions, by), keys, "left")
    return joined.fillna(0, [*REF_TYPES, *EVENTS])


def with_totals(counts: DataFrame) -> DataFrame:
    """Inclusion, skipping and the sum of all other events, as the error model takes them."""
    others = sum(F.col(e) for e in EVENTS)
    return counts.select("*", F.col("canonical_inclusion").alias("inclusion"), F.col("canonical_skipping").alias("skipping"), others.alias("others"))
