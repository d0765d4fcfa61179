"""From raw read pairs to merged reads: trimming, filtering and merging by overlap.

Pairs are rows ``h1, s1, q1, h2, s2, q2`` with any other columns, such as ``sample_id``.
Nothing is shuffled but the counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import overlap as O

PASSED, TOO_SHORT, LOW_QUALITY, TOO_MANY_N = "passed", "too_short", "low_quality", "too_many_n"
#: Qualities below this character (15) are poor.
_POOR = "".join(chr(33 + q) for q in range(15))


def _status(seq: Column, qual: Column, least_length: int, most_n: int, poor_percent: int) -> Column:
    poor = F.length(qual) - F.length(F.translate(qual, _POOR, ""))
    unknown = F.length(seq) - F.length(F.translate(seq, "N", ""))
    return (
        F.when(100 * poor > poor_percent * F.length(qual), LOW_QUALITY)
        .when(unknown > most_n, TOO_MANY_N)
        .when(F.length(seq) < least_length, TOO_SHORT)
        .otherwise(PASSED)
    )


def trim_pairs(
    pairs: DataFrame, cut_mean_quality: int = 20, window: int = 4, least_overlap: int = 30, most_wrong: int = 5, wrong_percent: int = 20, least_length: int = 15, most_n: int = 5, poor_percent: int = 40
) -> DataFrame:
    """The same pairs with bad tails and adapters cut, and a ``status``.

    Tails are cut by sliding mean quality, adapters where both mates overlap past each other's
    beginnings.  A pair that has lost too much or is too poor keeps its trimmed reads and
    gets the first read's reason, or the second one's.  A null read or quality is a null status.
    """
    lengths = O.kept_lengths(F.col("s1"), F.col("q1"), F.col("s2"), F.col("q2"), window, cut_mean_quality, least_overlap, most_wrong, wrong_percent / 100)
    rows = pairs.withColumn("__kept", lengths)
    cuts = {f"{c}{i}": F.substring(F.col(f"{c}{i}"), F.lit(1), F.col(f"__kept.n{i}")) for c in "sq" for i in (1, 2)}
    rows = rows.withColumns(cuts).drop("__kept")
    one, two = (_status(F.col(f"s{i}"), F.col(f"q{i}"), least_length, most_n, poor_percent) for i in (1, 2))
    known = F.col("s1").isNotNull() & F.col("q1").isNotNull() & F.col("s2").isNotNull() & F.col("q2").isNotNull()
    return rows.withColumn("status", F.when(known, F.when(one != PASSED, one).otherwise(two)))


def passed(trimmed: DataFrame) -> DataFrame:
    return trimmed.where(F.col("status") == PASSED).drop("status")


def trim_counts(trimmed: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Reads (two a pair) by status."""
    return trimmed.groupBy(*by, "status").agg((2 * F.count(F.lit(1))).alias("reads"))


def merge_pairs(pairs: DataFrame, min_overlap: int = 10, min_overlap_outie: int = 20, max_overlap: int = 250, max_mismatch_density: float = 0.25) -> DataFrame:
    """The same pairs with ``merged`` (seq, qual, offset, overlap, mismatches), null for pairs that do not overlap.

    Of all offsets with enough compared places that one is taken whose differences a place
    (at most ``max_overlap`` places count) are fewest.
    """
    m = O.merged(F.col("s1"), F.col("q1"), F.col("s2"), F.col("q2"), min_overlap, min_overlap_outie, max_overlap, max_mismatch_density)
    return pairs.withColumn("merged", m).withColumn("merged", F.when(F.col("merged.overlap").isNotNull(), F.col("merged")))


def extended(merged: DataFrame) -> DataFrame:
    """``header, seq, qual`` of merged pairs under the first read's header, with the other columns."""
    other = [c for c in merged.columns if c not in ("h1", "s1", "q1", "h2", "s2", "q2", "merged")]
    return merged.where(F.col("merged").isNotNull()).select(*other, F.col("h1").alias("header"), "merged.seq", "merged.qual")


def not_combined(merged: DataFrame) -> DataFrame:
    return merged.where(F.col("merged").isNull()).drop("merged")


def merge_counts(merged: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Combined and uncombined pairs, of which those that run past each other (``outies``)."""
    count = lambda c: F.count(F.when(c, 1))
    there = F.col("merged").isNotNull()
    return merged.groupBy(*by).agg(count(there).alias("combined"), count(~there).alias("uncombined"), count(F.col("merged.offset") < 0).alias("outies"))
