"""Filters, pairing and statistics of alignment records."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits and sets of flags.
UNMAPPED, PROPER, REVERSE, FIRST, LAST, SECONDARY, SUPPLEMENTARY = 4, 2, 16, 64, 128, 256, 2048
SPLICED_SINGLE, SPLICED_PAIR = (0, 16), (99, 147, 83, 163)


def has(flag: Column, mask: int) -> Column:
    return flag.bitwiseAND(mask) != 0


def primary_mapped(df: DataFrame) -> DataFrame:
    f = F.col("flag")
    return df.where(~has(f, UNMAPPED) & ~has(f, SECONDARY) & ~has(f, SUPPLEMENTARY))


def unmapped(df: DataFrame) -> DataFrame:
    return df.where(has(F.col("flag"), UNMAPPED))


def proper_pairs(df: DataFrame) -> DataFrame:
    f = F.col("flag")
    return df.where(has(f, PROPER) & ~has(f, SECONDARY) & ~has(f, SUPPLEMENTARY))


def improper(df: DataFrame) -> DataFrame:
    return df.where(~has(F.col("flag"), PROPER))


def unique_spliced(df: DataFrame, paired: bool = False) -> DataFrame:
    """Reads placed once (hit count exactly 1) with the flags of a spliced alignment."""
    return df.where(F.col("flag").isin(*(SPLICED_PAIR if paired else SPLICED_SINGLE)) & (F.col("tags")["NH"] == "1"))


def with_end(df: DataFrame) -> DataFrame:
    """Adds ``pos_end``, the reference position behind the alignment."""
    consumed = F.transform(F.regexp_extract_all("cigar", F.lit(r"(\d+)[MDN=X]"), F.lit(1)), lambda n: n.cast("int"))
    return df.withColumn("pos_end", F.col("pos") + F.aggregate(consumed, F.lit(0), lambda a, n: a + n))


def pair_up(df: DataFrame) -> DataFrame:
    """``qname, first, second``: mates as structs; an error if a name does not have exactly one of each."""
    # Mates are brought together before they are sorted: an aggregate of structs would first sort each part of the input as a whole.
    rows = df.withColumn("__r", F.struct(*df.columns)).repartition("qname")
    side = lambda m: F.max(F.when(has(F.col("flag"), m), F.col("__r")))
    pairs = rows.groupBy("qname").agg(side(FIRST).alias("first"), side(LAST).alias("second"), F.count(F.lit(1)).alias("n"))
    whole = (F.col("n") == 2) & F.col("first").isNotNull() & F.col("second").isNotNull()
    checked = F.when(whole, F.col("qname")).otherwise(F.raise_error(F.concat(F.lit("not a pair: "), "qname")))
    return pairs.select(checked.alias("qname"), "first", "second")


def to_reads(df: DataFrame) -> DataFrame:
    """Reads as sequenced: reverse alignments are flipped back."""
    from ..functions.sequence import revcomp

    back = has(F.col("flag"), REVERSE)
    return df.select(F.col("qname").alias("header"), F.when(back, revcomp(F.col("seq"))).otherwise(F.col("seq")).alias("seq"), F.when(back, F.reverse("qual")).otherwise(F.col("qual")).alias("qual"))


def reference_counts(df: DataFrame) -> DataFrame:
    """Mapped reads of each reference."""
    return primary_mapped(df).groupBy("rname").agg(F.count(F.lit(1)).alias("mapped"))


def with_source(tables: dict[str, DataFrame], column: str = "source") -> DataFrame:
    """All rows of all tables with the name of theirs."""
    return functools.reduce(DataFrame.unionByName, (df.select(F.lit(name).alias(column), *df.columns) for name, df in tables.items()))


def add_statistics(*tables: DataFrame) -> DataFrame:
    """Sums of equally named values over several tables (name, value)."""
    every = tables[0]
    for t in tables[1:]:
        every = every.unionByName(t)
    return every.groupBy("name").agg(F.sum("value").alias("value"))


def exon_of_header(header: Column) -> Column:
    """The exon id behind ``||``; deletions of 21 bases share one id.  Null without one."""
    ident = F.when(F.contains(header, F.lit("||")), F.element_at(F.split(header, r"\|\|"), -1))
    x, y = (F.regexp_extract(ident, r"_del(\d+)to(\d+)", i).try_cast("int") for i in (1, 2))
    return F.when(y - x + 1 == 21, F.concat(F.regexp_replace(ident, r"_del\d+to\d+.*$", ""), F.lit("_del21nt"))).otherwise(ident)


def split_by_exon(reads: DataFrame, exons: DataFrame) -> DataFrame:
    """Reads of known exons with their ``exon_id``; write it with ``partitionBy('exon_id')``."""
    return reads.withColumn("exon_id", exon_of_header(F.col("header"))).join(exons.select("exon_id").distinct(), "exon_id", "left_semi")
