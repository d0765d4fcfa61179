"""Catalogue queries on alignment: reads and pairs to exon references, spliced reads to genes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import aligning as A
from ..operators import alignments as L
from .catalog import query
from .tables import table

_placed = lambda df: df.select("qname", "flag", "rname", "pos", "cigar", F.col("tags")["AS"].cast("int").alias("score"), F.col("tags")["NM"].cast("int").alias("differences"))

#: Where reads were taken from.  Within the first or the last exon both products fit; the inclusion's name is first.
_PLANTED = """
    SELECT concat('r', cast(k as string), '_', cast(n as string)) AS qname, CASE WHEN kind = 'random' THEN 4 WHEN n % 2 = 0 THEN 16 ELSE 0 END AS flag,
           CASE WHEN kind = 'random' THEN '*' WHEN kind = 'skipping' AND place > 14 THEN concat('exon_skipping_', gene) ELSE concat('exon_inclusion_', gene) END AS rname,
           CASE WHEN kind = 'random' THEN -1 ELSE place END AS pos, CASE WHEN kind = 'random' THEN '*' ELSE '50M' END AS cigar,
           CASE WHEN kind <> 'random' THEN CASE WHEN seq = truth THEN 50 ELSE 45 END END AS score, CASE WHEN kind <> 'random' THEN CASE WHEN seq = truth THEN 0 ELSE 1 END END AS differences
    FROM {plain_exon_reads}"""


@query(_PLANTED)
def align_exon_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads of all genes against the products of all genes."""
    return _placed(A.align_single(table(spark, sf_dir, "exon_reads"), table(spark, sf_dir, "exon_references").select("rname", "seq")))


@query("""
    SELECT concat('r', cast(k as string), '_', cast(n as string)) AS qname, CASE WHEN n % 2 = 0 THEN 16 ELSE 0 END AS flag, gene AS rname, place + CASE kind WHEN 'second' THEN 132 ELSE 0 END AS pos,
           CASE kind WHEN 'whole' THEN '60M' ELSE concat(cast(64 - place as string), 'M', CASE kind WHEN 'skipping' THEN '200' ELSE '68' END, 'N', cast(place - 4 as string), 'M') END AS cigar,
           CASE kind WHEN 'whole' THEN 60 ELSE 56 END AS score, 0 AS differences
    FROM {plain_gene_reads}""")
def align_spliced_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads against the unspliced sequence of the gene that each belongs to."""
    found = A.align_single(table(spark, sf_dir, "gene_reads"), table(spark, sf_dir, "minigenes"), ["gene"], A.SPLICED)
    return _placed(found)


@query("""
    SELECT rname, flag, count(*) AS records FROM (
        SELECT concat(CASE WHEN o_orderkey % 3 = 0 THEN 'exon_skipping_' ELSE 'exon_inclusion_' END, gene) AS rname, unnest([99, 147]) AS flag
        FROM {orders} JOIN {supplier} ON s_suppkey = o_custkey % 10 + 1 JOIN {genes} ON gene = concat('g', cast(s_suppkey as string))) q GROUP BY 1, 2""")
def align_exon_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of proper pairs by reference and flag."""
    found = A.align_pairs(table(spark, sf_dir, "exon_pairs"), table(spark, sf_dir, "exon_references"), ["gene"])
    return L.proper_pairs(found).groupBy("rname", "flag").agg(F.count(F.lit(1)).alias("records"))
