"""Splice junctions: extraction from alignments, clustering, merging and annotation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import connected_components


def coordinates(bed: DataFrame) -> DataFrame:
    """Donor and acceptor of BED12 junctions, from the first block's size and the second one's start."""
    size = F.get(F.split("blockSizes", ","), F.lit(0)).cast("int")
    second = F.get(F.split("blockStarts", ","), F.lit(1)).cast("int")
    return bed.withColumn("donor", F.col("start") + size).withColumn("acceptor", F.col("start") + second)


def introns(exons: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Introns between a variant's exons in order of their starts, numbered I1, I2, ..."""
    order = Window.partitionBy(*by, "var_id").orderBy("exon_start")
    rows = exons.withColumn("before", F.lag("exon_end").over(order)).where("before is not null")
    return rows.select(
        *by,
        "var_id",
        F.concat(F.lit("I"), F.row_number().over(order)).alias("intron_id"),
        (F.col("before") + 1).alias("intron_start"),
        (F.col("exon_start") - 1).alias("intron_end"),
    )


def cluster(junctions: DataFrame, tolerance: int = 2, by: Sequence[str] = ()) -> DataFrame:
    """Names each junction's cluster by its smallest (donor, acceptor).

    Junctions of one chromosome and strand (and ``by``) whose donors and acceptors both differ
    by at most ``tolerance`` are linked, and links chain.  Distinct positions meet in the
    cells of a grid, which is an equi-join; links become clusters by joins as well, so no
    group of positions has to fit in one task.
    """
    keys = [*by, "chrom", "strand"]
    cell = lambda c: F.floor(F.col(c) / (tolerance + 1)).cast("int")
    points = junctions.select(*keys, "donor", "acceptor").distinct()
    # A partner behind in order lies in the same or the next column of cells.
    around = F.array(*(F.struct((cell("donor") + x).alias("x"), (cell("acceptor") + y).alias("y")) for x in (0, 1) for y in (-1, 0, 1)))
    reach = points.select(*keys, "donor", "acceptor", F.explode(around).alias("at")).select("*", "at.x", "at.y").drop("at")
    own = points.select(*keys, F.col("donor").alias("d2"), F.col("acceptor").alias("a2"), cell("donor").alias("x"), cell("acceptor").alias("y"))
    near = (F.abs(F.col("d2") - F.col("donor")) <= tolerance) & (F.abs(F.col("a2") - F.col("acceptor")) <= tolerance)
    behind = (F.col("d2") > F.col("donor")) | (F.col("d2") == F.col("donor")) & (F.col("a2") > F.col("acceptor"))
    node = lambda d, a: F.struct(*keys, F.col(d).alias("donor"), F.col(a).alias("acceptor"))
    links = reach.join(own, [*keys, "x", "y"]).where(near & behind).select(node("donor", "acceptor").alias("a"), node("d2", "a2").alias("b"))
    found = connected_components(links).select("node.*", F.col("component.donor").alias("cluster_donor"), F.col("component.acceptor").alias("cluster_acceptor"))
    rows = junctions.join(found, [*keys, "donor", "acceptor"], "left")
    return rows.withColumns({f"cluster_{c}": F.coalesce(f"cluster_{c}", c) for c in ("donor", "acceptor")})


def merge(clustered: DataFrame, least_coverage: int = 2, by: Sequence[str] = ()) -> DataFrame:
    """One row per cluster: summed coverage and the position of its best covered junction.

    Ties go to the smallest donor, acceptor, start and name.  The threshold holds for the sum.
    """
    best = F.min_by(F.struct("start", "end", "name", "donor", "acceptor"), F.struct(-F.col("coverage"), "donor", "acceptor", "start", "name"))
    merged = clustered.groupBy(*by, "chrom", "strand", "cluster_donor", "cluster_acceptor").agg(best.alias("b"), F.sum("coverage").alias("coverage"))
    return merged.where(F.col("coverage") >= least_coverage).select(*by, "chrom", "b.start", "b.end", "b.name", "coverage", "strand", "b.donor", "b.acceptor")


def base_variant(chrom: Column, mutated: bool = False) -> Column:
    """The variant that positions refer to: for mutagenesis libraries, the part before ``/`` without its last token, as wild type."""
    if not mutated:
        return chrom
    return F.concat(F.regexp_replace(F.regexp_replace(chrom, "/.*$", ""), "_[^_]*$", ""), F.lit("_wt"))


def _spans(table: DataFrame, kind: str, by: Sequence[str]) -> DataFrame:
    rows = F.sort_array(F.collect_list(F.struct(F.col(f"{kind}_start").alias("start"), F.col(f"{kind}_end").alias("end"), F.col(f"{kind}_id").alias("id"))))
    return table.groupBy(*by, "var_id").agg(rows.alias(f"{kind}s"))


def annotation(donor: Column, acceptor: Column, exons: Column, introns_: Column, overlap: int = 2) -> Column:
    """Event labels of a junction from its variant's exons and introns, ``;``-joined."""
    inside = lambda x, s: (x > s["start"] + overlap) & (x < s["end"] - overlap)
    label = lambda cond, text, s: F.when(cond, F.concat(F.lit(text), s["id"]))
    of_exon = lambda s: F.array(
        label(inside(donor, s), "exon_splicing_3p_", s),
        label(inside(acceptor, s), "exon_splicing_5p_", s),
        label((donor < s["start"] + overlap) & (acceptor > s["end"] - overlap), "exon_skipping_", s),
    )
    of_intron = lambda s: F.array(label(inside(donor, s), "intron_retension_5p_", s), label(inside(acceptor, s), "intron_retension_3p_", s))
    labels = F.filter(F.flatten(F.concat(F.transform(exons, of_exon), F.transform(introns_, of_intron))), lambda x: x.isNotNull())
    # A junction along one whole intron retains the other one.
    numbered = F.transform(introns_, lambda s, i: F.struct(s["start"].alias("start"), s["end"].alias("end"), i.alias("at")))
    whole = F.filter(numbered, lambda s: (F.abs(donor - s["start"]) <= 2) & (F.abs(acceptor - s["end"]) <= 2))
    at = F.get(whole, F.lit(0))["at"]
    other = F.get(introns_, F.when(at == 0, F.lit(1)).otherwise(at - 1))["id"]
    outside = (donor < F.array_min(F.transform(exons, lambda s: s["start"]))) | (acceptor > F.array_max(F.transform(exons, lambda s: s["end"])))
    none = F.lit("no_annotation")
    return (
        F.when(F.coalesce(F.size(exons), F.lit(0)) <= 0, F.lit("exon_data_missing"))
        .when(F.coalesce(F.size(introns_), F.lit(0)) <= 0, F.lit("intron_data_missing"))
        .when(outside, F.lit("out_of_range"))
        .when(F.size(whole) > 0, F.coalesce(F.concat(F.lit("intron_retention_"), other), none))
        .when(F.size(labels) > 0, F.array_join(labels, ";"))
        .otherwise(none)
    )


def annotate(
    junctions: DataFrame, exons: DataFrame, overlap: int = 2, mutated: bool = False, keep_unlabelled: bool = False, by: Sequence[str] = ()
) -> DataFrame:
    """Adds ``annotation``; junctions that match nothing go, those out of range or without positions stay.

    ``by`` names columns (the sample) that junctions and exons share.
    """
    spans = _spans(exons, "exon", by).join(_spans(introns(exons, by), "intron", by), [*by, "var_id"], "left").withColumnRenamed("var_id", "__base")
    rows = junctions.withColumn("__base", base_variant(F.col("chrom"), mutated)).join(spans, [*by, "__base"], "left")
    labelled = rows.withColumn("annotation", annotation(F.col("donor"), F.col("acceptor"), F.col("exons"), F.col("introns"), overlap)).drop("__base", "exons", "introns")
    return labelled if keep_unlabelled else labelled.where("annotation <> 'no_annotation'")


def classify(
    bed: DataFrame, exons: DataFrame, tolerance: int = 2, overlap: int = 2, least_coverage: int = 2, mutated: bool = False,
    by: Sequence[str] = (), exons_by: Sequence[str] = (),
) -> DataFrame:
    """BED12 junctions to classified junctions, those of each ``by`` (such as the replicate) on their own; exons may differ by ``exons_by``."""
    merged = merge(cluster(coordinates(bed), tolerance, by), least_coverage, by)
    return annotate(merged, exons, overlap, mutated, by=exons_by)


def from_alignments(alignments: DataFrame, anchor: int = 5, least_intron: int = 20) -> DataFrame:
    """``chrom, strand, donor, acceptor, coverage`` of the gaps in spliced alignments, 0-based half-open.

    Both neighbouring matched runs must reach ``anchor`` bases somewhere among the reads; positions come from the
    CIGAR's running sums.
    """
    ops = F.transform(
        F.regexp_extract_all("cigar", F.lit(r"(\d+[MIDNSHP=X])"), F.lit(1)),
        lambda o: F.struct(F.regexp_extract(o, r"(\d+)", 1).cast("int").alias("n"), F.substring(o, -1, 1).alias("op")),
    )
    rows = alignments.withColumn("ops", ops).where(F.exists("ops", lambda o: o["op"] == "N"))
    along = lambda o: F.when(o["op"].isin("M", "D", "N", "=", "X"), o["n"]).otherwise(0)
    until = lambda i: F.aggregate(F.slice("ops", F.lit(1), i), F.lit(0), lambda acc, o: acc + along(o))
    is_match = lambda o: F.coalesce(o["op"].isin("M", "=", "X"), F.lit(False))
    gaps = F.filter(
        F.transform(
            "ops",
            lambda o, i: F.struct(
                (F.col("pos") + until(i)).alias("donor"), (F.col("pos") + until(i) + o["n"]).alias("acceptor"), o["op"].alias("op"), o["n"].alias("n"),
                F.when(is_match(F.get("ops", i - 1)), F.get("ops", i - 1)["n"]).otherwise(0).alias("left"),
                F.when(is_match(F.get("ops", i + 1)), F.get("ops", i + 1)["n"]).otherwise(0).alias("right"),
            ),
        ),
        lambda g: (g["op"] == "N") & (g["n"] >= least_intron),
    )
    strand = F.when(F.col("flag").bitwiseAND(16) != 0, "-").otherwise("+")
    found = rows.select(F.col("rname").alias("chrom"), strand.alias("strand"), F.explode(gaps).alias("g"))
    counted = found.groupBy("chrom", "strand", F.col("g.donor").alias("donor"), F.col("g.acceptor").alias("acceptor")).agg(
        F.count(F.lit(1)).alias("coverage"), F.max("g.left").alias("left"), F.max("g.right").alias("right")
    )
    return counted.where((F.col("left") >= anchor) & (F.col("right") >= anchor)).drop("left", "right")
