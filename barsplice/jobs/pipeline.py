"""The whole job: from the reads of all samples and replicates to counts, corrected PSI and report tables.

Samples are rows.  Each brings its flanks, template and reference exons as columns, joined
by ``sample_id``; samples without a configuration drop out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import sequence as S
from ..operators import aligning, alignments, counts, fragments, junctions, matching, psi, report
from ..sources import shared

BY = ["sample_id"]


def layouts(sheet: DataFrame, references: DataFrame) -> DataFrame:
    """One row per ``sample_id``: flanks and template of the sheet, exons of the reference (``sample_id, seq``)."""
    exons = references.select("sample_id", S.reference_exons(F.col("seq")).alias("e"))
    flanks = [F.col("barcode_up").alias("up"), F.col("barcode_down").alias("down"), F.col("barcode_temp").alias("template")]
    return sheet.select("sample_id", *flanks).join(exons.select("sample_id", "e.*"), "sample_id")


_LAYOUT = ("before", "after", "up", "down", "template")


def _classified(match, reads: DataFrame, layout: DataFrame, barcodes: DataFrame, intron_library: bool) -> DataFrame:
    rows = reads.join(layout, "sample_id")
    return match(rows, barcodes, **{c: F.col(c) for c in _LAYOUT}, middle=F.col("middle") if intron_library else None, by=BY)


def reads_step(pairs: DataFrame, cut_mean_quality: int = 20, min_overlap: int = 10, min_overlap_outie: int = 20, max_overlap: int = 250, max_mismatch_density: float = 0.25) -> dict[str, DataFrame]:
    """From raw pairs of all samples (``sample_id, h1, s1, q1, h2, s2, q2``) to merged reads and pairs left apart.

    ``trimming`` and ``merging`` count them by sample.  All four are plans over the raw pairs;
    a caller that uses several writes the first two.
    """
    trimmed = fragments.trim_pairs(pairs, cut_mean_quality)
    merged = fragments.merge_pairs(fragments.passed(trimmed), min_overlap, min_overlap_outie, max_overlap, max_mismatch_density)
    return {
        "reads": fragments.extended(merged),
        "pairs": fragments.not_combined(merged),
        "trimming": fragments.trim_counts(trimmed, BY),
        "merging": fragments.merge_counts(merged, BY),
    }


def canonical_step(layout: DataFrame, barcodes: DataFrame, reads: DataFrame, pairs: DataFrame | None = None, intron_library: bool = False) -> dict[str, DataFrame]:
    """Canonical barcodes, unknown reads, totals and leftovers of all samples; merged reads and pairs count together."""
    single = _classified(matching.canonical_single, reads, layout, barcodes, intron_library)
    found = matching.canonical_counts(single, F.col("var_id"), BY)
    unknown = matching.unknown_counts(single, BY)
    out = {"leftovers": matching.leftovers(single, by=BY)}
    if pairs is not None:
        double = _classified(matching.canonical_pairs, pairs, layout, barcodes, intron_library)
        found = found.unionByName(matching.canonical_counts(double, F.col("var_id"), BY))
        both = unknown.unionByName(matching.unknown_counts(double, BY))
        unknown = both.groupBy(*BY).agg(*(F.sum(c).alias(c) for c in unknown.columns if c not in BY))
        out["pair_leftovers"] = matching.pair_leftovers(double, BY)
    return out | {"canonical": found, "unknown": unknown, "totals": matching.event_totals(found, BY)}


def aligned_step(layout: DataFrame, products: DataFrame, exons: DataFrame, barcodes: DataFrame, reads: DataFrame, clip: int = 5) -> dict[str, DataFrame]:
    """Canonical barcodes by alignment to the exon references of each sample (``sample_id, rname, seq``), and the reads that fit none.

    ``records`` are all alignment records.  Both results are plans over them.
    """
    records = aligning.align_single(reads, products, BY)
    mapped = alignments.with_end(alignments.primary_mapped(records)).join(layout.select("sample_id", "up", "down", "template"), "sample_id")
    filtered = matching.aligned_single(mapped, exons, F.col("up"), F.col("down"), F.col("template"), clip, spanning=True)
    rest = alignments.unmapped(records).select(*BY, F.col("qname").alias("header"), "seq", "qual")
    return {"records": records, "canonical": matching.aligned_counts(filtered, barcodes, BY), "leftovers": rest}


def spliced_step(genes: DataFrame, leftovers: DataFrame, per_exon: bool = False) -> DataFrame:
    """Spliced alignments, placed once, of leftovers on the unspliced sequences of their sample (``sample_id, rname, seq``).

    With ``per_exon`` a read is aligned only to the sequences of the exon that its header
    names (column ``exon_id`` of ``genes``), as for libraries of many variants.
    """
    by = BY
    if per_exon:
        leftovers, by = alignments.split_by_exon(leftovers, genes), [*BY, "exon_id"]
    return alignments.unique_spliced(aligning.align_single(leftovers, genes, by, aligning.SPLICED))


def novel_step(layout: DataFrame, barcodes: DataFrame, alignments: DataFrame, products: bool = False) -> dict[str, DataFrame]:
    """Barcodes and junctions of spliced alignments, renamed to the variants of their barcodes."""
    rows = alignments.join(layout, "sample_id")
    named = matching.novel_single(rows, barcodes, F.col("up"), F.col("down"), F.col("template"), BY)
    return {"novel": matching.novel_counts(named, products, BY), "renamed": named}


def counts_step(sheet: DataFrame, variants: DataFrame, canonical: DataFrame, bed: DataFrame, exons: DataFrame, tolerance: int = 2, overlap: int = 2, least_coverage: int = 2) -> DataFrame:
    """Event counts of every variant in every replicate, with ``sample`` and ``rep`` of the sheet.

    ``variants``, ``canonical``, ``bed`` and ``exons`` carry ``sample_id``.
    """
    found = junctions.classify(bed, exons, tolerance, overlap, least_coverage, by=BY, exons_by=BY)
    table = counts.splicing_counts(variants, canonical, found, BY)
    names = sheet.select("sample_id", "sample", F.col("replicate").alias("rep"))
    return counts.with_totals(table).join(names, "sample_id")


def psi_step(table: DataFrame, replicates: int = 3, mode: str = "can", variances: dict | None = None) -> DataFrame:
    """Corrected PSI of every sample that has exactly so many replicates.

    The error model is fitted for all samples together unless ``variances`` gives its
    variances by sample and replicate.  A fit reads the counts many times, so they are
    written once before it; everything else is one plan over all samples.
    """
    if variances is None:
        table = shared.table(table.select("sample", "var_id", "rep", "inclusion", "skipping", "others"))
    runs = sorted(tuple(r) for r in table.select("sample", "rep").distinct().collect())
    whole = {s: sorted(r for t, r in runs if t == s) for s, _ in runs}
    whole = {s: reps for s, reps in whole.items() if len(reps) == replicates}
    if not whole:
        raise ValueError(f"no sample has {replicates} replicates")
    if variances is None:
        variances = psi.fit_all(table, whole, mode=mode)
    kept = table.where(F.col("sample").isin(*whole)).select("sample", "var_id", "rep", "inclusion", "skipping", "others")
    return psi.estimates(kept, {k: v for k, v in variances.items() if k[0] in whole}, mode, by=["sample"])


def corrected_psi(canonical: DataFrame, bed: DataFrame, variants: DataFrame, exons: DataFrame, mode: str = "can", tolerance: int = 2, overlap: int = 2, least_coverage: int = 2) -> DataFrame:
    """Corrected PSI of one sample from its replicates (column ``rep`` in ``canonical`` and ``bed``)."""
    reps = canonical.select("rep").distinct()
    found = junctions.classify(bed, exons, tolerance, overlap, least_coverage, by=["rep"])
    table = counts.with_totals(counts.splicing_counts(variants.crossJoin(F.broadcast(reps)), canonical, found, ["rep"]))
    names = sorted(r[0] for r in reps.collect())
    return psi.round_all(psi.corrected_psi(table.select("var_id", "rep", "inclusion", "skipping", "others"), names, mode))


def junction_report(classified: DataFrame, replicates: list[str]) -> dict[str, DataFrame]:
    """The report's junction tables by name; ``classified`` has a column ``rep``."""
    category = report.junctions_category(classified, replicates)
    return {
        "category": category,
        "venn": report.venn(classified, ["chrom", "donor", "acceptor"], "rep", replicates),
        "events": report.event_summary(category),
        "coverage": report.coverage_ranges(category),
    }
