"""Canonical and novel classification of reads by their barcodes."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import sequence as S
from ..sources import shared

#: Mismatches in flanks and in a barcode's fixed bases, and the shortest spliced gap.
FLANK, BARCODE, SPLICED = 2, 1, 20
PAIR_GAP = "NNNN"


def _value(x: Column | str) -> Column:
    return F.lit(x) if isinstance(x, str) else x


def last_by_barcode(barcodes: DataFrame, order: str = "line", by: Sequence[str] = ()) -> DataFrame:
    """One row per barcode (and ``by``, such as the sample): that of the last line."""
    keys, keep = [*by, "barcode"], [c for c in barcodes.columns if c not in ("barcode", order, *by)]
    # The largest number of a key is hashed; texts in an aggregate would sort all lines first, so only the last ones go there.
    most = barcodes.groupBy(*keys).agg(F.max(order).alias("__most"))
    most = most.select(*(F.col(k).alias(f"__{k}") for k in keys), "__most")
    same = functools.reduce(Column.__and__, [*(F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys), F.col(order).eqNullSafe(F.col("__most"))])
    last = barcodes.join(most, same).groupBy(*keys).agg(F.max_by(F.struct(*keep), F.col(order)).alias("v"))
    return last.select(*keys, "v.*")


def known_barcodes(barcodes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The last variant of each barcode and its exon, written once to the shared folder.

    Its size is known then, so Spark sends small maps to the reads; large ones are joined by a shuffle of both.
    """
    return shared.table(last_by_barcode(barcodes, by=by).select(*by, "barcode", "var_id", S.upper_only(F.col("variant")).alias("__exon")))


def with_barcode(
    reads: DataFrame, up: Column | str, down: Column | str, template: Column | str, seq: Column | str = "seq", retry: bool = True, correct: bool = True
) -> DataFrame:
    """Adds ``barcode`` (null if none fits), ``oriented`` and whether the read was ``flipped``.

    With ``retry`` a read without both flanks is tried as its reverse complement.
    ``correct`` stores the barcode with the template's bases, else as read.  Flanks and
    template may be columns, so that every sample brings its own.
    """
    read = F.col(seq) if isinstance(seq, str) else seq
    up, down, template = map(_value, (up, down, template))
    found = reads.withColumn("__b", S.find_barcode(read, up, down, template, FLANK, BARCODE, retry)).withColumn("flipped", F.col("__b.flipped"))
    found = found.withColumn("oriented", F.when(F.col("flipped"), S.revcomp(read)).otherwise(read))
    return found.withColumn("barcode", F.col("__b.barcode" if correct else "__b.raw")).drop("__b")


def _status(rows: DataFrame, read: Column, before: Column, exon: Column, after: Column, most: int, edits: bool) -> DataFrame:
    """Adds ``status``; the read is searched for its variant's inclusion, then for skipping."""
    known = F.col("barcode").isNotNull() & F.col("var_id").isNotNull()
    rows = rows.withColumn("__event", S.first_of(F.when(known, read), [F.concat(before, exon, after), F.concat(before, after)], most, edits))
    status = (
        F.when(F.col("barcode").isNull(), "no_barcode")
        .when(F.col("var_id").isNull(), "no_variant")
        .when(F.col("__event") == 0, "exon_inclusion")
        .when(F.col("__event") == 1, "exon_skipping")
        .otherwise("leftover")
    )
    return rows.withColumn("status", status).drop("__event", "__exon")


def canonical_single(
    reads: DataFrame, barcodes: DataFrame, before: Column | str, after: Column | str, up: Column | str, down: Column | str,
    template: Column | str, middle: Column | str | None = None, by: Sequence[str] = (),
) -> DataFrame:
    """Single-end reads with ``status``: no_barcode, no_variant, exon_inclusion, exon_skipping or leftover.

    The exon is ``middle`` for intron libraries, else the variant's upper-case bases.  A
    leftover read that holds the exon before gets ``cut``, the place where it starts.
    Columns named by ``by`` (the sample) belong to the barcode's key; the layout may be
    columns of the reads.
    """
    return classified_single(reads, known_barcodes(barcodes, by), before, after, up, down, template, middle, by)


def classified_single(
    reads: DataFrame, known: DataFrame, before: Column | str, after: Column | str, up: Column | str, down: Column | str,
    template: Column | str, middle: Column | str | None = None, by: Sequence[str] = (),
) -> DataFrame:
    """``canonical_single`` with ``known_barcodes``, for several sets of reads."""
    before, after = _value(before), _value(after)
    rows = with_barcode(reads, up, down, template).join(known, [*by, "barcode"], "left")
    rows = _status(rows, F.col("oriented"), before, F.col("__exon") if middle is None else _value(middle), after, FLANK, False)
    return rows.withColumn("cut", S.locate(F.when(F.col("status") == "leftover", F.col("oriented")), before, FLANK))


def canonical_pairs(
    pairs: DataFrame, barcodes: DataFrame, before: Column | str, after: Column | str, up: Column | str, down: Column | str,
    template: Column | str, middle: Column | str | None = None, by: Sequence[str] = (),
) -> DataFrame:
    """Read pairs with ``status`` as for single reads; the barcode lies in read 2.

    Events are searched in read 1 followed by read 2 as turned for its barcode, within four
    times as many edits as a single read may have mismatches.  ``cut`` is the place of the
    exon before in read 1 of a leftover pair.
    """
    before, after = _value(before), _value(after)
    rows = with_barcode(pairs, up, down, template, seq="s2").join(known_barcodes(barcodes, by), [*by, "barcode"], "left")
    both = F.concat("s1", "oriented")
    rows = _status(rows, both, before, F.col("__exon") if middle is None else _value(middle), after, 4 * FLANK, True)
    return rows.withColumn("cut", S.locate(F.when(F.col("status") == "leftover", F.col("s1")), before, FLANK))


def canonical_counts(classified: DataFrame, read_ref: Column, by: Sequence[str] = ()) -> DataFrame:
    """Reads by reference, variant, barcode and event."""
    hits = classified.where(F.col("status").isin("exon_inclusion", "exon_skipping"))
    return hits.groupBy(*by, read_ref.alias("read_ref"), "var_id", "barcode", F.col("status").alias("ref_type")).agg(F.count(F.lit(1)).alias("count"))


def unknown_counts(classified: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Reads without a barcode and with a barcode of no variant."""
    count = lambda s: F.count(F.when(F.col("status") == s, 1))
    return classified.groupBy(*by).agg(count("no_barcode").alias("reads_without_barcodes"), count("no_variant").alias("reads_without_variants"))


def event_totals(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Always two rows (for each ``by``): inclusion and skipping."""
    total = lambda k: F.coalesce(F.sum(F.when(F.col("ref_type") == k, F.col("count"))), F.lit(0)).cast("bigint")
    one = counts.groupBy(*by).agg(*(total(k).alias(k) for k in ("exon_inclusion", "exon_skipping")))
    return one.unpivot(list(by), ["exon_inclusion", "exon_skipping"], "event", "total")


def _cut(c: Column | str) -> Column:
    return F.when(F.col("cut") >= 0, F.substring(c, F.col("cut") + 1, F.length(c))).otherwise(c)


def _named(header: str) -> Column:
    return F.when(F.col("cut") >= 0, F.concat_ws("||", header, "var_id")).otherwise(F.col(header))


def leftovers(classified: DataFrame, follow_orientation: bool = False, by: Sequence[str] = ()) -> DataFrame:
    """Unexplained reads for the spliced aligner: cut at the exon before, their header naming the variant.

    The cut is found on the oriented read but applied to the read as stored; set
    ``follow_orientation`` to cut the oriented one.
    """
    rows = classified.where("status = 'leftover'")
    seq = F.col("oriented") if follow_orientation else F.col("seq")
    qual = F.when(F.col("flipped") & F.lit(follow_orientation), F.reverse("qual")).otherwise(F.col("qual"))
    return rows.select(*by, _named("header").alias("header"), _cut(seq).alias("seq"), _cut(qual).alias("qual"))


def pair_leftovers(classified: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Unexplained pairs: read 1 cut and named like a single read, read 2 as stored."""
    rows = classified.where("status = 'leftover'")
    return rows.select(*by, _named("h1").alias("h1"), _cut(F.col("s1")).alias("s1"), _cut(F.col("q1")).alias("q1"), "h2", "s2", "q2")


def exon_spans(exons: DataFrame) -> DataFrame:
    """``var_id, first_end, one, two``: where the first exon ends and the lengths of the first two, exons in order of their starts."""
    rows = F.sort_array(F.collect_list(F.struct(F.col("exon_start").alias("start"), F.col("exon_end").alias("end"))))
    size = lambda i: F.get("e", F.lit(i))["end"] - F.get("e", F.lit(i))["start"] + 1
    return exons.groupBy("var_id").agg(rows.alias("e")).select("var_id", F.get("e", F.lit(0))["end"].alias("first_end"), size(0).alias("one"), size(1).alias("two"))


def _spanning(rows: DataFrame, exons: DataFrame, rname: Column, begin: Column, end: Column, clip: int) -> DataFrame:
    """Adds ``ref_type`` and ``read_ref`` from names like exon_inclusion_x, and ``spans``: both outer exons entered by more than ``clip`` bases."""
    words = F.split(rname, "_", 3)
    rows = rows.withColumn("ref_type", F.concat_ws("_", F.get(words, F.lit(0)), F.get(words, F.lit(1)))).withColumn("read_ref", F.get(words, F.lit(2)))
    rows = rows.join(exon_spans(exons).withColumnRenamed("var_id", "read_ref"), "read_ref", "left")
    inside = F.col("one") + F.when(F.col("ref_type") == "exon_inclusion", F.col("two")).otherwise(0)
    return rows.withColumn("spans", F.coalesce((F.col("first_end") - begin > clip) & (end - inside > clip), F.lit(False))).drop("first_end", "one", "two")


def aligned_single(alignments: DataFrame, exons: DataFrame, up: Column | str, down: Column | str, template: Column | str, clip: int = 5, spanning: bool = False) -> DataFrame:
    """Reads aligned to exon references with ``spans`` (else mapped wrongly) and ``kept`` (and a barcode that fits its template, taken as read).

    ``exons`` are positions by ``var_id``, the reference's name behind its kind.  With
    ``spanning`` only rows that span come back, and no barcodes are searched in others.
    """
    rows = _spanning(alignments, exons, F.col("rname"), F.col("pos"), F.col("pos_end"), clip)
    rows = rows.where("spans") if spanning else rows
    rows = with_barcode(rows, up, down, template, retry=False, correct=False)
    return rows.withColumn("kept", F.col("spans") & F.col("barcode").isNotNull()).drop("oriented", "flipped")


def aligned_pairs(pairs: DataFrame, exons: DataFrame, up: Column | str, down: Column | str, template: Column | str, clip: int = 5, spanning: bool = False) -> DataFrame:
    """Mates (structs ``first`` and ``second``) with ``spans`` and ``kept``, as ``aligned_single``; the barcode lies in read 2 turned back."""
    first, second = F.col("first"), F.col("second")
    rows = _spanning(pairs, exons, first["rname"], first["pos"], second["pos_end"], clip)
    rows = rows.withColumn("spans", F.col("spans") & F.coalesce(proper_pair(first, second, clip), F.lit(False)))
    rows = rows.where("spans") if spanning else rows
    rows = with_barcode(rows, up, down, template, seq=S.revcomp(second["seq"]), retry=False, correct=False)
    return rows.withColumn("kept", F.col("spans") & F.col("barcode").isNotNull()).drop("oriented", "flipped")


def aligned_counts(filtered: DataFrame, barcodes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Reads by reference, variant, barcode and event of aligned reads; a barcode listed for several variants counts for each."""
    reads = filtered.where("kept").groupBy(*by, "read_ref", "barcode", "ref_type").agg(F.count(F.lit(1)).alias("count"))
    # Every line of a barcode counts. Both sides hold their keys once, so the joined rows are the groups and no task has to hold them.
    known = barcodes.groupBy(*by, "barcode", "var_id").agg(F.count(F.lit(1)).alias("__lines"))
    rows = reads.join(known, [*by, "barcode"], "left").withColumn("count", F.col("count") * F.coalesce("__lines", F.lit(1)))
    return rows.select(*by, "read_ref", "var_id", "barcode", "ref_type", "count")


def proper_pair(first: Column, second: Column, clip: int = 5) -> Column:
    """Mates on one reference, clipped little where they face each other, in order and not overlapping."""
    return (
        (first["rname"] == second["rname"])
        & (S.softclips(first["cigar"])["last"] <= clip)
        & (S.softclips(second["cigar"])["first"] <= clip)
        & (second["pos"] >= first["pos_end"])
    )


def has_gap(cigar: Column, least: int = SPLICED) -> Column:
    return F.exists(S.cigar_ops(cigar), lambda o: (o["op"] == "N") & (o["n"] >= least))


def spliced_product(seq: Column, down_at: Column, barcode: Column, gap: Column, first: Column | None = None) -> Column:
    """The read up to its barcode, counted back from the leftmost downstream flank, behind the first mate if there is one.

    ``unavail`` without a barcode, without a gap, or if nothing lies before the barcode.
    The upstream flank belongs to the product.
    """
    behind = down_at - F.length(barcode)
    product = F.substring(seq, F.lit(1), behind)
    whole = product if first is None else F.concat(first, F.lit(PAIR_GAP), product)
    return F.when((down_at >= 0) & (behind > 0) & gap, whole).otherwise("unavail")


def _rescued(rows: DataFrame, barcodes: DataFrame, seq: Column, up, down, template, by: Sequence[str]) -> DataFrame:
    """Adds barcode, variant and ``__down``, the leftmost downstream flank in the whole read, which is taken as stored."""
    known = last_by_barcode(barcodes, by=by).select(*by, "barcode", "var_id")
    found = with_barcode(rows, up, down, template, seq=seq, retry=False)
    found = found.withColumn("__down", S.locate(F.when(F.col("barcode").isNotNull(), seq), _value(down), FLANK)).drop("oriented", "flipped")
    return found.join(known, [*by, "barcode"], "left")


def novel_single(alignments: DataFrame, barcodes: DataFrame, up: Column | str, down: Column | str, template: Column | str, by: Sequence[str] = ()) -> DataFrame:
    """Spliced alignments with the barcode and variant of their read, taken as stored; ``rname`` becomes the variant for known ones."""
    rows = _rescued(alignments, barcodes, F.col("seq"), up, down, template, by)
    product = spliced_product(F.col("seq"), F.col("__down"), F.col("barcode"), has_gap(F.col("cigar")))
    return rows.withColumn("spliced_sequence", product).withColumn("read_ref", F.col("rname")).withColumn("rname", F.coalesce("var_id", "rname")).drop("__down")


def novel_pairs(pairs: DataFrame, barcodes: DataFrame, up: Column | str, down: Column | str, template: Column | str, by: Sequence[str] = ()) -> DataFrame:
    """Mates (structs ``first`` and ``second``) with the barcode and variant of read 2; both take the variant's name as ``rname``."""
    first, second = F.col("first"), F.col("second")
    rows = _rescued(pairs, barcodes, second["seq"], up, down, template, by)
    gap = has_gap(first["cigar"]) | has_gap(second["cigar"])
    rows = rows.withColumn("spliced_sequence", spliced_product(second["seq"], F.col("__down"), F.col("barcode"), gap, first["seq"]))
    rows = rows.withColumn("read_ref", first["rname"])
    for mate in ("first", "second"):
        rows = rows.withColumn(mate, F.col(mate).withField("rname", F.coalesce(F.col("var_id"), F.col(f"{mate}.rname"))))
    return rows.drop("__down")


def novel_counts(rescued: DataFrame, products: bool = False, by: Sequence[str] = ()) -> DataFrame:
    """Reads by reference, variant and barcode (null variants are a group), with the spliced sequence if asked for."""
    keys = [*by, "read_ref", "var_id", "barcode", *(["spliced_sequence"] if products else [])]
    return rescued.where("barcode is not null").groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def contigs(reference: DataFrame, barcodes: DataFrame, default: int = 1000) -> DataFrame:
    """Header lines of rewritten alignments: references, and other variants as long as the reference named before their ``/``."""
    own = reference.select(F.col("id").alias("name"), F.length("seq").alias("length"))
    variants = barcodes.select(F.col("var_id").alias("name"), F.regexp_replace("var_id", "/.*$", "").alias("base")).distinct().join(own.select("name"), "name", "left_anti")
    sized = variants.join(own.withColumnRenamed("name", "base"), "base", "left")
    return own.unionByName(sized.select("name", F.coalesce("length", F.lit(default)).alias("length"))).distinct()
