"""Domain operators on hand cases."""

import itertools
import math
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from barsplice.functions import sequence
from barsplice.jobs import pipeline, tables
from barsplice.operators import alignments, association, idmap, junctions, matching, psi, report
from barsplice.streaming import canonical

EXONS = [("v", "E1", 1, 20), ("v", "E2", 101, 150), ("v", "E3", 301, 400)]
ANNOTATED = [
    (20, 101, "intron_retention_I2"),
    (150, 300, "intron_retention_I1"),
    (20, 300, "exon_skipping_E2"),
    (10, 100, "exon_splicing_3p_E1"),
    (20, 120, "exon_splicing_5p_E2"),
    (120, 300, "exon_splicing_3p_E2"),
    (60, 300, "exon_skipping_E2;intron_retension_5p_I1"),
    (2, 399, "exon_skipping_E1;exon_skipping_E2;exon_skipping_E3"),
    (18, 100, "no_annotation"),
    (0, 100, "out_of_range"),
    (20, 401, "out_of_range"),
]


@pytest.fixture(scope="module")
def exons(spark):
    return spark.createDataFrame(EXONS, "var_id string, exon_id string, exon_start int, exon_end int")


def test_annotation(spark, exons):
    rows = spark.createDataFrame([("v", d, a, w) for d, a, w in ANNOTATED] + [("x", 1, 2, "exon_data_missing")], "chrom string, donor int, acceptor int, want string")
    got = junctions.annotate(rows, exons, keep_unlabelled=True).collect()
    assert len(got) == len(ANNOTATED) + 1 and [(r.donor, r.acceptor) for r in got if r.annotation != r.want] == []
    assert junctions.annotate(rows, exons).count() == len(ANNOTATED)


def test_single_exon_has_no_introns(spark):
    one = spark.createDataFrame(EXONS[:1], "var_id string, exon_id string, exon_start int, exon_end int")
    rows = spark.createDataFrame([("v", 5, 10)], "chrom string, donor int, acceptor int")
    assert junctions.annotate(rows, one).first().annotation == "intron_data_missing"


@pytest.mark.parametrize(("points", "n"), [([(0, 0), (2, 2), (4, 4)], 1), ([(0, 0), (2, 10), (4, 0)], 3), ([(0, 0), (3, 0)], 2)])
def test_cluster(spark, points, n):
    rows = spark.createDataFrame([("c", "+", d, a) for d, a in points], "chrom string, strand string, donor int, acceptor int")
    assert junctions.cluster(rows).select("cluster_donor", "cluster_acceptor").distinct().count() == n


def test_merge_conserves_coverage(spark):
    rng = random.Random(5)
    rows = [("c", d, d + 5, f"n{i}", rng.randint(1, 9), "+", d, a) for i, (d, a) in enumerate((rng.randint(0, 60), rng.randint(100, 160)) for _ in range(200))]
    frame = spark.createDataFrame(rows, "chrom string, start int, end int, name string, coverage long, strand string, donor int, acceptor int")
    merged = junctions.merge(junctions.cluster(frame), 0)
    assert merged.agg(F.sum("coverage")).first()[0] == sum(r[4] for r in rows)


COUNTS = {"v1": [(90, 10, 0), (80, 20, 5), (85, 15, 0)], "v2": [(5, 95, 0), (10, 90, 10), (0, 0, 3)], "v3": [(29, 71, 0), (30, 70, 0), (50, 50, 0)]}
EXPECTED = {
    "can": {"v1": (1.680304, 0.029460, 0.842945, 0.993022, 0.840990, 0.791096, 0.880764), "v2": (-2.409579, 0.074525, 0.082445, 0.982535, 0.085105, 0.052122, 0.135967), "v3": (-0.545546, 0.018334, 0.366898, 0.995646, 0.367020, 0.308049, 0.430261)},
    "all": {"v1": (1.564253, 0.027690, 0.826963, 0.993220, 0.824969, 0.773196, 0.866958), "v2": (-2.462213, 0.072286, 0.078550, 0.982491, 0.081098, 0.049961, 0.129005), "v3": (-0.545546, 0.018334, 0.366898, 0.995500, 0.366966, 0.308007, 0.430194)},
}


@pytest.fixture(scope="module")
def replicate_counts(spark):
    rows = [(v, f"r{i}", *c) for v, cs in COUNTS.items() for i, c in enumerate(cs, 1)]
    return spark.createDataFrame(rows, "var_id string, rep string, inclusion long, skipping long, others long")


@pytest.mark.parametrize("mode", ["can", "all"])
def test_psi(replicate_counts, mode):
    got = {r.var_id: r for r in psi.estimates(replicate_counts, {"r1": 0.01, "r2": 0.01, "r3": 0.01}, mode).collect()}
    for v, want in EXPECTED[mode].items():
        r = got[v]
        have = (r.theta, r.var_theta, r.psi_est, r.shrinkage, r.psi_shrunk, r.psi_shrunk_lwr, r.psi_shrunk_upr)
        assert all(abs(a - b) < 2e-6 for a, b in zip(have, want, strict=True))
    assert got["v1"].ratio2 == "76:19:4" or got["v1"].ratio2 == "76:19:5"
    assert got["v3"].ratio1 == "28:71:0" or got["v3"].ratio1 == "28:71:1" or got["v3"].ratio1.startswith("28:71")


def test_fit_reaches_a_minimum(spark, replicate_counts):
    import numpy as np

    objective = lambda p: ((p - [1.0, -2.0]) ** 2 * [1, 10]).sum(1) + ((p - [1.0, -2.0]) ** 4).sum(1)
    found = psi.minimise(lambda points: {k: objective(p) for k, p in points.items()}, {"a": np.array([4.0, 4.0]), "b": np.array([-1.0, 0.5])})
    assert set(found) == {"a", "b"} and all(np.allclose(x, [1, -2], atol=1e-3) for x in found.values())
    fitted = psi.fit_variances(replicate_counts, ["r1", "r2", "r3"])
    assert set(fitted) == {"r1", "r2", "r3"} and all(v >= 0 for v in fitted.values())


UP, DOWN, BEFORE, AFTER = "GCAGTCCATGAC", "CTACGGTTAGCA", "TTGACCGATC", "GGATCATTCG"


def test_canonical_classes_partition_reads(spark):
    exon, barcode = "ACGTACCAGT", "CCCCATGGGGGG"
    tail = UP + barcode + DOWN
    reads = {
        "exon_inclusion": BEFORE + exon + AFTER + tail,
        "exon_skipping": BEFORE + AFTER + "TTTTTTTTTT" + tail,
        "leftover": "AA" + BEFORE + "TTTTTTTTTTTTTTTTT" + tail,
        "no_barcode": BEFORE + exon + AFTER,
        "no_variant": BEFORE + exon + AFTER + UP + "AAAAATAAAAAA" + DOWN,
    }
    flip = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    rows = [(k, s, "F" * len(s)) for k, s in reads.items()] + [("exon_inclusion", flip(reads["exon_inclusion"]), "F" * len(reads["exon_inclusion"]))]
    frame = spark.createDataFrame(rows, "header string, seq string, qual string")
    known = spark.createDataFrame([(barcode, "tt", "old", 1, 1), (barcode, "aa" + exon + "cc", "v1", 1, 2)], "barcode string, variant string, var_id string, count long, line long")
    got = matching.canonical_single(frame, known, BEFORE, AFTER, UP, DOWN, "NNNNATNNNNNN")
    assert all(r.status == r.header for r in got.collect()) and got.count() == len(rows)
    left = matching.leftovers(got).first()
    assert left.header == "leftover||v1" and left.seq.startswith(BEFORE)
    assert matching.canonical_counts(got, F.lit("x")).agg(F.sum("count")).first()[0] == 3


FLIP = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def test_pairs_are_searched_as_turned(spark):
    """The same pair has the same event whichever way its second read is stored; only read 1 of a leftover is cut."""
    before, after = BEFORE + "AAGGCTAAGG", AFTER + "CCTAAGCCTA"
    exon, barcode, tail = "ACGTACCAGT", "CCCCATGGGGGG", UP + "CCCCATGGGGGG" + DOWN
    reads = {"exon_inclusion": (before + exon[:5], exon[5:] + after + tail), "leftover": ("AA" + before + "TTTTTTTTTTTTTTTTTTTTTTTTT", "TTTTTTTTTTTTTTTTTTT" + tail), "no_barcode": (before, after)}
    rows = [(k, a, "F" * len(a), k, s, "F" * len(s)) for k, (a, b) in reads.items() for s in (b, FLIP(b))]
    frame = spark.createDataFrame(rows, "h1 string, s1 string, q1 string, h2 string, s2 string, q2 string")
    known = spark.createDataFrame([(barcode, "aa" + exon + "cc", "v1", 1, 2)], "barcode string, variant string, var_id string, count long, line long")
    got = matching.canonical_pairs(frame, known, before, after, UP, DOWN, "NNNNATNNNNNN")
    assert [(r.h1, r.status) for r in got.collect() if r.h1 != r.status] == []
    left = matching.pair_leftovers(got).collect()
    assert len(left) == 2 and all((r.h1, r.s1[:10], len(r.q1), r.h2) == ("leftover||v1", BEFORE, len(r.s1), "leftover") for r in left)
    assert sorted(r.s2 for r in left) == sorted((reads["leftover"][1], FLIP(reads["leftover"][1])))


def test_spliced_products(spark):
    """Counted back from the leftmost downstream flank in the whole read, by the barcode's length; nothing before it is unavail."""
    barcode, tail = "CCCCATGGGGGG", UP + "CCCCATGGGGGG" + DOWN
    cases = [("ACGTACGT" + tail, "5M20N5M", "ACGTACGT" + UP), ("ACGT" + tail, "5M19N5M", "unavail"), (DOWN + tail, "5M20N5M", "unavail"), ("ACG" + DOWN + tail, "5M20N5M", "unavail"), ("AACCGGTTAACCGGTT" + DOWN + tail, "5M20N5M", "AACC"), ("ACGT", "5M20N5M", "unavail")]
    known = spark.createDataFrame([(barcode, "A", "v1", 1, 2)], "barcode string, variant string, var_id string, count long, line long")
    frame = spark.createDataFrame(cases, "seq string, cigar string, want string").withColumn("rname", F.lit("ref"))
    got = matching.novel_single(frame, known, UP, DOWN, "NNNNATNNNNNN").collect()
    assert [(r.seq, r.spliced_sequence, r.want) for r in got if r.spliced_sequence != r.want] == []
    assert {(r.read_ref, r.rname) for r in got} == {("ref", "v1"), ("ref", "ref")}
    mate = "struct<rname:string,cigar:string,seq:string>"
    pairs = spark.createDataFrame([(("ref", "9M30N9M", "GGG"), ("ref", "20M", "ACGTACGT" + tail)), (("ref", "9M", "GGG"), ("ref", "20M", "ACGTACGT" + tail))], f"first {mate}, second {mate}")
    both = matching.novel_pairs(pairs, known, UP, DOWN, "NNNNATNNNNNN").collect()
    assert [(r.spliced_sequence, r.first.rname, r.second.rname, r.read_ref) for r in both] == [("GGGNNNNACGTACGT" + UP, "v1", "v1", "ref"), ("unavail", "v1", "v1", "ref")]


def test_aligned_barcodes_are_not_turned(spark):
    exons = spark.createDataFrame([("x", "E1", 1, 15), ("x", "E2", 101, 112), ("x", "E3", 201, 260)], "var_id string, exon_id string, exon_start int, exon_end int")
    tail = UP + "CCCCATGGGGGG" + DOWN
    frame = spark.createDataFrame([("exon_inclusion_x", 2, 40, tail, True), ("exon_inclusion_x", 2, 40, FLIP(tail), False), ("exon_inclusion_x", 12, 40, tail, False), ("exon_skipping_x", 2, 21, tail, True), ("exon_inclusion_x", 2, 30, tail, False), ("exon_inclusion_y", 2, 90, tail, False)], "rname string, pos int, pos_end int, seq string, want boolean")
    got = matching.aligned_single(frame, exons, UP, DOWN, "NNNNATNNNNNN").collect()
    assert [r for r in got if r.kept != r.want] == []


def test_edit_windows(spark):
    rng = random.Random(4)

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    rows = [("".join(rng.choice("ACG") for _ in range(rng.randint(0, 30))), "".join(rng.choice("ACG") for _ in range(rng.randint(1, 12)))) for _ in range(150)]
    frame = spark.createDataFrame(rows, "s string, p string")
    for k in (0, 2, 4):
        got = frame.select("s", "p", sequence.locate_near(F.col("s"), F.col("p"), k, "levenshtein").alias("at")).collect()
        assert all(r["at"] == next((i for i in range(len(r.s) - len(r.p) + 1) if edits(r.s[i : i + len(r.p)], r.p) <= k), -1) for r in got)
    with pytest.raises(ValueError, match="unknown distance"):
        sequence.locate_near(F.col("s"), F.col("p"), 1, "cosine")


def test_natural_order_and_bins(spark):
    names = ["r10", "r2", "a1b3", "a1b20", "r1"]
    frame = spark.createDataFrame([(n,) for n in names], "name string")
    assert [r.name for r in frame.orderBy(report.natural_key(F.col("name"))).collect()] == ["a1b3", "a1b20", "r1", "r2", "r10"]
    bins = report.histogram(spark.createDataFrame([(0,), (5,), (6,), (10,), (None,)], "v int"), "v", [0, 5, 10, 15])
    assert {tuple(r) for r in bins.collect()} == {(0.0, 5.0, 2, 1.0), (5.0, 10.0, 2, 1.0)}


def test_psi_by_sample(spark, replicate_counts):
    """Two samples at once give what each gives on its own."""
    both = replicate_counts.withColumn("sample", F.explode(F.array(F.lit("a"), F.lit("b")))).withColumn("inclusion", F.col("inclusion") + F.when(F.col("sample") == "b", 7).otherwise(0))
    fixed = {(s, f"r{i}"): 0.01 for s in "ab" for i in (1, 2, 3)}
    got = {(r.sample, r.var_id): r.psi_shrunk for r in psi.estimates(both, fixed, by=["sample"]).collect()}
    for s in "ab":
        alone = psi.estimates(both.where(F.col("sample") == s).drop("sample"), {f"r{i}": 0.01 for i in (1, 2, 3)})
        assert all(abs(got[s, r.var_id] - r.psi_shrunk) < 1e-12 for r in alone.collect())
    with pytest.raises(ValueError, match="no sample"):
        pipeline.psi_step(both.where("rep <> 'r3'"))


def test_cigar_junctions(spark):
    rows = [("q1", 0, "c", 10, "20M30N25M"), ("q2", 0, "c", 10, "20M30N3M"), ("q3", 16, "c", 5, "2S8M40N9M20N7M"), ("q4", 0, "c", 5, "8M10N9M")]
    frame = spark.createDataFrame(rows, "qname string, flag int, rname string, pos int, cigar string")
    got = {(r.strand, r.donor, r.acceptor, r.coverage) for r in junctions.from_alignments(frame).collect()}
    assert got == {("+", 30, 60, 2), ("-", 13, 53, 1), ("-", 62, 82, 1)}


def test_pairs_must_be_whole(spark):
    rows = [("a", 64 | 1), ("a", 128 | 1), ("b", 64 | 1)]
    frame = spark.createDataFrame(rows, "qname string, flag int")
    with pytest.raises(Exception, match="not a pair"):
        alignments.pair_up(frame).collect()
    assert alignments.pair_up(frame.where("qname = 'a'")).first().first.flag == 65


def _plan(df):
    """The first plan, as text with a line an operator."""
    return df._jdf.queryExecution().executedPlan().toString()


def test_aligned_counts_hold_no_joined_groups(spark):
    """Every line of a barcode counts, and mates and joined rows are not sorted or grouped once more (F12)."""
    filtered = spark.createDataFrame([("x", "AC", "e", True)] * 3 + [("x", "GG", "e", True), ("x", "AC", "e", False)], "read_ref string, barcode string, ref_type string, kept boolean")
    known = spark.createDataFrame([("AC", "v1"), ("AC", "v1"), ("AC", "v2"), ("AC", None), ("TT", "v3"), (None, "v4")], "barcode string, var_id string")
    got = matching.aligned_counts(filtered, known)
    assert sorted(map(tuple, got.collect()), key=str) == sorted([("x", "v1", "AC", "e", 6), ("x", "v2", "AC", "e", 3), ("x", None, "AC", "e", 3), ("x", None, "GG", "e", 1)], key=str)
    assert "Aggregate" not in _plan(got).split("Join")[0].replace("AdaptiveSparkPlan", "")
    pairs = alignments.pair_up(spark.createDataFrame([("a", 65), ("a", 129)], "qname string, flag int"))
    assert "Sort [" not in _plan(pairs).split("Exchange")[1]


_FLANKS = {"before": "TTGACCGATC", "after": "GGATCATTCG", "up": "GCAGTCCATGAC", "down": "CTACGGTTAGCA", "template": "NNNN"}
_KNOWN_LINES = [("ACGT", "aaCCCCaa", "v0", 1, 1), ("ACGT", "aaGGGGaa", "v1", 1, 2)]


def _lines(spark):
    return spark.createDataFrame(_KNOWN_LINES, "barcode string, variant string, var_id string, count long, line long")


def test_kernels_of_reads_run_once(spark):
    """Filters on the status do not run the kernels again below, and small maps are sent to the reads (F13, F14, F16 to F20)."""
    reads = spark.createDataFrame([], "header string, seq string, qual string")
    single = matching.canonical_single(reads, _lines(spark), **_FLANKS)
    pairs = spark.createDataFrame([], "h1 string, s1 string, q1 string, h2 string, s2 string, q2 string")
    double = matching.canonical_pairs(pairs, _lines(spark), **_FLANKS)
    counted = [matching.canonical_counts(x, F.col("var_id")) for x in (single, double)]
    for frame, kernels in [(counted[0], 2), (counted[1], 2), (matching.event_totals(counted[0]), 2), (matching.leftovers(single), 3), (matching.pair_leftovers(double), 3)]:
        plan = _plan(frame)
        assert plan.count("ArrowEvalPython") == kernels
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_stream_finds_known_barcodes_once(spark, tmp_path, monkeypatch):
    calls, last = [], matching.last_by_barcode
    monkeypatch.setattr(matching, "last_by_barcode", lambda *a, **k: calls.append(1) or last(*a, **k))
    seq = "TTGACCGATC" + "GGGG" + "GGATCATTCG" + "GCAGTCCATGAC" + "ACGT" + "CTACGGTTAGCA"
    for _ in range(3):
        spark.createDataFrame([("r", seq, "F")], "header string, seq string, qual string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/reads")
    stream = spark.readStream.schema("header string, seq string, qual string").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/reads")
    run = canonical.start_table(stream, _lines(spark), f"{tmp_path}/counts", f"{tmp_path}/checkpoint", {"availableNow": True}, **_FLANKS)
    run.awaitTermination()
    assert len(run.recentProgress) >= 3 and len(calls) == 1
    assert [tuple(r) for r in canonical.current(spark, f"{tmp_path}/counts").collect()] == [("reads", "v1", "ACGT", "exon_inclusion", 3)]


@pytest.mark.parametrize("size", [1, 7, 36, 63, 64, 65])
def test_edits_of_far_texts_are_not_tabled(monkeypatch, size):
    """A cheap bound leaves out rows that hold nothing within the distance, and no others."""
    rng, change = random.Random(size), {"-": lambda t, i: t[:i] + t[i + 1 :], "+": lambda t, i: t[:i] + "A" + t[i:], "x": lambda t, i: t[:i] + "C" + t[i + 1 :]}
    words = lambda n: "".join(rng.choices("ACGT", k=n))
    patterns = [words(size) for _ in range(120)]
    near = patterns[:]
    for i in range(60):
        for _ in range(rng.randrange(11)):
            near[i] = change[rng.choice("-+x")](near[i], rng.randrange(size))
    texts = [words(rng.randrange(20)) + (near[i] if i < 60 else words(size)) + words(rng.randrange(20)) for i in range(120)]
    s, p = (sequence._texts(sequence.pa.array(x, sequence.pa.string())) for x in (texts, patterns))
    tabled, edits = [], sequence._edits
    monkeypatch.setattr(sequence, "_edits", lambda t, q, k: tabled.append(len(t)) or edits(t, q, k))
    for most in (0, 2, 8):
        tabled.clear()
        got = sequence._search(s, p, most, near=sequence._edits)
        held = sum(tabled)
        with monkeypatch.context() as m:
            m.setattr(sequence, "_may_edit", lambda t, q, k: np.ones(len(t), bool))
            assert (got == sequence._search(s, p, most, near=sequence._edits)).all()
        assert size not in (36, 63, 64) or held <= 62


def test_exon_headers(spark):
    cases = [("r", None), ("r||e1", "e1"), ("r||e1_del101to121", "e1_del21nt"), ("r||e1_del1to5", "e1_del1to5")]
    frame = spark.createDataFrame(cases, "h string, want string")
    assert all(r.x == r.want for r in frame.select("want", alignments.exon_of_header(F.col("h")).alias("x")).collect())


def test_long_read_association(spark):
    part = lambda a, x, b: a + x + b
    flanks = {"barcode": ("AAGACCTC", "CCTCAAGA"), "vhh": ("GGTTGCAT", "TAGGATCC"), "target": ("ACACGTGT", "TGAGCTCA")}
    seq = part(*(flanks["barcode"][0], "GGATGG", flanks["barcode"][1])) + part(flanks["vhh"][0], "CATCAT", flanks["vhh"][1]) + part(flanks["target"][0], "GATGAT", flanks["target"][1])
    flip = seq[::-1].translate(str.maketrans("ACGT", "TGCA"))
    frame = spark.createDataFrame([(seq,), (flip,), ("ACGT",)], "seq string")
    best, rows = association.associate_long_reads(frame, *flanks.values(), "NNATNN", [6], [6])
    assert [tuple(r) for r in best.select("barcode_seq", "vhh_seq", "target_seq", "count").collect()] == [("GGATGG", "CATCAT", "GATGAT", 2)]
    steps = {r.step: r.n for r in association.step_statistics(rows, association.LONG_STEPS).collect()}
    assert steps["barcode_up"] == 1 and steps["accepted"] == 2


def test_last_barcodes_are_hashed(spark):
    """The last line of every key, nulls and ties included, without sorting all lines."""
    from barsplice.operators import matching

    lines = [("s", "A", "v1", 1), ("s", "A", "v2", 3), ("s", "A", "v3", 2), ("t", "A", "v4", 1), ("s", None, "v5", 1), ("s", None, "v6", 2), ("t", "C", "v7", None), (None, "C", "v8", 5), (None, "C", "v8", 5)]
    last = matching.last_by_barcode(spark.createDataFrame(lines, "sample_id string, barcode string, var_id string, line long"), by=["sample_id"])
    assert {tuple(r) for r in last.collect()} == {("s", "A", "v2"), ("t", "A", "v4"), ("s", None, "v6"), ("t", "C", None), (None, "C", "v8")} and last.count() == 5
    assert "HashAggregate" in last._jdf.queryExecution().executedPlan().toString()


def test_id_maps(spark):
    rng = random.Random(8)
    known = ["".join(rng.choice("ACGT") for _ in range(20)) for _ in range(40)]
    queries = known[:5] + [k[:5] + "A" + k[6:] for k in known[5:15]] + [k[:8] + k[9:] for k in known[15:20]] + ["", "ACG"]
    ids = spark.createDataFrame([(f"i{n}", s, n) for n, s in enumerate(known)], "id string, seq string, line long")
    got = {r.seq: r.id for r in idmap.map_first(spark.createDataFrame([(q,) for q in queries], "seq string"), ids).collect()}
    assert all(got[q] == f"i{n}" for n, q in enumerate(queries[:20])) and got[""] == got["ACG"] == "not_found"
    staged = {r.seq: r.id for r in idmap.map_staged(spark.createDataFrame([(q,) for q in queries], "seq string"), ids).collect()}
    assert all(staged[q] == f"i{n}" for n, q in enumerate(queries[:20])) and staged["ACG"] == ""


def test_venn(spark):
    rows = [("a", "x"), ("a", "y"), ("b", "x"), ("c", "y"), ("c", "y")]
    got = {r.region: r.n for r in report.venn(spark.createDataFrame(rows, "k string, s string"), ["k"], "s", ["x", "y"]).collect()}
    assert got == {"x&y": 1, "x": 1, "y": 1}


def test_subsets():
    assert psi.subsets(3) == [(1, 2), (1, 3), (2, 3), (1, 2, 3)] and len(psi.subsets(4)) == 11
    assert list(itertools.chain(*psi.subsets(1))) == []


def test_id_map_tables_are_whole(spark):
    """Every customer with orders asks, and every part is known."""
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no tables here")
    read = lambda t: spark.read.parquet(f"{folder}/{t}.parquet")
    assert tables.table(spark, folder, "queries").count() == read("orders").count()
    kinds = read("orders").select("o_custkey", (F.col("o_orderkey") % 4).alias("kind")).distinct().count()
    assert tables.table(spark, folder, "queries").distinct().count() >= 0.99 * kinds
    assert tables.table(spark, folder, "ids").select("seq").distinct().count() >= 0.94 * read("part").count()


def test_id_map_queries_are_keyed_on_one_strand(spark, monkeypatch):
    """The few keys of known sequences stand for both strands, not the many of a query."""
    asked = []
    whole = idmap.candidates
    monkeypatch.setattr(idmap, "candidates", lambda queries, known, distance: (asked.append((queries.count(), known.count())), whole(queries, known, distance))[1])
    ids = spark.createDataFrame([("i1", "ACGTTGCAACCGGTACGTTA", 1), ("i2", "TTGACCAGATTACAGGCATC", 2)], "id string, seq string, line long")
    queries = spark.createDataFrame([("TAACGTACCGGTTGCAACG",), ("TTGACCAGATTACAGGCAT",)], "seq string")
    assert {r.id for r in idmap.map_first(queries, ids).collect()} == {r.id for r in idmap.map_staged(queries, ids).collect()} == {"i1", "i2"}
    assert asked == [(2, 4), (2, 4)]


def test_id_map_keys_are_not_shuffled(spark, monkeypatch):
    """Small chunks and blocks find the same pairs, and no key of a query is a row of a shuffle."""
    rng = random.Random(21)
    known = ["".join(rng.choice("ACGT") for _ in range(rng.choice([0, 3, 19, 20, 21]))) for _ in range(40)] + ["ACG\u00e9T" * 4]
    ids = spark.createDataFrame([(k, f"i{n}", n) for n, k in enumerate([*known, known[4]])] + [(None, "none", 99)], "seq string, id string, ord int")
    asked = [k[:5] + rng.choice(["A", "", "CG"]) + k[6:] for k in known if k] + [known[4][:18] + "\u00e9", "ACG\u00e9T" * 3 + "ACG\u00e9"]
    queries = spark.createDataFrame([(q,) for q in [*dict.fromkeys(asked), None]], "seq string")
    pairs = lambda: sorted(map(tuple, idmap.within(queries, ids, 4).collect()))
    whole = pairs()
    for name, value in (("CHUNK", 7), ("BLOCK", 5), ("LEAST", 3), ("BYTES", 200)):
        monkeypatch.setattr(idmap, name, value)
    assert pairs() == whole and len({q for q, *_ in whole}) == len(set(asked)) and {"i4", "i41"} <= {i for _, i, *_ in whole}
    assert "key#" not in idmap.candidates(queries, ids, 4)._jdf.queryExecution().executedPlan().toString()


def test_id_maps_by_brute_force(spark):
    """All pairs on a small fixture, with repeated known sequences and both strands."""
    rng = random.Random(12)
    flip = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    def edited(s):
        for _ in range(rng.randint(0, 5)):
            k = rng.randrange(len(s))
            s = s[:k] + rng.choice(["", "A", "C", s[k] + "G"]) + s[k + 1 :]
        return s

    base = ["".join(rng.choice("ACGT") for _ in range(rng.randint(18, 22))) for _ in range(30)]
    known = base + [edited(s) for s in base[:10]] + base[5:9]
    queries = sorted({q for s in known for q in (s, flip(s), edited(s), flip(edited(s)))})
    order, name = {}, {}
    for n, s in enumerate(known):
        order.setdefault(s, n)
        name[s] = f"i{n}"
    low, high = min(map(len, known)), max(map(len, known))

    def first(q):
        found = [(0 if q == s else 1 if flip(q) == s else 2, order[s], name[s]) for s in order if min(edits(q, s), edits(flip(q), s)) <= 4]
        return min(found)[2] if found and low - 4 <= len(q) <= high + 4 else "not_found"

    def staged(q):
        found = []
        for s in order:
            for turned, x in enumerate((q, flip(q))):
                d = edits(x, s)
                close = len(x) == len(s) and sum(a != b for a, b in zip(x, s, strict=True)) <= 2
                if d <= 4:
                    stage = turned if d == 0 else 2 + turned if close else 4
                    found.append((stage, d if stage == 4 else 0, order[s], turned, name[s]))
        return min(found)[4] if found and low - 2 <= len(q) <= high + 2 else ""

    ids = spark.createDataFrame([(f"i{n}", s, n) for n, s in enumerate(known)], "id string, seq string, line long")
    asked = spark.createDataFrame([(q,) for q in queries], "seq string")
    assert {r.seq: r.id for r in idmap.map_first(asked, ids).collect()} == {q: first(q) for q in queries}
    assert {r.seq: r.id for r in idmap.map_staged(asked, ids).collect()} == {q: staged(q) for q in queries}


def test_fit_of_all_samples_together(spark, monkeypatch):
    """As one fit for each sample, with as many jobs however many samples there are."""
    from barsplice.jobs import pipeline

    rng = np.random.default_rng(3)
    rows = []
    for s, noise in (("s1", 0.3), ("s2", 0.8), ("s3", 0.5), ("two", 0.4)):
        for v in range(40):
            theta = rng.normal()
            for rep in ("rA", "rB", "rC")[: 2 if s == "two" else 3]:
                n = int(rng.integers(20, 400))
                k = rng.binomial(n, 1 / (1 + math.exp(-theta - noise * rng.normal())))
                rows.append((s, f"v{v}", rep, int(k), int(n - k), int(rng.integers(0, 5))))
    counts = spark.createDataFrame(rows, "sample string, var_id string, rep string, inclusion long, skipping long, others long")
    reps = ["rA", "rB", "rC"]
    jobs = spark.sparkContext.statusTracker()

    def measured(samples):
        spark.sparkContext.setJobGroup(f"fit {samples}", "")
        out = psi.fit_all(counts, dict.fromkeys(samples, reps))
        n = len(jobs.getJobIdsForGroup(f"fit {samples}"))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return out, n

    together, n_all = measured(["s1", "s2", "s3"])
    one = psi.fit_variances(counts.where("sample = 's2'"), reps)
    assert all(abs(together["s2", r] - one[r]) <= 1e-4 * max(1, one[r]) for r in reps)
    alone, n_one = measured(["s1"])
    assert all(abs(together["s1", r] - alone["s1", r]) <= 1e-4 * max(1, alone["s1", r]) for r in reps)
    assert n_all <= 2 * n_one
    with pytest.raises(ValueError):
        psi.fit_all(counts, {"s1": reps, "two": ["rA", "rB"]})
    monkeypatch.setattr(psi, "fit_all", lambda _, samples, mode: {k: together[k] for k in [(s, r) for s in samples for r in reps]})
    got = pipeline.psi_step(counts)
    assert {r[0] for r in got.select("sample").distinct().collect()} == {"s1", "s2", "s3"} and got.count() == 120


def test_fuzzy_pairs_are_complete(spark):
    """All pairs within a distance, for short and long sequences, and few others for many random ones."""
    from barsplice.operators import idmap

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            corner, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                corner, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, corner + (x != y))
        return row[-1]

    rng = np.random.default_rng(5)
    word = lambda n: "".join(rng.choice(list("ACGT"), n))
    known = list(dict.fromkeys([word(int(n)) for n in rng.integers(1, 26, 60)]))
    asked = set()
    for k in known:
        for _ in range(3):
            q = list(k)
            for _ in range(int(rng.integers(0, 5))):
                i = int(rng.integers(0, len(q) + 1))
                q[i : i + int(rng.integers(0, 2))] = list(word(int(rng.integers(0, 2))))
            asked.add("".join(q))
    asked.discard("")
    frame = spark.createDataFrame([(k, f"id{i}", i) for i, k in enumerate(known)], "seq string, id string, ord int")
    queries = spark.createDataFrame([(q,) for q in sorted(asked)], "seq string")
    for distance in (1, 4):
        got = {(r.seq, r.id): r.distance for r in idmap.within(queries, frame, distance).collect()}
        want = {(q, f"id{i}"): d for q in asked for i, k in enumerate(known) if (d := edits(q, k)) <= distance}
        assert got == want
    # More segments must agree where more sequences are known.
    kept = [idmap.kept_segments(n, 25.0, 4) for n in (100, 10_000, 1_000_000, 100_000_000)]
    assert kept == sorted(kept) and kept[0] < kept[-1]
    assert idmap.within(queries.limit(0), frame, 2).count() == 0 and idmap.within(queries, frame.limit(0), 2).count() == 0


def test_local_regression(spark):
    """Against weighted least squares on all rows, place by place; whole numbers exactly, continuous values nearly."""
    import numpy as np
    from barsplice.operators import report

    rng = np.random.default_rng(3)

    def plain(x, y, at, span, degree):
        out = []
        for g in at:
            far = np.abs(x - g)
            h = np.sort(far)[int(span * len(x) + 1e-5) - 1]
            w = np.sqrt(np.clip(1 - (far / h) ** 3, 0, None) ** 3)
            out.append(np.linalg.lstsq(np.vander(x - g, degree + 1, increasing=True) * w[:, None], y * w, rcond=None)[0][0])
        return np.array(out)

    whole, some = rng.integers(1, 300, 800).astype(float), rng.uniform(5, 9, 900)
    groups = {"whole": (whole, np.sin(whole / 40) + 2 + rng.normal(0, 0.1, 800)), "some": (some, some**2 + rng.normal(0, 1, 900))}
    rows = [(k, float(a), float(b)) for k, (x, y) in groups.items() for a, b in zip(x, y)] + [("whole", 0.0, 5.0), ("some", 7.0, None), (None, 4.0, 2.0), (None, 4.0, 3.0)]
    table = spark.createDataFrame(rows, "fit string, x double, k0 double")
    for span, degree, limit in ((0.75, 2, 1e-9), (0.3, 1, 1e-9), (0.5, 0, 1e-9)):
        got = report.local_regression(table.withColumnRenamed("fit", "g"), "x", "k0", ["g"], span, degree, 30).toPandas()
        for name, (x, y) in groups.items():
            part = got[got["g"] == name].sort_values("x")
            want = plain(x, y, np.linspace(x.min(), x.max(), 30), span, degree)
            assert np.abs(part["fit"].to_numpy() - want).max() < (limit if name == "whole" else 5e-3) * np.abs(want).max()
        assert got[got["g"].isna()][["x", "fit"]].values.tolist() == [[4.0, 2.5]]
    assert report.local_regression(table.limit(0), "x", "k0").count() == 0 and report.local_regression(table, "x", "k0").count() == 80 and report.local_regression(table.where("fit is null"), "x", "k0").first().fit == 2.5
