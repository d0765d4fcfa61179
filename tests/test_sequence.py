"""The sequence kernel on hand cases and by property."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barsplice.functions import sequence as S


def one(spark, value, **columns):
    return spark.createDataFrame([tuple(columns.values())], ", ".join(f"{c} string" for c in columns)).select(value.alias("x")).first()["x"]


def test_revcomp(spark):
    assert one(spark, S.revcomp(F.col("s")), s="AACgtN") == "NacGTT"
    rows = [("ACGTTGCA",), ("",), ("TTTacg",)]
    frame = spark.createDataFrame(rows, "s string")
    assert [r[0] for r in frame.select(S.revcomp(S.revcomp(F.col("s")))).collect()] == [r[0] for r in rows]


@settings(max_examples=50, deadline=None)
@given(st.text("ACGT", max_size=30), st.text("ACGT", min_size=1, max_size=6), st.integers(0, 2))
def test_first_match(seq, pattern, k):
    expected = next((i for i in range(len(seq) - len(pattern) + 1) if sum(a != b for a, b in zip(seq[i:], pattern, strict=False)) <= k), -1)
    assert S.first_match([seq], pattern, k)[0] == expected


def test_locate(spark):
    rows = [("GCAAGCAG", "GCAG", 0), ("GCA", "GCAG", -1), (None, "GCAG", None), ("", "A", -1)]
    frame = spark.createDataFrame(rows, "s string, p string, want int")
    assert all(r.x == r.want for r in frame.select("*", S.locate(F.col("s"), F.col("p"), 1).alias("x")).collect())
    edit = frame.select("want", S.locate_edit(F.col("s"), F.col("p"), 1).alias("x")).collect()
    assert [r.x for r in edit] == [0, -1, None, -1]


def test_extract(spark):
    cases = [("TTGCAGACGTCTACAA", "ACGT", "ok"), ("TTGCAGACGT", None, S.DOWN_MISSING), ("TTTTACGT", None, S.UP_MISSING)]
    frame = spark.createDataFrame(cases, "s string, value string, status string")
    got = frame.select("value", "status", S.extract(F.col("s"), F.lit("GCAG"), F.lit("CTAC"), 0).alias("x")).collect()
    assert all((r.x.value, r.x.status) == (r.value, r.status) for r in got)


def test_barcode(spark):
    cases = [("CCATGG", "CCATGG"), ("CCGTGG", "CCATGG"), ("CCGCGG", None), ("CCATG", None), (None, None)]
    frame = spark.createDataFrame(cases, "b string, want string")
    got = frame.select("want", S.check_barcode(F.col("b"), F.lit("NNATNN"), 1).alias("x")).collect()
    assert all(r.x == r.want for r in got)


def test_exons(spark):
    s = F.lit("ACGTacgtGGNNaaTT")
    row = spark.range(1).select(S.exon_runs(s).alias("r"), S.exon_positions(s).alias("p"), S.inclusion_reference(s).alias("i"), S.skipping_reference(s).alias("k"), S.skipping_reference(F.lit("AAcc")).alias("none")).first()
    assert row.r == ["ACGT", "GGNN", "TT"] and [tuple(x) for x in row.p] == [(1, 4), (9, 12), (15, 16)]
    assert row.i == "ACGTGGNNTT" and row.k == "ACGTTT" and row.none is None


def test_softclips(spark):
    frame = spark.createDataFrame([("5S90M7S", 5, 7), ("90M", 0, 0)], "c string, a int, b int")
    assert all(tuple(r.x) == (r.a, r.b) for r in frame.select("a", "b", S.softclips(F.col("c")).alias("x")).collect())
