"""Alignment against a plain dynamic programme, and its operators on hand cases."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from barsplice.functions import seeding
from barsplice.functions.aligning import Scoring, align
from barsplice.jobs import pipeline
from barsplice.operators import aligning as A
from barsplice.sources import readers

READ = "header string, seq string, qual string"
TURN = str.maketrans("ACGTacgt", "TGCAtgca")
rnd = random.Random(11)
dna = lambda n: "".join(rnd.choice("ACGT") for _ in range(n))
turned = lambda s: s.translate(TURN)[::-1]


def sites(ref, j, k):
    return (ref[j : j + 2] != "GT") + (ref[k - 2 : k] != "AG")


def compared(a, b, s):
    return -1 if "N" in (a, b) else s.match if a == b else -s.mismatch


def plain(read, ref, s):
    m, n, low = len(read), len(ref), -(10**9)
    final, inserted = [[0] * (n + 1)], [[low] * (n + 1)]
    best = low
    for i in range(1, m + 1):
        ins = [max(inserted[-1][j], final[-1][j] - s.open) - s.extend for j in range(n + 1)]
        before = [max(-s.clip, ins[j], final[-1][j - 1] + compared(read[i - 1], ref[j - 1], s) if j else low) for j in range(n + 1)]
        row = []
        for j in range(n + 1):
            gaps = [before[q] - s.open - s.extend * (j - q) for q in range(j)]
            if s.intron is not None:
                gaps += [before[q] - s.intron - s.site * sites(ref, q, j) for q in range(j - s.least_intron + 1)]
            row.append(max([before[j], *gaps]))
        final.append(row)
        inserted.append(ins)
        best = max(best, max(row) - (0 if i == m else s.clip))
    return best


def rescored(read, ref, pos, cigar, s):
    i, j, value, wrong = 0, pos, 0, 0
    for n, op in ((int(n), op) for n, op in re.findall(r"(\d+)([MIDNS])", cigar)):
        if op == "M":
            value += sum(compared(a, b, s) for a, b in zip(read[i : i + n], ref[j : j + n], strict=True))
            wrong += sum(a != b for a, b in zip(read[i : i + n], ref[j : j + n], strict=True))
        elif op == "N":
            value -= s.intron + s.site * sites(ref, j, j + n)
        elif op == "S":
            value -= s.clip
        else:
            value, wrong = value - s.open - s.extend * n, wrong + n
        i, j = i + n * (op in "MIS"), j + n * (op in "MDN")
    assert i == len(read)
    return value, wrong


@pytest.mark.parametrize("s", [A.EXON, A.SPLICED, Scoring(1, 3, 2, 1, 2), Scoring(1, 3, 5, 3, 3, 4, 5, 8), Scoring(2, 3, 2, 1, 0, 3, 2, 5)])
def test_kernel(s):
    reads, refs = ["A", "N", "ACGT"], ["C", "A", "ACGT"]
    for _ in range(70):
        ref = dna(rnd.randint(1, 70))
        a, b, c = sorted(rnd.randrange(len(ref)) for _ in range(3))
        read = ref[a:b][:15] + rnd.choice(["", "", "CCG"]) + ref[c : c + 12]
        reads.append("".join(rnd.choice("ACGTN") if rnd.random() < 0.08 else x for x in read) or "A")
        refs.append(ref)
    got = align(pa.array(reads), pa.array(refs), -np.array([len(r) for r in reads]), np.array([len(r) for r in refs]), s)
    for k, (read, ref) in enumerate(zip(reads, refs, strict=True)):
        value, wrong = rescored(read, ref, got["pos"][k], got["cigar"][k], s)
        assert (got["value"][k], got["differences"][k]) == (value, wrong)
        assert value == plain(read, ref, s)


def test_kernel_nulls_and_long_reads():
    ref = dna(9000)
    got = align(pa.array([None, "", "ACGT", ref[1000:6000] + ref[6003:8000]]), pa.array(["A", "A", None, ref]), np.array([0, 0, 0, 990]), np.array([1, 1, 1, 1010]), A.EXON)
    assert got["cigar"][:3] == [None] * 3 and got["pos"][3] == 1000
    assert rescored(ref[1000:6000] + ref[6003:8000], ref, 1000, got["cigar"][3], A.EXON) == (6997 - 25, 3)


@pytest.fixture(scope="module")
def exons():
    return dna(60), dna(60), dna(60)


@pytest.fixture(scope="module")
def products(spark, exons):
    one, two, three = exons
    return spark.createDataFrame([("exon_inclusion_x", one + two.lower() + three), ("exon_skipping_x", one + three), ("none", None)], "rname string, seq string")


def test_single(spark, exons, products):
    one, two, three = exons
    skip = one[-30:] + three[:30]
    lost = (one + two)[20:60] + (one + two)[62:100]
    reads = [("a", skip), ("b", turned(skip)), ("c", one[5:50]), ("d", lost), ("e", "CCC" + one[:50].lower()), ("f", None), ("g", ""), ("h", "ACGT"), ("i", "N" * 50), ("j", dna(60)), ("a", skip), (None, skip)]
    df = spark.createDataFrame([(h, s, s and "F" * (len(s) - 1) + "G") for h, s in reads], READ)
    got = {(r.qname, i): r for i, r in enumerate(sorted(A.align_single(df, products).collect(), key=lambda r: (r.qname or "", r.flag)))}
    assert len(got) == len(reads)
    by = {r.qname: r for r in got.values()}
    brief = lambda r: (r.flag, r.rname, r.pos, r.cigar)
    assert brief(by["a"]) == brief(by[None]) == (0, "exon_skipping_x", 30, "60M")
    assert brief(by["b"]) == (16, "exon_skipping_x", 30, "60M") and by["b"].seq == skip and by["b"].qual[0] == "G"
    assert brief(by["c"]) == (0, "exon_inclusion_x", 5, "45M") and by["c"].mapq == 0 and by["c"].tags["NH"] == "2"
    assert by["d"].rname == "exon_inclusion_x" and rescored(lost, one + two + three, by["d"].pos, by["d"].cigar, A.EXON)[0] == 78 - 20 and by["d"].tags["NM"] == "2"
    assert brief(by["e"]) == (0, "exon_inclusion_x", 0, "3S50M")
    for name in "fghij":
        assert brief(by[name]) == (4, "*", -1, "*") and by[name].tags == {} and by[name].mapq == 0
    assert by["f"].seq is None
    none = A.align_single(df, products.limit(0)).collect()
    assert len(none) == len(reads) and {r.flag for r in none} == {4}
    assert A.align_single(df.limit(0), products).count() == 0


def test_shuffled_index_gives_the_same(spark, exons, products, monkeypatch):
    one, two, three = exons
    df = spark.createDataFrame([(str(i), (one + two + three)[i : i + 60], "F" * 60) for i in range(0, 120, 7)], READ)
    sent = sorted(map(str, A.align_single(df, products).collect()))
    monkeypatch.setattr(A, "SENT", 0)
    assert sorted(map(str, A.align_single(df, products).collect())) == sent


def test_large_references_are_not_sent(spark, products, monkeypatch):
    """Also where Spark takes them for small, which it tells by the size of their files."""
    plan = lambda: A.placements(spark.createDataFrame([("ACGT",)], "text string"), products)._jdf.queryExecution().executedPlan().toString()
    assert plan().count("BroadcastHashJoin") == 2
    monkeypatch.setattr(A, "SENT", 0)
    assert "BroadcastHashJoin" not in plan() and plan().count("SortMergeJoin") == 2


@pytest.mark.parametrize("turn", [False, True])
def test_introns_behind_seeds_by_chance(spark, turn):
    """The next exon's first bases are the intron's too, or the last exon's last ones, so that seeds reach past the exon."""
    one, other = "ACCTGAACGTTCAGCCATTGCAGGCTTAACGATCCTGATTCGACAAGCTTACCGGATACGTCC", "GATCCGTTAGGCAACTTCGGTACCATGAACCTGTCAGGACTTACGCTAGATCGACTTGCAACA"
    within = "GTAAGCTTTCAGATTTACCCAAATGGTTTTCCCTATATCGCGTTTAAACCCTTTGGAATTTTATAG"
    for first, intron, last, read, cigar in (
        (one, within, within[:8] + "CCTTG" + other, 48, f"48M{len(within)}N12M"), (one + "CAGTT" + within[-8:], within, other, 13, f"13M{len(within)}N47M"),
    ):
        text = first[-read:] + last[: 60 - read]
        df = spark.createDataFrame([("a", turned(text) if turn else text, "F" * 60)], READ)
        refs = spark.createDataFrame([("g", first + intron.lower() + last)], "rname string, seq string")
        (r,) = A.align_single(df, refs, (), A.SPLICED).collect()
        assert (r.flag, r.pos, r.cigar, r.tags["AS"]) == (16 * turn, len(first) - read, cigar, "56")


def test_groups_see_their_own_references(spark, exons):
    one, two, three = exons
    refs = spark.createDataFrame([("p", "r", one), ("q", "r", two)], "lane string, rname string, seq string")
    reads = spark.createDataFrame([("p", "a", one, one), ("q", "a", one, one), ("q", "b", two, two), (None, "c", one, one)], "lane string, " + READ)
    assert {(r.lane, r.qname): r.flag for r in A.align_single(reads, refs, ["lane"]).collect()} == {("p", "a"): 0, ("q", "a"): 4, ("q", "b"): 0, (None, "c"): 4}


@pytest.mark.parametrize("by", [[], ["lane"]])
def test_chunks_of_references_meet_blocks_of_texts(spark, monkeypatch, by):
    """Small chunks and blocks give what one broadcast gives, and no word of a text is a row of a shuffle."""
    rows = [(lane, f"r{i}", dna(150).lower() if i % 2 else dna(90)) for lane in ("p", "q", None) for i in range(8)]
    rows += [("p", "copy", rows[0][2]), ("q", "copy", rows[0][2][:70] + rows[1][2][:70]), ("p", "tiny", "ACG"), ("p", None, dna(60)), ("p", "null", None)]
    reads = []
    for n, (lane, _, ref) in enumerate(r for r in rows if r[2]):
        for at in range(0, max(1, len(ref) - 40), 23):
            read = ref[at : at + 40].upper()
            read = read[:17] + "N" + read[18:] if at % 2 else read
            reads += [(lane, f"{n}_{at}", turned(read) if n % 3 == 0 else read, "F" * len(read)), (None if n % 4 else "q", f"x{n}_{at}", read, "F" * len(read))]
    reads += [("p", "odd", "ACG\u00e9" + rows[0][2][:45], "F" * 49), ("p", "short", "ACGT", "FFFF")]
    refs = spark.createDataFrame(rows if by else [r for i, r in enumerate(rows) if r[0] != "q"], "lane string, rname string, seq string")
    refs = refs if by else refs.selectExpr("concat(coalesce(lane, ''), rname) as rname", "seq")
    df = spark.createDataFrame(reads, "lane string, " + READ)
    got = lambda: sorted(map(str, A.align_single(df, refs, by).collect()))
    sent = got()
    for name, value in (("SENT", 0), ("CHUNK", 300), ("BLOCK", 7), ("BLOCK_BYTES", 200), ("TOGETHER", 20)):
        monkeypatch.setattr(A, name, value)
    assert got() == sent and sum("flag=4," not in r for r in sent) > 60
    assert "word#" not in A.placements(df.select(*by, F.col("seq").alias("text")), refs, by)._jdf.queryExecution().executedPlan().toString()


def test_seeds_by_brute_force():
    rnd = random.Random(17)
    texts = ["".join(rnd.choice("ACGTN" if i % 4 else "AC") for _ in range(rnd.randint(0, 30))) for i in range(40)]
    refs = [rnd.choice(texts) + dna(5) + turned(rnd.choice(texts)) + "AC" * rnd.randint(0, 6) for _ in range(15)]
    side = lambda n: np.array([rnd.choice([5, -7]) for _ in range(n)])
    a, b = side(len(texts)), side(len(refs))
    for k, stride in ((3, 2), (6, 1), (5, 3)):
        want = {}
        for i, text in enumerate(texts):
            for turn, read in ((False, text), (True, turned(text))):
                for j, ref in enumerate(refs):
                    words = [(at, place) for at in range(0, len(read) - k + 1, stride) for place in range(len(ref) - k + 1) if read[at : at + k] == ref[place : place + k] and "N" not in read[at : at + k]]
                    if words and a[i] == b[j]:
                        at, shift = [w[0] for w in words], [w[1] - w[0] for w in words]
                        want[i, turn, j] = (len(set(at)), min(shift), max(shift), min(at), max(at))
        found = seeding.Index(pa.array(refs), b, k).hits(pa.array(texts), a, stride)
        assert dict(zip(zip(*(found[n].tolist() for n in ("text", "turned", "reference")), strict=True), zip(*(found[n].tolist() for n in seeding.COUNTS), strict=True), strict=True)) == want


def test_equal_reads_are_not_aligned_by_the_kernel(monkeypatch):
    from barsplice.functions import aligning

    ref = dna(50) + "ACGTACGTAC" * 4
    reads, low = [ref[i : i + 30] for i in range(0, 60, 7)], list(range(-9, 51, 7))
    want = align(pa.array([*reads, ref[:10] + "N" + ref[11:30]]), pa.array([ref] * 10), np.array([*low, -9]), np.array([n + 24 for n in [*low, -9]]), A.SPLICED)
    monkeypatch.setattr(aligning, "_Block", None)
    got = align(pa.array(reads), pa.array([ref] * 9), np.array(low), np.array([n + 24 for n in low]), A.SPLICED)
    assert got == {n: v[:9] for n, v in want.items()} and got["cigar"] == ["30M"] * 9 and [ref[p : p + 30] for p in got["pos"]] == reads


def test_pairs(spark, exons, products):
    one, two, three = exons
    q = "F" * 40
    pairs = [
        ("in/1", one[:40], turned(two[20:])),
        ("out 1", one[:40], turned(three[20:])),
        ("same/1", one[:40], two[20:]),
        ("half/1", dna(40), turned(three[20:])),
        ("none/1", None, ""),
    ]
    df = spark.createDataFrame([(h, a, a and q, h, b, b and q) for h, a, b in pairs], "h1 string, s1 string, q1 string, h2 string, s2 string, q2 string")
    got = {}
    for r in A.align_pairs(df, products).collect():
        got.setdefault(r.qname, []).append((r.flag, r.rname, r.pos, r.rnext, r.pnext, r.tlen))
    assert sorted(got["in"]) == [(99, "exon_inclusion_x", 0, "=", 80, 120), (147, "exon_inclusion_x", 80, "=", 0, -120)]
    assert {r[0] for r in got["out"]} == {99, 147}
    assert {r[0] for r in got["same"]} == {65, 129}
    assert {r[0] for r in got["half"]} == {101, 153}
    assert {r[:2] for r in got["none"]} == {(77, "*"), (141, "*")}


def test_steps(spark):
    up, down, template = "GCAGTCCATGAC", "CTACGGTTAGCA", "NNNNATNNNNNN"
    one, two, barcode = dna(60), dna(60), "ACGTATGGCCTT"
    three = dna(30) + up + barcode + down
    intron = "GT" + dna(80) + "AG"
    table = lambda rows, ddl: spark.createDataFrame(rows, "sample_id string, " + ddl)
    layout = table([("s", up, down, template)], "up string, down string, template string")
    products = table([("s", "exon_inclusion_x", one + two + three), ("s", "exon_skipping_x", one + three)], "rname string, seq string")
    positions = spark.createDataFrame([("x", "E1", 1, 60), ("x", "E2", 61, 120), ("x", "E3", 121, 186)], "var_id string, exon_id string, exon_start int, exon_end int")
    barcodes = table([("s", barcode, "aa", "v1", 1, 1)], "barcode string, variant string, var_id string, count long, line long")
    unknown = dna(40)
    reads = [("k", one[30:] + three), ("k", one[30:] + three), ("i", one[30:] + two + three), ("n", unknown + three[:20])]
    out = pipeline.aligned_step(layout, products, positions, barcodes, table([("s", h, r, "F" * len(r)) for h, r in reads], READ))
    counts = {(r.ref_type, r.barcode, r.var_id): r["count"] for r in out["canonical"].collect()}
    assert counts == {("exon_skipping", barcode, "v1"): 2, ("exon_inclusion", barcode, "v1"): 1}
    assert [r.header for r in out["leftovers"].collect()] == ["n"]
    novel = one[:-5] + three
    gene = one[:-5] + "GT" + dna(90) + "AG" + three
    left = table([("s", "z||e1", novel, "F" * len(novel))], READ)
    genes = table([("s", "e1", "gene", gene), ("s", "e2", "gene", intron)], "exon_id string, rname string, seq string")
    for per_exon in (False, True):
        use = genes if per_exon else genes.where("exon_id = 'e1'").drop("exon_id")
        spliced = pipeline.spliced_step(use, left, per_exon)
        assert [(r.rname, r.pos, r.cigar) for r in spliced.collect()] == [("gene", 0, "55M94N66M")]
        found = pipeline.novel_step(layout, barcodes, spliced)["novel"].collect()
        assert [(r.var_id, r.barcode, r["count"]) for r in found] == [("v1", barcode, 1)]


def test_by_exon(spark, tmp_path):
    rows = [("a", "AC", "FF", "e1"), ("b", "GT", "FG", "e1"), ("c", "TT", "GG", "e 2"), ("d", "AA", "FF", None)]
    df = spark.createDataFrame(rows, READ + ", exon_id string")
    path = str(tmp_path / "split")
    readers.write_by_exon(df, path)
    lines = {e: sorted(r.value for r in spark.read.text(f"{path}/exon_id={e}").collect()) for e in ("e1", "e 2")}
    assert lines == {"e1": sorted(["@a", "AC", "+", "FF", "@b", "GT", "+", "FG"]), "e 2": sorted(["@c", "TT", "+", "GG"])}
    readers.write_by_exon(df, path, fasta=True)
    assert sorted(r.value for r in spark.read.text(f"{path}/exon_id=e1").collect()) == sorted([">a", "AC", ">b", "GT"])
