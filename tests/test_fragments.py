"""Trimming and merging of read pairs against plain versions."""

import random

from barsplice.jobs import pipeline
from barsplice.operators import fragments as G

TURN = str.maketrans("ACGTacgt", "TGCAtgca")
PAIR = "k int, h1 string, s1 string, q1 string, h2 string, s2 string, q2 string"


def laid(s1, s2, d):
    places = [(s1[i], s2[i - d]) for i in range(max(0, d), min(len(s1), len(s2) + d))]
    called = [(x, y) for x, y in places if x in "ACGT" and y in "ACGT"]
    return len(places), len(called), sum(x != y for x, y in called)


def plain_merge(s1, q1, s2, q2, least=10, outie=20, most=250, density=0.25):
    s2, q2 = s2.translate(TURN)[::-1], q2[::-1]
    best = None
    for d in [*range(len(s1)), *range(-1, -len(s2), -1)]:
        _, n, bad = laid(s1, s2, d)
        if n >= (least if d >= 0 else outie):
            score = (bad / min(n, most), -n)
            if best is None or score < best[0]:
                best = (score, d, n, bad)
    if best is None or best[0][0] > density:
        return None
    _, d, n, bad = best
    seq, qual = "", ""
    for p in range(min(0, d), max(len(s1), len(s2) + d)):
        one = (s1[p], ord(q1[p])) if 0 <= p < len(s1) else None
        two = (s2[p - d], ord(q2[p - d])) if 0 <= p - d < len(s2) else None
        if not one or not two:
            b, v = one or two
        elif "N" in (one[0], two[0]):
            b, v = max(one, two, key=lambda x: (x[0] != "N", x[1]))
        elif one[0] == two[0]:
            b, v = one[0], max(one[1], two[1])
        else:
            b, v = (two if two[1] > one[1] else one)[0], 33 + max(2, abs(one[1] - two[1]))
        seq, qual = seq + b, qual + chr(v)
    return seq, qual, d, n, bad


def plain_trim(s1, q1, s2, q2):
    def tail(q):
        good = [e for e in range(4, len(q) + 1) if sum(ord(c) - 33 for c in q[e - 4 : e]) >= 80]
        return len(q) if len(q) < 4 else max(good, default=0)

    n1, n2 = tail(q1), tail(q2)
    a, b = s1[:n1], s2[:n2].translate(TURN)[::-1]
    for d in [*range(len(a)), *range(-1, -len(b), -1)]:
        length, _, bad = laid(a, b, d)
        if length >= 30 and bad <= min(5, int(length * 0.2)):
            if d < 0:
                n1 = n2 = length
            break
    return s1[:n1], q1[:n1], s2[:n2], q2[:n2]


def some_pairs(n):
    rng = random.Random(5)
    dna = lambda k: "".join(rng.choice("ACGT") for _ in range(k))
    out = []
    for k in range(n):
        f = dna(rng.choice([0, 5, 18, 33, 40, 60, 75, 110])) if k % 5 else "AC" * rng.randint(0, 40)
        ends = [(x + dna(60))[: rng.choice([45, 60])] if k % 3 else x[:60] for x in (f, f.translate(TURN)[::-1])]
        reads = ["".join(rng.choice("ACGTN") if rng.random() < (k % 4) / 15 else c for c in x) for x in ends]
        quals = ["".join(chr(33 + rng.randint(0, 40) if rng.random() < 0.3 else 33 + 30) for _ in r) for r in reads]
        if k % 6 == 0:
            quals = [q[: len(q) * 2 // 3] + "#" * (len(q) - len(q) * 2 // 3) for q in quals]
        out.append((k, f"r{k}/1", reads[0], quals[0], f"r{k}/2", reads[1], quals[1]))
    return out


def test_merge(spark):
    rows = some_pairs(400)
    got = {r.k: r.merged for r in G.merge_pairs(spark.createDataFrame(rows, PAIR)).collect()}
    want = {k: plain_merge(s1, q1, s2, q2) for k, _, s1, q1, _, s2, q2 in rows}
    assert {k: v and tuple(v) for k, v in got.items()} == want
    assert sum(v is not None for v in want.values()) > 100 and any(v and v[2] < 0 for v in want.values()) and any(v and v[4] for v in want.values())


def test_trim(spark):
    rows = some_pairs(400)
    got = {r.k: (r.s1, r.q1, r.s2, r.q2) for r in G.trim_pairs(spark.createDataFrame(rows, PAIR)).collect()}
    want = {k: plain_trim(s1, q1, s2, q2) for k, _, s1, q1, _, s2, q2 in rows}
    assert got == want and any(len(want[r[0]][0]) not in (len(r[2]), 0) for r in rows)


def test_odd_pairs(spark):
    """Nulls, empty reads, poor and unknown bases, other columns and an empty table."""
    good = ("ACGTTGCATTGACCGATCAGGCTATTCAGA", "F" * 30)
    other = (good[0].translate(TURN)[::-1], good[1])
    rows = [(0, "a", *good, "b", *other), (1, "a", None, "F", "b", *other), (2, "a", "", "", "b", *other), (3, "a", good[0], "F" * 15 + "%F" * 7 + "F", "b", other[0], "(" * 16 + "H" * 14),
            (4, "a", "N" * 6 + good[0][6:], good[1], "b", *other), (5, "a", *good, "b", other[0][:10], "F" * 10)]
    pairs = spark.createDataFrame(rows, PAIR)
    status = {r.k: r.status for r in G.trim_pairs(pairs).collect()}
    assert status == {0: "passed", 1: None, 2: "too_short", 3: "low_quality", 4: "too_many_n", 5: "too_short"}
    merged = G.merge_pairs(pairs)
    assert {r.k: r.merged and (r.merged.offset, r.merged.overlap) for r in merged.collect()} == {0: (0, 30), 1: None, 2: None, 3: (0, 30), 4: (0, 24), 5: (20, 10)}
    assert G.merge_pairs(pairs.limit(0)).count() == 0 and G.trim_pairs(pairs.limit(0)).count() == 0
    steps = pipeline.reads_step(pairs.selectExpr("'s' AS sample_id", "*"))
    assert [(r.sample_id, r.header, r.seq) for r in steps["reads"].collect()] == [("s", "a", good[0])] and steps["pairs"].count() == 0
    assert {(r.status, r.reads) for r in steps["trimming"].collect()} == {("passed", 2), (None, 2), ("too_short", 4), ("low_quality", 2), ("too_many_n", 2)}


def test_kernels_run_once(spark):
    """Filters and counts on what the kernels find do not run them again below (F15)."""
    pairs = spark.createDataFrame([], "sample_id string, " + PAIR).repartition(3)
    for name, kernels in (("merging", 2), ("reads", 2), ("pairs", 2), ("trimming", 1)):
        plan = pipeline.reads_step(pairs)[name]._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == kernels, name
