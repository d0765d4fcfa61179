"""Source divergence, quality voting and whitening against plain versions."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from barsplice.llm import divergence, quality, queries, whitening

DOCS = "doc_id long, text string, lang string, source string"


def plain_audit(rows, top=200):
    """The audit by dictionaries: rows of (text, lang, source)."""
    held, count, groups = defaultdict(set), Counter(), set()
    for i, row in enumerate(rows):
        text, lang, source = (x or "" for x in row)
        groups.add((lang, source))
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        for t in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", lower):
            held[lang, t].add(i)
            count[lang, source, t] += 1
    out = set()
    for lang in {g for g, _ in groups}:
        terms = [t for (g, t), docs in held.items() if g == lang and len(docs) >= 3]
        sources = [s for g, s in groups if g == lang]
        share = {}
        for s in [*sources, None]:
            n = {t: sum(count[lang, o, t] for o in sources if s is None or o == s) for t in terms}
            total = sum(n.values()) + len(terms)
            share[s] = {t: (1 + 10**9 * (k + 1) // total, k) for t, k in n.items()}
        f = lambda p, q: (p - q) * (p - q) // q
        for s in sources:
            pairs = [(o, sum(f(share[s][t][0], share[o][t][0]) for t in terms)) for o in sources if o != s]
            words = [(t, f(p, share[None][t][0])) for t, (p, k) in share[s].items() if k > 0 and p > share[None][t][0]]
            for part, items in (("pair", pairs), ("term", words)):
                ordered = sorted(items, key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, item, v, r) for r, (item, v) in enumerate(ordered[: top if part == "term" else None], 1)}
    return out


def test_divergence_by_hand(spark, monkeypatch):
    rng = np.random.default_rng(1)
    words = ["The", "ÉTÉ", "naïve", "x", "rare", "日本", "Ünder", "tail", "k", "K", "z9z"]
    rows = [(" ".join(rng.choice(words, int(n), p=[0.3, 0.1, 0.1, 0.1, 0.02, 0.08, 0.1, 0.1, 0.04, 0.04, 0.02])), ("en", "de", None)[n % 3], ("a", "b", "c", None)[n % 4]) for n in rng.integers(0, 60, 200)]
    rows += [(None, "en", "only null"), ("", "xx", "empty"), ("one_two\x00three", "yy", "s"), ("a-b\tc", "yy", "s"), (" ".join(["long"] * 200_000), "en", "a"), *[("dup Dup", "en", "a")] * 3]
    docs = spark.createDataFrame([(None, *r, 1, "x") for r in rows], DOCS + ", n int, part string").repartition(5)
    want = plain_audit(rows)
    for together, held, cells in ((divergence.TOGETHER, divergence.HELD, divergence.CELLS), (500, 7, 3)):
        for name, value in (("TOGETHER", together), ("HELD", held), ("CELLS", cells)):
            monkeypatch.setattr(divergence, name, value)
        got = divergence.audit(docs)
        assert got.columns == ["lang", "source", "part", "item", "value", "rank"] and dict(got.dtypes)["value"] == "bigint" and dict(got.dtypes)["rank"] == "int"
        assert {tuple(r) for r in got.collect()} == want
    assert {tuple(r) for r in divergence.audit(docs, top=2).collect()} == plain_audit(rows, 2)
    assert divergence.audit(docs.limit(0)).count() == 0


def test_scaled_shares_are_exact():
    rng = np.random.default_rng(2)
    total = rng.integers(1, 1 << 52, 2000)
    count = np.minimum(total, rng.integers(0, 1 << 52, 2000))
    assert divergence.scaled(count, total).tolist() == [1 + 10**9 * c // t for c, t in zip(count.tolist(), total.tolist(), strict=True)]


def test_quality_votes(spark, tmp_path):
    rng = np.random.default_rng(4)
    word = lambda: "".join(rng.choice(list("aeioulnrst"), rng.integers(2, 9)))
    prose = lambda: " ".join(" ".join([word().capitalize(), *(word() for _ in range(8))]) + "." for _ in range(int(rng.integers(2, 8))))
    junk = [lambda: " ".join(f"{word().upper()}!!" for _ in range(40)), lambda: " | ".join(word() for _ in range(40)), lambda: " ".join([word()] * 50)]
    rows, labels = [], []
    for i in range(400):
        good = int(i % 5 > 0)
        rows.append((i, prose() if good else junk[i // 5 % 3](), "en", "s"))
        labels.append((i, good, 0))
    rows += [(1000, None, None, None), (1001, "", "en", "s"), (1002, " \n", "en", "s"), (None, rows[3][1], "en", "s"), (3, rows[3][1], "de", "t"), (1003, "q" * 300_000, "en", "s"), (1004, rows[1][1] + " " + " ".join(word() for _ in range(300_000)), "en", "s")]
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([*labels, (None, 1, 0), (1, None, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = queries.op12_quality_classifier(spark, str(tmp_path))
    assert got.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    out = got.collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out if r.doc_id is not None)
    held = [r for r in out if r.held_out and r.doc_id is not None and r.doc_id < 400]
    assert sum(r.predicted == int(r.doc_id % 5 > 0) for r in held) >= 0.97 * len(held)
    by = defaultdict(set)
    for r in out:
        by[r.doc_id].add(r.score)
    assert by[1000] == by[1001] == by[1002] and by[None] == by[3]

    # The vote by its definition, one text at a time.
    docs, marks = spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{tmp_path}/labels.parquet")
    model = quality.train(docs, marks)
    text = rows[7][1]
    cosines = sorted(((float(model.project([text])[0] @ v), y) for v, y in zip(model.vectors, model.labels, strict=True)), reverse=True)[:15]
    vote = sum(max(c, 0) ** 4 * y for c, y in cosines) / sum(max(c, 0) ** 4 for c, _ in cosines)
    assert abs(model.scores([text])[0] - vote) < 1e-6
    # Rows that are held out teach nothing: other labels there change no score.
    flipped = marks.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 4 = 2 then 1 - quality else quality end as quality")
    again = quality.train(docs, flipped)
    assert np.array_equal(again.vectors, model.vectors) and np.array_equal(again.labels, model.labels)
    odd = docs.selectExpr("*", "1 as c0", "'x' as `a.b`", "2 as score", "3 as __score")
    scored = quality.score(odd, model)
    assert scored.columns == ["doc_id", "text", "lang", "source", "c0", "a.b", "__score", "score"] and scored.where("c0 = 1 and __score = 3").count() == len(rows)
    assert quality.score(docs.limit(0), model).count() == 0
    assert quality.train(docs, marks.limit(0)).scores(["any", ""]).tolist() == [0.0, 0.0]


def test_long_texts_have_the_terms_of_their_words(monkeypatch):
    text = "Alpha beta, beta 12 %% " * 50
    want = quality.terms([text, "", "x", "日本語 ﬁ 𝔘"])
    monkeypatch.setattr(quality, "TOGETHER", 40)
    got = quality.terms([text, "", "x", "日本語 ﬁ 𝔘"])
    assert all(np.array_equal(a, b) for a, b in zip(want, got, strict=True))


def plain_whitening(vectors):
    x = np.floor(1024 * np.asarray(vectors, float)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(0)
    c = x - s / n
    e, v = np.linalg.eigh(c.T @ c / n)
    return ((n * x - s) ** 2).sum(1), c, e[::-1], v[:, ::-1]


@pytest.mark.parametrize("d,n,start", [(12, 300, 0), (5, 40, 0), (40, 25, 0), (3, 200, 5)])
def test_whitening_equals_eigenvectors(spark, d, n, start):
    rng = np.random.default_rng(d + n)
    x = rng.normal(size=(n, d)) * np.linspace(3, 0.5, d) + start
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    bad = [(900, None, 1), (901, [None] + [1.0] * (d - 1), 1), (902, [float("nan")] * d, 1), (903, [float("inf")] + [0.0] * (d - 1), 1)]
    frame = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, component int").repartition(3)
    out = whitening.whiten(frame).orderBy("vec_id", "component").collect()
    away, c, e, v = plain_whitening(x)
    k = min(8, d, n - 1)
    assert [r.vec_id for r in out] == [i for i in range(n) for _ in range(k)] and {r.n for r in out} == {n}
    assert [r.deviation for r in out[::k]] == away.tolist()
    got = np.array([r.whitened for r in out]).reshape(n, k)
    want = c @ v[:, :k] / np.sqrt(e[:k])
    assert np.allclose(got, want * np.sign((want * got).sum(0)), atol=1e-7)
    assert np.allclose([r.explained for r in out[:k]], e[:k] / e.sum(), rtol=1e-9) and all(r.identity_error < 1e-9 for r in out)


def test_whitening_of_odd_tables(spark):
    ddl = "vec_id string, embedding array<float>"
    made = lambda rows: spark.createDataFrame(rows, ddl)
    assert whitening.whiten(made([])).count() == whitening.whiten(made([("a", [1.0, 2.0])])).count() == whitening.whiten(made([("a", [1.0]), (None, [1.0]), ("b", None)])).count() == 0
    # Equal eigenvalues: all directions of a cube; short vectors end in zeros; huge entries keep finite results and no deviation.
    cube = [(None, [float(a), float(b), float(c)]) for a in (-1, 1) for b in (-1, 1) for c in (-1, 1)]
    out = whitening.whiten(made(cube)).collect()
    assert len(out) == 24 and all(abs(r.explained - 1 / 3) < 1e-9 and r.identity_error < 1e-9 for r in out)
    assert [round(r.whitened, 9) for r in whitening.whiten(made([("a", [1.0]), ("b", [1.0, 2.0])])).orderBy("vec_id").collect()] in ([1.0, -1.0], [-1.0, 1.0])
    huge = whitening.whiten(made([("a", [3e38, 0.0]), ("b", [-3e38, 1.0]), ("c", [0.0, 2.0])])).collect()
    assert all(r.deviation is None or r.vec_id == "c" for r in huge) and all(np.isfinite(r.whitened) for r in huge)


def test_bidiagonalisation_stops_early_and_finds_copies():
    """Wide tables: far fewer passes than dimensions, and both copies of a repeated largest value."""
    rng = np.random.default_rng(9)
    d = 400
    values = np.concatenate([[50.0, 50.0, 40.0, 30.0, 20.0, 15.0, 12.0, 10.0, 9.0], rng.uniform(0, 1, d - 9)])
    q = np.linalg.qr(rng.normal(size=(d, d)))[0]
    x = np.linalg.qr(rng.normal(size=(500, d)))[0] * values @ q.T
    passes = []

    def product(z, w):
        passes.append(1)
        s = x @ z
        return float(s @ s), (s @ x) @ w if w.shape[1] else np.empty(0), s @ x

    found, vectors = whitening.components(product, d, 500)
    assert np.allclose(found, values[:8], rtol=1e-10) and np.allclose(np.abs(vectors[:, 2:].T @ q[:, 2:8]), np.eye(6), atol=1e-8)
    assert np.allclose(np.linalg.norm(q[:, :2].T @ vectors[:, :2], axis=0), 1) and len(passes) < 150
