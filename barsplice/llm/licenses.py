"""Licence scans by a trained paragraph classifier, confirmed against templates.

A paragraph is a run of lines between blank ones.  It is judged as a whole, line by line
and in windows of 2, 4, 8 and 16 lines, so wrapped notices are found as well as one line
inside other text.  Such a unit is a set of word unigrams and bigrams for a sparse logistic
regression with a class for each licence family and one for everything else.  The
regression is fitted on notices and on sentences made from names and phrases; sentences
with phrases that it has never seen calibrate its temperature and the least probability of
a family.  A family counts only if one of its templates is held by the unit, or holds it.

The scan is one projection of built-in functions over whole texts: no shuffle, no Python.
"""

from __future__ import annotations

import functools
import random
import re
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .license_texts import IDENTIFIERS, NAMES, NOTICES, ORDINARY
from .syncmers import _let, _upto

UNKNOWN = "unknown"
GNU = {"GPL", "GPL-2.0", "GPL-3.0", "LGPL", "AGPL"}
#: Share of a notice's bigrams that a unit must hold, or of the unit's bigrams that lie in it; a name must be there in full.
LEAST_OVERLAP = 0.6
#: A unit of fewer bigrams is not confirmed by lying inside a notice.
LEAST_INSIDE = 5
WINDOWS = (1, 2, 4, 8, 16)
#: Buckets of the feature table; a feature whose bucket is taken is left out.
BUCKETS = 1 << 16
_WORD = re.compile(r"[a-z0-9]+")

_SUBJECTS = ["", "this project is", "the code is", "this file is", "all content here is", "copyright 2019 the authors", "this work is", "our data is", "the software is"]
_VERBS = ["released under", "licensed under", "distributed under", "available under", "published under the terms of", "provided under", "subject to", "made available under", "covered by", "governed by", "under"]
_ENDS = ["", "see the license file for details", "terms", "and comes without warranty", "unless stated otherwise", "by its authors"]
_SUBJECTS_HELD, _VERBS_HELD, _ENDS_HELD = ["", "this package is", "the texts in this archive are"], ["issued under", "shared under", "dual licensed under", "you may use it under"], ["", "as found in the top folder", "for everybody"]


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower().replace("licence", "license"))


def features(text: str) -> list[str]:
    words = words_of(text)
    return sorted({*words, *(f"{a} {b}" for a, b in zip(words, words[1:]))})


def bigrams(text: str) -> list[str]:
    return [f for f in features(text) if " " in f]


def _sentences(rng: random.Random, subjects: list[str], verbs: list[str], ends: list[str], each: int) -> list[tuple[str, str]]:
    """``(family, text)``: grants by name and identifier, parts of notices, and other prose as ``unknown``."""
    rows = []
    for family, names in NAMES.items():
        for name in names:
            for _ in range(each):
                rows.append((family, " ".join([rng.choice(subjects), rng.choice(verbs), rng.choice(["", "the "]) + name, rng.choice(ends)])))
            rows.append((family, name))
        rows += [(family, f"SPDX-License-Identifier: {i}") for i in IDENTIFIERS.get(family, ())] * 4
    whole = {f: [" ".join(["", *words_of(n), ""]) for n in ns] for f, ns in NOTICES.items()}
    for family, notices in NOTICES.items():
        for notice in notices:
            words = notice.split()
            for _ in range(4 * each):
                size = rng.randint(min(len(words), 6), max(6, len(words) if rng.random() < 0.5 else 14))
                at = rng.randint(0, max(0, len(words) - size))
                part = " ".join(words[at : at + size])
                held = {f for f, ns in whole.items() if any(" ".join(["", *words_of(part), ""]) in n for n in ns)}
                # A part that several GNU licences share is of none of them in particular.
                rows.append((family if len(held) < 2 or not held <= GNU else "GPL", part))
    loose = sorted({w for notices in NOTICES.values() for n in notices for w in words_of(n)} | {w for names in NAMES.values() for n in names for w in n.split()})
    for text in ORDINARY:
        rows += [(UNKNOWN, text)] * 4
        for _ in range(3 * each):
            # A few words of licences, out of their order, do not make a grant.
            words = text.split() + rng.choice(ORDINARY).split()
            for _ in range(rng.randint(0, 4)):
                words.insert(rng.randint(0, len(words)), rng.choice(loose))
            rows.append((UNKNOWN, " ".join(words)))
    rows += [(UNKNOWN, " ".join(rng.sample(loose, rng.randint(1, 6)))) for _ in range(100 * each)]
    rows += [(UNKNOWN, w) for w in loose]
    return rows


@dataclass(frozen=True)
class Model:
    classes: tuple[str, ...]
    index: dict[str, int]
    weights: np.ndarray
    bias: np.ndarray
    #: Family, features and the share needed of each template.
    templates: tuple[tuple[str, tuple[int, ...], float], ...]
    temperature: float
    least: float

    def known(self, text: str) -> list[int]:
        return sorted({self.index[f] for f in features(text) if f in self.index})

    def probabilities(self, text: str) -> dict[str, float]:
        """The classifier's answer for one unit, as the scan computes it."""
        p = _softmax(_logits(self.weights, self.bias, [self.known(text)]) / self.temperature)[0]
        return dict(zip(self.classes, p.tolist(), strict=True))


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _logits(weights: np.ndarray, bias: np.ndarray, rows: list[list[int]]) -> np.ndarray:
    return np.array([bias + weights[r].sum(0) / np.sqrt(max(1, len(r))) for r in rows])


def _hash(feature: str) -> int:
    """Spark's ``xxhash64`` of a text."""
    value = xxhash.xxh64_intdigest(feature.encode(), seed=42)
    return value - (1 << 64) if value >> 63 else value


def _vocabulary(texts: list[str], wanted: set[str], least: int = 3) -> dict[str, int]:
    counts: dict[str, int] = {}
    for t in texts:
        for f in features(t):
            counts[f] = counts.get(f, 0) + 1
    taken, index = set(), {}
    for f in sorted(counts, key=lambda f: (f not in wanted, -counts[f], f)):
        bucket = _hash(f) & (BUCKETS - 1)
        if (counts[f] >= least or f in wanted) and bucket not in taken:
            taken.add(bucket)
            index[f] = len(index)
    return index


@functools.lru_cache(maxsize=1)
def fit(seed: int = 5, each: int = 12, rounds: int = 300, rate: float = 0.1, penalty: float = 2e-5, near_zero: float = 0.1) -> Model:
    """The classifier, its templates and its thresholds, fitted on the driver from the fixed texts alone.

    A penalty on their sizes makes most weights zero, and features without weights that no
    template uses are dropped, so the model is sparse.  Unseen sentences then set the
    temperature (by likelihood) and the least probability: the smallest at which at most
    one in a hundred others passes as a licence before templates are compared.
    """
    rng = random.Random(seed)
    classes = (*NAMES, UNKNOWN)
    rows = _sentences(rng, _SUBJECTS, _VERBS, _ENDS, each)
    templates = [(g, n, LEAST_OVERLAP) for f, ns in NOTICES.items() for n in ns for g in {f, "GPL" if f in GNU else f}]
    templates += [(f, n, 1.0) for f, ns in NAMES.items() for n in ns]
    templates += [(f, f"SPDX-License-Identifier: {i}", 1.0) for f, ids in IDENTIFIERS.items() for i in ids]
    parts = [(f, bigrams(t) or features(t), need) for f, t, need in templates]
    index = _vocabulary([t for _, t in rows], {p for _, ps, _ in parts for p in ps})
    label = np.array([classes.index(f) for f, _ in rows])
    x = np.zeros((len(rows), len(index)), np.float32)
    for i, (_, text) in enumerate(rows):
        found = [index[f] for f in features(text) if f in index]
        x[i, found] = 1 / np.sqrt(max(1, len(found)))
    target = np.eye(len(classes), dtype=np.float32)[label]
    share = 1 / np.bincount(label, minlength=len(classes))[label][:, None]
    share[label == len(classes) - 1] *= 2
    share /= share.sum()
    w, b = np.zeros((len(index), len(classes)), np.float32), np.zeros(len(classes), np.float32)
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in (w, b)]
    for step in range(1, rounds + 1):
        g = (share * (_softmax(x @ w + b) - target)).astype(np.float32)
        for p, d, (m, v) in zip((w, b), (x.T @ g + penalty * np.sign(w), g.sum(0)), state, strict=True):
            m += 0.1 * (d - m)
            v += 0.01 * (d * d - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    w[np.abs(w) < near_zero] = 0
    used = {p for _, ps, _ in parts for p in ps}
    kept = [f for f, i in index.items() if f in used or w[i].any()]
    weights = w[[index[f] for f in kept]].round(3).astype(float)
    index = {f: i for i, f in enumerate(kept)}
    shaped = tuple((f, tuple(sorted(index[p] for p in ps if p in index)), need) for f, ps, need in parts)
    model = Model(classes, index, weights, b.round(3).astype(float), tuple(t for t in shaped if t[1]), 1.0, 0.5)
    return _calibrated(model, _sentences(random.Random(seed + 1), _SUBJECTS_HELD, _VERBS_HELD, _ENDS_HELD, each))


def _calibrated(model: Model, held: list[tuple[str, str]]) -> Model:
    z = _logits(model.weights, model.bias, [model.known(t) for _, t in held])
    label = np.array([model.classes.index(f) for f, _ in held])
    loss = {t: -np.log(_softmax(z / t)[np.arange(len(z)), label] + 1e-12).mean() for t in np.geomspace(0.25, 4, 33)}
    temperature = float(round(min(loss, key=loss.get), 4))
    p = _softmax(z / temperature)
    other = p[label == len(model.classes) - 1, :-1].max(1)
    least = float(np.quantile(other, 0.99))
    return Model(model.classes, model.index, model.weights, model.bias, model.templates, temperature, round(min(0.9, max(0.3, least)), 4))


def probabilities(text: str) -> dict[str, float]:
    return fit().probabilities(text)


def _numbers(values, kind: str) -> Column:
    """A constant array as one literal, which the optimiser folds once."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


class _Scan:
    """The model's tables as constant columns, and the expressions over them."""

    def __init__(self, model: Model):
        self.model = model
        hashes = [_hash(f) for f in model.index]
        table = np.full(BUCKETS, -1)
        table[[h & (BUCKETS - 1) for h in hashes]] = np.arange(len(hashes))
        self.table, self.hashes = _numbers(table.tolist(), "int"), _numbers(hashes, "bigint")
        self.weights, self.bias = _numbers(model.weights.ravel().tolist(), "double"), _numbers(model.bias.tolist(), "double")
        self.names = F.array(*map(F.lit, model.classes))
        families = sorted({t[0] for t in model.templates}, key=model.classes.index)
        of = lambda f: F.array(*(F.struct(_numbers(ids, "int").alias("ids"), F.lit(need).alias("need")) for g, ids, need in model.templates if g == f))
        self.templates = F.array(*map(of, families))
        self.order = F.array(*map(F.lit, families))

    def found(self, feature: Column) -> Column:
        """Number of a feature; null if the model does not have it."""
        slot = lambda h: F.get(self.table, h.bitwiseAND(BUCKETS - 1).cast("int"))
        return _let(F.xxhash64(feature), lambda h: _let(slot(h), lambda i: F.when((i >= 0) & (F.get(self.hashes, i) == h), i)))

    def line(self, words: Column, before: Column) -> Column:
        """Known features and number of bigrams of a line, whose first bigram reaches back to the line before."""
        none = F.array().cast("array<string>")
        chain = F.concat(F.when(before.isNotNull(), F.array(before)).otherwise(none), words)
        return _let(chain, lambda c: self._line(c, words))

    def _line(self, chain: Column, words: Column) -> Column:
        pairs = F.transform(_upto(F.size(chain) - 1), lambda i: F.concat_ws(" ", F.get(chain, i), F.get(chain, i + 1)))
        ids = F.filter(F.transform(F.concat(words, pairs), self.found), lambda i: i.isNotNull())
        return F.struct(F.array_distinct(ids).alias("ids"), F.greatest(F.size(chain) - 1, F.lit(0)).alias("n"))

    def block(self, text: Column, number: Column) -> Column:
        words = F.transform(F.split(text, "\n", -1), lambda t: F.regexp_extract_all(t, F.lit(r"[a-z0-9]+"), F.lit(0)))
        lines = lambda ws: F.transform(ws, lambda w, i: self.line(w, F.try_element_at(F.get(ws, i - 1), F.lit(-1))))
        return _let(words, lambda ws: _let(lines(ws), lambda rows: self.units(rows, number)))

    def units(self, rows: Column, number: Column) -> Column:
        """Answers for every window of lines that holds any known feature; other windows are unknown."""
        n = F.size(rows)
        levels = F.array(*(F.struct(F.lit(k).alias("k"), F.lit(max(1, k // 2)).alias("step")) for k in WINDOWS))
        stop = lambda v: F.ceil(F.greatest(n - v["k"], F.lit(0)) / v["step"]).cast("int") * v["step"]
        starts = lambda v: F.transform(F.sequence(F.lit(0), stop(v), v["step"]), lambda s: F.struct(s.alias("first"), F.least(v["k"], n - s).alias("lines")))
        windows = F.flatten(F.transform(F.filter(levels, lambda v: (v["k"] == 1) | (n * 2 > v["k"])), starts))
        part = lambda u: F.slice(rows, u["first"] + 1, u["lines"])
        answers = F.transform(windows, lambda u: _let(part(u), lambda p: self.unit(p, u, number)))
        return F.when(F.exists(rows, lambda r: F.size(r["ids"]) > 0), F.filter(answers, lambda a: a.isNotNull()))

    def unit(self, part: Column, at: Column, number: Column) -> Column:
        ids = F.array_distinct(F.flatten(F.transform(part, lambda r: r["ids"])))
        size = F.aggregate(part, F.lit(0), lambda a, r: a + r["n"])
        return _let(ids, lambda i: F.when(F.size(i) > 0, _let(self.scores(i), lambda z: self.answer(i, z, size, at, number))))

    def scores(self, ids: Column) -> Column:
        width = len(self.model.classes)
        total = lambda c: F.aggregate(ids, F.lit(0.0), lambda a, i: a + F.get(self.weights, i * width + c))
        scale = 1 / F.sqrt(F.size(ids))
        return F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda c: (F.get(self.bias, c) + total(c) * scale) / self.model.temperature)

    def answer(self, ids: Column, z: Column, size: Column, at: Column, number: Column) -> Column:
        best = F.array_max(z)
        odds = F.aggregate(z, F.lit(0.0), lambda a, v: a + F.exp(v - best))
        family = F.get(self.names, (F.array_position(z, best) - 1).cast("int"))
        sure = (family != UNKNOWN) & (1 / odds >= self.model.least)
        overlap = F.when(sure, F.array_max(F.transform(F.get(self.templates, (F.array_position(self.order, family) - 1).cast("int")), lambda t: self.overlap(ids, t, size))))
        return F.struct(
            number.alias("paragraph"), at["first"].alias("first_line"), at["lines"].alias("n_lines"), family.alias("family"), (1 / odds).alias("probability"), overlap.alias("overlap")
        )

    @staticmethod
    def settled(units: Column) -> Column:
        """The unit that fits best of each family of one paragraph, in the order of the units."""
        special = lambda us: F.exists(us, lambda a: a["family"].isin(*sorted(GNU - {"GPL"})))
        sure = F.filter(units, lambda a: a["overlap"].isNotNull())
        kept = _let(sure, lambda us: _let(special(us), lambda gnu: F.filter(us, lambda a: ~(gnu & (a["family"] == "GPL")))))
        rank = lambda a, i: F.struct(a["family"].alias("family"), -a["overlap"], a["n_lines"], a["first_line"], i.alias("i"), a.alias("unit"))
        first = lambda rs: F.filter(rs, lambda r, i: (i == 0) | (F.get(rs, i - 1)["family"] != r["family"]))
        best = _let(F.array_sort(F.transform(kept, rank)), first)
        return F.transform(F.array_sort(F.transform(best, lambda r: F.struct(r["i"], r["unit"]))), lambda r: r["unit"])

    @staticmethod
    def overlap(ids: Column, template: Column, size: Column) -> Column:
        """The larger share of the two, null if neither is enough; only notices may hold a unit, which counts a little less."""
        both = F.size(F.array_intersect(ids, template["ids"]))
        share = F.greatest(both / F.size(template["ids"]), F.when((template["need"] < 1) & (size >= LEAST_INSIDE), F.least(both / size, F.lit(0.99))).otherwise(0.0))
        return F.when(share >= template["need"], share)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_paragraphs, n_candidates, licenses, families``, one row per input row.

    ``licenses`` lists every family of every paragraph once: paragraph (from 0), first line
    in it, number of lines, family, probability and overlap of the unit that fits best (the
    greatest overlap, then the fewest lines).  ``GPL`` gives way to a
    particular GNU licence of the same paragraph.  ``families`` joins their distinct names in
    alphabetical order; ``n_candidates`` counts the units with any known feature.  Null and
    empty texts have no paragraphs.  Null and repeated ids are kept as they are; other
    columns are ignored; an empty table gives no rows.
    """
    model = _Scan(fit())
    text = F.replace(F.lower(F.col(text_col)), F.lit("licence"), F.lit("license"))
    blocks = F.when(F.coalesce(F.length(text), F.lit(0)) > 0, F.split(text, r"\n[^\S\n]*(?:\n[^\S\n]*)+", -1)).otherwise(F.array().cast("array<string>"))
    rows = docs.select(F.col(id_col).alias("id"), blocks.alias("blocks"))
    found = F.filter(F.transform("blocks", model.block), lambda u: u.isNotNull())
    rows = rows.select("id", F.size("blocks").cast("bigint").alias("n_paragraphs"), F.transform(found, lambda u: F.struct(F.size(u).alias("n"), model.settled(u).alias("best"))).alias("found"))
    rows = rows.select("id", "n_paragraphs", F.aggregate("found", F.lit(0).cast("bigint"), lambda a, p: a + p["n"]).alias("n_candidates"), F.flatten(F.transform("found", lambda p: p["best"])).alias("licenses"))
    return rows.select(
        F.col("id").alias(id_col), "n_paragraphs", "n_candidates", "licenses",
        F.array_join(F.array_sort(F.array_distinct(F.transform("licenses", lambda a: a["family"]))), ",").alias("families"),
    )
