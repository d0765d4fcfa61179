"""Toxicity from averaged subword embeddings and a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams (with word edges) and of itself, hashed into
one embedding table; an unseen misspelling so shares most vectors with the word it comes
from.  A window of words is the mean of its words' vectors, classified by a linear softmax.
A text's score is that of its most toxic window, calibrated on the training texts, so a
few words in a long text are not averaged away.

Training reads a bounded sample of labelled rows (``max_texts``), their texts whole;
scoring reads whole texts of all rows, one pass, no shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold

WINDOW, STRIDE = 8, 4
BUCKET_BITS, DIM, GRAMS = 16, 4, (3, 4, 5)
BUCKETS = 1 << BUCKET_BITS
#: Runs of more characters than LONG are cut into overlapping pieces; each n-gram of a run lies in one of them.
LONG, PIECE, STEP = 80, 12, 6
#: Words whose subwords are worked out together.
TOGETHER = 50_000
_EDGES = ".,;:!?\"'()[]{}<>|*#$%&-_/\\"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word and its character n-grams, and the word that each belongs to, for all words at once."""
    texts = [f"<{w}>" for w in words]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    points = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4").astype(np.uint64)
    begins = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(texts)), sizes)
    left = np.repeat(begins + sizes, sizes) - np.arange(len(points))  # characters from here to the word's end
    place = (np.arange(len(points)) - begins[owner]).astype(np.uint64)
    with np.errstate(over="ignore"):
        whole = np.add.reduceat(_mixed(points + place * np.uint64(0x9E3779B97F4A7C15)), begins) if len(texts) else np.empty(0, np.uint64)
        hashes, owners = [_mixed(whole)], [np.arange(len(texts))]
        run = points.copy()
        for n in range(1, max(GRAMS)):
            run = run[:-1] * np.uint64(0x100000001B3) ^ points[n:]
            if n + 1 in GRAMS:
                inside = np.flatnonzero(left[: len(run)] > n)
                hashes.append(_mixed(run[inside] + np.uint64(n)))
                owners.append(owner[inside])
    return (np.concatenate(hashes) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32), np.concatenate(owners)


def normal(word: str) -> str:
    """Lower case without punctuation at the edges."""
    return word.lower().strip(_EDGES) or word.lower()


def words_of(text: str | None) -> list[str]:
    """Words of a text; a run without spaces that is too long for a word counts as its overlapping pieces."""
    words = (text or "").split()
    if not words or max(map(len, words)) <= LONG:
        return words
    return [p for w in words for p in ([w] if len(w) <= LONG else [w[i : i + PIECE] for i in range(0, len(w) - PIECE + STEP, STEP)])]


def _windows(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the windows over n words; a short text is one window."""
    starts = np.arange(0, max(1, n - WINDOW + STRIDE), STRIDE)
    return starts, np.minimum(starts + WINDOW, n)


@dataclass
class Model:
    """Word contributions to the logit follow from ``u``: the embeddings times the softmax's difference."""

    u: np.ndarray
    bias: float
    slope: float
    shift: float
    prior: float

    def scorer(self):
        return _Scorer(self)


class _Scorer:
    """Logits of texts, with the contributions of words seen lately."""

    limit = 400_000

    def __init__(self, model: Model):
        self.model = model
        self.known: dict[str, float] = {}
        self.plain: dict[str, float] = {}

    def learn(self, words: set[str]) -> None:
        """Contributions of those words that are not known, all worked out together."""
        if len(self.known) > self.limit:
            self.known.clear()
            self.plain.clear()
        names = {w: normal(w) for w in words.difference(self.known)}
        every = list(set(names.values()).difference(self.plain))
        for i in range(0, len(every), TOGETHER):
            new = every[i : i + TOGETHER]
            bucket, owner = subwords(new)
            means = np.bincount(owner, self.model.u[bucket], len(new)) / np.bincount(owner, minlength=len(new))
            self.plain.update(zip(new, means.tolist(), strict=True))
        self.known.update((w, self.plain[n]) for w, n in names.items())

    def logits(self, texts: list[str | None]) -> list[float | None]:
        """The most toxic window's logit of each text; none for a text without words."""
        split = [words_of(t) for t in texts]
        self.learn(set(chain.from_iterable(split)))
        return [self._logit(words) if words else None for words in split]

    def _logit(self, words: list[str]) -> float:
        total = np.cumsum(np.fromiter(map(self.known.__getitem__, words), np.float64, len(words)))
        total = np.concatenate([[0.0], total])
        starts, ends = _windows(len(words))
        return float(((total[ends] - total[starts]) / (ends - starts)).max()) + self.model.bias

    def scores(self, texts: list[str | None]) -> list[float]:
        slope, shift = self.model.slope, self.model.shift
        return [self.model.prior if z is None else 1 / (1 + math.exp(-min(500.0, max(-500.0, slope * z + shift)))) for z in self.logits(texts)]


def _marked(words: list[str], keep: np.ndarray) -> dict[str, bool]:
    """Which words have a subword that is kept."""
    names = {w: normal(w) for w in words}
    plain = sorted(set(names.values()))
    bucket, owner = subwords(plain)
    hit = dict(zip(plain, np.bincount(owner, keep[bucket], len(plain)) > 0, strict=True))
    return {w: hit[n] for w, n in names.items()}


def _presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, label, bucket, n): how many whole texts hold each subword's bucket; bucket -1 counts the texts."""
    counts: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        split = [list(set(map(normal, words_of(t)))) for t in batch.column("text").to_pylist()]
        names = sorted(set(chain.from_iterable(split)))
        place = {w: i for i, w in enumerate(names)}
        bucket, owner = subwords(names)
        order = np.argsort(owner, kind="stable")
        cuts = np.searchsorted(owner[order], np.arange(len(names) + 1))
        bucket = bucket[order]
        for part, label, words in zip(batch.column("part").to_pylist(), batch.column("label").to_pylist(), split, strict=True):
            n = counts.setdefault((part, label), np.zeros(BUCKETS + 1, np.int64))
            n[-1] += 1
            if words:
                at = [place[w] for w in words]
                n[np.unique(np.concatenate([bucket[cuts[i] : cuts[i + 1]] for i in at]))] += 1
    for (part, label), n in counts.items():
        seen = np.flatnonzero(n)
        columns = (pa.array(np.full(len(seen), part), pa.int32()), pa.array(np.full(len(seen), label), pa.int32()), pa.array(np.where(seen == BUCKETS, -1, seen), pa.int32()), pa.array(n[seen]))
        yield pa.RecordBatch.from_arrays(list(columns), ["part", "label", "bucket", "n"])


def telling(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int, least_texts: int = 3, evidence: float = 20.0, ratio: float = 2.0) -> np.ndarray:
    """Buckets that toxic texts hold more often, beyond chance: by the log-likelihood ratio of two shares.

    By accident a bucket reaches ``evidence`` once in 250,000 times, so among all buckets hardly one does.
    """
    a, b = toxic.astype(float), clean.astype(float)
    total = max(1, n_toxic + n_clean)

    def term(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return seen * np.log(np.maximum(seen, 1e-12) / np.maximum(expected, 1e-12))

    held = (a + b) / total
    g2 = 2 * (term(a, n_toxic * held) + term(b, n_clean * held) + term(n_toxic - a, n_toxic * (1 - held)) + term(n_clean - b, n_clean * (1 - held)))
    more = a / max(1, n_toxic) >= ratio * b / max(1, n_clean)
    return more & (a >= least_texts) & (g2 >= evidence)


def _training_windows(keep: np.ndarray):
    """Every window of every text that holds a kept subword, as its size and the words that hold one, and for each text one window without any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            split = [words_of(t) for t in batch.column("text").to_pylist()]
            marked = _marked(list(set(chain.from_iterable(split))), keep)
            rows: list[tuple] = []
            for i, part, label, words in zip(*(batch.column(c).to_pylist() for c in ("id", "part", "label")), split, strict=True):
                told = [normal(w) if marked[w] else None for w in words]
                hits = np.concatenate([[0], np.cumsum(np.fromiter((w is not None for w in told), np.int64, len(told)))])
                starts, ends = _windows(len(words))
                rows.append((i, part, label, 1, ""))
                for j in np.flatnonzero(hits[ends] > hits[starts]).tolist():
                    a, b = int(starts[j]), int(ends[j])
                    rows.append((i, part, label, b - a, " ".join(w for w in told[a:b] if w is not None)))
            columns = zip(*rows, strict=True) if rows else ((),) * 5
            types = (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["id", "part", "label", "size", "words"])

    return run


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    test_fold: int | None = 0, max_texts: int = 1600, seed: int = 11, parts: int = 5,
) -> Model:
    """Fit on at most ``max_texts`` toxic and twice as many clean texts, all of them whole.

    Subwords that toxic texts hold more often beyond chance are kept; all others keep the
    zero vector, so few labels teach little rather than noise.  Windows without a kept
    subword are all alike and count once for each text.  The answer is calibrated across
    ``parts`` parts of the texts: each is scored by a model that selected and learned from
    the others, at the labels' own shares.  Rows whose id falls in ``test_fold`` (crc32 of
    the id as text, modulo 5) are never read for training.  The sample takes the smallest
    hashes of ids, so it does not depend on the order of rows.  Rows with a null id, text or
    label teach nothing; of a repeated id the toxic label counts, with each of its texts.
    With fewer than two labels, or without any telling subword, the model always answers
    the toxic share (0 without any).
    """
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    if test_fold is not None:
        known = known.where(fold(F.col(id_col)) != test_fold)
    known = known.groupBy(id_col).agg(F.max(label_col).cast("int").alias("label"))
    order = F.xxhash64(F.col(id_col), F.lit(seed))
    drawn = [known.where(F.col("label") == y).orderBy(order, id_col).limit(n) for y, n in ((1, max_texts), (0, 2 * max_texts))]
    # At most 3 * max_texts ids.
    sample = F.broadcast(drawn[0].unionByName(drawn[1]))
    texts = docs.select(F.col(id_col), F.col(text_col).alias("text")).where("text is not null").join(sample, id_col)
    part = F.pmod(F.xxhash64(id_col, F.lit(seed + 1)), F.lit(parts)).cast("int")
    texts = texts.select(F.col(id_col).cast("string").alias("id"), part.alias("part"), "label", "text")
    seen = texts.mapInArrow(_presence, "part int, label int, bucket int, n bigint").groupBy("part", "label", "bucket").agg(F.sum("n").alias("n"))
    # At most BUCKETS rows, each a subword's texts by part and label.
    cells = [F.coalesce(F.sum(F.when((F.col("part") == p) & (F.col("label") == y), F.col("n"))), F.lit(0)).cast("int").alias(f"n{p}_{y}") for p in range(parts) for y in (0, 1)]
    table = seen.groupBy("bucket").agg(*cells).toPandas()
    counts = np.zeros((BUCKETS + 1, parts, 2), np.int64)
    if len(table):
        counts[table["bucket"].to_numpy()] = table.drop(columns="bucket").to_numpy().reshape(-1, parts, 2)
    keeps = [_kept(np.delete(counts, p, axis=1)) for p in range(parts)]
    whole = _kept(counts)
    n = counts[-1].sum(0)
    share = float(n[1] / max(1, n.sum()))
    every = whole | np.logical_or.reduce(keeps)
    rows = texts.mapInArrow(_training_windows(every), "id string, part int, label int, size int, words string").toPandas() if every.any() else None
    if rows is None or share in (0.0, 1.0):
        return constant(_share(known))
    rows = rows.sort_values(["id", "size", "words"], kind="stable")
    windows = Windows(rows["id"].to_numpy(), rows["label"].to_numpy(), rows["size"].to_numpy(), [w.split(" ") if w else [] for w in rows["words"]])
    part = rows["part"].to_numpy()
    logits, answers = [], []
    for p, keep in enumerate(keeps):
        held = windows.of(part == p)
        logits.append(held.logits(windows.of(part != p).fit(keep, seed)))
        answers.append(held.answers())
    model = windows.fit(whole, seed)
    z, y = np.concatenate(logits), np.concatenate(answers)
    prior = _share(known)
    model.prior = prior * 0.5
    # Both labels weigh as much as they occur, however many texts of each were drawn.
    weight = np.where(y > 0, prior / max(1e-9, y.mean()), (1 - prior) / max(1e-9, 1 - y.mean()))
    return calibrated(model, z, y, weight)


def _kept(counts: np.ndarray) -> np.ndarray:
    by_label = counts.sum(1)
    return telling(by_label[:-1, 1], by_label[:-1, 0], *by_label[-1, ::-1].tolist())


def _share(known: DataFrame) -> float:
    return float(known.agg(F.avg("label")).first()[0] or 0.0)


def constant(share: float) -> Model:
    """A model that always answers ``share``."""
    odds = min(40.0, max(-40.0, math.log(max(share, 1e-18) / max(1 - share, 1e-18))))
    return Model(np.zeros(BUCKETS), 0.0, 0.0, odds, share)


def calibrated(model: Model, logits: np.ndarray, labels: np.ndarray, weights: np.ndarray | None = None) -> Model:
    """Sets the model's slope and shift by texts' logits."""
    model.slope, model.shift = _platt(logits, labels, np.ones(len(labels)) if weights is None else weights)
    return model


class Windows:
    """Training windows of texts: their sizes and the words in them that may tell something."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, sizes: np.ndarray, words: list[list[str]]):
        self.labels, self.sizes = labels.astype(np.float64), sizes.astype(np.float32)
        self.text = np.unique(ids, return_inverse=True)[1]
        names: dict[str, int] = {}
        self.word = np.fromiter((names.setdefault(w, len(names)) for x in words for w in x), np.int64)
        self.owner = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
        self.bucket, self.gram_of = subwords(list(names))
        self.grams = np.bincount(self.gram_of, minlength=len(names)).astype(np.float32)

    def of(self, chosen: np.ndarray) -> Windows:
        """Some of the windows; words keep their numbers."""
        out = object.__new__(Windows)
        number = np.cumsum(chosen) - 1
        held = chosen[self.owner]
        out.labels, out.sizes, out.text = self.labels[chosen], self.sizes[chosen], np.unique(self.text[chosen], return_inverse=True)[1]
        out.word, out.owner = self.word[held], number[self.owner[held]]
        out.bucket, out.gram_of, out.grams = self.bucket, self.gram_of, self.grams
        return out

    def _best(self, values: np.ndarray) -> np.ndarray:
        out = np.full(self.text.max(initial=-1) + 1, -np.inf)
        np.maximum.at(out, self.text, values)
        return out

    def answers(self) -> np.ndarray:
        """Label of each text."""
        return self._best(self.labels)

    def logits(self, model: Model) -> np.ndarray:
        """The most toxic window's logit of each text, as the scorer has it."""
        word = np.bincount(self.gram_of, model.u[self.bucket], len(self.grams)) / self.grams
        return self._best(np.bincount(self.owner, word[self.word], len(self.sizes)) / self.sizes + model.bias)

    def fit(self, keep: np.ndarray, seed: int = 11, epochs: int = 60, warm: int = 8, decay: float = 1e-5) -> Model:
        """Joint full-batch training of embeddings and softmax by Adam.

        After ``warm`` rounds on all windows only the most toxic window of a toxic text
        stands for it, as most others are clean; clean texts count with all their windows.
        Subwords outside ``keep`` have the zero vector.
        """
        y, text_of = self.labels, self.text
        share = float(np.mean(y)) if len(y) else 0.0
        told = keep[self.bucket]
        seen = np.zeros(len(self.grams), bool)
        seen[self.word] = True
        told &= seen[self.gram_of]
        if share in (0.0, 1.0) or not told.any():
            return constant(share)
        # Only kept subwords, words that hold one and windows that hold such a word have vectors other than zero.
        order = np.argsort(self.gram_of[told], kind="stable")
        words, gowner = np.unique(self.gram_of[told][order], return_inverse=True)
        used, gflat = np.unique(self.bucket[told][order], return_inverse=True)
        number = np.full(len(self.grams), -1)
        number[words] = np.arange(len(words))
        flat = number[self.word]
        live, owner = np.unique(self.owner[flat >= 0], return_inverse=True)
        flat = flat[flat >= 0]
        gsizes, lengths = self.grams[words][:, None], self.sizes[live][:, None]
        by_word, by_gram = (np.argsort(x, kind="stable") for x in (flat, gflat))
        cuts = lambda x, n: np.searchsorted(x, np.arange(n))
        word_cuts, gram_cuts = cuts(flat[by_word], len(words)), cuts(gflat[by_gram], len(used))
        window_cuts, name_cuts = cuts(owner, len(live)), cuts(gowner, len(words))
        rng = np.random.default_rng(seed)
        emb = rng.normal(0, 0.1, (len(used), DIM)).astype(np.float32)
        soft, bias = rng.normal(0, 0.1, (DIM, 2)).astype(np.float32), np.zeros(2, np.float32)
        state = [(np.zeros_like(p), np.zeros_like(p)) for p in (emb, soft, bias)]
        active = np.ones(len(y))
        mean = np.zeros((len(y), DIM), np.float32)
        for step in range(1, epochs + 1):
            word = np.add.reduceat(emb[gflat], name_cuts) / gsizes
            mean[live] = np.add.reduceat(word[flat], window_cuts) / lengths
            logits = mean @ soft + bias
            logit = (logits[:, 1] - logits[:, 0]).astype(np.float64)
            if step > warm:
                active = np.where((y == 0) | (logit == self._best(logit)[text_of]), 1.0, 0.0)
            weight = active * np.where(y > 0, 0.5 / (active * y).sum(), 0.5 / (active * (1 - y)).sum())
            p = 1 / (1 + np.exp(np.clip(-logit, -60, 60)))
            g1 = (weight * (p - y)).astype(np.float32)
            g = np.stack([-g1, g1], 1)
            d_mean = (g[live] @ soft.T) / lengths
            d_word = np.add.reduceat(d_mean[owner[by_word]], word_cuts) / gsizes
            d_emb = np.add.reduceat(d_word[gowner[by_gram]], gram_cuts) + decay * emb
            for param, grad, (m, v) in zip((emb, soft, bias), (d_emb, mean.T @ g, g.sum(0)), state, strict=True):
                m += 0.1 * (grad - m)
                v += 0.01 * (grad * grad - v)
                param -= 0.08 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
        u = np.zeros(BUCKETS)
        u[used] = emb @ (soft[:, 1] - soft[:, 0])
        return Model(u.astype(np.float32), float(bias[1] - bias[0]), 1.0, 0.0, share * 0.5)


def _platt(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Logistic slope and shift by Newton steps, with a small penalty so that separable texts end too."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -60, 60)))
        w = weight * (p * (1 - p) + 1e-6)
        g = np.array([(weight * (p - y) * z).sum() + 0.01 * a, (weight * (p - y)).sum()])
        h = np.array([[(w * z * z).sum() + 0.01, (w * z).sum()], [(w * z).sum(), w.sum()]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2.0 / max(1e-12, np.abs(step).max()))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return (float(a), float(b)) if a > 0 else (1.0, 0.0)


def _scores(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for batch in batches:
            names = [n for n in batch.schema.names if n != "__text"]
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                scores = scorer.scores(part.column("__text").to_pylist())
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), pa.array(scores, pa.float64())], [*names, "__score"])

    return run


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score", keep_text: bool = True) -> DataFrame:
    """Every row with its score from 0 to 1; null, empty and blank texts get half the training share.

    No row is dropped and no column but the text (unless kept) and a former ``score_col`` is
    lost, whatever its name.  Equal texts have equal scores; rows with null or repeated ids
    are scored like any other; an empty table stays empty.
    """
    names = [c for c in docs.columns if c != score_col and (keep_text or c != text_col)]
    quoted = lambda c: "`" + c.replace("`", "``") + "`"
    inner = docs.select(*(docs[quoted(c)].alias(f"c{i}") for i, c in enumerate(names)), F.col(text_col).alias("__text"))
    schema = ", ".join(f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(names)) + ", __score double"
    scored = inner.mapInArrow(_scores(model), schema)
    return scored.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(names)), F.col("__score").alias(score_col))
