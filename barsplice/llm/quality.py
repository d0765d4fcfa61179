"""Quality by nearest-neighbour voting among labelled latent-semantic vectors.

A text's terms are the shapes of its words (runs of capitals, small letters, digits and
each other character), pairs of neighbouring shapes, and marks of words that repeat what
stood before; they tell writing from junk in any language.  Terms of a bounded sample of
labelled texts are weighted, and their singular vectors span the latent space.  The sample's
vectors are broadcast; every text is compared with all of them in blocks of exact cosine
products, and its nearest ones vote with the weight of their similarity.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold

BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
#: Characters that are worked on together.
TOGETHER = 1 << 20
#: Texts whose cosines are taken together.
BLOCK = 256
#: Fixed classes; other characters are their own class behind these.
SPACE, UPPER, LOWER, DIGIT, OTHER = range(5)


@functools.cache
def _classes() -> np.ndarray:
    """Class of every code point of the first plane; those beyond are small letters, like letters without case."""
    out = np.full(1 << 16, LOWER, np.uint32)
    for i in range(1 << 16):
        c = chr(i)
        if c.isspace() or i < 32:
            out[i] = SPACE
        elif c.isdigit():
            out[i] = DIGIT
        elif c.isalpha():
            out[i] = UPPER if c.isupper() else LOWER
        else:
            out[i] = OTHER + i
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts) if len(starts) else np.empty(0, values.dtype)


def _pieces(texts: list[str]) -> Iterator[list[tuple[int, str]]]:
    """(text, piece) in lists of about TOGETHER characters; longer texts are cut at spaces (a run without any is cut anyway)."""
    held: list[tuple[int, str]] = []
    size = 0
    for i, text in enumerate(texts):
        a = 0
        while a < len(text):
            b = len(text)
            if b - a > TOGETHER:
                b = max(text.rfind(" ", a, a + TOGETHER), text.rfind("\n", a, a + TOGETHER)) + 1 or a + TOGETHER
                b = b if b > a else a + TOGETHER
            held.append((i, text[a:b]))
            size, a = size + b - a, b
            if size >= TOGETHER:
                yield held
                held, size = [], 0
    if held:
        yield held


def _words(pieces: list[tuple[int, str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, spelling, shape) of every word, the last two as hashes."""
    sizes = np.fromiter((len(t) for _, t in pieces), np.int64, len(pieces))
    points = np.frombuffer("".join(t for _, t in pieces).encode("utf-32-le", "surrogatepass"), "<u4")
    kind = np.where(points < 1 << 16, _classes()[np.minimum(points, (1 << 16) - 1)], LOWER)
    piece = np.repeat(np.arange(len(pieces)), sizes)
    at = np.flatnonzero(kind != SPACE)
    points, kind, piece = points[at].astype(np.uint64), kind[at], piece[at]
    new_word = (np.diff(at, prepend=-2) > 1) | (np.diff(piece, prepend=-1) != 0)
    begins = np.flatnonzero(new_word)
    word = np.cumsum(new_word) - 1
    run = np.flatnonzero(new_word | (np.diff(kind, prepend=kind[:1]) != 0))
    run_word = word[run]
    first = np.searchsorted(run_word, np.arange(len(begins)))
    place, nth = np.arange(len(points)) - begins[word], np.arange(len(run)) - first[run_word]
    with np.errstate(over="ignore"):
        spelled = _sums(_mixed(points + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), begins)
        length = np.minimum(np.diff(run, append=len(points)), 3).astype(np.uint64)
        shape = _sums(_mixed((kind[run].astype(np.uint64) << np.uint64(2)) + length + nth.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)), first)
    return np.fromiter((i for i, _ in pieces), np.int64, len(pieces))[piece[begins]], spelled, shape


def terms(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, share): the terms of every text with their share among its words, texts as numbers."""
    found = [_words(p) for p in _pieces(texts)]
    if not sum(len(f[0]) for f in found):
        return (np.empty(0, np.int64),) * 2 + (np.empty(0),)
    owner, spelled, shape = (np.concatenate(x) for x in zip(*found, strict=True))
    with np.errstate(over="ignore"):
        together = owner[1:] == owner[:-1]
        pair = _mixed(shape[:-1] * np.uint64(3) + shape[1:])[together]
        # Words in threes that stood in the text before, and words that repeat the last or the last but one.
        inside = owner[2:] == owner[:-2]
        three = _mixed(_mixed(spelled[:-2] * np.uint64(5) + spelled[1:-1]) * np.uint64(5) + spelled[2:])[inside]
        text_of_three = owner[2:][inside]
        seen = np.ones(len(three), bool)
        seen[np.unique(_mixed(three + text_of_three.astype(np.uint64)), return_index=True)[1]] = False
        once = owner[1:][together & (spelled[1:] == spelled[:-1])]
        twice = owner[2:][inside & (spelled[2:] == spelled[:-2])]
        marks = [(text_of_three[seen], 1), (once, 2), (twice, 3)]
        texts_of = np.concatenate([owner, owner[1:][together], *(m for m, _ in marks)])
        hashes = np.concatenate([_mixed(shape), pair, *(_mixed(np.full(len(m), k, np.uint64)) for m, k in marks)])
    bucket = (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    cells, count = np.unique(texts_of * BUCKETS + bucket, return_counts=True)
    which = cells // BUCKETS
    return which, cells % BUCKETS, count / np.bincount(owner, minlength=len(texts))[which]


@dataclass
class Model:
    """The latent space (``bucket`` -> column, weights, axes) and the labelled vectors in it."""

    column: np.ndarray
    weight: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    share: float
    neighbours: int
    power: float

    def project(self, texts: list[str]) -> np.ndarray:
        """Unit vectors of texts; zero without a known term."""
        which, bucket, share = terms(texts)
        return unit(weighted(which, self.column[bucket], share, self.weight, len(texts)) @ self.axes)

    def scores(self, texts: list[str]) -> np.ndarray:
        """The neighbours' labels, weighted by similarity."""
        if not len(self.vectors):
            return np.full(len(texts), self.share)
        out = np.empty(len(texts))
        for i in range(0, len(texts), BLOCK):
            part = texts[i : i + BLOCK]
            # Rounded, so that equal texts have equal neighbours wherever they stand in a block.
            cosines = np.round(self.project(part) @ self.vectors.T, 9)
            k = min(self.neighbours, cosines.shape[1])
            least = np.partition(cosines, -k, axis=1)[:, -k :][:, :1]
            votes = np.where(cosines >= np.maximum(least, 1e-9), np.maximum(cosines, 0.0), 0.0) ** self.power
            total = votes.sum(1)
            out[i : i + BLOCK] = np.where(total > 0, (votes @ self.labels + self.share * 1e-12) / (total + 1e-12), self.share)
        return np.clip(out, 0.0, 1.0)


def unit(x: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, size, out=np.zeros_like(x), where=size > 1e-12)


def weighted(which: np.ndarray, column: np.ndarray, share: np.ndarray, weight: np.ndarray, rows: int) -> np.ndarray:
    """Square roots of shares times the terms' weights; terms outside the space (column -1) are left out."""
    out = np.zeros((rows, len(weight)))
    there = column >= 0
    np.add.at(out, (which[there], column[there]), np.sqrt(share[there]))
    return out * weight


def fit(sample: list[tuple[int, np.ndarray, np.ndarray]], share: float, dims: int, most_terms: int, least_texts: int, neighbours: int, power: float) -> Model:
    """The space of (label, buckets, shares) and the voters in it: singular vectors of the weighted terms by an eigenproblem among terms."""
    labels = np.array([y for y, _, _ in sample], float)
    which = np.repeat(np.arange(len(sample)), [len(b) for _, b, _ in sample])
    bucket = np.concatenate([b for _, b, _ in sample]) if sample else np.empty(0, np.int64)
    shares = np.concatenate([s for _, _, s in sample]) if sample else np.empty(0)
    held = np.bincount(bucket, minlength=BUCKETS)
    chosen = np.argsort(-held, kind="stable")[:most_terms]
    chosen = chosen[held[chosen] >= least_texts]
    column = np.full(BUCKETS, -1)
    column[chosen] = np.arange(len(chosen))
    weight = 1 + np.log(len(sample) / np.maximum(held[chosen], 1))
    if not len(chosen):
        return Model(column, weight, np.zeros((0, 0)), np.zeros((0, 0)), labels, share, neighbours, power)
    x = unit(weighted(which, column[bucket], shares, weight, len(sample)))
    _, axes = np.linalg.eigh(x.T @ x)
    axes = axes[:, ::-1][:, :dims]
    return Model(column, weight, axes, unit(x @ axes), labels, share, neighbours, power)


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in _slices(batch, "text"):
            which, bucket, share = terms(part.column("text").to_pylist())
            cuts = np.searchsorted(which, np.arange(part.num_rows + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(cuts), pa.array(v, t)) for v, t in ((bucket, pa.int32()), (share, pa.float64()))]
            yield pa.RecordBatch.from_arrays([part.column("label"), part.column("key"), *lists], ["label", "key", "bucket", "share"])


def _slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about TOGETHER characters of text, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(sizes) - sizes) // TOGETHER
    cuts = np.flatnonzero(np.diff(part, prepend=-1))
    for a, b in zip(cuts, [*cuts[1:], len(sizes)], strict=True):
        yield batch.slice(int(a), int(b - a))


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", test_fold: int | None = 2, folds: int = 4,
    max_texts: int = 6000, dims: int = 64, most_terms: int = 1024, least_texts: int = 3, neighbours: int = 15, power: float = 4.0, seed: int = 5,
) -> Model:
    """Space and voters from at most ``max_texts`` labelled texts, all of them whole.

    Rows whose id falls in ``test_fold`` (crc32 of the id as text, modulo ``folds``) are
    never read for training.  The sample takes the smallest hashes of ids, so it keeps the
    labels' shares and does not depend on the order of rows.  Rows with a null id, text or
    label teach nothing; of a repeated id label 0 counts, with its smallest text by hash.
    Without labelled texts the model always answers the share of label 1 (0 without any).
    """
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    if test_fold is not None:
        known = known.where(fold(F.col(id_col), folds) != test_fold)
    known = known.groupBy(id_col).agg(F.min(label_col).cast("int").alias("label"))
    share = float(known.agg(F.avg("label")).first()[0] or 0.0)
    # At most max_texts ids.
    drawn = F.broadcast(known.orderBy(F.xxhash64(F.col(id_col), F.lit(seed)), id_col).limit(max_texts))
    texts = docs.select(id_col, F.col(text_col).alias("text")).where("text is not null").join(drawn, id_col)
    texts = texts.select("label", F.xxhash64(F.col(id_col), "text").alias("key"), F.col(id_col).cast("string").alias("id"), "text")
    held = texts.select("label", F.struct("id", "key").alias("key"), "text").mapInArrow(_sampled, "label int, key struct<id: string, key: bigint>, bucket array<int>, share array<double>")
    one = held.groupBy("key.id").agg(F.min_by(F.struct("label", "bucket", "share"), "key.key").alias("r"))
    rows = one.select("id", "r.*").toArrow().sort_by("id")  # at most max_texts rows of at most BUCKETS numbers
    sample = [(y, np.asarray(b, np.int64), np.asarray(s)) for y, b, s in zip(*(rows.column(c).to_pylist() for c in ("label", "bucket", "share")), strict=True)]
    return fit([r for r in sample if len(r[1])], share, dims, most_terms, least_texts, neighbours, power)


def _scores(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = model.value
        for batch in batches:
            names = [n for n in batch.schema.names if n != "__text"]
            for part in _slices(batch, "__text"):
                scores = voters.scores(pc.fill_null(part.column("__text"), "").to_pylist())
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), pa.array(scores)], [*names, "__score"])

    return run


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score", keep_text: bool = True) -> DataFrame:
    """Every row with its score from 0 to 1; null, empty and blank texts and those without a known term get the labels' share.

    No row is dropped and no column but the text (unless kept) and a former ``score_col`` is
    lost, whatever its name.  Equal texts have equal scores; rows with null or repeated ids
    are scored like any other; an empty table stays empty.  Tasks share the voters: at most
    ``max_texts`` vectors.
    """
    names = [c for c in docs.columns if c != score_col and (keep_text or c != text_col)]
    quoted = lambda c: "`" + c.replace("`", "``") + "`"
    inner = docs.select(*(docs[quoted(c)].alias(f"c{i}") for i, c in enumerate(names)), F.col(text_col).alias("__text"))
    schema = ", ".join(f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(names)) + ", __score double"
    shared = docs.sparkSession.sparkContext.broadcast(model)
    scored = inner.mapInArrow(_scores(shared), schema)
    return scored.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(names)), F.col("__score").alias(score_col))
