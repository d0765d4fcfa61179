"""Bigram language-model scores by deleted interpolation.

A token's probability mixes the maximum-likelihood bigram, the unigram and the uniform
estimate.  The mixture weights depend on how often the context was seen (one set of weights
for each power of two) and are learned by expectation-maximisation on held-out counts: one
fold of the training texts is deleted from the counts and predicted from the others.

Counts are exact and cover all training texts.  Texts are dealt to blocks of bounded size
by a hash.  A block asks for each of its distinct n-grams once, in arrays sorted by hash;
the partition that owns a range of hashes adds up all blocks' counts and answers in the
same order, so answers need no keys.  Frequent n-grams cost one entry a block, however
often they occur, and no vocabulary is ever held in one place.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table
from .minhash import WordHashes, words_of

BLOCK_BYTES = 12 << 20
FOLDS, TEST_FOLD, WEIGHT_FOLD = 5, 1, 0
#: Context-frequency buckets: unseen, then one for each power of two.
BUCKETS = 24
_BEGIN = np.uint64(0x5851F42D4C957F2D)
_STEP, _LEVELS = 4, 160
_ANSWERS = "block int, part int, kind int, everything binary, held binary, tokens bigint, types bigint, texts bigint"
UNIGRAM, BIGRAM = 0, 1


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (a ^ np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9) + b
        x ^= x >> np.uint64(30)
        x *= np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _pack_counts(counts: np.ndarray) -> bytes:
    """One byte each where that is enough, else four; the first byte tells."""
    small = not len(counts) or counts.max() < 256
    return (b"\1" if small else b"\4") + counts.astype("u1" if small else "<u4").tobytes()


def _unpack_counts(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "u1" if raw[:1] == b"\1" else "<u4", offset=1).astype(np.int64)


def _pack_keys(keys: np.ndarray) -> bytes:
    """Differences of sorted keys by byte position: the high positions are zeros that the shuffle's compression removes."""
    gaps = np.diff(keys, prepend=np.uint64(0))
    return gaps.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpack_keys(raw: bytes) -> np.ndarray:
    gaps = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view("<u8").ravel()
    return np.cumsum(gaps, dtype=np.uint64)


class _Block:
    """Tokens of a block's texts: hashes of words, one end token a text, and their contexts."""

    def __init__(self, rows: pa.Table, hashes: WordHashes):
        words: list[bytes] = []
        sizes = np.zeros(rows.num_rows, np.int64)
        for i, text in enumerate(rows.column("text").cast(pa.binary()).to_pylist()):
            before = len(words)
            words += words_of(text or b"")
            words.append(b"")
            sizes[i] = len(words) - before
        self.word = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
        self.sizes, self.starts = sizes, np.cumsum(sizes) - sizes
        self.fold = np.array([zlib.crc32(str(i).encode()) % FOLDS if i is not None else -1 for i in rows.column("fold_id").to_pylist()], np.int64)
        self.context = np.concatenate([[_BEGIN], self.word[:-1]])
        self.context[self.starts] = _BEGIN

    def grams(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Kind, sorted distinct hashes, and each token's place among them."""
        keys, at = np.unique(self.word, return_inverse=True)
        self.types, self.type_of = keys, at
        yield UNIGRAM, keys, at
        keys, pair = np.unique(_mix(self.context, self.word), return_inverse=True)
        yield BIGRAM, keys, pair


def _ask(shift: int):
    def run(key, rows):
        block = _Block(rows, WordHashes())
        train = np.repeat((block.fold != TEST_FOLD), block.sizes)
        held = np.repeat((block.fold == WEIGHT_FOLD), block.sizes)
        out = {n: [] for n in ("block", "part", "kind", "keys", "everything", "held", "texts", "held_texts")}
        for kind, keys, at in block.grams():
            everything = np.bincount(at[train], minlength=len(keys))
            deleted = np.bincount(at[held], minlength=len(keys))
            part = (keys >> np.uint64(shift)).astype(np.int64) if shift < 64 else np.zeros(len(keys), np.int64)
            names, begins = np.unique(part, return_index=True)
            for p, a, b in zip(names, begins, [*begins[1:], len(keys)], strict=True):
                for n, v in (("block", key[0].as_py()), ("part", int(p)), ("kind", kind), ("keys", _pack_keys(keys[a:b])), ("everything", _pack_counts(everything[a:b])), ("held", _pack_counts(deleted[a:b]))):
                    out[n].append(v)
                first = kind == UNIGRAM and not out["texts"]
                out["texts"].append(int((block.fold != TEST_FOLD).sum()) if first else 0)
                out["held_texts"].append(int((block.fold == WEIGHT_FOLD).sum()) if first else 0)
        types = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64())
        return pa.table({n: pa.array(v, t) for (n, v), t in zip(out.items(), types, strict=True)})

    return run


def _answer(key, rows):
    """Totals of a part's n-grams, in the order in which each block asked; totals of the part in rows without a block."""
    part = key[0].as_py()
    out: list[tuple] = []
    for kind in (UNIGRAM, BIGRAM):
        asked = rows.filter(pa.compute.equal(rows.column("kind"), kind)).to_pylist()
        if not asked:
            continue
        keys = [_unpack_keys(r["keys"]) for r in asked]
        names, at = np.unique(np.concatenate(keys), return_inverse=True)
        counts = [np.bincount(at, np.concatenate([_unpack_counts(r[c]) for r in asked]), len(names)).astype(np.int64) for c in ("everything", "held")]
        everything, held = counts
        if kind == UNIGRAM:
            texts, held_texts = (sum(r[c] for r in asked) for c in ("texts", "held_texts"))
            out.append((-1, part, 0, None, None, int(everything.sum()), int((everything > 0).sum()), texts))
            rest = everything - held
            out.append((-1, part, 1, None, None, int(rest.sum()), int((rest > 0).sum()), texts - held_texts))
        end = 0
        for r, k in zip(asked, keys, strict=True):
            mine, end = at[end : end + len(k)], end + len(k)
            own = _unpack_counts(r["held"]) > 0
            out.append((r["block"], part, kind, _pack_counts(everything[mine]), None, 0, 0, 0))
            if own.any():
                out.append((r["block"], part, kind + 2, _pack_counts(everything[mine[own]]), _pack_counts(held[mine[own]]), 0, 0, 0))
    types = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
    names = [c.split()[0] for c in _ANSWERS.split(", ")]
    return pa.table({n: pa.array([r[i] for r in out], t) for i, (n, t) in enumerate(zip(names, types, strict=True))})


def _joined(answers: pa.Table, kind: int, column: str) -> np.ndarray:
    rows = sorted((p, b) for p, k, b in zip(answers.column("part").to_pylist(), answers.column("kind").to_pylist(), answers.column(column).to_pylist(), strict=True) if k == kind)
    return np.concatenate([_unpack_counts(b) for _, b in rows]) if rows else np.empty(0, np.int64)


def _estimates(block: _Block, uni: np.ndarray, bi: np.ndarray, totals: dict):
    """Context bucket and the three estimates of every token, and the token's own count."""
    grams = {kind: (keys, at) for kind, keys, at in block.grams()}
    (types, at), (_, pair) = grams[UNIGRAM], grams[BIGRAM]
    count = uni[at]
    before = np.concatenate([[0], count[:-1]])
    before[block.starts] = totals["texts"]
    both = bi[pair]
    f2 = both / np.maximum(before, 1)
    f1 = count / max(1, totals["tokens"])
    bucket = np.minimum(BUCKETS - 1, np.where(before > 0, np.floor(np.log2(np.maximum(before, 1))).astype(np.int64) + 1, 0))
    return bucket, f2, f1, 1.0 / (totals["types"] + 1), count


def _level(ratio: np.ndarray) -> np.ndarray:
    """Quarter powers of two of a ratio to the uniform estimate; 0 for none."""
    with np.errstate(divide="ignore"):
        level = np.round(np.log2(ratio) * _STEP) + 40
    return np.where(ratio > 0, np.clip(level, 1, _LEVELS - 1), 0).astype(np.int64)


def _held_counts(totals: dict):
    def run(key, rows, answers):
        cells, n = np.empty(0, np.int64), np.empty(0, np.int64)
        if rows.num_rows and answers.num_rows:
            block = _Block(rows, WordHashes())
            uni, bi = (_joined(answers, kind + 2, "everything") - _joined(answers, kind + 2, "held") for kind in (UNIGRAM, BIGRAM))
            bucket, f2, f1, f0, _ = _estimates(block, uni, bi, totals)
            cells, n = np.unique((bucket * _LEVELS + _level(f2 / f0)) * _LEVELS + _level(f1 / f0), return_counts=True)
        return pa.table({"cell": pa.array(cells, pa.int64()), "n": pa.array(n, pa.int64())})

    return run


def learn_weights(cells: np.ndarray, n: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Weights (bigram, unigram, uniform) of each context bucket by expectation-maximisation.

    ``cells`` number the buckets and both estimates' levels; ``n`` are held-out counts.
    Buckets without counts take all buckets' weights.
    """
    value = lambda level: np.where(level > 0, 2.0 ** ((level - 40) / _STEP), 0.0)
    bucket, rest = np.divmod(cells, _LEVELS * _LEVELS)
    f = np.stack([value(rest // _LEVELS), value(rest % _LEVELS), np.ones(len(cells))], 1)

    def mixed(f, n, unseen):
        w = np.array([0.0, 0.6, 0.4] if unseen else [0.4, 0.4, 0.2])
        for _ in range(rounds):
            share = f * w
            share /= share.sum(1, keepdims=True)
            w = (share * n[:, None]).sum(0) / n.sum()
        w = np.maximum(w, [0.0 if unseen else 1e-9, 1e-9, 1e-9])
        return w / w.sum()

    common = mixed(f, n, False) if len(cells) else np.array([0.4, 0.4, 0.2])
    out = np.tile(common, (BUCKETS, 1))
    out[0] = np.array([0.0, *(common[1:] / common[1:].sum())])
    for b in np.unique(bucket):
        own = bucket == b
        out[b] = mixed(f[own], n[own], b == 0)
    return out


def _scored(totals: dict, weights: np.ndarray, id_type: pa.DataType):
    def run(key, rows, answers):
        names = ("n_tokens", "n_known", "base_score", "score")
        if not rows.num_rows:
            return pa.table({"id": pa.array([], id_type), **{n: pa.array([], pa.int64() if n[:2] == "n_" else pa.float64()) for n in names}})
        block = _Block(rows, WordHashes())
        bucket, f2, f1, f0, count = _estimates(block, _joined(answers, UNIGRAM, "everything"), _joined(answers, BIGRAM, "everything"), totals)
        w = weights[bucket]
        model = np.log10(w[:, 0] * f2 + w[:, 1] * f1 + w[:, 2] * f0)
        base = np.log10((count + 0.5) / (totals["tokens"] + 0.5 * (totals["types"] + 1)))
        add = lambda x: np.add.reduceat(x, block.starts)
        return pa.table({"id": rows.column("id"), "n_tokens": pa.array(block.sizes), "n_known": pa.array(add((count > 0).astype(np.int64))), "base_score": pa.array(add(base)), "score": pa.array(add(model))})

    return run


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, held_out, n_tokens, n_known, train_tokens, base_score, score``, one row per input row.

    Texts whose id's crc32 modulo 5 is 1 are held out; the model and the base learn from all
    others.  Null and empty texts are one end token.  A null id belongs to no fold: its text
    is learned from and ``held_out`` is null.  Rows that repeat an id count each.  Without training texts all
    estimates are uniform.  Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = docs.agg(F.sum(F.octet_length(text)).alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    blocks = max(1, -(-((size["bytes"] or 0) + 16 * size["n"]) // BLOCK_BYTES))
    bits = min(31, int(blocks - 1).bit_length())
    base = docs.select(
        F.col(id_col).alias("id"), F.col(id_col).cast("string").alias("fold_id"), text.alias("text"),
        F.pmod(F.xxhash64(id_col, text), F.lit(blocks)).cast("int").alias("block"),
    )
    asked = base.groupBy("block").applyInArrow(
        _ask(64 - bits), "block int, part int, kind int, keys binary, everything binary, held binary, texts bigint, held_texts bigint"
    )
    answers = table(asked.groupBy("part").applyInArrow(_answer, _ANSWERS))
    sums = answers.where("block = -1").groupBy("kind").agg(F.sum("tokens").alias("tokens"), F.sum("types").alias("types"), F.sum("texts").alias("texts"))
    totals = {r["kind"]: r.asDict() for r in sums.collect()}
    none = {"tokens": 0, "types": 0, "texts": 0}
    deleted, whole = totals.get(1, none), totals.get(0, none)

    held = base.where(F.crc32("fold_id") % FOLDS == WEIGHT_FOLD)
    counts = held.groupBy("block").cogroup(answers.where("block >= 0 and kind >= 2").groupBy("block")).applyInArrow(_held_counts(deleted), "cell bigint, n bigint")
    # At most BUCKETS * _LEVELS ** 2 cells.
    found: pd.DataFrame = counts.groupBy("cell").agg(F.sum("n").alias("n")).orderBy("cell").toPandas()
    weights = learn_weights(found["cell"].to_numpy(np.int64), found["n"].to_numpy(np.float64))

    id_arrow = pa.int64() if id_type.simpleString() == "bigint" else pa.int32() if id_type.simpleString() == "int" else pa.string()
    scored = base.groupBy("block").cogroup(answers.where("block >= 0 and kind < 2").groupBy("block")).applyInArrow(
        _scored(whole, weights, id_arrow), f"id {id_type.simpleString()}, n_tokens bigint, n_known bigint, base_score double, score double"
    )
    return scored.select(
        F.col("id").alias(id_col),
        (F.crc32(F.col("id").cast("string")) % FOLDS == TEST_FOLD).alias("held_out"),
        "n_tokens", "n_known", F.lit(int(whole["tokens"] or 0)).cast("bigint").alias("train_tokens"), "base_score", "score",
    )
