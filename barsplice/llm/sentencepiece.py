"""SentencePiece Unigram encoding and decoding.

A text's spaces become markers, one more stands before it, and the Viterbi path over its
pieces with the highest sum of log scores wins.  Pieces lie in a double-array trie.  As no
piece has a marker behind another character, a best path can always be cut before a run of
markers, so texts fall into words and each distinct word is segmented once; all words of a
batch walk the trie and the lattice together as arrays.  Characters without a piece become
byte pieces.

The vocabulary is read from a model file; a file with merge ranks in place of log
probabilities gets Zipf's law over the ranks.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: Kinds of pieces in a model file, and the penalty of an unknown character; fixed values.
NORMAL, UNKNOWN, USER, BYTE = 1, 2, 4, 6
UNIGRAM_MODEL, UNKNOWN_PENALTY = 1, 10.0
ZIPF_SHIFT = 2.7


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Number and value of each field of a serialized message."""
    i = 0

    def varint() -> int:
        nonlocal i
        value = shift = 0
        while True:
            byte = data[i]
            i += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while i < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            n = {1: 8, 5: 4}.get(key & 7) or varint()
            yield key >> 3, data[i : i + n]
            i += n


@dataclass
class Vocabulary:
    pieces: list[str]
    scores: np.ndarray
    kinds: np.ndarray
    prefix: bool = True
    trie: DoubleArray = field(init=False)

    def __post_init__(self):
        self.trie = DoubleArray({p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k in (NORMAL, USER)})
        self.unknown = np.float32(self.scores[np.isin(self.kinds, (NORMAL, USER))].min()) - np.float32(UNKNOWN_PENALTY)
        self.byte_id = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k == BYTE}
        self.unknown_id = int(np.flatnonzero(self.kinds == UNKNOWN)[0])
        if any(MARK in p.lstrip(MARK) for p, k in zip(self.pieces, self.kinds, strict=True) if k in (NORMAL, USER)):
            raise ValueError("a piece has a marker behind another character")

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, "rb") as f:
            message = list(_fields(f.read()))
        pieces, scores, kinds, model, prefix = [], [], [], UNIGRAM_MODEL, True
        for number, value in message:
            if number == 1:
                piece = dict(_fields(value))
                pieces.append(piece[1].decode())
                scores.append(struct.unpack("<f", piece[2])[0])
                kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                model = dict(_fields(value)).get(3, UNIGRAM_MODEL)
            elif number == 3:
                prefix = bool(dict(_fields(value)).get(3, 1))
        scores, kinds = np.array(scores), np.array(kinds)
        if model != UNIGRAM_MODEL:
            real = np.isin(kinds, (NORMAL, USER))
            rank = np.where(scores < -1e8, real.sum(), -scores)
            weight = 1 / (rank + ZIPF_SHIFT)
            scores = np.where(real, np.log(weight / weight[real].sum()), 0.0)
        return cls(pieces, scores.astype(np.float32), kinds, prefix)


class DoubleArray:
    """A trie as two arrays: the child of ``s`` by code ``c`` is ``base[s] + c`` if ``check`` there is ``s``."""

    def __init__(self, words: dict[str, int]):
        letters = sorted({c for w in words for c in w})
        self.code = {c: i + 1 for i, c in enumerate(letters)}
        self.longest = max(map(len, words), default=0)
        children: list[dict[int, int]] = [{}]
        values = [-1]
        for word, value in words.items():
            node = 0
            for c in word:
                node = children[node].setdefault(self.code[c], len(children))
                if node == len(children):
                    children.append({})
                    values.append(-1)
            values[node] = value
        size = 2 * (len(children) + len(letters)) + 2
        self.base, self.check, self.value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        free = np.ones(size, bool)
        free[0] = False
        self.check[0] = 0
        # Branching nodes go where ``cursor`` has come to, single children fill the gaps from ``low`` on.
        low, cursor, queue = 1, 1, [(0, 0)]
        while queue:
            following = []
            for node, at in queue:
                self.value[at] = values[node]
                codes = np.array(sorted(children[node]), np.int64)
                if not len(codes):
                    continue
                if len(codes) == 1:
                    while not free[low]:
                        low += 1
                    base = low - int(codes[0])
                else:
                    base = cursor
                while True:
                    if base + int(codes[-1]) >= len(free):
                        more = len(free)
                        free = np.concatenate([free, np.ones(more, bool)])
                        self.base = np.concatenate([self.base, np.zeros(more, np.int32)])
                        self.check, self.value = (np.concatenate([x, np.full(more, -1, np.int32)]) for x in (self.check, self.value))
                    if free[base + codes].all():
                        break
                    base += 1
                cursor = cursor if len(codes) == 1 else base
                self.base[at] = base
                free[base + codes] = False
                self.check[base + codes] = at
                following += [(children[node][int(c)], base + int(c)) for c in codes]
            queue = following
        pad = len(letters) + 1
        self.base = np.concatenate([self.base, np.zeros(pad, np.int32)])
        self.check, self.value = (np.concatenate([x, np.full(pad, -1, np.int32)]) for x in (self.check, self.value))

        self.code_of = np.zeros(max(map(ord, letters), default=0) + 2, np.int32)
        self.code_of[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)

    def codes(self, points: np.ndarray) -> np.ndarray:
        """Code of each code point; 0 if no word holds it."""
        return self.code_of[np.minimum(points, len(self.code_of) - 1)]


def segment(vocabulary: Vocabulary, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best paths of words (none empty): all ids in one array, ids of each word, and scores."""
    trie = vocabulary.trie
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    codes = np.concatenate([trie.codes(points), np.zeros(trie.longest, np.int32)])
    begins = np.cumsum(sizes) - sizes
    word_of = np.repeat(np.arange(len(words)), sizes)
    ends = (begins + sizes)[word_of]
    # All matches, from all places at once.
    at, state = np.arange(len(points)), np.zeros(len(points), np.int64)
    starts, stops, ids = [], [], []
    single = np.zeros(len(points), bool)
    for depth in range(trie.longest):
        go = at + depth < ends[at]
        at, state = at[go], state[go]
        c = codes[at + depth]
        child = trie.base[state] + c
        go = (c > 0) & (trie.check[child] == state)
        at, state = at[go], child[go]
        if not len(at):
            break
        hit = trie.value[state] >= 0
        starts.append(at[hit])
        stops.append(at[hit] + depth + 1)
        ids.append(trie.value[state[hit]])
        if depth == 0:
            single[at[hit]] = True
    lone = np.flatnonzero(~single)
    starts.append(lone)
    stops.append(lone + 1)
    ids.append(np.full(len(lone), vocabulary.unknown_id, np.int32))
    start, stop, ident = np.concatenate(starts), np.concatenate(stops), np.concatenate(ids)
    gain = np.where(ident == vocabulary.unknown_id, vocabulary.unknown, vocabulary.scores[ident]).astype(np.float32)
    # The lattice, one step for each distance from a word's begin; ties go to the longest piece.
    reach = stop - begins[word_of[start]]
    order = np.argsort((reach * (len(points) + 1) + stop) * (trie.longest + 1) - np.minimum(stop - start, trie.longest))
    start, stop, ident, gain, reach = (x[order] for x in (start, stop, ident, gain, reach))
    # A word's end is the next one's begin: ``score`` of a begin is always 0.
    score, back = np.zeros(len(points) + 1, np.float32), np.zeros(len(points) + 1, np.int64)
    first = np.zeros(len(points) + 1, bool)
    first[begins] = True
    cuts = np.searchsorted(reach, np.arange(1, int(sizes.max()) + 2))
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        s, e = start[lo:hi], stop[lo:hi]
        value = np.where(first[s], np.float32(0), score[s]) + gain[lo:hi]
        heads = np.flatnonzero(np.concatenate([[True], e[1:] != e[:-1]]))
        top = np.maximum.reduceat(value, heads)
        owner = np.repeat(np.arange(len(heads)), np.diff([*heads, len(e)]))
        won = np.flatnonzero(value == top[owner])
        pick = won[np.concatenate([[True], owner[won[1:]] != owner[won[:-1]]])]
        back[e[pick]] = lo + pick
        score[e[pick]] = top
    # Back from all ends at once.
    who, place, step = np.arange(len(words)), begins + sizes, 0
    seen = []
    while len(who):
        edge = back[place]
        seen.append((who, np.full(len(who), step), edge))
        place = start[edge]
        more = place > begins[who]
        who, place, step = who[more], place[more], step + 1
    who, steps, edges = (np.concatenate([x[i] for x in seen]) for i in range(3))
    order = np.lexsort((-steps, who))
    who, edges = who[order], edges[order]
    path = ident[edges]
    unknown = np.flatnonzero(path == vocabulary.unknown_id) if vocabulary.byte_id else np.empty(0, np.int64)
    if len(unknown):
        raw = [chr(c).encode() for c in points[start[edges[unknown]]].tolist()]
        repeat = np.ones(len(path), np.int64)
        repeat[unknown] = [len(b) for b in raw]
        to = np.cumsum(repeat) - repeat
        who, path = np.repeat(who, repeat), np.repeat(path, repeat)
        for i, b in zip(to[unknown].tolist(), raw, strict=True):
            path[i : i + len(b)] = [vocabulary.byte_id[x] for x in b]
    return path.astype(np.int32), np.bincount(who, minlength=len(words)), score[begins + sizes].astype(np.float64)


class Encoder:
    """Texts to ids, with the segmentations of words seen lately."""

    limit = 400_000

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        line = "" if "\n" in vocabulary.trie.code else "\n"
        self.words = re.compile(f"{MARK}*[^{MARK}{line}]+|{MARK}+" + (f"|{line}" if line else "")).findall
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.ids, self.size, self.score = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0)

    def split(self, text: str) -> list[str]:
        if not text:
            return []
        return self.words((MARK if self.vocabulary.prefix else "") + text.replace(" ", MARK))

    def encode(self, texts: list[str], step: int = 1 << 21) -> Iterator[tuple[np.ndarray, float]]:
        """Ids and score of each text, worked out for about ``step`` characters at a time."""
        i = 0
        while i < len(texts):
            split, size = [], 0
            while i < len(texts) and (not split or size < step):
                split.append(self.split(texts[i]))
                size += len(texts[i])
                i += 1
            if len(self.place) > self.limit:
                self._forget()
            new = list(set(chain.from_iterable(split)).difference(self.place))
            if new:
                self.place.update(zip(new, range(len(self.place), len(self.place) + len(new)), strict=True))
                parts = segment(self.vocabulary, new)
                self.ids, self.size, self.score = (np.concatenate(x) for x in zip((self.ids, self.size, self.score), parts, strict=True))
            begins = np.cumsum(self.size) - self.size
            for words in split:
                at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
                n = self.size[at]
                yield self.ids[np.repeat(begins[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())], float(self.score[at].sum())


class Decoder:
    """Ids to text: runs of byte pieces are UTF-8 (wrong ones U+FFFD), markers spaces, the first one dropped."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.byte = {i: b for b, i in vocabulary.byte_id.items()}
        self.text = [chr(self.byte[i]) if self.byte.get(i, 128) < 128 else p if k in (NORMAL, USER) else "" for i, (p, k) in enumerate(zip(vocabulary.pieces, vocabulary.kinds, strict=True))]
        self.text = [t.replace(MARK, " ") for t in self.text]
        self.text[vocabulary.unknown_id] = " ⁇ "
        self.high = np.array([self.byte.get(i, 0) >= 128 for i in range(len(vocabulary.pieces))])

    def decode(self, ids: np.ndarray) -> str:
        if self.high[ids].any():
            parts, run = [], bytearray()
            for i in ids.tolist():
                if i in self.byte:
                    run.append(self.byte[i])
                else:
                    if run:
                        parts.append(run.decode(errors="replace"))
                        run.clear()
                    parts.append(self.text[i])
            text = "".join([*parts, run.decode(errors="replace")])
        else:
            text = "".join(map(self.text.__getitem__, ids.tolist()))
        return text[1:] if self.vocabulary.prefix and text.startswith(" ") else text


_ENCODED = [("ids", pa.list_(pa.int32())), ("n_ids", pa.int64()), ("n_bytes", pa.int64()), ("score", pa.float64()), ("ids_crc32", pa.int64()), ("round_trip", pa.bool_())]


def _encode(vocabulary: Vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = Encoder(vocabulary), Decoder(vocabulary)
        is_byte = vocabulary.kinds == BYTE
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                texts = [t or "" for t in part.column(1).to_pylist()]
                got = list(encoder.encode(texts))
                ids = [g[0] for g in got]
                offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))
                columns = [
                    lists, pa.array(np.diff(offsets), pa.int64()), pa.array([int(is_byte[x].sum()) for x in ids], pa.int64()), pa.array([float(g[1]) for g in got]),
                    pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()), pa.array([decoder.decode(x) == t for x, t in zip(ids, texts, strict=True)]),
                ]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], ["id", *(n for n, _ in _ENCODED)])

    return run


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None) -> DataFrame:
    """``id_col, ids, n_ids, n_bytes, score, ids_crc32, round_trip``, one row per input row, no shuffle.

    ``n_bytes`` counts byte pieces, ``score`` sums the path's log scores, ``round_trip`` says
    whether decoding gives the text again (not so for texts that hold a marker themselves).
    Null and empty texts have no ids.  Null and repeated ids are kept as they are; other
    columns are ignored; an empty table gives no rows.
    """
    vocabulary = Vocabulary.load(model or default_model())
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, ids array<int>, n_ids bigint, n_bytes bigint, score double, ids_crc32 bigint, round_trip boolean"
    return base.mapInArrow(_encode(vocabulary), schema).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", model: str | None = None) -> DataFrame:
    """``id_col, text`` from arrays of ids; null and empty arrays give empty texts, ids out of range an error."""
    vocabulary = Vocabulary.load(model or default_model())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(vocabulary)
        for batch in batches:
            texts = [decoder.decode(np.array(x or [], np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["id", "text"])

    base = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return base.mapInArrow(run, f"id {encoded.schema[id_col].dataType.simpleString()}, text string").withColumnRenamed("id", id_col)
