"""Sequences that share a signature: numpy lookups of a block of queries in a chunk of known sequences.

Known sequences of one length have their segments at the same places, and so do queries of one
length, so a signature's key is the same columns of a table of prefix hashes for all of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Letters that are hashed at once, pairs that are held, and bits of the filter for every key.
_LETTERS, _PAIRS, _BITS = 1 << 21, 1 << 21, 16
_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
Signature = tuple[int, tuple[int, ...], tuple[int, ...]]


def _by_length(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, numbers of the texts and hashes of their prefixes (a row each), some texts of a length at once."""
    sizes = pc.utf8_length(texts).to_numpy(zero_copy_only=False)
    for size in np.unique(sizes).tolist():
        every = np.flatnonzero(sizes == size)
        step = max(1, _LETTERS // max(1, size))
        for own in (every[i : i + step] for i in range(0, len(every), step)):
            letters = np.frombuffer("".join(texts.take(pa.array(own)).to_pylist()).encode("utf-32-le"), "<u4").reshape(len(own), size)
            prefix = np.zeros((size + 1, len(own)), np.uint64)
            for i in range(size):
                prefix[i + 1] = prefix[i] * _BASE + letters[:, i].astype(np.uint64) + np.uint64(1)
            yield size, own, prefix


def _key(prefix: np.ndarray, size: int, pieces: int, segments: tuple[int, ...], shifts: tuple[int, ...]) -> np.ndarray | None:
    """Hash of the segments of a known sequence of ``size``, shifted; None where they don't fit in."""
    key = np.zeros(prefix.shape[1], np.uint64)
    for segment, shift in zip(segments, shifts, strict=True):
        begin, end = size * segment // pieces + shift, size * (segment + 1) // pieces + shift
        if begin < 0 or end >= len(prefix):
            return None
        power = np.uint64(pow(int(_BASE), end - begin, 1 << 64))
        key = (key ^ (key >> np.uint64(29))) * _MIX + (prefix[end] - prefix[begin] * power)
    return (key ^ (key >> np.uint64(32))) * _MIX


class Known:
    """Sorted keys of a chunk of known sequences, for every length and choice of segments."""

    def __init__(self, texts: pa.Array, signatures: tuple[Signature, ...], pieces: int):
        self.signatures, self.pieces = signatures, pieces
        self.tables: dict[tuple[int, tuple[int, ...]], tuple] = {}
        found: dict[tuple[int, tuple[int, ...]], list] = {}
        for size, own, prefix in _by_length(texts):
            for segments in {s for _, s, _ in signatures}:
                found.setdefault((size, segments), []).append((_key(prefix, size, pieces, segments, (0,) * len(segments)), own))
        for name, parts in found.items():
            keys, owner = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(keys)
            shift = np.uint64(64 - max(10, int(len(keys) * _BITS).bit_length()))
            there = np.zeros(1 << 64 - int(shift), bool)
            there[keys >> shift] = True
            self.tables[name] = keys[order], owner[order].astype(np.int32), shift, np.packbits(there, bitorder="little")
        self.sizes = sorted({size for size, _ in found})

    def _pairs(self, own: np.ndarray, key: np.ndarray, table: tuple) -> Iterator[np.ndarray]:
        keys, owner, shift, there = table
        bit = key >> shift
        maybe = np.flatnonzero(there[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1)
        first = np.searchsorted(keys, key[maybe])
        count = np.searchsorted(keys, key[maybe], "right") - first
        maybe, first, count = maybe[count > 0], first[count > 0], count[count > 0]
        total, begin = np.concatenate([[0], np.cumsum(count)]), 0
        while begin < len(maybe):
            stop = max(begin + 1, int(np.searchsorted(total, total[begin] + _PAIRS, "right")) - 1)
            n = count[begin:stop]
            entry = np.repeat(first[begin:stop] - (total[begin:stop] - total[begin]), n) + np.arange(n.sum())
            yield np.repeat(own[maybe[begin:stop]], n).astype(np.int64) << 32 | owner[entry]
            begin = stop

    def candidates(self, queries: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Numbers of queries and known sequences that share a signature; pairs seldom come again."""
        held, size = [], 0
        for length, own, prefix in _by_length(queries):
            for known in self.sizes:
                for difference, segments, shifts in self.signatures:
                    key = _key(prefix, known, self.pieces, segments, shifts) if difference == length - known else None
                    if key is None:
                        continue
                    for found in self._pairs(own, key, self.tables[known, segments]):
                        held.append(found)
                        size += len(found)
                        if size > 2 * _PAIRS:
                            held = [np.unique(np.concatenate(held))]
                            size = len(held[0])
                            if size > _PAIRS:
                                yield held[0] >> 32, held[0] & 0xFFFFFFFF
                                held, size = [], 0
        if size:
            found = np.unique(np.concatenate(held))
            yield found >> 32, found & 0xFFFFFFFF


def shared(signatures: tuple[Signature, ...], pieces: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows ``chunk, known, queries`` (lists of structs of a text), those of a chunk in a row, to ``seq, known_seq``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = known = texts = None
        for batch in batches:
            for i in range(batch.num_rows):
                if (number := batch.column("chunk")[i].as_py()) != chunk:
                    texts = batch.column("known")[i].values.field("seq")
                    chunk, known = number, Known(texts, signatures, pieces)
                queries = batch.column("queries")[i].values.field("seq")
                for a, b in known.candidates(queries):
                    for j in range(0, len(a), 20_000):
                        yield pa.RecordBatch.from_arrays([queries.take(pa.array(a[j : j + 20_000])), texts.take(pa.array(b[j : j + 20_000]))], ["seq", "known_seq"])

    return run
