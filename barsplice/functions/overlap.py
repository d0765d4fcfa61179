"""Both mates of a fragment laid over each other: best overlap, adapter ends, consensus.

``offset`` is where the reverse complement of the second read starts in the first one; it is
negative if the reads run past each other's beginnings.  Places where a read is not A, C, G or T are not
compared.  All offsets of many pairs are counted at once, in blocks of
bounded size.  Both kernels are declared not deterministic, so that a filter on their results is
not moved below them, which would run them twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from .sequence import _CELLS, Texts, _known, _texts, _turned

_CALLED = np.zeros(256, np.uint8)
_CALLED[np.frombuffer(b"ACGTacgt", np.uint8)] = np.frombuffer(b"ACGTACGT", np.uint8)


def _blocks(rows: np.ndarray, one: np.ndarray, two: np.ndarray) -> Iterator[np.ndarray]:
    """Rows of about equal lengths together, so that padding costs little."""
    rows = rows[np.argsort(one[rows] + two[rows], kind="stable")]
    while len(rows):
        step = max(1, _CELLS // max(1, int(max(one[rows[-1]], two[rows[-1]]))))
        yield rows[:step]
        rows = rows[step:]


def _compared(a: np.ndarray, b: np.ndarray, offset: int) -> tuple[np.ndarray, np.ndarray]:
    """Compared and differing places of every row at one offset."""
    i, j = max(0, offset), max(0, -offset)
    n = min(a.shape[1] - i, b.shape[1] - j)
    x, y = a[:, i : i + n], b[:, j : j + n]
    both = (x > 0) & (y > 0)
    return np.count_nonzero(both, axis=1), np.count_nonzero(both & (x != y), axis=1)


def _offsets(a: np.ndarray, b: np.ndarray) -> Iterator[int]:
    """From no shift on to the right, then to the left."""
    yield from range(a.shape[1])
    yield from range(-1, -b.shape[1], -1)


def best_overlap(one: Texts, two: Texts, rows: np.ndarray, least: int, least_outie: int, most: int, density: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offset, compared places and differences of the least dense overlap; no compared places if none is good enough.

    Ties go to the longer overlap, then to the first offset.
    """
    offset, length, wrong = (np.zeros(len(one[1]), np.int32) for _ in range(3))
    for part in _blocks(rows, one[1], two[1]):
        a, b = (_CALLED[t[0][part, : max(1, int(t[1][part].max()))]] for t in (one, two))
        score = np.full(len(part), np.inf)
        for d in _offsets(a, b):
            n, bad = _compared(a, b, d)
            enough = n >= max(1, least if d >= 0 else least_outie)
            now = np.where(enough, bad / np.maximum(1, np.minimum(n, most)), np.inf)
            better = (now < score) | (enough & (now == score) & (n > length[part]))
            score[better] = now[better]
            offset[part[better]], length[part[better]], wrong[part[better]] = d, n[better], bad[better]
        length[part[score > density]] = 0
    return offset, length, wrong


def first_overlap(one: Texts, two: Texts, rows: np.ndarray, least: int, most_wrong: int, share: float) -> tuple[np.ndarray, np.ndarray]:
    """First offset whose differences are few, and whether there is one."""
    offset, found = np.zeros(len(one[1]), np.int32), np.zeros(len(one[1]), bool)
    for part in _blocks(rows, one[1], two[1]):
        a, b = (_CALLED[t[0][part, : max(1, int(t[1][part].max()))]] for t in (one, two))
        for d in _offsets(a, b):
            i, j = max(0, d), max(0, -d)
            length = np.minimum(one[1][part] - i, two[1][part] - j)
            _, bad = _compared(a, b, d)
            here = ~found[part] & (length >= least) & (bad <= np.minimum(most_wrong, np.floor(length * share)))
            offset[part[here]], found[part[here]] = d, True
    return offset, found


def _reversed(texts: Texts) -> Texts:
    table, sizes = texts
    out = np.zeros_like(table)
    there = np.arange(table.shape[1]) < sizes[:, None]
    out[there] = table[:, ::-1][there[:, ::-1]]
    return out, sizes


def _write(codes: np.ndarray, sizes: np.ndarray, missing: np.ndarray) -> pa.Array:
    """Rows of codes as texts of the given sizes, null where missing."""
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    flat = codes[np.arange(codes.shape[1]) < sizes[:, None]].astype(np.uint8)
    whole = pa.StringArray.from_buffers(len(sizes), pa.py_buffer(ends), pa.py_buffer(flat))
    return pc.if_else(pa.array(missing), pa.scalar(None, pa.string()), whole)


def _taken(texts: Texts, at: np.ndarray) -> np.ndarray:
    """Codes at given places, 0 outside the text."""
    table, sizes = texts
    inside = (at >= 0) & (at < sizes[:, None])
    if not table.shape[1]:
        return np.zeros(at.shape, np.uint8)
    return np.where(inside, np.take_along_axis(table, np.clip(at, 0, table.shape[1] - 1), 1), 0)


def _consensus(s1: Texts, q1: Texts, s2: Texts, q2: Texts, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bases, qualities and sizes of both reads together, from the first base of either to the last one."""
    low = np.minimum(0, offset)
    size = np.maximum(s1[1], s2[1] + offset) - low
    at = low[:, None] + np.arange(int(size.max(initial=0)))
    b1, v1 = _taken(s1, at), _taken(q1, at).astype(np.int16)
    b2, v2 = _taken(s2, at - offset[:, None]), _taken(q2, at - offset[:, None]).astype(np.int16)
    called1, called2 = _CALLED[b1], _CALLED[b2]
    # A read that is absent or has no base at a place leaves it to the other one.
    second = (b2 > 0) & ((b1 == 0) | ((called1 == 0) & (called2 > 0)) | (((called1 > 0) == (called2 > 0)) & (v2 > v1)))
    differ = (called1 > 0) & (called2 > 0) & (called1 != called2)
    quality = np.where(differ, 33 + np.maximum(2, np.abs(v1 - v2)), np.where(second, v2, v1))
    same = (called1 > 0) & (called1 == called2)
    quality = np.where(same, np.maximum(v1, v2), quality)
    return np.where(second, b2, b1), quality, size


def merged(s1: Column, q1: Column, s2: Column, q2: Column, least: int, least_outie: int, most: int, density: float) -> Column:
    """struct(seq, qual, offset, overlap, mismatches) of two reads laid over each other; null fields if they do not overlap.

    ``q2`` and ``s2`` are as sequenced.  Where the reads differ the base of higher quality
    stands (the first read's if equal), with the difference of both, at least 2; where they
    agree the higher quality stands.  A quality shorter than its read is an error.
    """

    @F.arrow_udf("seq string, qual string, offset int, overlap int, mismatches int")
    def run(a: pa.Array, x: pa.Array, b: pa.Array, y: pa.Array) -> pa.Array:
        there = _known(a, x, b, y)
        one, two, high, low = _texts(a), _turned(_texts(b)), _texts(x), _reversed(_texts(y))
        if ((one[1] != high[1]) | (two[1] != low[1]))[there].any():
            raise ValueError("a read and its qualities differ in length")
        offset, length, wrong = best_overlap(one, two, np.flatnonzero(there & (one[1] > 0) & (two[1] > 0)), least, least_outie, most, density)
        none = length == 0
        codes, quality, size = _consensus(one, high, two, low, offset)
        size = np.where(none, 0, size)
        numbers = [pa.array(v, pa.int32(), mask=none) for v in (offset, length, wrong)]
        return pa.StructArray.from_arrays([_write(codes, size, none), _write(quality, size, none), *numbers], ["seq", "qual", "offset", "overlap", "mismatches"])

    return run.asNondeterministic()(s1, q1, s2, q2)


def kept_lengths(s1: Column, q1: Column, s2: Column, q2: Column, window: int, quality: int, least: int, most_wrong: int, share: float) -> Column:
    """struct(n1, n2): how much of each read stays after cutting bad tails, then adapters.

    A read is cut behind its last window whose mean quality is high enough; without one
    nothing stays, and reads shorter than a window are left alone.  If the first fitting
    overlap of what stays has a negative offset, both reads run into adapters and are cut
    to the overlap.
    """

    def good(q: Texts) -> np.ndarray:
        table, sizes = q
        if table.shape[1] < window:
            return sizes.copy()
        sums = np.concatenate([np.zeros((len(table), 1), np.int64), np.cumsum(table, 1, dtype=np.int64)], 1)
        fits = sums[:, window:] - sums[:, :-window] >= window * (quality + 33)
        at = np.arange(fits.shape[1]) + window
        last = np.where(fits & (at <= sizes[:, None]), at, 0).max(1)
        return np.where(sizes < window, sizes, last)

    def cut(texts: Texts, sizes: np.ndarray) -> Texts:
        table = texts[0]
        return np.where(np.arange(table.shape[1]) < sizes[:, None], table, 0), sizes

    @F.arrow_udf("n1 int, n2 int")
    def run(a: pa.Array, x: pa.Array, b: pa.Array, y: pa.Array) -> pa.Array:
        there = _known(a, x, b, y)
        one, two = _texts(a), _texts(b)
        n1, n2 = np.minimum(good(_texts(x)), one[1]), np.minimum(good(_texts(y)), two[1])
        first, second = cut(one, n1), _turned(cut(two, n2))
        offset, found = first_overlap(first, second, np.flatnonzero(there & (n1 > 0) & (n2 > 0)), least, most_wrong, share)
        past = found & (offset < 0)
        overlap = np.minimum(n1, n2 + offset)
        return pa.StructArray.from_arrays([pa.array(np.where(past, overlap, n), pa.int32(), mask=~there) for n in (n1, n2)], ["n1", "n2"])

    return run.asNondeterministic()(s1, q1, s2, q2)
