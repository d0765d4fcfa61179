"""Pairwise alignment of reads to references with affine gaps, clipped ends and introns, inside a band of diagonals.

All pairs of a block advance together, one read base at a time.  A gap in the read, short
(deletion) or with splice sites (intron), is a running maximum along the row, so every
length costs the same.  A state is a number of read bases (row) and a diagonal (reference
bases minus read bases, counted from the band's lowest).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from .sequence import _known, _texts

#: Cells (pairs by rows by diagonals) whose moves are held at once, four bytes each for narrow bands.
_CELLS = 1 << 21
_NONE = -(1 << 15)
_CALLED = np.zeros(256, bool)
_CALLED[np.frombuffer(b"ACGT", np.uint8)] = True
#: Moves into a state before gaps of the read: begin, one base of each, or an insertion of so many bases.
_BEGIN, _BOTH = 0, -1


@dataclass(frozen=True)
class Scoring:
    """Costs are positive.  A gap of n bases costs ``open + n * extend``, a clipped end ``clip``, a base that is not called 1.

    With ``intron`` set, a gap of at least ``least_intron`` reference bases costs that, and
    ``site`` more for each end that is not GT or AG, if this is cheaper.
    """

    match: int = 1
    mismatch: int = 4
    open: int = 10
    extend: int = 5
    clip: int = 1
    intron: int | None = None
    site: int = 6
    least_intron: int = 20


def _behind(values: np.ndarray, places: int, fill: int) -> np.ndarray:
    out = np.full_like(values, fill)
    out[places:] = values[: max(0, len(values) - places)]
    return out


def _ahead(values: np.ndarray, fill: int) -> np.ndarray:
    out = np.full_like(values, fill)
    out[:-1] = values[1:]
    return out


class _Block:
    """Alignments of pairs that share a band's width, a column each: ``reads`` and ``window`` (the reference from ``low`` on) are tables of codes."""

    def __init__(self, reads: np.ndarray, window: np.ndarray, inside: np.ndarray, sizes: np.ndarray, band: int, scoring: Scoring):
        self.reads, self.sizes, self.window, self.inside, self.band, self.s = reads, sizes, window, inside, band, scoring
        # Of a value and a place in one number, 32 bits hold all unless reads or bands are long.
        costs = max(1, scoring.match, scoring.mismatch, scoring.open, scoring.extend, scoring.clip, scoring.site, scoring.intron or 0)
        longest = (len(reads) + band + 2) * costs
        self.type = np.int32 if longest < -_NONE // 2 and band < 1 << 13 else np.int64
        self.none = _NONE if self.type is np.int32 else -(1 << 40)
        self._fill()

    def _gaps(self, before: np.ndarray, row: int) -> tuple[np.ndarray, np.ndarray]:
        """Best value behind a gap of the read at every diagonal, and the gap's length (negative for introns)."""
        s, at = self.s, np.arange(self.band, dtype=self.type)[:, None]
        bits = self.band.bit_length()
        # Value and place in one number: of equal values the nearest place wins.
        behind = lambda v, n: _behind(np.maximum.accumulate((v << bits) | at, axis=0), n, self.none << bits)
        far = behind(before + s.extend * at, 1)
        value, length = (far >> bits) - s.open - s.extend * at, at - (far & ((1 << bits) - 1))
        if s.intron is not None:
            far = behind(before - self.donor[row : row + self.band], max(1, s.least_intron))
            spliced = (far >> bits) - s.intron - self.acceptor[row : row + self.band]
            length = np.where(spliced > value, (far & ((1 << bits) - 1)) - at, length)
            value = np.maximum(value, spliced)
        return value, length

    def _fill(self) -> None:
        s, band, n = self.s, self.band, len(self.sizes)
        rows = int(self.sizes.max(initial=0))
        small = np.int16 if max(band, rows) < 1 << 15 else np.int32
        self.moves, self.jumps = (np.zeros((rows + 1, band, n), small) for _ in range(2))
        if s.intron is not None:
            pair = lambda x, y: (self.window[:-1] == ord(x)) & (self.window[1:] == ord(y))
            self.donor = np.where(np.pad(pair("G", "T"), ((0, 1), (0, 0))), 0, s.site).astype(self.type)
            self.acceptor = np.where(np.pad(pair("A", "G"), ((2, 0), (0, 0)))[:-1], 0, s.site).astype(self.type)
        value = np.where(self.inside[:band], 0, self.none).astype(self.type)
        inserted, run = np.full((band, n), self.none, self.type), np.zeros((band, n), self.type)
        self.best, self.end, self.diagonal = np.full(n, self.none, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        unknown = ~_CALLED[self.window]
        for i in range(1, rows + 1):
            base, read = self.window[i - 1 : i - 1 + band], self.reads[i - 1]
            step = np.where(base == read, self.type(s.match), self.type(-s.mismatch))
            step[unknown[i - 1 : i - 1 + band] | ~_CALLED[read]] = -1
            opened, longer = _ahead(value, self.none) - s.open, _ahead(inserted, self.none)
            run = np.where(longer > opened, _ahead(run, 0) + self.type(1), self.type(1))
            inserted = np.maximum(opened, longer) - s.extend
            both = value + step
            before, move = np.maximum(both, -s.clip), np.where(both >= -s.clip, _BOTH, _BEGIN)
            move = np.where(inserted > before, run, move)
            before = np.where(self.inside[i : i + band], np.maximum(before, inserted), self.none)
            gap, length = self._gaps(before, i)
            gap = np.where(self.inside[i : i + band], gap, self.none)
            self.moves[i], self.jumps[i] = move, np.where(gap > before, length, 0)
            value = np.maximum(np.maximum(before, gap), self.none)
            ends = np.where(i == self.sizes, 0, np.where(i < self.sizes, -s.clip, self.none))
            at = value.argmax(0)
            top = value[at, np.arange(n)] + ends
            better = top > self.best
            self.best[better], self.end[better], self.diagonal[better] = top[better], i, at[better]

    def trace(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
        """Rows and diagonals where alignments begin, differing bases (gaps of the read and insertions count whole, introns not), and CIGARs."""
        n = len(self.sizes)
        i, b, every = self.end.copy(), self.diagonal.copy(), np.arange(n)
        wrong, gapped, going = np.zeros(n, np.int64), np.zeros(n, bool), self.end > 0
        ops, lengths = [np.full(n, ord("S"), np.uint8)], [self.sizes - self.end]
        while going.any():
            move, jump = self.moves[i, b, every].astype(np.int64), self.jumps[i, b, every].astype(np.int64)
            leap = going & ~gapped & (jump != 0)
            both, insert = going & ~leap & (move == _BOTH), going & ~leap & (move > 0)
            wrong += np.where(both, self.window[np.maximum(i - 1 + b, 0), every] != self.reads[np.maximum(i - 1, 0), every], 0)
            wrong += np.where(insert, move, np.where(leap, np.maximum(jump, 0), 0))
            ops.append(np.where(both, ord("M"), np.where(insert, ord("I"), np.where(jump < 0, ord("N"), ord("D")))).astype(np.uint8))
            lengths.append(np.where(both, 1, np.where(insert, move, np.where(leap, np.abs(jump), 0))))
            going &= (leap | both | insert)
            b = np.where(leap, b - np.abs(jump), np.where(insert, b + move, b))
            i = np.where(both, i - 1, np.where(insert, i - move, i))
            gapped = leap
            going &= (i > 0)
        ops.append(np.full(n, ord("S"), np.uint8))
        lengths.append(i)
        return i, b, wrong, _cigars(np.array(ops[::-1]).T, np.array(lengths[::-1]).T)


def _cigars(ops: np.ndarray, lengths: np.ndarray) -> list[str]:
    """One CIGAR a row; equal neighbours are one run, empty runs are left out."""
    row, column = np.nonzero(lengths)
    op, size = ops[row, column], lengths[row, column]
    if not len(row):
        return [""] * len(ops)
    heads = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (op[1:] != op[:-1])]))
    texts = [f"{k}{chr(c)}" for k, c in zip(np.add.reduceat(size, heads).tolist(), op[heads].tolist(), strict=True)]
    ends = np.cumsum(np.bincount(row[heads], minlength=len(ops)))
    return ["".join(texts[a:z]) for a, z in zip([0, *ends[:-1]], ends, strict=True)]


def _blocks(rows: np.ndarray, sizes: np.ndarray, widths: np.ndarray) -> Iterator[np.ndarray]:
    """Rows of about equal bands together; a pair whose cells are more than a block's comes alone."""
    rows = rows[np.lexsort((sizes[rows], widths[rows]))]
    begin = 0
    while begin < len(rows):
        most, stop = 0, begin
        while stop < len(rows):
            most = max(most, int(sizes[rows[stop]]) + 1)
            if stop > begin and (stop - begin + 1) * most * int(widths[rows[stop]]) > _CELLS:
                break
            stop += 1
        yield rows[begin:stop]
        begin = stop


def align(reads: pa.Array, references: pa.Array, low: np.ndarray, high: np.ndarray, scoring: Scoring) -> dict[str, list]:
    """``score, value, pos, cigar, differences`` of the best alignment of every pair whose diagonals lie between ``low`` and ``high``; None for nulls."""
    (texts, sizes), (refs, lengths) = _texts(reads), _texts(references)
    there = np.flatnonzero(_known(reads, references) & (sizes > 0) & (high >= low))
    out = {name: [None] * len(sizes) for name in ("score", "value", "pos", "cigar", "differences")}

    def put(part: np.ndarray, *columns) -> None:
        for name, values in zip(out, columns, strict=True):
            for r, v in zip(part.tolist(), values if isinstance(values, list) else values.tolist(), strict=True):
                out[name][r] = v

    def blocks(rows: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray, np.ndarray, np.ndarray]]:
        for part in _blocks(rows, sizes, high - low + 1):
            band, longest = int((high - low)[part].max()) + 1, int(sizes[part].max())
            at = low[part, None] + np.arange(band + longest + 2)
            length = lengths[part, None]
            window = np.where((at >= 0) & (at < length), refs[part[:, None], np.clip(at, 0, max(0, refs.shape[1] - 1))] if refs.shape[1] else 0, 0)
            yield part, band, texts[part, :longest], window, (at >= 0) & (at <= length)

    rest = there
    if min(scoring.match, scoring.match + scoring.mismatch, scoring.open + scoring.extend, scoring.extend + 1, scoring.clip + 1) > 0 and (scoring.intron is None or min(scoring.intron, scoring.site + 1) > 0):
        same = np.full(len(sizes), -1)
        for part, band, table, window, _ in blocks(there):
            same[part] = _equal(table, window, sizes[part], np.minimum(band, (high - low)[part] + 1))
        own, rest = there[same[there] >= 0], there[same[there] < 0]
        put(own, sizes[own] * scoring.match, sizes[own] * scoring.match, same[own] + low[own], [f"{n}M" for n in sizes[own].tolist()], np.zeros(len(own), int))
    for part, band, table, window, inside in blocks(rest):
        block = _Block(*(np.ascontiguousarray(t.T) for t in (table, window, inside)), sizes[part], band, scoring)
        begin, diagonal, wrong, cigars = block.trace()
        clipped = (begin > 0).astype(int) + (block.end < sizes[part])
        put(part, block.best + scoring.clip * clipped, block.best, begin + diagonal + low[part], cigars, wrong)
    return out


def _equal(reads: np.ndarray, window: np.ndarray, sizes: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """The lowest diagonal on which a called read equals the reference, so that no alignment is better and the kernel would choose it; else -1."""
    beyond = np.arange(reads.shape[1]) >= sizes[:, None]
    out = np.full(len(reads), -1)
    left = np.flatnonzero((_CALLED[reads] | beyond).all(axis=1))
    for d in range(int(widths.max(initial=0))):
        left = left[out[left] < 0]
        maybe = left[(window[left, d] == reads[left, 0]) & (d < widths[left])]
        found = ((window[maybe, d : d + reads.shape[1]] == reads[maybe]) | beyond[maybe]).all(axis=1)
        out[maybe[found]] = d
    return out


def aligned(reads: pa.Array, references: pa.Array, near: list[np.ndarray], far: list[np.ndarray], scoring: Scoring) -> dict[str, list]:
    """``align`` between the diagonals of ``near``; with introns, pairs that one could still better are aligned between those of ``far`` too."""
    found = align(reads, references, *near, scoring)
    if scoring.intron is None:
        return found
    most = pc.utf8_length(reads).fill_null(0).to_numpy(zero_copy_only=False) * scoring.match - scoring.intron
    value = np.array([np.inf if v is None else v for v in found["value"]])
    again = np.flatnonzero((value < most) & ((far[0] < near[0]) | (far[1] > near[1])))
    if len(again):
        other = align(reads.take(pa.array(again)), references.take(pa.array(again)), far[0][again], far[1][again], scoring)
        for i, r in enumerate(again.tolist()):
            if other["value"][i] > value[r]:
                for values, better in zip(found.values(), other.values(), strict=True):
                    values[r] = better[i]
    return found


def placed(read: Column, reference: Column, low: Column, high: Column, scoring: Scoring, far: tuple[Column, Column] | None = None) -> Column:
    """struct(score, value, pos, cigar, differences) of the best alignment between two diagonals; null fields for nulls and empty reads.

    ``score`` counts bases and gaps, ``value`` the cost of clipped ends too.  ``far`` are the diagonals
    as far as introns may lead, which are tried where the nearer ones leave room for one.
    """
    types = {"score": pa.int32(), "value": pa.int32(), "pos": pa.int32(), "cigar": pa.string(), "differences": pa.int32()}

    @F.arrow_udf("score int, value int, pos int, cigar string, differences int")
    def run(a: pa.Array, b: pa.Array, lo: pa.Array, hi: pa.Array, far_lo: pa.Array, far_hi: pa.Array) -> pa.Array:
        near, wide = ([x.fill_null(f).to_numpy(zero_copy_only=False).astype(np.int64) for x, f in ((x, 0), (y, -1))] for x, y in ((lo, hi), (far_lo, far_hi)))
        found = aligned(a, b, near, wide, scoring)
        return pa.StructArray.from_arrays([pa.array(found[n], t) for n, t in types.items()], list(types))

    return run(read, reference, low, high, *(far or (low, high)))
