"""The sequence kernel: complements, approximate search, flanked extraction, templates, exons.

Searches take the first window within the allowed distance, not the best one.  They run as
Arrow UDFs that compare all windows of many rows at once, each row with its own pattern;
everything else is built-in functions.  ``first_of`` and ``find_barcode`` are declared not
deterministic, so that a filter on what they find is not moved below them, which would run them twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

UP_MISSING, DOWN_MISSING = "upstream not found", "downstream not found"
#: Cells (rows by width) that are compared at once, which bounds a task's memory.
_CELLS = 1 << 19

Texts = tuple[np.ndarray, np.ndarray]
Near = Callable[[np.ndarray, np.ndarray, int], np.ndarray]
_COMPLEMENT = np.arange(256, dtype=np.uint8)
_COMPLEMENT[np.frombuffer(b"ACGTacgt", np.uint8)] = np.frombuffer(b"TGCAtgca", np.uint8)


def revcomp(seq: Column) -> Column:
    """Reverse complement of A, C, G, T in either case; other characters stay."""
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))


def _texts(column: pa.Array) -> Texts:
    """Latin-1 codes padded by 0, and lengths; nulls are empty."""
    values = pc.fill_null(column.cast(pa.large_string()), "")
    ends = np.frombuffer(values.buffers()[1], np.int64, len(values) + 1, values.offset * 8)
    data = np.frombuffer(values.buffers()[2] or b"", np.uint8)[: ends[-1]]
    if data.size and data[ends[0] :].max() > 127:
        raw = [t.encode("latin-1", "replace") for t in values.to_pylist()]
        ends = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
        data = np.frombuffer(b"".join(raw), np.uint8)
    sizes = np.diff(ends)
    width = int(sizes.max(initial=0))
    table = np.zeros((len(sizes), width), np.uint8)
    table[np.arange(width) < sizes[:, None]] = data[ends[0] :]
    return table, sizes


def _turned(texts: Texts) -> Texts:
    """Reverse complements, padded behind."""
    table, sizes = texts
    out = np.zeros_like(table)
    there = np.arange(table.shape[1]) < sizes[:, None]
    out[there] = _COMPLEMENT[table[:, ::-1]][there[:, ::-1]]
    return out, sizes


def _hamming(table: np.ndarray, patterns: np.ndarray, most: int) -> np.ndarray:
    """Which windows differ from their row's pattern in at most ``most`` places."""
    size = patterns.shape[1]
    windows = table.shape[1] - size + 1
    wrong = np.zeros((len(table), windows), np.uint8 if size < 256 else np.uint32)
    for j in range(size):
        wrong += table[:, j : j + windows] != patterns[:, j : j + 1]
    return wrong <= most


def _edits(table: np.ndarray, patterns: np.ndarray, most: int) -> np.ndarray:
    """Which windows of the pattern's length lie within ``most`` edits of it (a band of the edit table, all windows at once)."""
    size = patterns.shape[1]
    windows = table.shape[1] - size + 1
    shape, cap = (len(table), windows), min(most, 250) + 1
    row = [np.full(shape, min(j, cap), np.uint8) for j in range(min(size, cap) + 1)] + [None] * (size - min(size, cap))
    for i in range(1, size + 1):
        low, high = max(1, i - cap), min(size, i + cap)
        corner = row[low - 1]
        left = row[low - 1] = np.full(shape, min(i, cap) if low == 1 else cap, np.uint8)
        for j in range(low, high + 1):
            best = corner + (table[:, j - 1 : j - 1 + windows] != patterns[:, i - 1 : i])
            np.minimum(best, left + 1, out=best)
            corner = row[j]
            if corner is not None:
                np.minimum(best, corner + 1, out=best)
            else:
                corner = np.full(shape, cap, np.uint8)
            left = row[j] = np.minimum(best, cap)
    return row[size] <= most


def _may_edit(table: np.ndarray, patterns: np.ndarray, most: int) -> np.ndarray:
    """Which rows hold any text within ``most`` edits of their pattern; no others have a window that ``_edits`` finds.

    A column of the edit table is two words of bits (what a step down adds and takes), a row of
    the text turns it into the next.
    """
    size = patterns.shape[1]
    if not 0 < size <= 64:
        return np.ones(len(table), bool)
    bits = np.left_shift(np.uint64(1), np.arange(size, dtype=np.uint64))
    letters = np.flatnonzero(np.bincount(patterns.ravel(), minlength=256))
    number = np.full(256, len(letters), np.intp)
    number[letters] = np.arange(len(letters))
    places = np.zeros((len(letters) + 1, len(table)), np.uint64)
    for j in range(size):
        places[number[patterns[:, j]], np.arange(len(table))] |= bits[j]
    texts, rows, one, last = number[table], np.arange(len(table)), np.uint64(1), np.uint64(size - 1)
    plus, minus = np.full(len(table), ~np.uint64(0)), np.zeros(len(table), np.uint64)
    score, least = np.full(len(table), size, np.int32), np.full(len(table), size, np.int32)
    for i in range(table.shape[1]):
        same = places[texts[:, i], rows]
        down = (((same & plus) + plus) ^ plus) | same | minus
        more, less = minus | ~(down | plus), plus & down
        score += ((more >> last) & one).astype(np.int32) - ((less >> last) & one).astype(np.int32)
        np.minimum(least, score, out=least)
        more, less = more << one, less << one
        same |= minus
        plus, minus = less | ~(same | more), more & same
    return least <= most


def _search(texts: Texts, patterns: Texts, most: int, begin: np.ndarray | None = None, rows: np.ndarray | None = None, near: Near = _hamming) -> np.ndarray:
    """Leftmost 0-based window of each row at or after ``begin`` near the row's pattern; -1 if none, or for rows not asked for."""
    (table, sizes), (wanted, lengths) = texts, patterns
    out = np.full(len(sizes), -1, np.int32)
    rows = np.flatnonzero(lengths <= sizes) if rows is None else rows[lengths[rows] <= sizes[rows]]
    for n in np.unique(lengths[rows]):
        group = rows[lengths[rows] == n]
        width = int(sizes[group].max())
        step = max(1, _CELLS // max(1, width))
        if near is _edits:
            group = np.concatenate([p[_may_edit(table[p, :width], wanted[p, :n], most)] for p in (group[i : i + step] for i in range(0, len(group), step))])
        for part in (group[i : i + step] for i in range(0, len(group), step)):
            ok = near(table[part, :width], wanted[part, :n], most)
            at = np.arange(width - n + 1)
            ok &= at + n <= sizes[part, None]
            if begin is not None:
                ok &= at >= begin[part, None]
            out[part] = np.where(ok.any(1), ok.argmax(1), -1)
    return out


def first_match(texts: list[str], pattern: str, mismatches: int, begin: np.ndarray | None = None) -> np.ndarray:
    """Leftmost 0-based window at or after ``begin`` within ``mismatches`` of ``pattern``; -1 if none."""
    return _search(_texts(pa.array(texts, pa.string())), _texts(pa.array([pattern] * len(texts), pa.string())), mismatches, begin)


def _known(*columns: pa.Array) -> np.ndarray:
    out = np.ones(len(columns[0]), bool)
    for c in columns:
        out &= pc.is_valid(c).to_numpy(zero_copy_only=False)
    return out


def _locating(mismatches: int, near: Near):
    @F.arrow_udf("int")
    def run(s: pa.Array, p: pa.Array) -> pa.Array:
        there = _known(s, p)
        at = _search(_texts(s), _texts(p), mismatches, rows=np.flatnonzero(there), near=near)
        return pa.array(at, pa.int32(), mask=~there)

    return run


def locate(seq: Column, pattern: Column, mismatches: int) -> Column:
    """Leftmost window of ``seq`` within a Hamming distance of ``pattern``, from 0; -1 if none, null for nulls."""
    return _locating(mismatches, _hamming)(seq, pattern)


def locate_edit(seq: Column, pattern: Column, distance: int) -> Column:
    """Leftmost window of the pattern's length within an edit distance; -1 if none, null for nulls."""
    return _locating(distance, _edits)(seq, pattern)


def locate_near(seq: Column, pattern: Column, most: int, distance: str = "hamming") -> Column:
    """``locate`` or ``locate_edit`` by the name of the distance; other names are an error."""
    kinds = {"hamming": locate, "levenshtein": locate_edit}
    if distance not in kinds:
        raise ValueError(f"unknown distance {distance!r}, not one of {', '.join(kinds)}")
    return kinds[distance](seq, pattern, most)


def first_of(seq: Column, patterns: Sequence[Column], most: int, edits: bool = False) -> Column:
    """Number (from 0) of the first pattern that occurs in ``seq``, -1 if none does, null for null texts.

    A pattern is only searched where the former ones do not occur.  With ``edits`` a
    Hamming search comes first, which settles most rows cheaply: few mismatches are as few edits.
    """

    @F.arrow_udf("int")
    def run(s: pa.Array, *wanted: pa.Array) -> pa.Array:
        there, texts = _known(s), _texts(s)
        out = np.full(len(s), -1, np.int32)
        for i, w in enumerate(wanted):
            known, pattern = _known(w), _texts(w)
            for near in (_hamming, _edits) if edits else (_hamming,):
                rest = np.flatnonzero(there & known & (out < 0))
                out[_search(texts, pattern, most, rows=rest, near=near) >= 0] = i
        return pa.array(out, pa.int32(), mask=~there)

    return run.asNondeterministic()(seq, *patterns)


def _between(s: Texts, u: Texts, d: Texts, most: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the upstream flank and of the first downstream flank behind it, -1 if missing."""
    up = _search(s, u, most, rows=rows)
    found = np.flatnonzero(up >= 0)
    return up, _search(s, d, most, begin=up + u[1], rows=found)


def _flank_places(s: pa.Array, u: pa.Array, d: pa.Array, mismatches: int, retry: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of both flanks, and whether they are those of the reverse complement."""
    there = _known(s, u, d)
    texts, before, behind = _texts(s), _texts(u), _texts(d)
    up, down = _between(texts, before, behind, mismatches, np.flatnonzero(there))
    flipped = np.zeros(len(there), bool)
    rest = np.flatnonzero(there & (down < 0))
    if retry and len(rest):
        some = lambda x: (x[0][rest], x[1][rest])
        up2, down2 = _between(_turned(some(texts)), some(before), some(behind), mismatches, np.arange(len(rest)))
        flipped[rest] = down2 >= 0
        up[flipped], down[flipped] = up2[down2 >= 0], down2[down2 >= 0]
    return up, down, flipped


def flanks(seq: Column, up: Column, down: Column, mismatches: int, retry: bool = False) -> Column:
    """struct(up, down, flipped): places of the leftmost ``up`` and of the first ``down`` behind it, -1 if missing.

    With ``retry`` a text without both is searched again as its reverse complement; if both
    are found there, ``flipped`` is set and the places are those of the complement.
    """

    @F.arrow_udf("up int, down int, flipped boolean")
    def run(s: pa.Array, u: pa.Array, d: pa.Array) -> pa.Array:
        kinds = (pa.int32(), pa.int32(), pa.bool_())
        places = _flank_places(s, u, d, mismatches, retry)
        return pa.StructArray.from_arrays([pa.array(x, t) for x, t in zip(places, kinds, strict=True)], ["up", "down", "flipped"])

    return run(seq, up, down)


def find_barcode(seq: Column, up: Column, down: Column, template: Column, mismatches: int, barcode_mismatches: int, retry: bool = False) -> Column:
    """struct(raw, barcode, flipped): the text between the flanks, and with its template's fixed bases if it fits.

    ``barcode`` is null if flanks are missing or the text does not fit, as ``check_barcode``
    has it; ``raw`` is null with it.  ``retry`` is that of ``flanks``.
    """

    @F.arrow_udf("raw string, barcode string, flipped boolean")
    def run(s: pa.Array, u: pa.Array, d: pa.Array, t: pa.Array) -> pa.Array:
        places = _flank_places(s, u, d, mismatches, retry)
        texts, shape = _texts(s), _texts(pc.utf8_upper(t))
        start = places[0] + _texts(u)[1]
        raw, fixed = np.full(len(s), None, object), np.full(len(s), None, object)
        fits = (places[1] >= 0) & (places[1] - start == shape[1]) & _known(t)
        for turned in (False, True):
            for n in np.unique(shape[1][fits]):
                rows = np.flatnonzero(fits & (places[2] == turned) & (shape[1] == n))
                wanted = shape[0][rows, :n]
                at = start[rows, None] + np.arange(n)
                # A place of the complement is one of the text, counted from its end.
                seen = _COMPLEMENT[texts[0][rows[:, None], texts[1][rows, None] - 1 - at]] if turned else texts[0][rows[:, None], at]
                free = wanted == ord("N")
                rows = rows[keep := (~free & (seen != wanted)).sum(1) <= barcode_mismatches]
                raw[rows], fixed[rows] = _strings(seen[keep]), _strings(np.where(free, seen, wanted)[keep])
        columns = [pa.array(raw, pa.string()), pa.array(fixed, pa.string()), pa.array(places[2], pa.bool_())]
        return pa.StructArray.from_arrays(columns, ["raw", "barcode", "flipped"])

    return run.asNondeterministic()(seq, up, down, template)


def _strings(codes: np.ndarray) -> list[str]:
    """Rows of codes as texts."""
    size = codes.shape[1]
    text = codes.tobytes().decode("latin-1")
    return [text[i * size : (i + 1) * size] for i in range(len(codes))]


def extract(seq: Column, up: Column, down: Column, mismatches: int) -> Column:
    """struct(value, status, begin): the text between the leftmost ``up`` and the first ``down`` behind it.

    ``status`` is ``ok`` or says which flank is missing; ``begin`` is where ``up`` starts.
    """
    at = flanks(seq, up, down, mismatches)
    status = F.when(at["up"] < 0, UP_MISSING).when(at["down"] < 0, DOWN_MISSING).otherwise("ok")
    return F.struct(F.when(at["down"] >= 0, inner(seq, at, up)).alias("value"), status.alias("status"), at["up"].alias("begin"))


def inner(seq: Column, at: Column, up: Column) -> Column:
    """The text between two flanks found by ``flanks``."""
    return F.substring(seq, at["up"] + F.length(up) + 1, at["down"] - at["up"] - F.length(up))


def check_barcode(barcode: Column, template: Column, mismatches: int) -> Column:
    """The barcode with its template's fixed bases put right; null if lengths or more than ``mismatches`` fixed bases differ.

    ``N`` stands for any base; other letters are literal.
    """
    chars = lambda c: F.filter(F.split(c, ""), lambda x: x != "")
    pairs = F.zip_with(chars(barcode), chars(template), lambda b, t: F.struct(b.alias("b"), t.alias("t")))
    wrong = F.size(F.filter(pairs, lambda p: (p["t"] != "N") & (p["b"] != p["t"])))
    fixed = F.array_join(F.transform(pairs, lambda p: F.when(p["t"] == "N", p["b"]).otherwise(p["t"])), "")
    return F.when((F.length(barcode) == F.length(template)) & (wrong <= mismatches), fixed)


def softclips(cigar: Column) -> Column:
    """struct(first, last): soft-clipped bases at either end, 0 if none."""
    count = lambda pattern: F.coalesce(F.try_to_number(F.regexp_extract(cigar, pattern, 1), F.lit("999999999")).cast("int"), F.lit(0))
    return F.struct(count(r"^(\d+)S").alias("first"), count(r"(\d+)S$").alias("last"))


def exon_runs(seq: Column) -> Column:
    """Runs of upper-case letters."""
    return F.regexp_extract_all(seq, F.lit("([A-Z]+)"), F.lit(1))


def exon_positions(seq: Column) -> Column:
    """array<struct(start, end)>, 1-based inclusive, of the runs of upper-case letters."""
    parts = F.regexp_extract_all(seq, F.lit("([A-Z]+|[^A-Z]+)"), F.lit(1))
    ends = lambda i: F.aggregate(F.slice(parts, F.lit(1), i), F.lit(0), lambda acc, p: acc + F.length(p))
    placed = F.transform(parts, lambda p, i: F.struct((ends(i) + 1).alias("start"), ends(i + 1).alias("end"), p.alias("text")))
    return F.transform(F.filter(placed, lambda p: p["text"].rlike("^[A-Z]")), lambda p: F.struct(p["start"], p["end"]))


def upper_only(seq: Column) -> Column:
    return F.regexp_replace(seq, "[^A-Z]", "")


def inclusion_reference(seq: Column) -> Column:
    return F.array_join(exon_runs(seq), "")


def skipping_reference(seq: Column) -> Column:
    """All exons but the middle one (number n // 2 from 0); null for fewer than three."""
    runs = exon_runs(seq)
    middle = F.floor(F.size(runs) / 2).cast("int")
    return F.when(F.size(runs) >= 3, F.array_join(F.filter(runs, lambda r, i: i != middle), ""))


def reference_exons(seq: Column) -> Column:
    """struct(before, middle, after): the first three runs of upper-case letters, each cut at its first N."""
    runs = exon_runs(seq)
    return F.struct(*(F.substring_index(F.get(runs, F.lit(i)), "N", 1).alias(n) for i, n in enumerate(("before", "middle", "after"))))


def cigar_ops(cigar: Column) -> Column:
    """array<struct(n, op)>."""
    ops = F.regexp_extract_all(cigar, F.lit(r"(\d+[MIDNSHP=X])"), F.lit(1))
    return F.transform(ops, lambda o: F.struct(F.regexp_extract(o, r"(\d+)", 1).cast("int").alias("n"), F.substring(o, -1, 1).alias("op")))
