"""Words that texts share with references: numpy lookups of a block of texts in a chunk of references.

A chunk's words are sorted once and looked up by all blocks that meet it, so neither side's
words become rows.  Hits of a text are counted for every reference and strand.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Hits that are expanded at once, and bits of the filter for every word of a chunk.
_HITS, _BITS = 1 << 21, 16
_DIGIT = np.full(256, 4, np.uint8)
_DIGIT[np.frombuffer(b"ACGT", np.uint8)] = np.arange(4)
_MIX, _SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
#: Of a text's hits on a reference: different words, diagonals from and to, first and last place in the text.
COUNTS = ("seeds", "low", "high", "head", "last")


def _digits(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Digits of all bases behind each other (4 for others) and the texts' ends."""
    if pc.sum(pc.utf8_length(texts)).as_py() != pc.sum(pc.binary_length(texts)).as_py():
        texts = pc.replace_substring_regex(texts, "[^ACGT]", "N")
    ends = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))])
    return _DIGIT[np.frombuffer("".join(texts.to_pylist()).encode(), np.uint8)], ends


def _codes(digits: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """A number for the word at every place, exact up to 32 bases, and whether all its bases are called."""
    base = np.uint64(4) if k <= 32 else _MIX
    with np.errstate(over="ignore"):
        one = digits.astype(np.uint64)
        code, width = one, 1
        for bit in bin(k)[3:]:
            code = code[: max(0, len(code) - width)] * base**np.uint64(width) + code[width:]
            width *= 2
            if bit == "1":
                code = code[: max(0, len(code) - 1)] * base + one[width : width + max(0, len(code) - 1)]
                width += 1
    wrong = np.concatenate([[0], np.cumsum(digits == 4)])
    return code, wrong[k:] == wrong[: max(0, len(wrong) - k)]


def _places(ends: np.ndarray, k: int, stride: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of the text and place in it of every ``stride``-th word."""
    counts = np.maximum(0, (ends[1:] - ends[:-1] - k) // stride + 1)
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, (np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)) * stride


def _mixed(codes: np.ndarray, groups: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        word = (codes + groups.view(np.uint64) * _MIX) * _SPREAD
        return (word ^ (word >> np.uint64(32))) * _MIX


class Index:
    """Sorted words of a chunk: ``references`` in upper case, ``groups`` of 64 bits, which texts must share."""

    def __init__(self, references: pa.Array, groups: np.ndarray, k: int):
        digits, ends = _digits(references)
        owner, place = _places(ends, k, 1)
        codes, called = _codes(digits, k)
        at = ends[owner] + place
        keep = called[at]
        owner, place, at = owner[keep], place[keep], at[keep]
        words = _mixed(codes[at], groups[owner])
        order = np.argsort(words)
        self.k, self.groups, self.words = k, groups, words[order]
        self.owner, self.place = owner[order].astype(np.int32), place[order].astype(np.int32)
        bits = max(10, int(len(words) * _BITS).bit_length())
        self.shift = np.uint64(64 - bits)
        there = np.zeros(1 << bits, bool)
        there[words >> self.shift] = True
        self.filter = np.packbits(there, bitorder="little")

    def _ranges(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words that are there, with the first and the number of their entries."""
        bit = words >> self.shift
        maybe = np.flatnonzero(self.filter[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1)
        first = np.searchsorted(self.words, words[maybe])
        count = np.searchsorted(self.words, words[maybe], "right") - first
        found = count > 0
        return maybe[found], first[found], count[found]

    def hits(self, texts: pa.Array, groups: np.ndarray, stride: int) -> dict[str, np.ndarray]:
        """``text, turned, reference`` by number and ``COUNTS``, one entry for all hits of a strand on a reference."""
        digits, ends = _digits(texts)
        owner, at = _places(ends, self.k, stride)
        found = {n: [] for n in ("text", "turned", "reference", *COUNTS)}
        for turned in (False, True):
            # Turned round as a whole, texts come in reverse order.
            codes, called = _codes(np.where(digits == 4, 4, 3 - digits)[::-1] if turned else digits, self.k)
            start = ends[-1] - ends[1:] if turned else ends[:-1]
            flat = start[owner] + at
            keep = np.flatnonzero(called[flat])
            which, first, count = self._ranges(_mixed(codes[flat[keep]], groups[owner[keep]]))
            which, total = keep[which], np.concatenate([[0], np.cumsum(count)])
            begin = 0
            while begin < len(which):
                stop = max(begin + 1, int(np.searchsorted(total, total[begin] + _HITS, "right")) - 1)
                n = count[begin:stop]
                entry = np.repeat(first[begin:stop] - (total[begin:stop] - total[begin]), n) + np.arange(n.sum())
                part = self._counted(np.repeat(owner[which[begin:stop]], n), np.repeat(at[which[begin:stop]], n), entry, groups)
                found["turned"].append(np.full(len(part["text"]), turned))
                for name, values in part.items():
                    found[name].append(values)
                begin = stop
        return _merged({n: np.concatenate(v) if v else np.empty(0, bool if n == "turned" else np.int64) for n, v in found.items()})

    def _counted(self, text: np.ndarray, at: np.ndarray, entry: np.ndarray, groups: np.ndarray) -> dict[str, np.ndarray]:
        reference = self.owner[entry].astype(np.int64)
        own = self.groups[reference] == groups[text]
        text, at, reference, entry = text[own], at[own], reference[own], entry[own]
        order = np.lexsort((at, reference, text))
        text, at, reference, diagonal = text[order], at[order], reference[order], self.place[entry[order]] - at[order]
        head = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (reference[1:] != reference[:-1])])) if len(text) else np.empty(0, np.int64)
        if not len(head):
            return {n: np.empty(0, np.int64) for n in ("text", "reference", *COUNTS)}
        fresh = np.concatenate([[True], at[1:] != at[:-1]])
        fresh[head] = True
        return {
            "text": text[head], "reference": reference[head], "seeds": np.add.reduceat(fresh.astype(np.int64), head), "low": np.minimum.reduceat(diagonal, head),
            "high": np.maximum.reduceat(diagonal, head), "head": np.minimum.reduceat(at, head), "last": np.maximum.reduceat(at, head),
        }


def _merged(found: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Entries of one text, strand and reference together; a word's hits are all in one of them."""
    keys = ("text", "turned", "reference")
    order = np.lexsort([found[n] for n in keys[::-1]])
    found = {n: v[order] for n, v in found.items()}
    if not len(order):
        return found
    head = np.flatnonzero(np.concatenate([[True], np.any([found[n][1:] != found[n][:-1] for n in keys], axis=0)]))
    how = {"seeds": np.add, "low": np.minimum, "head": np.minimum, "high": np.maximum, "last": np.maximum}
    return {n: how[n].reduceat(v, head) if n in how else v[head] for n, v in found.items()}


def packed(most: int, size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows ``part, item`` to rows ``part, items`` of at most ``most`` items and, unless it is one, ``size`` bytes of their last field."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def row(part: int) -> pa.RecordBatch:
            items = pa.concat_arrays(held.pop(part)[1])
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.ListArray.from_arrays(pa.array([0, len(items)], pa.int32()), items)], ["part", "items"])

        for batch in batches:
            parts, items = batch.column(0).to_numpy(), batch.column(1)
            sizes = pc.binary_length(items.field(items.type.num_fields - 1)).to_numpy(zero_copy_only=False)
            for part in np.unique(parts).tolist():
                own = np.flatnonzero(parts == part)
                while len(own):
                    entry = held.setdefault(part, [0, [], 0])
                    room = np.flatnonzero((np.arange(len(own)) + entry[0] >= most) | (np.cumsum(sizes[own]) + entry[2] > size))
                    take = int(room[0]) if len(room) else len(own)
                    if take == 0 and entry[0] == 0:
                        take = 1
                    if take:
                        entry[0], entry[2] = entry[0] + take, entry[2] + int(sizes[own[:take]].sum())
                        entry[1].append(items.take(pa.array(own[:take])))
                    own = own[take:]
                    if len(own):
                        yield row(part)
            # What many parts hold together is bounded too.
            while sum(e[2] for e in held.values()) > 8 * size:
                yield row(max(held, key=lambda p: held[p][2]))
        for part in list(held):
            yield row(part)

    return run


def seeded(k: int, stride: int, share: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows ``part, chunk, references, block, texts``, all of a part in a row and those of a chunk in it, to texts' hits.

    ``references`` are structs (group, rname, reference), ``texts`` structs (group, ..., text).  Of a text's
    hits in a part, those stay that have at least ``share`` of the most words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = chunk = index = names = None
        blocks: dict[int, list] = {}

        def finished() -> Iterator[pa.RecordBatch]:
            for texts, most, kept in blocks.values():
                for rnames, found in kept:
                    stay = np.flatnonzero(found["seeds"] >= share * most[found["text"]])
                    for i in range(0, len(stay), 20_000):
                        own = stay[i : i + 20_000]
                        took = texts.take(pa.array(found["text"][own]))
                        columns = {f.name: took.field(j) for j, f in enumerate(texts.type) if f.name != "group"}
                        columns |= {"turned": pa.array(found["turned"][own]), "rname": rnames.take(pa.array(found["name"][own]))}
                        columns |= {n: pa.array(found[n][own].astype(np.int32)) for n in COUNTS}
                        yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))
            blocks.clear()

        for batch in batches:
            for i in range(batch.num_rows):
                now, number, block = (batch.column(n)[i].as_py() for n in ("part", "chunk", "block"))
                if now != part:
                    yield from finished()
                    part, chunk = now, None
                if number != chunk:
                    references = batch.column("references")[i].values
                    index = Index(references.field("reference"), references.field("group").to_numpy(), k)
                    chunk, names = number, references.field("rname")
                if block not in blocks:
                    # A copy, so that the batch with its chunk is not held.
                    texts = pa.concat_arrays([batch.column("texts")[i].values.take(pa.array(np.arange(len(batch.column("texts")[i].values))))])
                    blocks[block] = [texts, np.zeros(len(texts), np.int64), []]
                texts, most, kept = blocks[block]
                found = index.hits(texts.field("text"), texts.field("group").to_numpy(), stride)
                np.maximum.at(most, found["text"], found["seeds"])
                stay = np.flatnonzero(found["seeds"] >= share * most[found["text"]])
                if len(stay):
                    found = {n: v[stay] for n, v in found.items()}
                    used, found["name"] = np.unique(found.pop("reference"), return_inverse=True)
                    kept.append((names.take(pa.array(used)), {n: v if n == "turned" else v.astype(np.int32) for n, v in found.items()}))
        yield from finished()

    return run
