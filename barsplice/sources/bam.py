"""Binary alignment files (BAM) as a Spark data source, in and out.

Files are split at any byte: a task looks for the first compressed block in its range and
in it for the first record, told by fields that fit each other over a run of records.
Records belong to the range their block starts in.  Fields of many records are decoded at
once into Arrow batches; no index and no sorting is needed.

``spark.dataSource.register(bam.BamSource)`` once, then ``spark.read.format("bam").load(path)``
and ``df.write.format("bam").option("contigs", "name:length,...").save(folder)``.  Files are
opened by Arrow's file systems (local, HDFS, S3, GCS).
"""

from __future__ import annotations

import functools
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from .. import schema

# Fixed values of the format: codes of bases and of operations, sizes of tag values.
BASES, OPERATIONS = "=ACMGRSVTWYHKDBN", "MIDNSHP=X"
NUMBERS = {"c": "<i1", "C": "<u1", "s": "<i2", "S": "<u2", "i": "<i4", "I": "<u4", "f": "<f4"}
FIXED = 36
#: Compressed bytes of a split, unpacked bytes that are decoded together or searched for a record, unpacked bytes of a written block.
SPLIT, TOGETHER, SEARCHED, BLOCK = 32 << 20, 4 << 20, 1 << 19, 65_280
#: Tasks up to which every split is one; more splits are dealt to tasks of up to ``SPLIT`` bytes.
TASKS = 64
_ARROW = pa.schema(
    [(c.split()[0], pa.int32() if c.split()[1] == "int" else pa.string()) for c in schema.ALIGNMENTS.split(", ")[:11]] + [("tags", pa.map_(pa.string(), pa.string()))]
)


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def _block_size(head: bytes) -> int:
    """Length of the compressed block that starts here; 0 if none does."""
    if len(head) < 18 or head[:4] != b"\x1f\x8b\x08\x04":
        return 0
    extra, at = head[12 : 12 + struct.unpack_from("<H", head, 10)[0]], 0
    while at + 4 <= len(extra):
        size = struct.unpack_from("<H", extra, at + 2)[0]
        if extra[at : at + 2] == b"BC" and size == 2 and at + 6 <= len(extra):
            return struct.unpack_from("<H", extra, at + 4)[0] + 1
        at += 4 + size
    return 0


def _blocks(file, at: int) -> Iterator[tuple[int, bytes]]:
    """(place, unpacked bytes) of every block from ``at`` on."""
    window, begin = b"", at
    while True:
        head = window[at - begin :]
        size = _block_size(head)
        if not size or len(head) < size:
            window, begin = file.read_at(1 << 20, at), at
            if not window:
                return
            size = _block_size(window)
            if not size or len(window) < size:
                raise ValueError(f"not a block of a BAM file at byte {at}")
            head = window
        skip = 12 + struct.unpack_from("<H", head, 10)[0]
        yield at, zlib.decompress(head[skip : size - 8], -15)
        at += size


def _first_block(file, at: int, size: int) -> int | None:
    """Place of the first block at or behind ``at``: one that another block or the file's end follows."""
    window = file.read_at(1 << 18, at)
    for m in re.finditer(b"\x1f\x8b\x08\x04", window):
        own = _block_size(window[m.start() :])
        behind = at + m.start() + own
        if own and (behind == size or _block_size(file.read_at(64, behind))):
            return at + m.start()
    return None


def _header(blocks: Iterator[tuple[int, bytes]]) -> tuple[list[str], int, int]:
    """Names of the references, the place of the block in which the first record starts or the header ends, and how far in it."""
    data, last, before = bytearray(), 0, 0

    def need(n: int) -> None:
        nonlocal last, before
        while len(data) < n:
            before = len(data)
            last, block = next(blocks)
            data.extend(block)

    need(12)
    if data[:4] != b"BAM\1":
        raise ValueError("not a BAM file")
    at = 8 + struct.unpack_from("<i", data, 4)[0]
    need(at + 4)
    names, count = [], struct.unpack_from("<i", data, at)[0]
    at += 4
    for _ in range(count):
        need(at + 4)
        n = struct.unpack_from("<i", data, at)[0]
        need(at + 8 + n)
        names.append(data[at + 4 : at + 3 + n].decode())
        at += 8 + n
    return names, last, at - before


@functools.lru_cache(8)
def _header_of(path: str, size: int, changed: int | None) -> tuple[list[str], int, int]:
    """The header of a file, read once by a worker for many of the file's splits."""
    fs, name = _open(path)
    with fs.open_input_file(name) as file:
        return _header(_blocks(file, 0))


def _int32(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    return data[at[:, None] + np.arange(4)].copy().view("<i4")[:, 0]


def _int16(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    return data[at[:, None] + np.arange(2)].copy().view("<u2")[:, 0].astype(np.int64)


def _plausible(data: np.ndarray, at: np.ndarray, references: int) -> np.ndarray:
    """Whether a record may start at these places, by its fields."""
    size, ref, pos, mate, mate_pos, bases = (_int32(data, at + k).astype(np.int64) for k in (0, 4, 8, 24, 28, 20))
    name, ops = data[at + 12].astype(np.int64), _int16(data, at + 16)
    least = 32 + name + 4 * ops + (bases + 1) // 2 + bases
    ok = (size >= least) & (size < 1 << 28) & (name > 0) & (bases >= 0)
    for r, p in ((ref, pos), (mate, mate_pos)):
        ok &= (r >= -1) & (r < references) & (p >= -1)
    last = at + FIXED + name - 1
    ends = data[np.minimum(last, len(data) - 1)] == 0
    return ok & ((last >= len(data)) | ends)


def _behind(raw: bytes, at: int) -> int | None:
    """Where a plausible record ends if its name, operations and tags fit too, as far as there are bytes; else None."""
    size, bases = struct.unpack_from("<i", raw, at)[0], struct.unpack_from("<i", raw, at + 20)[0]
    name, ops = raw[at + 12], struct.unpack_from("<H", raw, at + 16)[0]
    end = at + 4 + size
    text = raw[at + FIXED : at + FIXED + name - 1]
    if not all(33 <= c <= 126 for c in text):
        return None
    cigar = at + FIXED + name
    if any(raw[i] & 15 >= len(OPERATIONS) for i in range(cigar, min(len(raw), cigar + 4 * ops), 4)):
        return None
    tag = cigar + 4 * ops + (bases + 1) // 2 + bases
    while tag + 3 <= min(end, len(raw)):
        key, kind = raw[tag : tag + 2], chr(raw[tag + 2])
        if not key.isalnum():
            return None
        tag += 3
        if kind in NUMBERS or kind == "A":
            tag += 1 if kind == "A" else np.dtype(NUMBERS[kind]).itemsize
        elif kind in "ZH":
            nul = raw.find(b"\0", tag, end)
            if nul < 0:
                return end if end > len(raw) else None
            tag = nul + 1
        elif kind == "B" and tag + 5 <= len(raw) and chr(raw[tag]) in NUMBERS:
            tag += 5 + max(0, struct.unpack_from("<i", raw, tag + 1)[0]) * np.dtype(NUMBERS[chr(raw[tag])]).itemsize
        elif not (kind == "B" and tag + 5 > len(raw)):
            return None
    return end if tag == end or end > len(raw) else None


def first_record(raw: bytes, references: int, run: int = 8) -> int | None:
    """Place of the first record in unpacked bytes that may start inside of one: the first with ``run`` records in a row, or the longest row to the end."""
    data = np.frombuffer(raw, np.uint8)
    last = max(0, len(data) - FIXED + 1)
    best: tuple[bool, int] = (False, 0)
    place = None
    # A few at a time, as the first record is mostly near.
    parts = (np.arange(a, min(last, a + 4096)) for a in range(0, last, 4096))
    for start in (s for part in parts for s in part[_plausible(data, part, references)].tolist()):
        at, count = start, 0
        while at is not None and count < run and at + FIXED <= len(data) and _plausible(data, np.array([at]), references)[0]:
            at, count = _behind(raw, at), count + 1
        if at is not None and count == run:
            return start
        if at is not None and at + FIXED > len(data) and (at == len(data), count) > best:
            best, place = (at == len(data), count), start
    return place


def _pieces(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of ragged pieces behind each other, and their offsets."""
    ends = np.concatenate([[0], np.cumsum(sizes)])
    return data[np.repeat(starts - ends[:-1], sizes) + np.arange(ends[-1])], ends


def _strings(flat: np.ndarray, ends: np.ndarray, missing: np.ndarray | None = None) -> pa.Array:
    """Texts of ragged ASCII codes; missing ones are ``*``."""
    out = pa.StringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(flat)))
    return out if missing is None or not missing.any() else pc.if_else(pa.array(missing), "*", out)


_BASE_CODES = np.frombuffer(BASES.encode(), np.uint8)


def _cigars(data: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> pa.Array:
    flat, _ = _pieces(data, starts, counts * 4)
    kinds, code = np.unique(flat.view("<u4"), return_inverse=True)
    texts = pa.array([f"{k >> 4}{OPERATIONS[k & 15]}" for k in kinds.tolist()], pa.string())
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), texts.take(pa.array(code.ravel())))
    return pc.if_else(pa.array(counts == 0), "*", pc.binary_join(lists, ""))


def _tags(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Maps from tag to value text; the next tag of all records is read at once."""
    nul = np.flatnonzero(data == 0)
    at, rows = starts.copy(), np.arange(len(starts))
    owner, keys, values = [], [], []
    while len(rows := rows[at[rows] < ends[rows]]):
        p = at[rows]
        key = _strings(*_pieces(data, p, np.full(len(p), 2))).to_pylist()
        kind = data[p + 2]
        value = np.full(len(rows), None, object)
        step = np.zeros(len(rows), np.int64)
        for code in np.unique(kind):
            name, own = chr(code), np.flatnonzero(kind == code)
            q = p[own] + 3
            if name in NUMBERS:
                size = np.dtype(NUMBERS[name]).itemsize
                numbers = data[q[:, None] + np.arange(size)].copy().view(NUMBERS[name])[:, 0]
                value[own] = [f"{x:g}" for x in numbers.tolist()] if name == "f" else list(map(str, numbers.tolist()))
                step[own] = size
            elif name == "A":
                value[own], step[own] = [chr(c) for c in data[q]], 1
            elif name in "ZH":
                size = nul[np.searchsorted(nul, q)] - q
                value[own], step[own] = _strings(*_pieces(data, q, size)).to_pylist(), size + 1
            elif name == "B":
                for i, a in zip(own.tolist(), q.tolist(), strict=True):
                    inner, n = chr(data[a]), struct.unpack_from("<i", data, a + 1)[0]
                    numbers = np.frombuffer(data, NUMBERS[inner], n, a + 5).tolist()
                    value[i] = ",".join([inner, *(f"{x:g}" if inner == "f" else str(x) for x in numbers)])
                    step[i] = 5 + n * np.dtype(NUMBERS[inner]).itemsize
            else:
                raise ValueError(f"unknown kind of tag {name!r}")
        at[rows] = p + 3 + step
        owner.append(rows.copy())
        keys += key
        values += value.tolist()
    owner = np.concatenate(owner) if owner else np.empty(0, np.int64)
    order = pa.array(np.argsort(owner, kind="stable"))
    offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(starts)))]), pa.int32())
    return pa.MapArray.from_arrays(offsets, pa.array(keys, pa.string()).take(order), pa.array(values, pa.string()).take(order))


def decode(raw: bytes, at: np.ndarray, names: list[str]) -> pa.RecordBatch:
    """Alignments of the records that start at these places: positions from 0, as ``read_sam`` has them."""
    data = np.frombuffer(raw, np.uint8)
    size, ref, pos, bases, mate, mate_pos, length = (_int32(data, at + k) for k in (0, 4, 8, 20, 24, 28, 32))
    name, quality, ops, flag = data[at + 12].astype(np.int64), data[at + 13], _int16(data, at + 16), _int16(data, at + 18)
    bases = bases.astype(np.int64)
    begin = at + FIXED
    cigar = begin + name
    seq = cigar + 4 * ops
    qual = seq + (bases + 1) // 2
    tags = qual + bases
    ends = np.concatenate([[0], np.cumsum(bases)])
    nth = np.arange(ends[-1]) - np.repeat(ends[:-1], bases)
    packed = data[np.repeat(seq, bases) + nth // 2]
    letters = _BASE_CODES[np.where(nth % 2 == 0, packed >> 4, packed & 15)]
    scores, _ = _pieces(data, qual, bases)
    absent = (bases == 0) | (data[np.minimum(qual, len(data) - 1)] == 255)
    every = pa.array([*names, "*", "="], pa.string())
    rname = every.take(pa.array(np.where(ref < 0, len(names), ref)))
    rnext = every.take(pa.array(np.where(mate < 0, len(names), np.where(mate == ref, len(names) + 1, mate))))
    ints = {"flag": flag, "pos": pos, "mapq": quality, "pnext": mate_pos + 1, "tlen": length}
    columns = {
        "qname": _strings(*_pieces(data, begin, name - 1)), "rname": rname, "cigar": _cigars(data, cigar, ops), "rnext": rnext,
        "seq": _strings(letters, ends, bases == 0), "qual": _strings((scores + 33).astype(np.uint8), ends, absent), "tags": _tags(data, tags, at + 4 + size),
    } | {c: pa.array(v.astype(np.int32)) for c, v in ints.items()}
    return pa.RecordBatch.from_arrays([columns[n] for n in _ARROW.names], schema=_ARROW)


def _records(file, begin: int, end: int, size: int, header: tuple[list[str], int, int] | None = None) -> Iterator[pa.RecordBatch]:
    """Batches of the records whose block starts in the range; a header may span many ranges, which have none."""
    names, first, skip = header or _header(_blocks(file, 0))
    place = first if begin <= first else _first_block(file, begin, size)
    if place is None or place >= end:
        return
    held, passed, limit, synchronised = bytearray(), 0, None, begin <= first
    blocks = _blocks(file, place)
    while True:
        block = next(blocks, None)
        if block is not None:
            if block[0] >= end and limit is None:
                limit = passed + len(held)
            held += block[1]
            if len(held) < (TOGETHER if synchronised else SEARCHED) and limit is None:
                continue
            if not synchronised and len(held) < SEARCHED:
                continue
        if not synchronised:
            record = first_record(bytes(held), len(names))
            if record is None:
                if block is None:
                    return
                raise ValueError(f"no record found behind byte {place}")
            skip, synchronised = record, True
        at, places = skip, []
        while at + 4 <= len(held) and (limit is None or passed + at < limit):
            behind = at + 4 + struct.unpack_from("<i", held, at)[0]
            if behind > len(held):
                break
            places.append(at)
            at = behind
        if places:
            yield decode(bytes(held), np.array(places), names)
        if limit is not None and passed + at >= limit:
            return
        if block is None:
            if at < len(held):
                raise ValueError("the file ends inside of a record")
            return
        cut = min(at, len(held))
        del held[:cut]
        passed, skip = passed + cut, at - cut


@dataclass
class _Range:
    path: str
    begin: int
    end: int
    size: int
    changed: int | None


@dataclass
class _Ranges(InputPartition):
    """Splits of one task, each of which finds its own first record."""

    ranges: list[_Range]


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.path, self.split = options["path"], int(options.get("splitbytes", SPLIT))

    def partitions(self) -> list[_Ranges]:
        fs, path = _open(self.path)
        info = fs.get_file_info(path)
        if info.type == pafs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        files = [info] if info.is_file else [f for f in fs.get_file_info(pafs.FileSelector(path)) if f.path.endswith(".bam")]
        prefix = self.path[: len(self.path) - len(path)] if self.path.endswith(path) else ""
        ranges = [_Range(prefix + f.path, a, min(f.size, a + self.split), f.size, f.mtime_ns) for f in files for a in range(0, f.size, self.split)]
        # A task costs many times what a small split does.
        each = max(1, min(SPLIT // self.split, len(ranges) // TASKS))
        return [_Ranges(ranges[i : i + each]) for i in range(0, len(ranges), each)]

    def read(self, partition: _Ranges) -> Iterator[pa.RecordBatch]:
        for part in partition.ranges:
            fs, path = _open(part.path)
            with fs.open_input_file(path) as file:
                yield from _records(file, part.begin, part.end, part.size, _header_of(part.path, part.size, part.changed))


def pack_block(raw: bytes) -> bytes:
    """One compressed block; that of no bytes marks a file's end."""
    squeezer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = squeezer.compress(raw) + squeezer.flush()
    return b"\x1f\x8b\x08\x04" + bytes(5) + b"\xff\x06\x00BC\x02\x00" + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(raw), len(raw))


def encode_header(contigs: list[tuple[str, int]]) -> bytes:
    text = "".join(f"@SQ\tSN:{n}\tLN:{k}\n" for n, k in contigs).encode()
    out = [b"BAM\1", struct.pack("<i", len(text)), text, struct.pack("<i", len(contigs))]
    return b"".join(out + [struct.pack("<i", len(n.encode()) + 1) + n.encode() + b"\0" + struct.pack("<i", k) for n, k in contigs])


def _bin(begin: int, end: int) -> int:
    """The smallest of the format's nested bins that holds the range."""
    for level, shift in ((5, 14), (4, 17), (3, 20), (2, 23), (1, 26)):
        if begin >> shift == (end - 1) >> shift:
            return ((1 << 3 * level) - 1) // 7 + (begin >> shift)
    return 0


_NIBBLES = bytes(BASES.find(chr(c).upper()) if chr(c).upper() in BASES else 15 for c in range(256))
_SCORES = bytes(max(0, c - 33) for c in range(256))


def _operations(cigar: str | None) -> tuple[bytes, int, int]:
    """Packed operations, their number and the reference bases that they cover."""
    ops = [(int(n), OPERATIONS.index(o)) for n, o in re.findall(r"(\d+)([MIDNSHP=X])", cigar or "")]
    return b"".join(struct.pack("<I", n << 4 | o) for n, o in ops), len(ops), sum(n for n, o in ops if OPERATIONS[o] in "MDN=X")


def _tag(key: str, value: str | None) -> bytes:
    whole = re.fullmatch(r"-?\d{1,10}", value or "") and -(1 << 31) <= int(value) < 1 << 31 and str(int(value)) == value
    return key.encode() + (b"i" + struct.pack("<i", int(value)) if whole else b"Z" + (value or "").encode() + b"\0")


def _bases(seq: str | None, qual: str | None) -> tuple[bytes, int]:
    """Packed bases with their scores, and their number."""
    seq = "" if seq in (None, "*") else seq
    codes = np.frombuffer(seq.encode("ascii", "replace").translate(_NIBBLES) + b"\0" * (len(seq) % 2), np.uint8)
    qual = qual or "*"
    scores = b"\xff" * len(seq) if qual == "*" and len(seq) != 1 or len(qual) != len(seq) else qual.encode("ascii", "replace").translate(_SCORES)
    return (codes[0::2] << 4 | codes[1::2]).tobytes() + scores, len(seq)


_HEAD = struct.Struct("<iiiBBHHHiiii")


def _coded(column: pa.Array) -> tuple[list, list]:
    """Different values of a column, None too, and the number of each row's."""
    coded = column.dictionary_encode(null_encoding="encode")
    return coded.dictionary.to_pylist(), coded.indices.to_numpy().tolist()


def encode_all(batch: pa.RecordBatch, number: dict[str, int]) -> Iterator[bytes]:
    """Records of a batch; a name that is not among the contigs is an error, missing fields are the format's. Equal names, CIGARs and tags are encoded once."""
    column = dict(zip(batch.schema.names, batch.columns, strict=True))
    ints = lambda c, missing=0: column[c].fill_null(missing).to_numpy().tolist()
    coded = {c: _coded(column[c]) for c in ("rname", "rnext", "cigar")}
    refs = [-1 if n in (None, "*") else number[n] for n in coded["rname"][0]]
    mates = [None if n == "=" else -1 if n in (None, "*") else number[n] for n in coded["rnext"][0]]
    ops = [_operations(c) for c in coded["cigar"][0]]
    tags = column["tags"]
    offsets, there = tags.offsets.to_numpy().tolist(), tags.is_valid().to_numpy(zero_copy_only=False).tolist()
    first, last = (offsets[0], offsets[-1]) if len(tags) else (0, 0)
    (keys, key_of), (values, value_of) = _coded(tags.keys.slice(first, last - first)), _coded(tags.items.slice(first, last - first))
    texts: dict[tuple[int, int], bytes] = {}
    pieces = []
    for pair in zip(key_of, value_of, strict=True):
        piece = texts.get(pair)
        if piece is None:
            piece = texts[pair] = _tag(keys[pair[0]], values[pair[1]])
        pieces.append(piece)
    bare = column["seq"].null_count == column["qual"].null_count == len(batch)
    bases = None if bare else [_bases(q, r) for q, r in zip(column["seq"].to_pylist(), column["qual"].to_pylist(), strict=True)]
    rows = zip(column["qname"].to_pylist(), coded["rname"][1], coded["rnext"][1], coded["cigar"][1], *(ints(c) for c in ("flag", "mapq", "pnext", "tlen")), ints("pos", -1), strict=True)
    for i, (name, r, m, c, flag, mapq, pnext, tlen, pos) in enumerate(rows):
        ref, mate, (packed, count, covered) = refs[r], mates[m], ops[c]
        begin = max(0, pos)
        letters, size = (b"", 0) if bare else bases[i]
        name = (name or "*").encode()
        own = b"".join(pieces[offsets[i] - first : offsets[i + 1] - first]) if there[i] else b""
        body = b"".join((name, b"\0", packed, letters, own))
        yield _HEAD.pack(32 + len(body), ref, pos, len(name) + 1, min(255, mapq), _bin(begin, begin + max(1, covered)), count, flag, size, ref if mate is None else mate, pnext - 1, tlen) + body


def encode(row: dict, number: dict[str, int]) -> bytes:
    """One record."""
    return next(encode_all(pa.RecordBatch.from_pylist([row], schema=_ARROW), number))


@dataclass
class _Written(WriterCommitMessage):
    file: str


class _Writer(DataSourceArrowWriter):
    """Every task writes a whole file under a hidden name; committing gives the files of successful tasks their names."""

    def __init__(self, options, overwrite: bool):
        self.path, self.overwrite = options["path"].rstrip("/"), overwrite
        self.contigs = [(c.rpartition(":")[0], int(c.rpartition(":")[2])) for c in options.get("contigs", "").split(",") if c]

    def write(self, batches: Iterator[pa.RecordBatch]) -> _Written:
        fs, path = _open(self.path)
        fs.create_dir(path, recursive=True)
        number = {n: i for i, (n, _) in enumerate(self.contigs)}
        file = f"{path}/.{uuid.uuid4().hex}.bam"
        with fs.open_output_stream(file) as out:
            held = bytearray(encode_header(self.contigs))

            def flush(least: int) -> None:
                while len(held) > least:
                    out.write(pack_block(bytes(held[:BLOCK])))
                    del held[:BLOCK]

            for batch in batches:
                for record in encode_all(batch, number):
                    held += record
                    if len(held) > BLOCK:
                        flush(BLOCK)
            flush(0)
            out.write(pack_block(b""))
        return _Written(file)

    def commit(self, messages: list[_Written | None]) -> None:
        fs, path = _open(self.path)
        fs.create_dir(path, recursive=True)
        kept = {m.file for m in messages if m}
        for f in fs.get_file_info(pafs.FileSelector(path)):
            # Other files are earlier results, or what attempts left that did not count.
            if f.path.endswith(".bam") and f.path not in kept and (self.overwrite or f.base_name.startswith(".")):
                fs.delete_file(f.path)
        for file in sorted(kept):
            fs.move(file, f"{path}/part-{file.rpartition('/.')[2]}")

    def abort(self, messages: list[_Written | None]) -> None:
        fs, _ = _open(self.path)
        for m in messages:
            if m and fs.get_file_info(m.file).is_file:
                fs.delete_file(m.file)


class BamSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return schema.ALIGNMENTS

    def reader(self, schema) -> _Reader:
        return _Reader(self.options)

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options, overwrite)


def read_bam(spark: SparkSession, path: str, split_bytes: int = SPLIT) -> DataFrame:
    """Alignments of a file or of all ``.bam`` files of a folder, as ``read_sam`` has them; larger files are read by several tasks."""
    spark.dataSource.register(BamSource)
    return spark.read.format("bam").option("splitBytes", split_bytes).load(path)


def write_bam(alignments: DataFrame, contigs: DataFrame, path: str) -> None:
    """A folder of whole files without order, one a task, whose headers list ``contigs`` (name, length: the driver holds these).

    Running it again replaces what lies there; a task that is run twice leaves one file.
    """
    spark = alignments.sparkSession
    spark.dataSource.register(BamSource)
    listed = ",".join(f"{r['name']}:{r['length']}" for r in contigs.select("name", "length").orderBy("name").collect())
    names = [c.split()[0] for c in schema.ALIGNMENTS.split(", ")]
    alignments.select(*names).write.format("bam").option("contigs", listed).mode("overwrite").save(path)
