"""FASTQ files as a Spark data source whose tasks read whole records, so that no line is shuffled.

A plain file is split at any byte.  A task looks for the first record behind its border: the
line that starts with ``@`` and whose second next one starts with ``+``.  No other line of a
record can do so, because sequences start with neither.  Records belong to the split
their header starts in.  A compressed file is one split.

Files are opened by Arrow's file systems (local, HDFS, S3, GCS); a path is a file, a folder
or a folder with a pattern.
"""

from __future__ import annotations

import fnmatch
import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SUFFIXES = (".fq", ".fastq", ".fq.gz", ".fastq.gz")
#: Bytes that are taken apart together, and bytes behind a border in which a record is looked for at first.
TOGETHER, SEARCHED = 4 << 20, 1 << 14
SCHEMA = "source int, split int, at bigint, header string, seq string, qual string"
COUNTS = "source int, split int, n bigint"


@dataclass
class Split(InputPartition):
    """Bytes of one file: ``source`` numbers the given path, ``split`` counts through all its files in order."""

    source: int
    split: int
    path: str
    begin: int
    end: int
    size: int

    @property
    def compressed(self) -> bool:
        return self.path.endswith(".gz")


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def _files(path: str) -> list[tuple[str, int]]:
    """Names and sizes of the files that a path stands for, in the order of their names."""
    folder, _, pattern = path.rpartition("/")
    if not set("*?[") & set(pattern):
        folder, pattern = path, ""
    fs, inner = _open(folder or "/")
    info = fs.get_file_info(inner)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.is_file:
        return [(path, info.size)]
    inside = sorted((f for f in fs.get_file_info(pafs.FileSelector(inner)) if f.is_file), key=lambda f: f.path)
    fits = (lambda n: fnmatch.fnmatch(n, pattern)) if pattern else (lambda n: n.endswith(SUFFIXES))
    found = [(f"{folder.rstrip('/')}/{f.base_name}", f.size) for f in inside if fits(f.base_name)]
    if not found:
        raise FileNotFoundError(path)
    return found


def splits(paths: Sequence[str], split_bytes: int) -> list[Split]:
    out = []
    for source, path in enumerate(paths):
        ranges = [(name, a, size) for name, size in _files(path) for a in (range(0, size, split_bytes) if not name.endswith(".gz") else [0])]
        out += [Split(source, i, name, a, size if name.endswith(".gz") else min(size, a + split_bytes), size) for i, (name, a, size) in enumerate(ranges)]
    return out


def first_record(file, begin: int, size: int, path: str) -> int:
    """Place of the first header at or behind ``begin``, ``size`` if there is none."""
    back, ahead = 0, SEARCHED
    while begin:
        low = max(0, begin - back)
        base = max(0, low - 1)
        file.seek(base)
        raw = np.frombuffer(file.read(begin - base + ahead), np.uint8)
        behind = np.flatnonzero(raw == 10) + 1
        starts = np.concatenate([[0], behind]) if low == 0 else behind
        starts = starts[starts < len(raw)]
        last = base + len(raw) >= size
        head = raw[starts]
        known = [0] if low == 0 else [i for i in range(min(4, len(starts) - 2)) if head[i] == ord("@") and head[i + 2] == ord("+")]
        if known:
            headers = starts[known[0] :: 4] + base
            at = headers[np.searchsorted(headers, begin) :]
            if len(at) or last:
                return int(at[0]) if len(at) else size
        elif len(starts) >= 6:
            raise ValueError(f"no FASTQ record behind byte {begin} of {path}")
        elif last:
            # Too few lines are left to tell; they are told by the lines before them.
            back = max(SEARCHED, back * 4)
            continue
        ahead *= 4
    return 0


def _columns(raw: bytes, ends: np.ndarray) -> list[pa.Array]:
    """Headers without ``@``, sequences and qualities of whole records; ``ends`` are those of their lines."""
    offsets = pa.py_buffer(np.concatenate([[0], ends]).astype(np.int64))
    lines = pa.LargeStringArray.from_buffers(len(ends), offsets, pa.py_buffer(raw))
    texts = lambda i: pc.ascii_rtrim(lines.take(pa.array(np.arange(i, len(ends), 4))), characters="\r\n").cast(pa.string())
    return [pc.utf8_slice_codeunits(texts(0), 1), texts(1), texts(3)]


def records(file, begin: int, end: int | None, path: str) -> Iterator[tuple[bytes, np.ndarray]]:
    """Bytes and ends of lines of whole records; those whose header starts before ``end``, from a header at ``begin`` on."""
    rest, place = b"", begin
    while end is None or place < end:
        more = file.read(TOGETHER)
        raw = rest + more
        if not more and raw and not raw.endswith(b"\n"):
            raw += b"\n"
        ends = np.flatnonzero(np.frombuffer(raw, np.uint8) == 10) + 1
        n = len(ends) // 4
        if not more and len(ends) % 4:
            raise ValueError(f"Truncated FASTQ record in {path}")
        stops = ends[3::4][:n]
        kept = n if end is None else int(np.searchsorted(place + np.concatenate([[0], stops[:-1]]), end)) if n else 0
        if kept:
            yield raw, ends[: 4 * kept]
        if kept < n or not more:
            return
        used = int(stops[-1]) if n else 0
        rest, place = raw[used:], place + used


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.paths, self.split = json.loads(options["paths"]), int(options["splitbytes"])
        self.counts = options.get("counts") == "true"

    def partitions(self) -> list[Split]:
        return splits(self.paths, self.split)

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        fs, path = _open(partition.path)
        opened = fs.open_input_stream(path, compression="gzip") if partition.compressed else fs.open_input_file(path)
        n, names = 0, ["source", "split", "at", "header", "seq", "qual"]
        numbers = lambda k: [pa.array(np.full(k, v, np.int32)) for v in (partition.source, partition.split)]
        with opened as file:
            begin, end = 0, None
            if not partition.compressed:
                begin, end = first_record(file, partition.begin, partition.size, partition.path), partition.end
                file.seek(begin)
            for raw, ends in records(file, begin, end, partition.path):
                k = len(ends) // 4
                if not self.counts:
                    at = pa.array(np.arange(n, n + k, dtype=np.int64))
                    yield pa.RecordBatch.from_arrays([*numbers(k), at, *_columns(raw, ends)], names)
                n += k
        if self.counts:
            yield pa.RecordBatch.from_arrays([*numbers(1), pa.array([n], pa.int64())], ["source", "split", "n"])


class FastqSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        return COUNTS if self.options.get("counts") == "true" else SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(self.options)


def scan(spark: SparkSession, paths: Sequence[str], split_bytes: int, counts: bool = False) -> DataFrame:
    """Records with their path's number, split and place in the split; with ``counts`` only the number of records of every split."""
    spark.dataSource.register(FastqSource)
    options = {"paths": json.dumps(list(paths)), "splitBytes": split_bytes, "counts": str(counts).lower()}
    return spark.read.format("fastq").options(**options).load()


def numbered(spark: SparkSession, paths: Sequence[str], split_bytes: int) -> DataFrame:
    """``source, record`` (from 0 in each path) and the record's texts.

    Paths of one split need no more than their places.  Others are read once more to count:
    one number a split, written so that Spark knows its size and broadcasts it while it is small.
    """
    from . import shared

    rows = scan(spark, paths, split_bytes)
    if all(s.split == 0 for s in splits(paths, split_bytes)):
        return rows.select("source", F.col("at").alias("record"), "header", "seq", "qual")
    counts = shared.table(scan(spark, paths, split_bytes, counts=True))
    before = F.expr("coalesce(sum(n) OVER (PARTITION BY source ORDER BY split ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)")
    starts = shared.table(counts.select("source", "split", before.alias("start")))
    return rows.join(starts, ["source", "split"]).select("source", (F.col("start") + F.col("at")).alias("record"), "header", "seq", "qual")
