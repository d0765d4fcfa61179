"""Packing by concatenating and cutting, in two passes over the token totals of partitions.

The first pass encodes every text once and stores its ids (two bytes each) with the id's
place in its partition.  Prefix sums over the partitions' totals, one row a partition,
give every text its global place.  The second pass cuts at multiples of the sequence
length: a text's boundary records say which piece lies where.  Only ids move, no text,
and no row is shuffled.
"""

from __future__ import annotations

import base64
import functools
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import table

#: Id that closes every document.
END = 0
#: The tokenizer's pre-token pattern (possessive, so equal matches at less cost); fixed values.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
PIECE = "length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def added_tokens(path: str) -> dict[str, int]:
    """Added tokens of the tokenizers file beside a vocabulary; none where there is no such file."""
    beside = f"{os.path.splitext(path)[0]}.json"
    if not os.path.exists(beside):
        return {}
    with open(beside, encoding="utf-8") as f:
        return {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}


@functools.lru_cache(maxsize=2)
def _encoding(path: str):
    import tiktoken

    added = added_tokens(path)

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    if max([*ranks.values(), *added.values()]) >= 1 << 16:
        raise ValueError("ids must fit two bytes")
    return tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)


def encoder(path: str):
    """A text's ids: those of added tokens where they stand, and of the parts between them by ranks."""
    encoding = _encoding(path)
    added = tuple(encoding.special_tokens_set)

    def encode(text: str) -> list[int]:
        if any(t in text for t in added):
            return encoding.encode(text, allowed_special="all")
        return encoding.encode_ordinary(text)

    return encode


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        part, place = TaskContext.get().partitionId(), 0
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                rows = batch.slice(i, 1000)
                ids = [np.array([*encode(t or ""), END], np.uint16) for t in rows.column(1).to_pylist()]
                sizes = np.fromiter(map(len, ids), np.int64, len(ids))
                starts = place + np.cumsum(sizes) - sizes
                place += int(sizes.sum())
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array([part] * len(ids), pa.int32()), pa.array(starts), pa.array(sizes), pa.array([x.astype("<u2").tobytes() for x in ids], pa.binary())],
                    ["id", "part", "local", "size", "ids"],
                )

    return run


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begins = batch.column(1).to_pylist()
            doc, start, size, crc, total, sequence, offset = [], [], [], [], [], [], []
            for row, (begin, raw) in enumerate(zip(begins, batch.column(2).to_pylist(), strict=True)):
                ids = np.frombuffer(raw, "<u2").astype("<u4")
                at = 0
                while at < len(ids):
                    where = (begin + at) % length
                    end = min(len(ids), at + length - where)
                    doc.append(row)
                    start.append(at)
                    size.append(end - at)
                    crc.append(zlib.crc32(ids[at:end].tobytes()))
                    total.append(len(ids))
                    sequence.append((begin + at) // length)
                    offset.append(where)
                    at = end
            numbers = (start, size, crc, total, sequence, offset)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(doc, pa.int64())), *(pa.array(x, pa.int64()) for x in numbers)],
                ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    return run


def token_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """``id, begin, size, ids``: each document's ids as little-endian 16-bit binary, with its place in the whole."""
    id_type = docs.schema[id_col].dataType.simpleString()
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    encoded = table(base.mapInArrow(_encode(vocabulary or default_vocabulary()), f"id {id_type}, part int, local bigint, size bigint, ids binary"))
    totals = encoded.groupBy("part").agg(F.sum("size").alias("total"))
    # One row a partition of the input: a few bytes for every 128 MB of it.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    return encoded.join(F.broadcast(bases), "part").select("id", (F.col("base") + F.col("local")).alias("begin"), "size", "ids")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 1024, vocabulary: str | None = None) -> DataFrame:
    """One row per piece: a run of one document's ids that lies in one sequence.

    ``start`` counts the document's ids before the piece, ``offset`` the sequence's.  Only
    the last sequence can be short.  Null and empty texts are one closing id.  Rows with a
    null or repeated id are packed like any other.  Other columns are ignored; an empty
    table gives no pieces.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    tokens = token_table(docs, id_col, text_col, vocabulary).select("id", "begin", "ids")
    pieces = tokens.mapInArrow(_cut(length), f"id {id_type}, start bigint, {PIECE}")
    return pieces.withColumnRenamed("id", id_col)
