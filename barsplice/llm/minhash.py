"""Near-duplicate texts by circulant MinHash, banding and exact Jaccard verification.

A text's set holds its distinct shingles of five words.  Two fixed permutations of one
universe make every signature coordinate: the first places a shingle, the second is read
at that place shifted by the coordinate's number (Li & Li, "C-MinHash", 2021).

Links are found without listing all pairs of a group:

1. texts with equal sets form a class, represented once;
2. in every bucket of equal bands each class is compared with the bucket's smallest class;
3. classes of one bucket that then still lie in different components are compared in
   tiles of bounded size, which the triangle inequality of the Jaccard distance (through
   the bucket's smallest class) keeps to those that can be close; a tile emits only a
   spanning forest of the links it confirms.

All links rest on full sets.  With 24 bands of 5 rows a pair at the threshold of 0.85 is
missed by every band with probability 8e-7; the smaller threshold of 0.8 uses the same
bands and misses 7e-5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, table
from .components import connected_components

BANDS, ROWS, WORDS = 24, 5, 5
#: Classes of either side of a tile.
TILE = 512
#: Places of the permuted universe, a power of two.
UNIVERSE_BITS = 20
_BASE = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """Words to 64-bit hashes, kept for words seen lately."""

    limit = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def words_of(text: bytes) -> list[bytes]:
    """A-Z in lower case, words split at the six ASCII white-space bytes."""
    return text.lower().split()


def shingles_of(text: bytes | None, hashes: WordHashes, width: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes; a shorter text is one shingle, one without words none."""
    words = words_of(text or b"")
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - width + 1)
    with np.errstate(over="ignore"):
        acc = np.zeros(n, np.uint64)
        for i in range(min(width, len(h))):
            acc = (acc ^ h[i : i + n]) * _BASE
            acc ^= acc >> np.uint64(29)
    return np.unique(acc)


class Circulant:
    """Signature coordinates from two permutations, the second one shifted circularly."""

    def __init__(self, size: int, seed: int = 20210908):
        rng = np.random.default_rng(seed)
        n = 1 << UNIVERSE_BITS
        self.place = rng.permutation(n).astype(np.int32)
        second = rng.permutation(n).astype(np.int32)
        self.windows = np.lib.stride_tricks.sliding_window_view(np.concatenate([second, second[: size - 1]]), size)
        self.size = size

    def signature(self, shingles: np.ndarray, step: int = 4096) -> np.ndarray:
        places = self.place[(shingles >> np.uint64(64 - UNIVERSE_BITS)).astype(np.int64)]
        out = np.full(self.size, np.iinfo(np.int32).max, np.int32)
        for i in range(0, len(places), step):
            np.minimum(out, self.windows[places[i : i + step]].min(axis=0), out=out)
        return out


def _profiles(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, circulant = WordHashes(), Circulant(BANDS * ROWS)
        powers = np.array([pow(0xD6E8FEB86659FD93, i + 1, 1 << 64) for i in range(ROWS)], np.uint64)
        salt = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)
        for batch in batches:
            sizes, keys, bands = [], [], []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                s = shingles_of(text, hashes, width)
                sizes.append(len(s))
                keys.append(xxhash.xxh3_128_digest(s.tobytes()))
                if len(s):
                    with np.errstate(over="ignore"):
                        rows = circulant.signature(s).astype(np.uint64).reshape(BANDS, ROWS)
                        value = (rows * powers).sum(axis=1, dtype=np.uint64) + salt
                        value ^= value >> np.uint64(31)
                        value *= _BASE
                    bands.append(value.view(np.int64))
                else:
                    bands.append(np.empty(0, np.int64))
            ends = np.cumsum([0, *map(len, bands)]).astype(np.int32)
            flat = np.concatenate(bands) if bands else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                ["id", "n_shingles", "class", "bands"],
            )

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            keys, sets = [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                s = shingles_of(text, hashes, width)
                if xxhash.xxh3_128_digest(s.tobytes()) == key:  # else another text under a repeated id
                    keys.append(key)
                    sets.append(s.view(np.int64))
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            flat = np.concatenate(sets) if sets else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["class", "set"])

    return run


def _overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Both set sizes, the intersection and the Jaccard distance of each pair of classes."""
    return (
        pairs.join(sets.withColumnRenamed("set", "s"), "class")
        .join(sets.select(F.col("class").alias("other"), F.col("set").alias("t")), "other")
        .select("class", "other", F.size("s").alias("n"), F.size("t").alias("m"), F.size(F.array_intersect("s", "t")).alias("both"))
        .withColumn("distance", 1 - F.col("both") / (F.col("n") + F.col("m") - F.col("both")))
    )


def _linked(percent: int):
    return 100 * F.col("both").cast("long") >= percent * (F.col("n") + F.col("m") - F.col("both")).cast("long")


def _across(measured: DataFrame, found: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between classes that share a bucket but lie in different components after the stars.

    Both have been measured against the bucket's smallest class, their leader, so all are
    found among the classes of a leader.  These are cut along the distance to the leader
    into bins as wide as the largest distance of a link: partners lie in the same bin or in
    adjacent ones.  Bins are joined in tiles of bounded size, and a tile emits only a
    spanning forest of the links it confirms.
    """
    width = 1 - percent / 100
    names = found.withColumnRenamed("node", "class")
    group = (
        measured.join(names, "class", "left")
        .join(names.select(F.col("class").alias("other"), F.col("component").alias("own")), "other", "left")
        .select("class", F.col("other").alias("leader"), "distance", F.coalesce("component", "class").alias("component"), F.coalesce("own", "other").alias("own"))
    )
    group = cut(group)
    apart = F.col("component") != F.col("own")
    open_ = (
        group.groupBy("leader")
        .agg(F.count(F.lit(1)).alias("size"), F.min(F.when(apart, F.col("distance"))).alias("least"))
        .where("size > 1 and least is not null")
    )
    placed = (
        group.join(open_, "leader")
        .where(F.col("distance") >= F.col("least") - width - 1e-9)
        .withColumn("bin", F.floor(F.col("distance") / (width + 1e-9)).cast("int"))
        .withColumn("splits", F.ceil(F.col("size") / TILE).cast("int"))
        .withColumn("split", F.pmod(F.xxhash64("class"), F.col("splits")).cast("int"))
    )
    every = F.sequence(F.lit(0), F.col("splits") - 1)
    tile = lambda b, i, j: F.struct(b.cast("int").alias("bin"), i.cast("int").alias("i"), j.cast("int").alias("j"))
    tiles = F.array_union(
        F.transform(every, lambda k: tile(F.col("bin"), F.col("split"), k)),
        F.array_union(
            F.transform(every, lambda k: tile(F.col("bin"), k, F.col("split"))),
            F.transform(every, lambda k: tile(F.col("bin") - 1, k, F.col("split"))),
        ),
    )
    placed = placed.select("class", "leader", "component", F.col("bin").alias("own_bin"), "split", F.explode(tiles).alias("t")).where("t.bin >= 0")
    keys = ["leader", "bin", "i", "j"]
    rows = placed.select(
        "class", "leader", "component", "t.bin", "t.i", "t.j",
        ((F.col("own_bin") == F.col("t.bin")) & (F.col("split") == F.col("t.i"))).alias("native"),
        (F.col("split") == F.col("t.j")).alias("guest"),
    )
    # A tile needs a native and someone of another component.
    useful = (
        rows.groupBy(*keys)
        .agg(F.min("component").alias("low"), F.max("component").alias("high"), F.max("native").alias("any"), F.count(F.lit(1)).alias("n"))
        .where("low != high and any and n > 1")
        .select(*keys)
    )
    filled = rows.join(useful, keys).join(sets, "class")
    return filled.groupBy(*keys).applyInArrow(_tile_links(percent), "a binary, b binary")


def _tile_links(percent: int):
    def run(tile):
        names = tile.column("class").to_pylist()
        component = np.unique(np.array(tile.column("component").to_pylist(), object), return_inverse=True)[1]
        native, guest = (tile.column(c).to_numpy() for c in ("native", "guest"))
        raw = tile.column("set").combine_chunks()
        raw = raw.chunk(0) if isinstance(raw, pa.ChunkedArray) else raw
        flat = raw.flatten().to_numpy()
        sizes = np.diff(raw.offsets.to_numpy())
        owner = np.repeat(np.arange(len(names)), sizes)
        # Shingles of one class alone are in no intersection.
        _, code, times = np.unique(flat, return_inverse=True, return_counts=True)
        shared = times[code] > 1
        code, owner = np.unique(code[shared], return_inverse=True)[1], owner[shared]
        x, y = np.flatnonzero(native), np.flatnonzero(guest)
        both = np.zeros((len(x), len(y)), np.float32)
        order = np.argsort(code, kind="stable")
        code, owner = code[order], owner[order]
        for start in range(0, int(code[-1]) + 1 if len(code) else 0, 8192):
            lo, hi = np.searchsorted(code, [start, start + 8192])
            part = np.zeros((len(names), 8192), np.float32)
            part[owner[lo:hi], code[lo:hi] - start] = 1
            both += part[x] @ part[y].T
        i, j = np.nonzero(100 * both >= percent * (sizes[x][:, None] + sizes[y][None, :] - both))
        i, j = x[i], y[j]
        label, a, b = component, [], []
        while True:
            differ = label[i] != label[j]
            i, j = i[differ], j[differ]
            if not len(i):
                break
            a.append(names[i[0]])
            b.append(names[j[0]])
            label = np.where(label == label[i[0]], label[j[0]], label)
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85, width: int = WORDS) -> DataFrame:
    """``(id_col, n_shingles, component_id, kept)``, one row per input row.

    Texts are linked if 100 * intersection >= percent * union of their shingle sets;
    ``component_id`` is the smallest id reachable by links, ``kept`` marks that row.

    Null, empty and blank texts have no shingles and are linked with nothing.  Rows with a
    null id are linked with nothing, have a null component and are kept.  Rows that repeat
    an id are returned each; equal ones share a component.  Other columns are ignored.  An
    empty table gives no rows.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    profiles = table(base.mapInArrow(_profiles(width), f"id {id_type}, n_shingles bigint, class binary, bands array<bigint>"))
    linked = profiles.where((F.col("n_shingles") > 0) & F.col("id").isNotNull())
    classes = linked.groupBy("class").agg(F.min("id").alias("id"), F.min("n_shingles").alias("n"))
    representatives = linked.select("id", "class", "bands").join(classes, ["id", "class"])
    bands = representatives.select("class", "n", F.explode("bands").alias("bucket"))
    buckets = bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("class").alias("leader")).where("size > 1")
    members = table(bands.join(buckets.select("bucket", "leader"), "bucket"))
    stars = table(members.where("class != leader").select("class", F.col("leader").alias("other")).distinct())

    candidates = stars.select("class").unionByName(stars.select(F.col("other").alias("class"))).distinct()
    wanted = classes.join(candidates, "class").select("id", "class")
    sets = table(base.join(wanted, "id").select("class", "text").mapInArrow(_sets(width), "class binary, set array<bigint>"))
    measured = table(_overlaps(stars, sets))
    links = measured.where(_linked(percent)).select(F.col("class").alias("a"), F.col("other").alias("b"))
    found = cut(connected_components(links))

    more = cut(_across(measured, found, sets, percent))
    if not more.isEmpty():
        found = connected_components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))
    return _named(profiles, classes, found, id_col)


def _named(profiles: DataFrame, classes: DataFrame, found: DataFrame, id_col: str) -> DataFrame:
    """Components of classes as smallest ids, joined to every row."""
    of = classes.join(found.withColumnRenamed("node", "class"), "class", "left").select("class", F.coalesce("component", "class").alias("component"), "id")
    least = of.groupBy("component").agg(F.min("id").alias("component_id"))
    names = of.select("class", "component").join(least, "component").select("class", "component_id")
    component = F.when(F.col("id").isNull(), None).when(F.col("n_shingles") == 0, F.col("id")).otherwise(F.col("component_id"))
    return profiles.select("id", "n_shingles", "class").join(names, "class", "left").select(
        F.col("id").alias(id_col),
        "n_shingles",
        component.alias("component_id"),
        (F.col("id").isNull() | (F.col("id") == component)).alias("kept"),
    )
