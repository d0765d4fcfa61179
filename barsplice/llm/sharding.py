"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``replicas`` virtual nodes on a ring of ``slots`` places.  A key hashes to
a place and belongs to the next virtual node clockwise; once that node's shard is full, the
rest continue clockwise.  The bounds are exact quotas, so shard counts differ by at most
one (law ``rows``), and only keys that overflow leave the shard that the plain ring gives.

Where keys overflow depends only on the number of keys at each place.  These counts, one
number a place however large the table is, are walked once around the ring on the driver;
the resulting intervals (place, ranks, shard, first slot) are joined back, and a row's rank
within its place, by hash and id, decides.  All row work is DataFrame functions.
"""

from __future__ import annotations

from collections import deque

import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARDS, REPLICAS, SLOTS = 24, 128, 1 << 15


def ring(shards: int, replicas: int = REPLICAS, slots: int = SLOTS) -> list[tuple[int, int]]:
    """(place, shard) of the virtual nodes in clockwise order; a taken place keeps its smallest shard."""
    places: dict[int, int] = {}
    for shard in range(shards):
        for replica in range(replicas):
            place = xxhash.xxh64_intdigest(f"{shard}/{replica}") % slots
            places[place] = min(shard, places.get(place, shard))
    return sorted(places.items())


def quotas(total: int, shards: int) -> list[int]:
    return [total // shards + (s < total % shards) for s in range(shards)]


def walk(counts: dict[int, int], shards: int, replicas: int = REPLICAS, slots: int = SLOTS) -> list[tuple[int, int, int, int, int]]:
    """(place, first rank, end rank, shard, slot of the first rank) for all keys.

    Nodes are visited clockwise from place 0.  A node admits its own keys by place and
    rank, then those that overflowed before it, as far as its shard's quota lasts; the
    rest are carried on, around the ring again if need be.
    """
    nodes = ring(shards, replicas, slots)
    left, filled, out = quotas(sum(counts.values()), shards), [0] * shards, []
    carried: deque[tuple[int, int, int]] = deque()
    own: list[list[tuple[int, int, int]]] = [[] for _ in nodes]
    node = 0
    for place in sorted(counts):
        while node < len(nodes) and nodes[node][0] < place:
            node += 1
        own[node % len(nodes)].append((place, 0, counts[place]))
    lap = 0
    while lap < 2 or carried:
        for i, (_, shard) in enumerate(nodes):
            queue = deque(own[i] if lap == 0 else ())
            queue.extend(carried)
            carried = deque()
            while queue:
                place, a, b = queue.popleft()
                n = min(b - a, left[shard])
                if n:
                    out.append((place, a, a + n, shard, filled[shard]))
                    left[shard] -= n
                    filled[shard] += n
                if a + n < b:
                    carried.append((place, a + n, b))
        lap += 1
    return out


def shard(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", replicas: int = REPLICAS, slots: int = SLOTS) -> DataFrame:
    """``id_col, size, text_crc32, law, shard, slot, grown_shard``, one row per input row.

    ``size`` is the text's UTF-8 bytes (null: 0) plus 8, ``slot`` counts a shard's rows
    from 0 without gaps.  A null id has its own place on the ring; rows that repeat an id
    share a place and may overflow apart.  ``grown_shard`` is null: this law moves rows
    between the old shards too when one is added.  Other columns are ignored; an empty
    table gives no rows.
    """
    spark = docs.sparkSession
    key = F.xxhash64(F.col(id_col))
    place = F.pmod(key, F.lit(slots)).cast("int")
    counts = {r[0]: r[1] for r in docs.groupBy(place.alias("place")).agg(F.count(F.lit(1))).collect()}  # at most ``slots`` rows
    intervals = spark.createDataFrame(walk(counts, shards, replicas, slots), "place int, first long, last long, shard int, base long")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + 8).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        place.alias("place"),
        key.alias("key"),
    )
    order = Window.partitionBy("place").orderBy("key", "id", "text_crc32", "size")
    ranked = rows.withColumn("rank", F.row_number().over(order) - 1)
    # At most slots + shards * replicas * laps intervals, whatever the table's size.
    at = (ranked["place"] == intervals["place"]) & (ranked["rank"] >= intervals["first"]) & (ranked["rank"] < intervals["last"])
    return ranked.join(F.broadcast(intervals), at).select(
        F.col("id").alias(id_col),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        (F.col("base") + F.col("rank") - F.col("first")).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
