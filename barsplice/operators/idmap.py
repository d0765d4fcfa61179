"""Fuzzy mapping of sequences to known ids.

Queries are made distinct first; exact and reverse-complement matches are equi-joins, so
only the rest is compared by edit distance.  That comparison is an equi-join too: of k + r
segments of a known sequence, k edits leave r untouched, which appear in the query at places
that the same edits allow.  All r together are the key, and r is chosen by the number of
known sequences, so that keys stay selective however many there are.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fuzzy import shared
from ..functions.seeding import packed
from ..functions.sequence import revcomp


def known_sequences(ids: DataFrame, order: str = "line") -> DataFrame:
    """``seq, id, ord``: a repeated sequence has its first line's place and its last line's id."""
    return ids.groupBy(F.upper("seq").alias("seq")).agg(F.max_by("id", order).alias("id"), F.min(order).alias("ord"))


#: Known sequences of a chunk, queries of a block, bytes of either, queries that meet the same copy of the known ones, and least queries of a part.
CHUNK, BLOCK, BYTES, TOGETHER, LEAST = 200_000, 50_000, 4 << 20, 1_000_000, 4_000


@functools.cache
def signatures(distance: int, kept: int) -> tuple[tuple[int, tuple[int, ...], tuple[int, ...]], ...]:
    """(difference of lengths, segments, shifts) that any two sequences within ``distance`` edits share one of.

    A known sequence is cut into ``distance + kept`` segments.  Each edit touches one of
    them (an insertion between two touches the left one, one at the start the first), so
    ``kept`` are untouched.  Those are the first untouched ones: every segment skipped
    before the last of them holds an edit, shifts change only across skipped segments, and
    what is left of the difference of lengths lies behind the last one.
    """
    pieces = distance + kept
    found = []

    def extend(segments: tuple[int, ...], shifts: tuple[int, ...], edits: int) -> None:
        last, shift = (segments[-1], shifts[-1]) if segments else (-1, 0)
        if len(segments) == kept:
            rest = distance - edits if last < pieces - 1 else 0
            found.extend((shift + d, segments, shifts) for d in range(-rest, rest + 1))
            return
        for skipped in range(min(distance - edits, pieces - last - 2) + 1):
            most = distance - edits if skipped else 0
            for d in range(-most, most + 1):
                extend((*segments, last + 1 + skipped), (*shifts, shift + d), edits + max(skipped, abs(d)))

    extend((), (), 0)
    return tuple(found)


def kept_segments(known: int, length: float, distance: int, candidate: float = 2.0, most: int = 5) -> int:
    """Number of untouched segments that costs least: keys of a query, and ``candidate`` times as much for each
    random sequence of four letters that shares one."""
    def cost(kept: int) -> float:
        chance = 4.0 ** -min(500.0, kept * length / (distance + kept))
        return len(signatures(distance, kept)) * (1 + candidate * known * chance)

    return min(range(1, most + 1), key=cost)


def candidates(queries: DataFrame, known: DataFrame, distance: int) -> DataFrame:
    """``seq, known_seq`` of queries and known sequences that share a signature; a pair may come more than once.

    A query has hundreds of keys, so none becomes a row: queries are dealt to parts in blocks,
    which meet all chunks of known sequences and look their keys up there.
    """
    size = known.agg(F.count(F.lit(1)).alias("n"), F.avg(F.length("seq")).alias("length")).first()
    kept = kept_segments(size["n"], size["length"] or 0.0, distance)
    session = queries.sparkSession
    cores = session.sparkContext.defaultParallelism
    parallel = max(int(session.conf.get("spark.sql.shuffle.partitions")), cores)
    number = queries.count()
    parts = max(1, -(-number // TOGETHER), min(2 * cores, -(-number // LEAST)))
    item = F.struct("seq").alias("item")
    dealt = queries.where("seq is not null").select(F.pmod(F.xxhash64("seq"), F.lit(parts)).cast("int").alias("part"), item).repartition(parallel, "part")
    blocks = dealt.mapInArrow(packed(BLOCK, BYTES), "part int, items array<struct<seq:string>>")
    blocks = blocks.select("part", F.col("items").alias("queries")).repartition(parallel, "part")
    each = known.where("seq is not null").select("seq").distinct().select(F.lit(0).alias("part"), item)
    chunks = each.repartition(max(1, -(-size["n"] // CHUNK)), F.xxhash64("item.seq")).mapInArrow(packed(CHUNK, BYTES), "part int, items array<struct<seq:string>>")
    chunks = chunks.select(F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.monotonically_increasing_id().alias("chunk"), F.col("items").alias("known"))
    # Streams the chunks, so that each is prepared once for all blocks of a part.
    pairs = chunks.repartition(parallel, "part").hint("merge").join(blocks, "part").select("chunk", "known", "queries")
    return pairs.mapInArrow(shared(signatures(distance, kept), distance + kept), "seq string, known_seq string")


def within(queries: DataFrame, known: DataFrame, distance: int) -> DataFrame:
    """``seq, id, ord, distance`` for all pairs of distinct queries and known sequences within an edit distance.

    Known sequences shorter than the number of segments have empty ones, which are in every
    query of a fitting length.
    """
    d = F.levenshtein("seq", "known_seq", distance)
    # Only close pairs are shuffled.
    close = candidates(queries, known, distance).withColumn("distance", d).where("distance >= 0").distinct()
    named = known.select(F.col("seq").alias("known_seq"), "id", "ord")
    return close.join(named, "known_seq").select("seq", "id", "ord", "distance").distinct()


def _measured(queries: DataFrame, known: DataFrame, mismatches: int, slack: int) -> DataFrame:
    """Distinct upper-case queries; null if empty or outside the known lengths."""
    span = known.agg(F.min(F.length("seq")).alias("lo"), F.max(F.length("seq")).alias("hi"))
    rows = queries.select(F.upper("seq").alias("seq")).where("seq <> ''").distinct().crossJoin(F.broadcast(span))
    return rows.where(F.length("seq").between(F.col("lo") - slack, F.col("hi") + slack)).select("seq")


def _both_strands(known: DataFrame) -> DataFrame:
    """Known sequences as they are and turned (``rc`` 1): a query has many more keys than these, so it is asked on one strand only."""
    strands = F.array(F.struct(F.lit(0).alias("rc"), F.col("seq").alias("seq")), F.struct(F.lit(1).alias("rc"), revcomp(F.col("seq")).alias("seq")))
    return known.select("id", "ord", F.inline(strands))


def map_first(queries: DataFrame, ids: DataFrame, mismatches: int = 2, missing: str = "not_found") -> DataFrame:
    """``seq, id`` for each distinct query: exact, else reverse complement exact, else the first known
    sequence in file order within 2 * mismatches edits of either strand."""
    known = known_sequences(ids)
    fit = _measured(queries, known, mismatches, 2 * mismatches)
    exact = fit.join(known, "seq").select("seq", F.struct(F.lit(0).alias("stage"), F.col("ord").alias("ord"), "id").alias("hit"))
    turned = fit.withColumn("rc", revcomp(F.col("seq"))).join(known.withColumnRenamed("seq", "rc"), "rc")
    turned = turned.select("seq", F.struct(F.lit(1).alias("stage"), F.col("ord").alias("ord"), "id").alias("hit"))
    done = exact.unionByName(turned)
    rest = fit.join(done.select("seq").distinct(), "seq", "left_anti")
    close = within(rest, _both_strands(known).select("seq", "id", "ord"), 2 * mismatches)
    fuzzy = close.select("seq", F.struct(F.lit(2).alias("stage"), F.col("ord").alias("ord"), "id").alias("hit"))
    best = done.unionByName(fuzzy).groupBy("seq").agg(F.min("hit").alias("hit"))
    every = queries.select(F.upper("seq").alias("seq")).distinct()
    return every.join(best, "seq", "left").select("seq", F.coalesce("hit.id", F.lit(missing)).alias("id"))


def map_staged(queries: DataFrame, ids: DataFrame, mismatches: int = 2) -> DataFrame:
    """``seq, id`` in stages: exact, reverse complement, Hamming within ``mismatches`` forward, then reverse, then
    the closest edit distance; empty if none.  Queries may be ``mismatches`` longer or shorter than known ones."""
    known = known_sequences(ids)
    fit = _measured(queries, known, mismatches, mismatches)
    strands = _both_strands(known).select("seq", "ord", F.struct("id", "rc", F.col("seq").alias("known_seq")).alias("id"))
    rows = within(fit, strands, 2 * mismatches).select("seq", "ord", "distance", "id.*")
    chars = lambda c: F.filter(F.split(c, ""), lambda x: x != "")
    hamming = F.when(F.length("seq") == F.length("known_seq"), F.size(F.filter(F.zip_with(chars("seq"), chars("known_seq"), lambda a, b: a != b), lambda x: x)))
    stage = F.when(F.col("distance") == 0, F.col("rc")).when(hamming <= mismatches, 2 + F.col("rc")).otherwise(F.lit(4))
    rows = rows.withColumn("hit", F.struct(stage.alias("stage"), F.when(stage == 4, F.col("distance")).otherwise(0).alias("d"), "ord", "rc", "id"))
    best = rows.groupBy("seq").agg(F.min("hit").alias("hit"))
    every = queries.select(F.upper("seq").alias("seq")).distinct()
    return every.join(best, "seq", "left").select("seq", F.coalesce("hit.id", F.lit("")).alias("id"))
