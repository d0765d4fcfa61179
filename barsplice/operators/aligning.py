"""Alignment of reads and pairs to exon references and, with introns, to minigenes.

Reads share short words (seeds) with the references they are aligned to: an equi-join, or for
large references lookups of blocks of texts in chunks of references, then
one kernel for all pairs of a text and a reference, in the band of diagonals that its seeds
span.  Equal reads are aligned once.  The references of a reads' group are found by ``by``,
such as the sample or the exon that a leftover's header names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.aligning import Scoring, placed
from ..functions.seeding import COUNTS, packed, seeded
from ..functions.sequence import revcomp

#: Costs of mismatches, gaps and clipped ends on exon references.
EXON = Scoring(match=1, mismatch=4, open=10, extend=5, clip=1)
SPLICED = Scoring(match=1, mismatch=3, open=5, extend=3, clip=3, intron=4, site=5, least_intron=20)
#: Bases of all references up to which their words are sent to all executors; more are looked up in chunks.
SENT = 2_000_000
#: Bases of a chunk of references, texts and bytes of a block, and texts that meet the same copy of the references.
CHUNK, BLOCK, BLOCK_BYTES, TOGETHER = 4_000_000, 50_000, 4 << 20, 1_000_000
_PLACE = "array<struct<cost:int,rname:string,turned:boolean,pos:int,pos_end:int,cigar:string,score:int,differences:int>>"


@dataclass(frozen=True)
class Seeding:
    """Words of ``k`` bases, every ``stride``-th of a read; a reference needs ``share`` of the most words that any has.

    Bands reach ``pad`` diagonals past those of the seeds, with introns also as far as one of
    ``reach`` bases at an end where at least ``anchor`` bases have no seed, or at both if the
    alignment leaves room for one; alignments score at least ``least``.
    """

    k: int = 13
    stride: int = 3
    share: float = 0.5
    pad: int = 12
    least: int = 30
    anchor: int = 7
    reach: int = 2000


def _words(seq: Column, by: Sequence[str], k: int, stride: int) -> Column:
    """array<struct(at, word)> of hashed words without unknown bases."""
    last = F.length(seq) - k
    places = F.when(last >= 0, F.sequence(F.lit(0), last, F.lit(stride))).otherwise(F.array().cast("array<int>"))
    texts = F.transform(places, lambda p: F.struct(p.alias("at"), F.substring(seq, p + 1, F.lit(k)).alias("text")))
    called = F.filter(texts, lambda w: F.translate(w["text"], "ACGT", "") == "")
    return F.transform(called, lambda w: F.struct(w["at"].alias("at"), F.xxhash64(*by, w["text"]).alias("word")))


def _end(pos: Column, cigar: Column) -> Column:
    spans = F.transform(F.regexp_extract_all(cigar, F.lit(r"(\d+)[MDN]"), F.lit(1)), lambda n: n.cast("int"))
    return pos + F.aggregate(spans, F.lit(0), lambda a, n: a + n)


def _hits(texts: DataFrame, refs: DataFrame, size: int, by: Sequence[str], seeding: Seeding) -> DataFrame:
    """Hits of distinct texts on references of their group, in parts: groups are dealt to some, the texts of each to several.

    Texts and references are shuffled, never their words; a part's chunks of references meet its blocks of texts one by one.
    """
    session = texts.sparkSession
    parallel = max(int(session.conf.get("spark.sql.shuffle.partitions")), session.sparkContext.defaultParallelism)
    number = texts.count()
    groups = max(1, min(10_000, -(-size // CHUNK))) if by else 1
    each = max(1, -(-number // (groups * TOGETHER)), min(-(-parallel // groups), -(-number // (groups * BLOCK))))
    group = F.xxhash64(*by) if by else F.lit(0).cast("bigint")
    bucket = F.pmod(F.col("group"), F.lit(groups)).cast("int") * each
    whole = " and ".join(f"`{c}` is not null" for c in by) or "true"
    kinds, partitions = dict(texts.dtypes), max(parallel, groups * each)
    text = "struct<group:bigint," + "".join(f"`{c}`:{kinds[c]}," for c in by) + "text:string>"
    reference = "struct<group:bigint,rname:string,reference:string>"
    asked = texts.where("text is not null").where(whole).withColumn("group", group)
    asked = asked.withColumn("part", (bucket + F.pmod(F.xxhash64("text"), F.lit(each))).cast("int"))
    # Repeated by the part, so that texts are not shuffled once more to become distinct.
    asked = asked.repartition(partitions, "part").dropDuplicates(["part", *by, "text"])
    blocks = asked.select("part", F.struct("group", *by, "text").alias("item")).mapInArrow(packed(BLOCK, BLOCK_BYTES), f"part int, items array<{text}>")
    blocks = blocks.select("part", F.monotonically_increasing_id().alias("block"), F.col("items").alias("texts")).repartition(partitions, "part")
    known = refs.where(whole).withColumn("group", group).select(bucket.alias("part"), F.struct("group", "rname", "reference").alias("item"))
    known = known.repartition(parallel, "part", F.pmod(F.xxhash64("item.rname"), F.lit(max(1, -(-size // (groups * CHUNK))))))
    chunks = known.mapInArrow(packed(CHUNK, CHUNK), f"part int, items array<{reference}>")
    chunks = chunks.select("part", F.monotonically_increasing_id().alias("chunk"), F.col("items").alias("references"))
    chunks = chunks.withColumn("part", F.explode(F.sequence("part", F.col("part") + each - 1))).repartition(partitions, "part")
    pairs = chunks.hint("merge").join(blocks, "part").select("part", "chunk", "references", "block", "texts")
    schema = "".join(f"`{c}` {kinds[c]}, " for c in by) + "text string, turned boolean, rname string, " + ", ".join(f"{c} int" for c in COUNTS)
    return pairs.mapInArrow(seeded(seeding.k, seeding.stride, seeding.share), schema)


def placements(texts: DataFrame, references: DataFrame, by: Sequence[str] = (), scoring: Scoring = EXON, seeding: Seeding = Seeding()) -> DataFrame:
    """``text, places`` (and ``by``) of distinct texts with at least one place, best first; ties by reference name, then forward first.

    ``references`` are ``rname, seq`` (and ``by``) with different names in a group.
    Texts are in upper case.  Null, short and unrelated texts are left out.
    """
    refs = references.select(*by, "rname", F.upper("seq").alias("reference")).where("rname is not null and reference is not null")
    size = refs.agg(F.coalesce(F.sum(F.length("reference")), F.lit(0))).first()[0]
    # Words are many times larger than the references' files, by whose size Spark would send them all the same.
    sent = F.broadcast if size <= SENT else lambda df: df.hint("merge")
    if size > SENT:
        near = _hits(texts.select(*by, "text"), refs, size, by, seeding)
    else:
        index = refs.select(*by, "rname", F.inline(_words(F.col("reference"), by, seeding.k, 1)))
        index = index.select(*by, "rname", F.col("at").alias("place"), "word")
        distinct = texts.select(*by, "text").where("text is not null").distinct()
        strands = F.array(*(F.struct(F.lit(t).alias("turned"), s.alias("read")) for t, s in ((False, F.col("text")), (True, revcomp(F.col("text"))))))
        reads = distinct.select(*by, "text", F.inline(strands))
        words = reads.select(*by, "text", "turned", F.inline(_words(F.col("read"), by, seeding.k, seeding.stride)))
        shift = F.col("place") - F.col("at")
        hits = words.join(sent(index), [*by, "word"]).groupBy(*by, "text", "turned", "rname")
        hits = hits.agg(F.size(F.collect_set("at")).alias("seeds"), F.min(shift).alias("low"), F.max(shift).alias("high"), F.min("at").alias("head"), F.max("at").alias("last"))
        most = hits.groupBy(*by, "text").agg(F.max("seeds").alias("most"), F.collect_list(F.struct("turned", "rname", "seeds", "low", "high", "head", "last")).alias("hits"))
        near = most.select(*by, "text", F.inline(F.filter("hits", lambda h: h["seeds"] >= seeding.share * F.col("most"))))
    near = near.join(sent(refs), [*by, "rname"])
    read = F.when(F.col("turned"), revcomp(F.col("text"))).otherwise(F.col("text"))
    low, high = F.col("low") - seeding.pad, F.col("high") + seeding.pad
    far = None
    if scoring.intron is not None:
        tail = F.length("text") - F.col("last") - seeding.k
        # A seed may reach past an exon by chance, so that less than an anchor seems to be left.
        far = F.greatest(F.least(low, -F.col("head")), low - seeding.reach), F.least(F.greatest(high, F.length("reference") - F.length("text") + tail), high + seeding.reach)
        low = F.when(F.col("head") >= seeding.anchor, far[0]).otherwise(low)
        high = F.when(tail >= seeding.anchor, far[1]).otherwise(high)
    # As a generator's rows: a filter on them is not pushed below the kernel, which would run it twice.
    found = near.select(*by, "text", "turned", "rname", F.inline(F.array(placed(read, F.col("reference"), low, high, scoring, far))))
    found = found.where(F.col("score") >= seeding.least)
    place = F.struct((-F.col("value")).alias("cost"), "rname", "turned", "pos", _end(F.col("pos"), F.col("cigar")).alias("pos_end"), "cigar", "score", "differences")
    return found.groupBy(*by, "text").agg(F.sort_array(F.collect_list(place)).alias("places"))


def _either(found: Column) -> Column:
    return F.coalesce(found, F.array().cast(_PLACE))


def _record(qname: Column, seq: Column, qual: Column, places: Column, best: Column, flag: Column, mate: Column | None = None) -> list[Column]:
    """The columns of an alignment record (positions from 0, -1 for none)."""
    there, turned = best.isNotNull(), F.coalesce(best["turned"], F.lit(False))
    ties = F.size(F.filter(places, lambda p: p["cost"] == best["cost"]))
    other = F.coalesce(F.array_max(F.transform(F.filter(places, lambda p: (p["rname"] != best["rname"]) | (p["turned"] != best["turned"])), lambda p: p["score"])), F.lit(0))
    quality = F.when(ties > 1, 0).when(there, F.greatest(F.lit(0), F.least(F.lit(60), 6 * (best["score"] - other)))).otherwise(0)
    rnext, pnext, tlen = F.lit("*"), F.lit(-1), F.lit(0)
    if mate is not None:
        together = there & (best["rname"] == mate["rname"])
        rnext = F.when(together, "=").otherwise(F.coalesce(mate["rname"], F.lit("*")))
        pnext = F.coalesce(mate["pos"], F.lit(-1))
        span = F.greatest(best["pos_end"], mate["pos_end"]) - F.least(best["pos"], mate["pos"])
        tlen = F.coalesce(F.when(together, F.when(turned, -span).otherwise(span)), F.lit(0))
    values = {"AS": best["score"], "XS": other, "NM": best["differences"], "NH": ties}
    tags = F.when(there, F.create_map(*(x for n, v in values.items() for x in (F.lit(n), v.cast("string"))))).otherwise(F.create_map().cast("map<string,string>"))
    return [
        qname.alias("qname"), flag.cast("int").alias("flag"), F.coalesce(best["rname"], F.lit("*")).alias("rname"), F.coalesce(best["pos"], F.lit(-1)).alias("pos"),
        quality.cast("int").alias("mapq"), F.coalesce(best["cigar"], F.lit("*")).alias("cigar"), rnext.alias("rnext"), pnext.alias("pnext"), tlen.alias("tlen"),
        F.when(turned, revcomp(seq)).otherwise(seq).alias("seq"), F.when(turned, F.reverse(qual)).otherwise(qual).alias("qual"), tags.alias("tags"),
    ]


def align_single(reads: DataFrame, references: DataFrame, by: Sequence[str] = (), scoring: Scoring = EXON, seeding: Seeding = Seeding()) -> DataFrame:
    """One alignment record for each read (``header, seq, qual``): its best place, or unmapped (flag 4).

    Of equal places the first reference's stands, with mapping quality 0; tag ``NH`` counts
    them.  Null and empty reads are unmapped; repeated reads have records of their own.
    """
    found = placements(reads.select(*by, F.upper("seq").alias("text")), references, by, scoring, seeding)
    rows = reads.select(*by, "header", "seq", "qual", F.upper("seq").alias("text")).join(found, [*by, "text"], "left").withColumn("places", _either(F.col("places")))
    rows = rows.withColumn("best", F.get("places", F.lit(0)))
    best = F.col("best")
    flag = F.when(best.isNull(), 4).when(best["turned"], 16).otherwise(0)
    return rows.select(*by, *_record(F.col("header"), F.col("seq"), F.col("qual"), F.col("places"), best, flag))


def _facing(a: Column, b: Column) -> Column:
    """On one reference and different strands, the forward mate beginning and ending no later than the other one."""
    forward, back = F.when(a["turned"], b).otherwise(a), F.when(a["turned"], a).otherwise(b)
    return (a["rname"] == b["rname"]) & (a["turned"] != b["turned"]) & (forward["pos"] <= back["pos"]) & (forward["pos_end"] <= back["pos_end"])


def align_pairs(pairs: DataFrame, references: DataFrame, by: Sequence[str] = (), scoring: Scoring = EXON, seeding: Seeding = Seeding(), apart: int = 17) -> DataFrame:
    """Two alignment records for each pair (``h1, s1, q1, h2, s2, q2``).

    Places of both mates are chosen together: those of the least cost, where mates that do
    not face each other on one reference cost ``apart`` more.  ``qname`` is the first header
    up to its first space or ``/``, so that mates share it.
    """
    mates = F.explode(F.array(*(F.upper(s) for s in ("s1", "s2"))))
    found = placements(pairs.select(*by, mates.alias("text")), references, by, scoring, seeding)
    rows = pairs
    for m in (1, 2):
        rows = rows.withColumn(f"t{m}", F.upper(f"s{m}")).join(found.select(*by, F.col("text").alias(f"t{m}"), F.col("places").alias(f"p{m}")), [*by, f"t{m}"], "left")
        rows = rows.withColumn(f"p{m}", _either(F.col(f"p{m}")))
    choose = lambda a, b: F.struct((a["cost"] + b["cost"] + F.when(_facing(a, b), 0).otherwise(apart)).alias("cost"), (~_facing(a, b)).alias("apart"), a.alias("a"), b.alias("b"))
    rows = rows.withColumn("both", F.array_min(F.flatten(F.transform("p1", lambda a: F.transform("p2", lambda b: choose(a, b))))))
    rows = rows.withColumn("a", F.coalesce("both.a", F.get("p1", F.lit(0)))).withColumn("b", F.coalesce("both.b", F.get("p2", F.lit(0))))
    name = F.regexp_extract("h1", r"^([^ /]*)", 1)
    records = []
    for m, own, mate, number in ((1, "a", "b", 64), (2, "b", "a", 128)):
        own, mate = F.col(own), F.col(mate)
        bits = [(F.coalesce(~F.col("both.apart"), F.lit(False)), 2), (own.isNull(), 4), (mate.isNull(), 8), (F.coalesce(own["turned"], F.lit(False)), 16), (F.coalesce(mate["turned"], F.lit(False)), 32)]
        flag = F.lit(1 + number)
        for c, bit in bits:
            flag = flag + F.when(c, bit).otherwise(0)
        records.append(F.struct(*_record(name, F.col(f"s{m}"), F.col(f"q{m}"), F.col(f"p{m}"), own, flag, mate)))
    return rows.select(*by, F.inline(F.array(*records)))
