"""Document fingerprints of closed syncmers, in DataFrame functions alone.

Tokens are runs without white space of up to 16 characters, and the single characters of
longer ones.  A run of K tokens is chosen when the least hash among its inner runs of S
tokens lies at its first or last position.  The choice looks at nothing outside the run, so
equal passages choose equal anchors wherever they stand, and an edit only changes anchors
that it touches.  Two texts are compared by the anchors that they share at matching
positions.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K, S = 6, 2
_DARK = r"[^\x20\x09-\x0D]"
TOKEN = rf"(?<!{_DARK}){_DARK}{{1,16}}(?!{_DARK})|{_DARK}"
#: Shared anchors count if the next shared one lies on about the same diagonal: so many tokens may come or go between them.
DRIFT = 8
#: Bytes of text for each range of ids, and the accuracy of their bounds (ranks are exact to a hundred-thousandth).
RANGE_BYTES, ACCURACY = 8 << 20, 100_000


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _upto(n: Column) -> Column:
    """0 to n - 1; empty for n below 1."""
    return F.when(n > 0, F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1)).otherwise(F.array().cast("array<int>"))


def anchors(text: Column, k: int = K, s: int = S) -> Column:
    """Array of (position, hash) of the chosen runs, positions counted in tokens, hashes of 32 bits.

    A text of fewer than ``k`` tokens is one anchor, a null, empty or blank one has none.
    """

    def of_tokens(tokens: Column) -> Column:
        inner = F.transform(_upto(F.size(tokens) - (s - 1)), lambda i: F.xxhash64(*(F.get(tokens, i + j) for j in range(s))))
        return F.when(F.size(tokens) >= k, _let(inner, of_inner)).when(F.size(tokens) > 0, F.array(anchor(F.lit(0), F.xxhash64(tokens)))).otherwise(F.array().cast("array<struct<position:int,hash:bigint>>"))

    def of_inner(hashes: Column) -> Column:
        last = k - s
        edge = lambda i: F.least(F.get(hashes, i), F.get(hashes, i + last))
        middle = lambda i: F.least(*(F.get(hashes, i + j) for j in range(1, last)))
        picked = F.filter(_upto(F.size(hashes) - last), lambda i: edge(i) <= middle(i))
        cover = [*range(0, last, s), last]
        return F.transform(picked, lambda i: anchor(i, F.xxhash64(*(F.get(hashes, i + j) for j in cover))))

    def anchor(position: Column, value: Column) -> Column:
        return F.struct(position.cast("int").alias("position"), F.shiftrightunsigned(value, 32).alias("hash"))

    return _let(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0)), of_tokens)


def hashes_of(found: Column) -> Column:
    return F.array_distinct(F.transform(found, lambda a: a["hash"]))


def as_string(hashes: Column) -> Column:
    """Eight hexadecimal digits for each distinct anchor, in the order of the text."""
    return F.array_join(F.transform(hashes, lambda h: F.lpad(F.lower(F.hex(h)), 8, "0")), "")


#: Packed anchors: hash, side and position in one number.
_SIDE, _HASH = 30, 31


def packed(found: Column) -> Column:
    """Anchors as numbers that sort by hash, then position."""
    return F.sort_array(F.transform(found, lambda a: F.shiftleft(a["hash"], _HASH) + a["position"]))


def first_places(sorted_: Column) -> Column:
    """Of sorted packed anchors, the first place of every hash."""
    of = lambda x: F.shiftright(x, _HASH)
    return F.filter(sorted_, lambda x, i: (i == 0) | (of(F.get(sorted_, i - 1)) != of(x)))


def merged(a: Column, b: Column) -> Column:
    """Both texts' first places in one order, those of the second behind those of the first."""
    return F.sort_array(F.concat(a, F.transform(b, lambda x: x + (1 << _SIDE))))


def shared_places(both: Column) -> Column:
    """Sorted numbers, one for each shared hash: its place in the first text, then its diagonal."""
    of = lambda x: F.shiftright(x, _SIDE)
    place = lambda x: x.bitwiseAND((1 << _SIDE) - 1)
    pair = lambda x, y: F.when(of(x) + 1 == F.when(of(y) % 2 == 1, of(y)), F.shiftleft(place(x), _HASH) + (place(y) - place(x) + (1 << _SIDE)))
    pairs = F.transform(both, lambda x, i: pair(x, F.get(both, i + 1)))
    return F.sort_array(F.array_compact(pairs))


def matching(shared: Column) -> Column:
    """How many shared anchors have a neighbour within ``DRIFT`` tokens of their diagonal; a single one counts."""
    diagonal = lambda x: x.bitwiseAND((1 << _HASH) - 1)
    close = lambda x, j: F.coalesce(F.abs(diagonal(F.get(shared, j)) - diagonal(x)) <= DRIFT, F.lit(False))
    return F.size(F.filter(shared, lambda x, i: (F.size(shared) == 1) | close(x, i - 1) | close(x, i + 1)))


def with_likeness(rows: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Adds each named likeness of two columns of ``first_places``: anchors that match by position over all distinct ones; 1 if both are empty.

    Shared anchors are put in the order of the first text.  One counts if a neighbour in
    that order lies on about its diagonal, so a passage counts wherever it stands, and a
    stray phrase does not.
    """
    rows = rows.withColumns({f"__m_{n}": merged(F.col(a), F.col(b)) for n, (a, b) in pairs.items()})
    rows = rows.withColumns({f"__s_{n}": shared_places(F.col(f"__m_{n}")) for n in pairs})
    rows = rows.withColumns({f"__k_{n}": matching(F.col(f"__s_{n}")) for n in pairs})
    share = lambda n: F.when(F.size(f"__m_{n}") == 0, F.lit(1.0)).otherwise(F.col(f"__k_{n}") / (F.size(f"__m_{n}") - F.col(f"__k_{n}")))
    return rows.withColumns({n: share(n) for n in pairs}).drop(*(f"__{x}_{n}" for x in "msk" for n in pairs))


def _count_upto(bounds: list, value: Column) -> Column:
    """How many of the sorted bounds are at most ``value``: first among every m-th one, then between two of these."""
    if not bounds:
        return F.lit(0)
    m = max(1, int(len(bounds) ** 0.5))
    number = lambda xs: F.split(F.lit(",".join(map(str, xs))), ",").cast("array<double>" if isinstance(bounds[0], float) else "array<bigint>")
    under = lambda xs: F.size(F.filter(xs, lambda b: b <= value))
    blocks = under(number(bounds[::m]))
    return _let(blocks, lambda k: F.when(k > 0, (k - 1) * m + under(F.slice(number(bounds), (k - 1) * m + 1, F.lit(m)))).otherwise(0))


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, text, next_text``: the next document by ascending id, after the last the first.

    Ids are numbers; null ones come first, ties are ordered by a hash of the text and then
    by the text.  Ids are cut into ranges of about equal size by quantiles; an id that
    fills several ranges, or null, is cut further by the hash.  The first document of each
    range is also sent to the range before, so texts are shuffled once and no range, and no
    repeated id, is one large task.
    """
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    seen = base.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("id").isNull(), 1)).alias("nulls")).first()
    n = min(ACCURACY, max(1, -(-(seen["bytes"] or 0) // RANGE_BYTES)))
    cuts = sorted(base.agg(F.percentile_approx("id", [i / n for i in range(1, n)], ACCURACY)).first()[0] or []) if n > 1 else []
    bounds = sorted(set(cuts))
    # Ids that take several cuts, and null, are split by the hash into as many parts.
    parts = {b: k for b, k in Counter(cuts).items() if k > 1}
    nulls = -(-n * seen["nulls"] // max(1, seen["rows"]))
    base = base.withColumn("tie", F.shiftrightunsigned(F.xxhash64("text"), 1))
    share = lambda k: F.floor(F.col("tie") / F.lit(2.0**63) * k).cast("int")
    sub = F.lit(0)
    for_hot = F.map_from_arrays(F.array(*map(F.lit, parts)), F.array(*map(F.lit, parts.values()))) if parts else None
    if for_hot is not None:
        low = F.get(F.array(*map(F.lit, bounds)), F.col("range") - 1)
        k = F.try_element_at(for_hot, low)
        sub = F.when(k.isNull(), 0).when(F.col("id") == low, share(k)).otherwise(k)
    if nulls > 1:
        sub = F.when(F.col("id").isNull(), share(F.lit(nulls))).otherwise(sub)
    base = base.withColumn("range", F.when(F.col("id").isNull(), -1).otherwise(_count_upto(bounds, F.col("id")))).withColumn("sub", sub)
    place, key = ["range", "sub"], ["id", "tie"]
    starts = base.groupBy(*place).agg(F.min(F.struct(F.col("id").isNotNull().alias("there"), *key)).alias("k")).select(*place, "k.id", "k.tie")
    # At most one row for each range: a small table, ordered in one task and broadcast.
    order = Window.partitionBy(F.lit(0)).orderBy(*place)
    behind = Window.partitionBy(F.lit(0)).orderBy(*(F.desc(c) for c in place))
    before = F.coalesce(F.lag(F.struct(*place)).over(order), F.first(F.struct(*place)).over(behind))
    starts = F.broadcast(starts.select(*(F.col(c).alias(f"{c}_0") for c in (*place, *key)), before.alias("before")))
    same = [F.col(c).eqNullSafe(F.col(f"{c}_0")) for c in (*place, *key)]
    first = base.join(starts, reduce(lambda a, b: a & b, same)).groupBy("before").agg(F.min("text").alias("text"))
    every = base.select("id", "text", "tie", *place, F.lit(0).alias("role")).unionByName(
        first.select(F.lit(None).cast(base.schema["id"].dataType).alias("id"), "text", F.lit(0).cast("bigint").alias("tie"), "before.*", F.lit(1).alias("role"))
    )
    within = Window.partitionBy(*place).orderBy("role", F.col("id").asc_nulls_first(), "tie", "text")
    placed = every.repartition(n, *place)
    return placed.withColumn("next_text", F.lead("text").over(within)).where("role = 0").select("id", "text", "next_text")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, s: int = S) -> DataFrame:
    """``id_col`` and ``anchors``: the anchors of every row's whole text, without any shuffle.

    Anchors carry their positions.  Null and empty texts have none; null and repeated ids
    are kept as they are; an empty table gives no rows; other columns are ignored.
    """
    return docs.select(id_col, anchors(F.col(text_col), k, s).alias("anchors"))


def edit_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's fingerprint beside its edited text's and the next document's.

    The edited text replaces the last floor(n / 2) code points by the first as many of the
    next document (all of a shorter one).  Null texts are empty; a single document is its
    own next.  Rows with null or repeated ids are documents like any other.  An empty table
    gives no rows.
    """
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    rows = with_next(docs, id_col, text_col).withColumn("n_chars", n.cast("bigint")).withColumn("edited", edited)
    sets = rows.select(
        "id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        anchors(F.col("text")).alias("own"), anchors(F.col("edited")).alias("changed"), anchors(F.col("next_text")).alias("next"),
    )
    texts = ("own", "changed", "next")
    placed = sets.select(
        "id", "n_chars", "edited_sha256", as_string(hashes_of(F.col("own"))).alias("fingerprint"), as_string(hashes_of(F.col("changed"))).alias("edited_fingerprint"),
        *(packed(F.col(c)).alias(c) for c in texts),
    )
    placed = with_likeness(placed.withColumns({c: first_places(F.col(c)) for c in texts}), {"near_edited": ("own", "changed"), "near_next": ("own", "next")})
    return placed.select(F.col("id").alias(id_col), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
