"""Source divergence audit: which sources of a language differ, and by which terms.

Texts are split into terms by Arrow's compute functions inside tasks (``ascii_lower``,
``split_pattern_regex``, ``dictionary_encode``, hash ``group_by``), which leaves partial
counts by language, source and term.  Spark merges them, and columnar shards of the kept
terms, one column a source, give all divergences.  All arithmetic is on integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import table

#: Everything but ASCII letters and characters beyond ASCII parts terms.
GAPS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
LEAST_DOCS = 3
SCALE = 1_000_000_000
#: Bytes of text that are split together, rows of partial counts that a task holds, cells of a shard's matrix.
TOGETHER, HELD, CELLS = 8 << 20, 400_000, 1 << 20
_KEYS = ["lang", "source", "term"]


def _slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about TOGETHER bytes of text, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(sizes) - sizes) // TOGETHER
    cuts = np.flatnonzero(np.diff(part, prepend=-1))
    for a, b in zip(cuts, [*cuts[1:], len(sizes)], strict=True):
        yield batch.slice(int(a), int(b - a))


def _sums(rows: pa.Table) -> pa.Table:
    out = rows.group_by(_KEYS, use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return out.select([*_KEYS, "n_sum", "docs_sum"]).rename_columns([*_KEYS, "n", "docs"])


def _counted(part: pa.RecordBatch) -> pa.Table:
    """Occurrences and documents of every term by language and source."""
    text = pc.ascii_lower(pc.fill_null(part.column("text"), ""))
    split = pc.split_pattern_regex(text, GAPS)
    terms, doc = pc.list_flatten(split), pc.list_parent_indices(split)
    there = pc.greater(pc.binary_length(terms), 0)
    coded = terms.filter(there).dictionary_encode()
    rows = pa.table({"doc": doc.filter(there), "code": coded.indices})
    by_doc = rows.group_by(["doc", "code"], use_threads=False).aggregate([([], "count_all")])
    names = {c: pc.fill_null(part.column(c), "").dictionary_encode() for c in ("lang", "source")}
    at = {c: d.indices.take(by_doc.column("doc").combine_chunks()) for c, d in names.items()}
    by_group = pa.table({**at, "code": by_doc.column("code"), "n": by_doc.column("count_all")})
    sums = by_group.group_by(["lang", "source", "code"], use_threads=False).aggregate([("n", "sum"), ([], "count_all")])
    whole = {c: d.dictionary.take(sums.column(c).combine_chunks()) for c, d in names.items()}
    return pa.table({**whole, "term": coded.dictionary.take(sums.column("code").combine_chunks()), "n": sums.column("n_sum"), "docs": sums.column("count_all")})


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []
    for batch in batches:
        for part in _slices(batch, "text"):
            held.append(_counted(part))
            if sum(t.num_rows for t in held) > HELD:
                held = [_sums(pa.concat_tables(held))]
                if held[0].num_rows > HELD // 2:
                    yield from held.pop().to_batches(max_chunksize=50_000)
    if held:
        yield from _sums(pa.concat_tables(held)).to_batches(max_chunksize=50_000)


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences, and rows that hold the term; nulls are ''."""
    rows = docs.select("lang", "source", "text").mapInArrow(_partial, "lang string, source string, term string, n bigint, docs bigint")
    return rows.groupBy(*_KEYS).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def scaled(count: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """1 + floor(SCALE * count / total) without overflow, for counts up to the totals."""
    if count.size == 0 or int(count.max()) <= (1 << 62) // SCALE:
        return 1 + SCALE * count // total
    out, rest = np.zeros_like(count), count.copy()
    for _ in range(3):  # SCALE is a thousand to the third
        out, rest = out * 1000 + rest * 1000 // total, rest * 1000 % total
    return 1 + out


class _Shares:
    """What shards need of the groups: for each language its sources with their totals, its own total and number of terms."""

    def __init__(self, groups: list, langs: list):
        self.sources: dict[str, list[str]] = {}
        self.totals: dict[str, np.ndarray] = {}
        for lang, source, n in sorted(groups):
            self.sources.setdefault(lang, []).append(source)
            self.totals[lang] = np.append(self.totals.get(lang, np.empty(0, np.int64)), n)
        self.langs = {lang: (n, v) for lang, n, v in langs}


def _divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _top(rows: pa.Table, top: int) -> pa.Table:
    """The first ``top`` terms of every language and source, by value and then by the term's bytes."""
    order = pc.sort_indices(rows, sort_keys=[("lang", "ascending"), ("source", "ascending"), ("value", "descending"), ("item", "ascending")])
    rows = rows.take(order)
    if not rows.num_rows:
        return rows
    key = [rows.column(c).combine_chunks().dictionary_encode().indices.to_numpy() for c in ("lang", "source")]
    new = np.flatnonzero(np.diff(key[0], prepend=-1) | np.diff(key[1], prepend=-1))
    place = np.arange(rows.num_rows) - np.repeat(new, np.diff([*new, rows.num_rows]))
    return rows.filter(pa.array(place < top))


def _shards(shares: _Shares, top: int):
    names = ["lang", "source", "part", "item", "value"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs: dict[str, np.ndarray] = {}
        best: list[pa.Table] = []
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            for lang in rows.column("lang").unique().to_pylist():
                sources = shares.sources[lang]
                own = rows.filter(pc.equal(rows.column("lang"), lang))
                step = max(1, CELLS // len(sources))
                for i in range(0, own.num_rows, step):
                    part = own.slice(i, step).combine_chunks()
                    sums, found = shard(part, sources, shares.totals[lang], *shares.langs[lang])
                    pairs[lang] = pairs.get(lang, 0) + sums
                    where, at, value = found
                    best.append(pa.table({
                        "lang": pa.array([lang] * len(at), pa.string()),
                        "source": pa.array(sources, pa.string()).take(pa.array(at)),
                        "item": part.column("term").combine_chunks().take(pa.array(where)),
                        "value": pa.array(value, pa.int64()),
                    }))
                    if sum(t.num_rows for t in best) > HELD:
                        best = [_top(pa.concat_tables(best), top)]
        for lang, sums in pairs.items():
            sources = shares.sources[lang]
            n = len(sources)
            columns = [[lang] * n * n, np.repeat(np.array(sources, object), n), ["pair"] * n * n, sources * n, sums.ravel()]
            types = [pa.string()] * 4 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)
        if best:
            rows = _top(pa.concat_tables(best), top)
            rows = rows.append_column("part", pa.array(["term"] * rows.num_rows, pa.string())).select(names)
            yield from rows.to_batches()

    return run


def shard(part: pa.Table, sources: list[str], totals: np.ndarray, whole: int, terms: int) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of one language's terms (``total``, ``by``: their counts by source): the divergence of every source from every other
    one, summed over these terms, and (term, source, value) wherever a source has more of a term than its language."""
    by = part.column("by").combine_chunks()
    flat, owner = pc.list_flatten(by), pc.list_parent_indices(by).to_numpy()
    at = pc.index_in(flat.field("source"), pa.array(sources, pa.string())).to_numpy(zero_copy_only=False).astype(np.int64)
    count = np.zeros((len(sources), part.num_rows), np.int64)
    count[at, owner] = flat.field("n").to_numpy(zero_copy_only=False)
    p = scaled(count + 1, totals[:, None] + terms)
    q = scaled(part.column("total").to_numpy() + 1, whole + terms)
    sums = np.stack([_divergence(p, p[b]).sum(1) for b in range(len(sources))], axis=1)
    which, where = np.nonzero((count > 0) & (p > q))
    return sums, (where, which, _divergence(p[which, where], q[where]))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = 200) -> DataFrame:
    """``lang, source, part, item, value, rank`` for every language and source of ``docs`` (text, lang, source).

    A language keeps the terms that at least ``least_docs`` of its rows hold.  Every group,
    even one without terms, gives each kept term the share p = 1 + floor(SCALE * (count + 1)
    / (N + V)), N its occurrences of kept terms, V their number; f = floor((p - q)^2 / q)
    is the divergence from a share q.  Part ``pair`` has for each other source of the
    language f summed over all kept terms, part ``term`` the ``top`` terms that the group
    uses more than its language.

    Null texts, languages and sources are ''.  Every row counts, repeated ones and those
    with null or repeated ids too; other columns are not read, whatever their names.  Ties
    are ranked by the item's bytes.  An empty table gives no row.

    Tasks hold the table of groups, one row for each language and source: the result has a
    row for each two sources of a language, so its size is about that table's square.
    """
    named = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    counts = term_counts(named)
    both = F.struct("source", "n")
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(both).alias("by"))
    kept = table(kept.where(F.col("docs") >= least_docs).select("lang", "term", "total", "by"))
    occurring = named.select("lang", "source").distinct()
    held = kept.select("lang", F.explode("by").alias("b")).groupBy("lang", "b.source").agg(F.sum("b.n").alias("n"))
    groups = table(occurring.join(held, ["lang", "source"], "left").select("lang", "source", F.coalesce("n", F.lit(0)).alias("n")))
    langs = kept.groupBy("lang").agg(F.sum("total").alias("n"), F.count(F.lit(1)).alias("v"))
    shares = _Shares([tuple(r) for r in groups.collect()], [tuple(r) for r in langs.collect()])
    rows = table(kept.mapInArrow(_shards(shares, top), "lang string, source string, part string, item string, value bigint"))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    sums = rows.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    others = groups.select("lang", "source").join(groups.select("lang", F.col("source").alias("item")), "lang").where("source <> item")
    pairs = others.join(sums, ["lang", "source", "item"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))
    terms = rows.where("part = 'term'").withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(ranked)).unionByName(terms)
