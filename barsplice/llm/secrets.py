"""Secret scans over a content-addressed ledger of blobs.

A document, or any historical version of one, is a path to a blob, addressed by the
SHA-256 of its text.  Only blobs that the ledger does not hold for the current version of
the rules are scanned, each once however many paths lead to it; findings are joined back
to all paths.  The rules are the three base ones; the method adds no further spans.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

#: Kinds in their order, patterns, least lengths and the measured group.
RULES = (
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE, 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 0, 16),
)
RULE_VERSION = hashlib.sha256(repr(RULES).encode()).hexdigest()[:16]
LEDGER = "blob string, rule_version string, spans array<struct<kind:string,start:bigint,end:bigint>>"

# The letters of the assign rule's words in either case.  Compiled with ASCII case folding only.
_COMPILED = tuple((kind, re.compile(pattern, flags | re.ASCII), group, least) for kind, pattern, flags, group, least in RULES)
#: What every assign match holds; looking for these words is cheaper than the whole pattern.
_WORDS = re.compile(r"passw|secret|token|api", re.ASCII)


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """Kind, start and end (code points, end exclusive) of every secret, by start, then kind as listed."""
    found = []
    lower = text.lower() if text.isascii() else text.translate(_LOWER)
    for order, (kind, pattern, group, least) in enumerate(_COMPILED):
        if kind == "assign" and not _WORDS.search(lower) or kind == "access" and "AKIA" not in text:
            continue
        found += [(m.start(), order, kind, m.end()) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


_LOWER = {i: i + 32 for i in range(65, 91)}


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    for batch in batches:
        spans = [[{"kind": k, "start": a, "end": b} for k, a, b in find_spans(t or "")] for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([RULE_VERSION] * len(spans), pa.string()), pa.array(spans, pa.list_(kind))], ["blob", "rule_version", "spans"]
        )


def _paths(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), text.alias("text"), F.sha2(text, 256).alias("blob"))


def _known(ledger: DataFrame) -> DataFrame:
    return ledger.where(F.col("rule_version") == RULE_VERSION).select("blob", "spans").dropDuplicates(["blob"])


def _entries(paths: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """The ledger's new entries: blobs of these paths that it does not hold for this version of the rules, each scanned once."""
    unseen = paths.groupBy("blob").agg(F.min("id").alias("first"))
    if ledger is not None:
        unseen = unseen.join(_known(ledger).select("blob"), "blob", "left_anti")
    first = unseen.withColumnRenamed("blob", "known")
    picked = paths.join(first, F.col("id").eqNullSafe(F.col("first")) & (F.col("blob") == F.col("known")), "left_semi")
    # Equal rows may repeat a first path.
    return table(picked.select("blob", "text").mapInArrow(_scan, LEDGER).dropDuplicates(["blob"]))


def _findings(paths: DataFrame, ledger: DataFrame, id_col: str) -> DataFrame:
    found = paths.select("id", "blob").join(_known(ledger).where(F.size("spans") > 0), "blob", "left")
    spans = F.coalesce("spans", F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>"))
    return found.select(F.col("id").alias(id_col), "blob", spans.alias("spans"))


def scan(docs: DataFrame, ledger: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(findings, entries)``: every path with its spans, and the ledger's new entries.

    ``findings`` has one row per input row: ``id_col``, ``blob`` and ``spans``, an array of
    (kind, start, end).  ``entries`` has the columns of ``LEDGER``; append it to ``ledger``
    and pass that the next time.  A null text is an empty blob.  Null and repeated ids are
    paths like any other.  Other columns are ignored; an empty table gives no rows.
    """
    paths = _paths(docs, id_col, text_col)
    entries = _entries(paths, ledger)
    return _findings(paths, entries if ledger is None else ledger.select(*entries.columns).unionByName(entries), id_col), entries


def scan_history(versions: Sequence[DataFrame], ledger: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(findings, ledger)`` of a history, oldest version first: as ``scan``, with one row for each path of each version.

    Versions are scanned one after the other against the ledger so far, which every one
    extends by a table in the shared folder; a blob that an earlier version (or a former
    run's ledger) holds is not scanned again.  Findings come from the whole ledger.
    """
    paths = [_paths(v, id_col, text_col) for v in versions]
    for p in paths:
        new = _entries(p, ledger)
        ledger = new if ledger is None else ledger.select(*new.columns).unionByName(new)
    every = functools.reduce(DataFrame.unionByName, (p.select("id", "blob") for p in paths))
    return _findings(every, ledger, id_col), ledger


def digest(findings: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts by kind, the spans as text and their SHA-256; one row per finding, null and repeated ids as they are, other columns left out."""
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
    kinds = F.transform("spans", lambda s: s.kind)
    counts = [F.size(F.filter(kinds, F.lit(kind).__eq__)).cast("bigint").alias(f"n_{kind}") for kind, *_ in RULES]
    return findings.select(id_col, *counts, F.sha2(spans, 256).alias("base_sha256"), spans.alias("spans"), "blob")


def _mask(text: str, spans) -> str:
    out, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def _masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = [x and [(s["kind"], s["start"], s["end"]) for s in x] for x in batch.column("spans").to_pylist()]
        texts = [t if not x else _mask(t, x) for t, x in zip(batch.column("text").to_pylist(), spans, strict=True)]
        keep = [n for n in batch.schema.names if n != "spans"]
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in keep], keep)


def redact(docs: DataFrame, ledger: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The same rows and columns with every secret replaced by its kind in brackets.

    Texts without secrets, null and empty ones stay as they are.  Rows with null or repeated
    ids are redacted like any other, columns of any name are kept, an empty table stays empty.
    """
    findings, _ = scan(docs, ledger, id_col, text_col)
    found = findings.where(F.size("spans") > 0).select(F.col("blob").alias("__blob"), "spans").dropDuplicates(["__blob"])
    names = docs.columns
    keyed = docs.select(*(docs["`" + c.replace("`", "``") + "`"].alias("text" if c == text_col else f"c{i}") for i, c in enumerate(names)))
    keyed = keyed.withColumn("__blob", F.sha2("text", 256))
    joined = keyed.join(found, "__blob", "left").drop("__blob")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema if f.name != "spans")
    masked = joined.mapInArrow(_masked, schema)
    return masked.select(*(F.col("text" if c == text_col else f"c{i}").alias(c) for i, c in enumerate(names)))
