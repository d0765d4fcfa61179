"""The registered query of each training-data operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import divergence, embeddings, language_model, licenses, minhash, packing, quality, secrets, sentencepiece, sharding, syncmers, toxicity, whitening
from .common import fold, read


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece.encode(read(spark, sf_dir, "documents"))


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(read(spark, sf_dir, "embeddings"))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, keep_text=False)
    return scored.select(
        "doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read(spark, sf_dir, "documents"))


def op6_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(read(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


def op8_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.edit_report(read(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The table as the history of a growing repository: two commits that together add every document once.
    docs = read(spark, sf_dir, "documents").select("doc_id", "text").withColumn("commit", F.pmod(F.xxhash64("doc_id"), F.lit(2)))
    findings, _ = secrets.scan_history([docs.where(F.col("commit") == c) for c in (0, 1)])
    return secrets.digest(findings)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents"))


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality.train(docs, read(spark, sf_dir, "labels")), keep_text=False)
    return scored.select(
        "doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_sentencepiece,
        op2_embedding_near_dedup,
        op3_minhash_near_dedup,
        op4_toxicity,
        op5_sharding,
        op6_language_model,
        op7_license_scan,
        op8_syncmer_fingerprints,
        op9_packing,
        op10_secret_scan,
        op11_source_divergence,
        op12_quality_classifier,
        op13_embedding_whitening,
    )
}

#: The base rules as RE2 patterns without case folding, the measured group and its least length.
_ASSIGN = "([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"
_SPANS = " UNION ALL ".join(
    f"SELECT doc_id, {order} AS o, '{kind}' AS kind, regexp_split_to_array(t, '{pattern}') AS gaps, regexp_extract_all(t, '{pattern}', 0) AS hits, regexp_extract_all(t, '{pattern}', {group}) AS parts, {least} AS least FROM d"
    for order, (kind, pattern, group, least) in enumerate((("assign", _ASSIGN, 2, 12), ("access", "AKIA[A-Z0-9]+", 0, 18), ("hex", "[0-9a-f]+", 0, 16)))
)
_SECRETS = f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), m AS ({_SPANS}),
    i AS (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM m),
    s AS (SELECT doc_id, o, kind, cast(list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) as bigint) AS b, length(hits[i]) AS n FROM i WHERE length(parts[i]) >= least),
    g AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex, string_agg(concat_ws(':', kind, cast(b as varchar), cast(b + n as varchar)), ',' ORDER BY b, o) AS spans FROM s GROUP BY doc_id)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans, sha256(t) AS blob FROM d LEFT JOIN g USING (doc_id)"""

#: Smallest node reachable from every node of ``n`` by the links ``l`` (both ways).
_COMPONENTS = "r(id, root) AS (SELECT id, id FROM n UNION SELECT l.b, r.root FROM r JOIN l ON r.id = l.a WHERE r.root < l.b), c AS (SELECT id, min(root) AS component_id FROM r GROUP BY id)"

_COSINES = f"""
    WITH RECURSIVE v AS (SELECT vec_id AS id, cast(embedding as double[]) AS x FROM embeddings),
    n AS (SELECT id FROM v),
    g AS (SELECT id, x, len(x) AS k, sqrt(list_sum(list_transform(x, lambda e: e * e))) AS size FROM v WHERE len(x) > 0 AND len(list_filter(x, lambda e: e IS NULL OR isnan(e) OR isinf(e))) = 0 AND len(list_filter(x, lambda e: e <> 0)) > 0),
    l AS (SELECT p.id AS a, q.id AS b FROM g p JOIN g q ON p.id <> q.id AND p.k = q.k WHERE list_dot_product(p.x, q.x) >= 0.9 * p.size * q.size),
    {_COMPONENTS}
    SELECT id AS vec_id, coalesce(k, 0) AS n_links, component_id, id = component_id AS kept FROM c LEFT JOIN (SELECT a AS id, count(*) AS k FROM l GROUP BY a) USING (id)"""

_SHINGLES = f"""
    WITH RECURSIVE w AS (SELECT doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    n AS (SELECT id FROM w),
    s AS (SELECT DISTINCT id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
    k AS (SELECT id, count(*) AS k FROM s GROUP BY id),
    o AS (SELECT p.id AS a, q.id AS b, count(*) AS m FROM s p JOIN s q ON p.s = q.s AND p.id <> q.id GROUP BY ALL),
    l AS (SELECT a, b FROM o JOIN k x ON x.id = a JOIN k y ON y.id = b WHERE 100 * m >= 85 * (x.k + y.k - m)),
    {_COMPONENTS}
    SELECT id AS doc_id, coalesce(k, 0) AS n_shingles, component_id, id = component_id AS kept FROM c LEFT JOIN k USING (id)"""

_DIVERGENCE = r"""
    WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
    c AS (SELECT lang, source, doc, w AS term, count(*) AS n FROM (SELECT lang, source, doc, unnest(w) AS w FROM d) GROUP BY ALL),
    k AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL HAVING count(*) >= 3),
    l AS (SELECT lang, count(*) AS v, sum(n) AS n FROM k GROUP BY lang),
    g AS (SELECT DISTINCT lang, source FROM d),
    x AS (SELECT g.lang, g.source, k.term, coalesce(s.n, 0) AS n, k.n AS whole FROM g JOIN k USING (lang) LEFT JOIN (SELECT lang, source, term, sum(n) AS n FROM c GROUP BY ALL) s ON s.lang = g.lang AND s.source = g.source AND s.term = k.term),
    p AS (SELECT x.*, cast(1 + cast(1000000000 AS hugeint) * (x.n + 1) // (sum(x.n) OVER (PARTITION BY x.lang, x.source) + l.v) AS hugeint) AS p, cast(1 + cast(1000000000 AS hugeint) * (whole + 1) // (l.n + l.v) AS hugeint) AS q FROM x JOIN l USING (lang)),
    o AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(o.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN o ON o.lang = a.lang AND o.source = a.source AND o.item = b.source
          UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q)
    SELECT lang, source, part, item, cast(value AS bigint) AS value, cast(rank AS int) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r) WHERE part = 'pair' OR rank <= 200"""

#: DuckDB SQL for the operators that it can express on whole tables.  The others rest on
#: hashes, models or tokenizers that it lacks and are tested by brute force.
ORACLE_SQL: dict[str, str] = {"op2_embedding_near_dedup": _COSINES, "op3_minhash_near_dedup": _SHINGLES, "op10_secret_scan": _SECRETS, "op11_source_divergence": _DIVERGENCE}
