"""Catalogue queries on raw read pairs: trimming and merging."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import fragments as G
from . import pipeline
from .catalog import query
from .tables import rc, table

#: Every offset of the turned second read against the first one; only first reads hold bases that were not called.
_LAID = """(SELECT *, length(x) AS l, length(replace(x, 'N', '')) AS n, hamming(x, y) - length(x) + length(replace(x, 'N', '')) AS bad FROM (
    SELECT *, substr(s1, greatest(0, d) + 1, least(a - greatest(0, d), b - greatest(0, -d))) AS x, substr(s2, greatest(0, -d) + 1, least(a - greatest(0, d), b - greatest(0, -d))) AS y
    FROM (SELECT *, unnest(range(1 - b, a)) AS d FROM (SELECT *, length(s1) AS a, length(s2) AS b FROM {0}) WHERE a > 0 AND b > 0)))"""

_tail = lambda q: f"coalesce(list_max(list_filter(range(4, length({q}) + 1), lambda e: list_sum(list_transform(range(e - 3, e + 1), lambda j: ord(substr({q}, j, 1)))) >= 212)), 0)"
_reason = lambda i: f"""CASE WHEN 100 * (length(q{i}) - length(regexp_replace(q{i}, '[!-/]', '', 'g'))) > 40 * length(q{i}) THEN 'low_quality'
    WHEN length(s{i}) - length(replace(s{i}, 'N', '')) > 5 THEN 'too_many_n' WHEN length(s{i}) < 15 THEN 'too_short' ELSE 'passed' END"""  # noqa: E731

_TRIMMED = f"""
    WITH t AS (SELECT *, {_tail('q1')} AS n1, {_tail('q2')} AS n2 FROM {{raw_pairs}}),
    f AS (SELECT k AS key, arg_min(CASE WHEN d < 0 THEN l END, CASE WHEN d < 0 THEN 1000 - d ELSE d END) AS l, arg_min(d, CASE WHEN d < 0 THEN 1000 - d ELSE d END) AS d
          FROM {_LAID.format(f"(SELECT k, substr(s1, 1, n1) AS s1, {rc('substr(s2, 1, n2)')} AS s2 FROM t)")} WHERE l >= 30 AND bad <= 5 GROUP BY k),
    c AS (SELECT * REPLACE (substr(s1, 1, n1) AS s1, substr(q1, 1, n1) AS q1, substr(s2, 1, n2) AS s2, substr(q2, 1, n2) AS q2)
          FROM (SELECT * REPLACE (CASE WHEN d < 0 THEN l ELSE n1 END AS n1, CASE WHEN d < 0 THEN l ELSE n2 END AS n2) FROM t LEFT JOIN f ON k = key)),
    r AS (SELECT *, CASE WHEN ({_reason(1)}) <> 'passed' THEN {_reason(1)} ELSE {_reason(2)} END AS status FROM c)"""

_second = "i < 0 OR i >= a OR (i >= d AND i < b + d AND (substr(s1, i + 1, 1) = 'N' OR substr(q2, i - d + 1, 1) > substr(q1, i + 1, 1)))"
_MERGED = f"""
    m AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score, n DESC, d < 0, abs(d)) AS place FROM (
              SELECT *, bad / least(n, 250) AS score FROM {_LAID.format(f"(SELECT k, s1, q1, {rc('s2')} AS s2, reverse(q2) AS q2 FROM {{source}})")} WHERE n >= CASE WHEN d >= 0 THEN 10 ELSE 20 END))
          WHERE place = 1 AND score <= 0.25),
    e AS (SELECT k, array_to_string(list_transform(range(least(0, d), greatest(a, b + d)), lambda i: CASE WHEN {_second} THEN substr(s2, i - d + 1, 1) ELSE substr(s1, i + 1, 1) END), '') AS seq,
                 array_to_string(list_transform(range(least(0, d), greatest(a, b + d)), lambda i: CASE
                     WHEN i < 0 OR i >= a OR (i >= d AND i < b + d AND substr(s1, i + 1, 1) = 'N') THEN substr(q2, i - d + 1, 1) WHEN i < d OR i >= b + d THEN substr(q1, i + 1, 1)
                     WHEN substr(s1, i + 1, 1) = substr(s2, i - d + 1, 1) THEN greatest(substr(q1, i + 1, 1), substr(q2, i - d + 1, 1))
                     ELSE chr(cast(33 + greatest(2, abs(ord(substr(q1, i + 1, 1)) - ord(substr(q2, i - d + 1, 1)))) AS int)) END), '') AS qual,
                 cast(d AS int) AS "offset", cast(n AS int) AS overlap, cast(bad AS int) AS mismatches FROM m)"""


@query(_TRIMMED + " SELECT k, s1, q1, s2, q2, status FROM r")
def trim_read_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.trim_pairs(table(spark, sf_dir, "raw_pairs")).select("k", "s1", "q1", "s2", "q2", "status")


@query("WITH " + _MERGED.replace("{source}", "{raw_pairs}") + ' SELECT k, seq, qual, "offset", overlap, mismatches FROM e')
def merge_read_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = G.merge_pairs(table(spark, sf_dir, "raw_pairs"))
    return merged.where(F.col("merged").isNotNull()).select("k", "merged.*")


_LANES = "(SELECT *, concat('s', cast(k % 4 as string)) AS sample_id FROM {raw_pairs})"


@query(
    _TRIMMED.replace("{raw_pairs}", _LANES) + ", p AS (SELECT * FROM r WHERE status = 'passed')," + _MERGED.replace("{source}", "p")
    + """ SELECT sample_id, count(e.k) AS combined, count(*) - count(e.k) AS uncombined, count(*) FILTER (e."offset" < 0) AS outies FROM p LEFT JOIN e USING (k) GROUP BY sample_id"""
)
def run_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw pairs of four samples to the counts of merged and unmerged pairs."""
    pairs = table(spark, sf_dir, "raw_pairs").withColumn("sample_id", F.concat(F.lit("s"), F.col("k") % 4))
    return pipeline.reads_step(pairs)["merging"]
