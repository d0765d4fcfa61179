"""The query catalogue: one query per operator family over derived tables, with DuckDB SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import counts as C
from ..operators import junctions as J
from ..operators import psi as P
from ..operators import report as R
from .tables import oracle, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
REPS = ("r1", "r2", "r3")


def query(text: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if text is not None:
            ORACLE_SQL[f.__name__] = oracle(text)
        return f

    return add


def _psi_sql(n: str, source: str = "{counts}", reps: tuple[str, ...] = REPS, raw: bool = True, group: str = "") -> str:
    by_rep = "".join(
        f", round(max(CASE WHEN rep = '{r}' THEN inclusion / total END), 4) AS psi{i}, max(CASE WHEN rep = '{r}' THEN concat(cast(trunc(inclusion / total * 100) as int), ':', cast(trunc(skipping / total * 100) as int), ':', cast(trunc(others / total * 100) as int)) END) AS ratio{i}"
        f", max(CASE WHEN rep = '{r}' THEN cast(total as bigint) END) AS n_total{i}"
        for i, r in enumerate(reps, 1)
    )
    names = ", ".join(f"{c}{i}" for c in ("psi", "ratio", "n_total") for i in range(1, len(reps) + 1)) if raw else ""
    logistic = lambda x: f"1 / (1 + exp(-({x})))"
    own, by, using = (f"{group}, ", f" GROUP BY {group}", f" JOIN g USING ({group})") if group else ("", "", ", g")
    return f"""
    WITH o AS (SELECT *, cast({n} as double) AS n, cast(inclusion + skipping + others as double) AS total FROM {source} WHERE {n} > 0),
    p AS (SELECT *, (inclusion + 0.5) / (n + 1) AS p FROM o),
    v AS (SELECT *, ln(p / (1 - p)) AS y, 1 / (n * p * (1 - p)) + 0.01 AS v FROM p),
    e AS (SELECT {own}var_id, sum(y / v) / sum(1 / v) AS theta, 1 / sum(1 / v) AS var_theta{by_rep} FROM v GROUP BY {own}var_id),
    g AS (SELECT {own}avg(theta) AS mu, var_samp(theta) AS tau2 FROM e{by}),
    s AS (SELECT e.*, tau2 / (tau2 + var_theta) AS sh, mu FROM e{using}),
    t AS (SELECT *, sh * theta + (1 - sh) * mu AS ts, sh * sh * var_theta AS vs FROM s)
    SELECT {own}var_id{', ' + names if raw else ''}, round(theta, 4) AS theta, round(var_theta, 4) AS var_theta, round({logistic('theta')}, 4) AS psi_est, round(sh, 4) AS shrinkage,
           round(ts, 4) AS theta_shrunk, round(vs, 4) AS var_theta_shrunk, round({logistic('ts')}, 4) AS psi_shrunk,
           round({logistic('ts - 1.96 * sqrt(vs)')}, 4) AS psi_shrunk_lwr, round({logistic('ts + 1.96 * sqrt(vs)')}, 4) AS psi_shrunk_upr FROM t"""


def _fixed(spark, sf_dir, mode):
    return P.round_all(P.estimates(table(spark, sf_dir, "counts"), dict.fromkeys(REPS, P.START_VARIANCE), mode))


@query(_psi_sql("(inclusion + skipping)"))
def psi_fixed_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fixed(spark, sf_dir, "can")


@query(_psi_sql("(inclusion + skipping + others)"))
def psi_all_fixed_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fixed(spark, sf_dir, "all")


@query()
def psi_fitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.round_all(P.corrected_psi(table(spark, sf_dir, "counts"), REPS))


_GRID = [(0, -4.6, -4.6, -4.6), (1, -2.0, -3.0, -4.0), (2, -1.0, -6.0, 0.5)]


def _nll_sql() -> str:
    terms = []
    for s in P.subsets(3):
        w = " + ".join(f"coalesce(1 / (s{i} + exp(a{i})), 0)" for i in s)
        th = f"(({' + '.join(f'coalesce(y{i} / (s{i} + exp(a{i})), 0)' for i in s)}) / nullif({w}, 0))"
        terms += [f"coalesce(0.5 * (ln(s{i} + exp(a{i})) + power(y{i} - {th}, 2) / (s{i} + exp(a{i}))), 0)" for i in s]
    pick = ", ".join(f"max(CASE WHEN rep = 'r{i}' THEN {c} END) AS {a}{i}" for i in (1, 2, 3) for c, a in (("y", "y"), ("s2", "s")))
    return f"""
    WITH p AS (SELECT *, (inclusion + 0.5) / (inclusion + skipping + 1.0) AS p, cast(inclusion + skipping as double) AS n FROM {{counts}} WHERE inclusion + skipping > 0),
    o AS (SELECT var_id, rep, ln(p / (1 - p)) AS y, 1 / (n * p * (1 - p)) AS s2 FROM p),
    w AS (SELECT var_id, {pick} FROM o GROUP BY var_id)
    SELECT point, round(sum({' + '.join(terms)}), 4) AS nll FROM w, (VALUES {', '.join(map(str, _GRID))}) t(point, a1, a2, a3) GROUP BY point"""


@query(_nll_sql())
def joint_nll_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = P.wide(P.observations(table(spark, sf_dir, "counts")), REPS)
    return P.round_all(P.joint_nll(wide, spark.createDataFrame(_GRID, "point int, a1 double, a2 double, a3 double"), 3))


_MATRIX = """SELECT concat('w', cast(p_partkey as string)) AS variant_id, cast(p_size * 3 as bigint) AS N_inc1, cast(p_partkey % 50 as bigint) AS N_skip1,
    cast(p_size * 2 + 1 as bigint) AS N_inc2, cast(p_partkey % 70 as bigint) AS N_skip2 FROM part"""
_MELTED = f"""(SELECT variant_id AS var_id, '1' AS rep, N_inc1 AS inclusion, N_skip1 AS skipping, 0 AS others FROM ({_MATRIX})
    UNION ALL SELECT variant_id, '2', N_inc2, N_skip2, 0 FROM ({_MATRIX}))"""


@query(_psi_sql("(inclusion + skipping)", _MELTED, ("1", "2"), raw=False))
def psi_from_wide_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    size, key = F.col("p_size").cast("bigint"), F.col("p_partkey")
    matrix = spark.read.parquet(f"{sf_dir}/part.parquet").select(
        F.concat(F.lit("w"), key).alias("variant_id"), (size * 3).alias("N_inc1"), (key % 50).alias("N_skip1"), (size * 2 + 1).alias("N_inc2"), (key % 70).alias("N_skip2")
    )
    rows = P.estimates(P.from_wide(matrix), {"1": P.START_VARIANCE, "2": P.START_VARIANCE})
    return P.round_all(rows.drop(*(f"{c}{i}" for c in ("psi", "ratio", "n_total") for i in (1, 2))))


def _event_sums() -> str:
    from ..schema import EVENTS

    return ", ".join(f"coalesce(sum(CASE WHEN e = '{e}' THEN coverage END), 0) AS {e}" for e in EVENTS)


def _events() -> str:
    from ..schema import EVENTS

    return ", ".join(f"cast(coalesce({e}, 0) as bigint) AS {e}" for e in EVENTS)


@query(f"""
    WITH c AS (SELECT var_id, sum(CASE WHEN ref_type = 'exon_inclusion' THEN count END) AS i, sum(CASE WHEN ref_type = 'exon_skipping' THEN count END) AS s
               FROM {{canonical}} WHERE var_id <> 'NA' GROUP BY var_id),
    n AS (SELECT chrom AS var_id, {_event_sums()} FROM (SELECT chrom, coverage, unnest(string_split(annotation, ';')) AS e FROM {{labelled}}) GROUP BY chrom)
    SELECT v.var_id, cast(coalesce(i, 0) as bigint) AS canonical_inclusion, cast(coalesce(s, 0) as bigint) AS canonical_skipping, {_events()}
    FROM (SELECT DISTINCT var_id FROM {{variants}}) v LEFT JOIN c USING (var_id) LEFT JOIN n USING (var_id)""")
def splicing_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.splicing_counts(*(table(spark, sf_dir, t) for t in ("variants", "canonical", "labelled")))


_INTRONS = """SELECT var_id, concat('I', row_number() OVER (PARTITION BY var_id ORDER BY exon_start)) AS intron_id, intron_start, intron_end FROM (
    SELECT var_id, exon_start, lag(exon_end) OVER (PARTITION BY var_id ORDER BY exon_start) + 1 AS intron_start, exon_start - 1 AS intron_end FROM {exons}) WHERE intron_start IS NOT NULL"""


@query(_INTRONS)
def introns_from_exons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.introns(table(spark, sf_dir, "exons"))


_MERGED = """
    WITH RECURSIVE j AS (SELECT *, start + cast(split_part(blockSizes, ',', 1) as int) AS donor, start + cast(split_part(blockStarts, ',', 2) as int) AS acceptor FROM {bed}),
    p AS (SELECT DISTINCT chrom, strand, donor, acceptor FROM j),
    k AS (SELECT *, donor * 100000 + acceptor AS id FROM p),
    l AS (SELECT a.chrom, a.strand, a.id AS a, b.id AS b FROM k a JOIN k b ON a.chrom = b.chrom AND a.strand = b.strand AND abs(a.donor - b.donor) <= 2 AND abs(a.acceptor - b.acceptor) <= 2),
    r(chrom, strand, id, root) AS (SELECT chrom, strand, id, id FROM k UNION SELECT r.chrom, r.strand, l.b, r.root FROM r JOIN l ON r.chrom = l.chrom AND r.strand = l.strand AND r.id = l.a WHERE r.root < l.b),
    c AS (SELECT chrom, strand, id, min(root) AS root FROM r GROUP BY ALL),
    m AS (SELECT j.*, c.root, row_number() OVER (PARTITION BY j.chrom, j.strand, c.root ORDER BY coverage DESC, donor, acceptor, start, name) AS n,
                 sum(coverage) OVER (PARTITION BY j.chrom, j.strand, c.root) AS total
          FROM j JOIN c ON j.chrom = c.chrom AND j.strand = c.strand AND j.donor * 100000 + j.acceptor = c.id)
    SELECT chrom, start, "end", name, cast(total as bigint) AS coverage, strand, donor, acceptor FROM m WHERE n = 1 AND total >= 2"""


@query(_MERGED)
def junction_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.merge(J.cluster(J.coordinates(table(spark, sf_dir, "bed"))))


_EXON_LABELS = "concat_ws(';', CASE WHEN d > s + 2 AND d < e - 2 THEN concat('exon_splicing_3p_', id) END, CASE WHEN a > s + 2 AND a < e - 2 THEN concat('exon_splicing_5p_', id) END, CASE WHEN d < s + 2 AND a > e - 2 THEN concat('exon_skipping_', id) END)"
_INTRON_LABELS = "concat_ws(';', CASE WHEN d > s + 2 AND d < e - 2 THEN concat('intron_retension_5p_', id) END, CASE WHEN a > s + 2 AND a < e - 2 THEN concat('intron_retension_3p_', id) END)"


_ANNOTATED = f"""
    WITH j AS (SELECT chrom, strand, start + 10 AS d, start + cast(split_part(blockStarts, ',', 2) as int) AS a, coverage FROM {{bed}}),
    i AS ({_INTRONS}),
    x AS (SELECT j.chrom, j.strand, j.d, j.a, string_agg(nullif({_EXON_LABELS}, ''), ';' ORDER BY s) AS l, min(s) AS lo, max(e) AS hi
          FROM j JOIN (SELECT var_id, exon_id AS id, exon_start AS s, exon_end AS e FROM {{exons}}) x ON j.chrom = x.var_id GROUP BY ALL),
    y AS (SELECT j.chrom, j.strand, j.d, j.a, string_agg(nullif({_INTRON_LABELS}, ''), ';' ORDER BY s) AS l, min(CASE WHEN abs(d - s) <= 2 AND abs(a - e) <= 2 THEN id END) AS hit
          FROM j JOIN (SELECT var_id, intron_id AS id, intron_start AS s, intron_end AS e FROM i) x ON j.chrom = x.var_id GROUP BY ALL)
    SELECT * FROM (SELECT j.chrom, j.strand, j.d AS donor, j.a AS acceptor, j.coverage,
           CASE WHEN x.lo IS NULL THEN 'exon_data_missing' WHEN j.d < x.lo OR j.a > x.hi THEN 'out_of_range'
                WHEN y.hit = 'I1' THEN 'intron_retention_I2' WHEN y.hit = 'I2' THEN 'intron_retention_I1'
                ELSE coalesce(nullif(concat_ws(';', x.l, y.l), ''), 'no_annotation') END AS annotation
    FROM j LEFT JOIN x ON x.chrom = j.chrom AND x.strand = j.strand AND x.d = j.d AND x.a = j.a LEFT JOIN y ON y.chrom = j.chrom AND y.strand = j.strand AND y.d = j.d AND y.a = j.a)
    WHERE annotation <> 'no_annotation'"""


@query(_ANNOTATED)
def junction_annotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = J.coordinates(table(spark, sf_dir, "bed")).select("chrom", "strand", "donor", "acceptor", "coverage")
    return J.annotate(rows, table(spark, sf_dir, "exons"))


_CATEGORY = """SELECT chrom AS var_id, donor, acceptor, annotation, cov_r1, cov_r2, cov_r3, (coalesce(cov_r1, 0) + coalesce(cov_r2, 0) + coalesce(cov_r3, 0)) / n AS avg_cov FROM (
    SELECT chrom, donor, acceptor, annotation, cast(sum(CASE WHEN rep = 'r1' THEN coverage END) as bigint) AS cov_r1, cast(sum(CASE WHEN rep = 'r2' THEN coverage END) as bigint) AS cov_r2,
           cast(sum(CASE WHEN rep = 'r3' THEN coverage END) as bigint) AS cov_r3, count(DISTINCT rep) AS n FROM {labelled} GROUP BY ALL) WHERE n >= 2"""


def _category(spark, sf_dir):
    return R.junctions_category(table(spark, sf_dir, "labelled"), REPS)


@query(f"SELECT * REPLACE (round(avg_cov, 6) AS avg_cov) FROM ({_CATEGORY})")
def junctions_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.round_all(_category(spark, sf_dir), 6)


@query("""SELECT region, count(*) AS n FROM (SELECT string_agg(DISTINCT rep, '&' ORDER BY rep) AS region FROM {labelled} GROUP BY chrom, donor, acceptor) GROUP BY region""")
def junction_venn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.venn(table(spark, sf_dir, "labelled"), ["chrom", "donor", "acceptor"], "rep", REPS)


@query(f"""SELECT label, count(DISTINCT var_id) AS n_variants, count(*) AS n_junctions, round(quantile_cont(l, 0.25), 6) AS q1, round(quantile_cont(l, 0.5), 6) AS q2, round(quantile_cont(l, 0.75), 6) AS q3
    FROM (SELECT var_id, unnest(string_split(annotation, ';')) AS label, log10(avg_cov + 1) AS l FROM ({_CATEGORY})) GROUP BY label""")
def event_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.round_all(R.event_summary(_category(spark, sf_dir)), 6)


_SHOWN = ("intron_retention_I1", "exon_splicing_5p_E2", "exon_skipping_E2")


@query(f"""WITH c AS ({_CATEGORY})
    SELECT var_id, {', '.join(f"max(CASE WHEN list_contains(string_split(annotation, ';'), '{s}') THEN 1 ELSE 0 END) AS {s}" for s in _SHOWN)}, round(log2(sum(avg_cov) + 1), 6) AS log_cov FROM c GROUP BY var_id""")
def upset_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.round_all(R.upset_matrix(_category(spark, sf_dir), _SHOWN), 6)


@query(f"""WITH c AS ({_CATEGORY}) SELECT r AS range, count(*) AS n, round(sum(avg_cov), 4) AS total FROM (
    SELECT avg_cov, unnest(['all', CASE WHEN avg_cov < 1 THEN NULL WHEN avg_cov < 10 THEN '[1,10)' WHEN avg_cov < 100 THEN '[10,100)' WHEN avg_cov < 1000 THEN '[100,1000)' WHEN avg_cov < 10000 THEN '[1000,10000)' ELSE '[10000,inf)' END]) AS r FROM c)
    WHERE r IS NOT NULL GROUP BY r""")
def coverage_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.round_all(R.coverage_ranges(_category(spark, sf_dir)))
