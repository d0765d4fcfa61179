"""Catalogue queries on read pairs, long reads, tool logs, report extras and whole runs of several samples."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import sequence as S
from ..operators import alignments as A
from ..operators import association as V
from ..operators import counts as C
from ..operators import junctions as J
from ..operators import matching as M
from ..operators import psi as P
from ..operators import report as R
from ..schema import EVENTS
from ..sources import bam, readers
from ..sources.shared import shared_folder
from . import catalog, pipeline
from .catalog import ORACLE_SQL, query
from .catalog_reads import _checked, _extracted, loc
from .tables import DOWN, PAIR_AFTER, PAIR_BEFORE, TARGET, TEMPLATE, UP, VHH, rc, spread, table



@query("SELECT qname, flag, rname, pos, cigar, nh, 'v' || cast(pos AS string) AS tag FROM {tagged}")
def bam_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived alignments written as binary files and scanned again in small splits."""
    rows = spread(table(spark, sf_dir, "tagged"))
    missing = [F.lit(None).cast(t).alias(c) for c, t in (("mapq", "int"), ("rnext", "string"), ("pnext", "int"), ("tlen", "int"), ("seq", "string"), ("qual", "string"))]
    tags = F.create_map(F.lit("NH"), "nh", F.lit("XV"), F.concat(F.lit("v"), "pos")).alias("tags")
    contigs = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.concat(F.lit("c"), "s_suppkey").alias("name"), F.lit(100_000).alias("length"))
    folder = f"{shared_folder(spark).rstrip('/')}/bam-{uuid.uuid4().hex}"
    bam.write_bam(rows.select("qname", "flag", "rname", "pos", "cigar", *missing, tags), contigs, folder)
    return bam.read_bam(spark, folder, 1 << 16).select("qname", "flag", "rname", "pos", "cigar", F.col("tags")["NH"].alias("nh"), F.col("tags")["XV"].alias("tag"))


_near = lambda text, pattern: f"len(list_filter(range(0, length({text}) - length({pattern}) + 1), lambda i: levenshtein(substr({text}, cast(i as int) + 1, length({pattern})), {pattern}) <= 8)) > 0"

_PAIRS = f"""
    WITH f AS (SELECT * RENAME (raw AS raw1) FROM (SELECT * EXCLUDE (u, d) FROM {_extracted('{read_pairs}', 's2')})),
    r AS (SELECT * FROM {_extracted(f"(SELECT *, {rc('s2')} AS other FROM f)", "other")}),
    b AS (SELECT * EXCLUDE (u, d, raw), {_checked('coalesce(raw1, raw)')} AS barcode, CASE WHEN raw1 IS NULL AND raw IS NOT NULL THEN other ELSE s2 END AS turned FROM r),
    m AS (SELECT barcode, var_id, regexp_replace(variant, '[^A-Z]', '', 'g') AS exon FROM (SELECT *, row_number() OVER (PARTITION BY barcode ORDER BY line DESC) AS n FROM {{barcode_map}}) WHERE n = 1),
    j AS (SELECT b.*, m.var_id, m.exon, concat(s1, turned) AS joined FROM b LEFT JOIN m USING (barcode)),
    c AS (SELECT *, CASE WHEN barcode IS NULL THEN 'no_barcode' WHEN var_id IS NULL THEN 'no_variant' WHEN {_near('joined', f"concat('{PAIR_BEFORE}', exon, '{PAIR_AFTER}')")} THEN 'exon_inclusion'
                         WHEN {_near('joined', f"'{PAIR_BEFORE}{PAIR_AFTER}'")} THEN 'exon_skipping' ELSE 'leftover' END AS status FROM j)"""


def _paired(spark, sf_dir):
    layout = {"before": PAIR_BEFORE, "after": PAIR_AFTER, "up": UP, "down": DOWN, "template": TEMPLATE}
    return M.canonical_pairs(table(spark, sf_dir, "read_pairs"), table(spark, sf_dir, "barcode_map"), **layout)


@query(_PAIRS + " SELECT var_id AS read_ref, var_id, barcode, status AS ref_type, count(*) AS count FROM c WHERE status IN ('exon_inclusion', 'exon_skipping') GROUP BY ALL")
def canonical_pe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.canonical_counts(_paired(spark, sf_dir), F.col("var_id"))


@query(_PAIRS + " SELECT status, count(*) AS n FROM c GROUP BY status")
def canonical_pe_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _paired(spark, sf_dir).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query(_PAIRS + f""", l AS (SELECT *, {loc('s1', f"'{PAIR_BEFORE}'")} AS cut FROM c WHERE status = 'leftover')
    SELECT CASE WHEN cut >= 0 THEN concat(h1, '||', var_id) ELSE h1 END AS h1, CASE WHEN cut >= 0 THEN substr(s1, cast(cut as int) + 1) ELSE s1 END AS s1, CASE WHEN cut >= 0 THEN substr(q1, cast(cut as int) + 1) ELSE q1 END AS q1, h2, s2, q2 FROM l""")
def canonical_pe_leftovers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.pair_leftovers(_paired(spark, sf_dir))


def _mates(spark, sf_dir):
    return A.pair_up(A.with_end(table(spark, sf_dir, "aligned_mates")))


_BOTH = "SELECT a.k, a.qname, a.rname AS r1, a.pos AS p1, a.cigar AS c1, a.seq AS s1, b.rname AS r2, b.pos AS p2, b.cigar AS c2, b.seq AS s2 FROM {aligned_mates} a JOIN {aligned_mates} b ON a.qname = b.qname AND a.flag = 99 AND b.flag = 147"


@query(f"""WITH e AS (SELECT *, {_checked()} AS barcode, {loc('s2', chr(39) + DOWN + chr(39))} AS dw FROM {_extracted(f'({_BOTH})', 's2')}),
    m AS (SELECT barcode, max_by(var_id, line) AS var_id FROM {{barcode_map}} GROUP BY barcode)
    SELECT r1 AS read_ref, m.var_id, e.barcode, CASE WHEN dw - 12 > 0 AND c2 LIKE '%22N%' THEN concat(s1, 'NNNN', substr(s2, 1, cast(dw as int) - 12)) ELSE 'unavail' END AS spliced_sequence, count(*) AS count
    FROM e LEFT JOIN m USING (barcode) WHERE e.barcode IS NOT NULL GROUP BY ALL""")
def novel_pe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.novel_counts(M.novel_pairs(_mates(spark, sf_dir), table(spark, sf_dir, "barcode_map"), UP, DOWN, TEMPLATE), products=True)


_PE_ALIGNED = f"""WITH t AS (SELECT *, {rc('s2')} AS back, p1 + 9 AS e1, p2 + CASE k % 4 WHEN 0 THEN 37 WHEN 1 THEN 27 ELSE 15 END AS e2 FROM ({_BOTH})),
    b AS (SELECT *, substr(r1, 1, length(r1) - 2) AS ref_type, r1 = r2 AND 15 - p1 > 5 AND e2 - CASE WHEN r1 LIKE 'exon_inclusion%' THEN 27 ELSE 15 END > 5
                 AND coalesce(try_cast(regexp_extract(c1, '(\\d+)S$', 1) as int), 0) <= 5 AND coalesce(try_cast(regexp_extract(c2, '^(\\d+)S', 1) as int), 0) <= 5 AND p2 >= e1 AS spans, {_checked()} IS NOT NULL AS fits
          FROM {_extracted('t', 'back')})"""


def _aligned_pairs(spark, sf_dir, spanning=False):
    return M.aligned_pairs(_mates(spark, sf_dir), table(spark, sf_dir, "aligned_exons"), UP, DOWN, TEMPLATE, spanning=spanning)


@query(_PE_ALIGNED + " SELECT ref_type, spans, CASE WHEN fits THEN raw END AS barcode, count(*) AS count FROM b GROUP BY ALL")
def canonical_pe_align_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _aligned_pairs(spark, sf_dir).groupBy("ref_type", "spans", "barcode").agg(F.count(F.lit(1)).alias("count"))


@query(_PE_ALIGNED + """, c AS (SELECT raw AS barcode, ref_type, count(*) AS count FROM b WHERE spans AND fits GROUP BY ALL)
    SELECT 'x' AS read_ref, m.var_id, c.barcode, ref_type, cast(sum(c.count) as bigint) AS count FROM c LEFT JOIN {barcode_map} m ON c.barcode = m.barcode GROUP BY ALL""")
def canonical_pe_align_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.aligned_counts(_aligned_pairs(spark, sf_dir, spanning=True), table(spark, sf_dir, "barcode_map"))


@query("""SELECT qname AS header, CASE WHEN flag & 16 <> 0 THEN """ + rc("seq") + """ ELSE seq END AS seq, source FROM (
    SELECT qname, flag, seq, 'unmapped' AS source FROM {aligned_mates} WHERE pos = 8 UNION ALL
    SELECT a.qname, a.flag, a.seq, 'wrong' FROM {aligned_mates} a JOIN (SELECT qname FROM {aligned_mates} GROUP BY qname HAVING count(DISTINCT rname) = 2) w USING (qname))""")
def leftover_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "aligned_mates").withColumn("qual", F.lit(""))
    wrong = A.pair_up(rows).where("first.rname <> second.rname")
    wrong = wrong.select(F.explode(F.array("first", "second")).alias("r")).select("r.*")
    unmapped = A.unmapped(rows.withColumn("flag", F.when(F.col("pos") == 8, F.col("flag").bitwiseOR(4)).otherwise(F.col("flag"))))
    return A.with_source({"unmapped": A.to_reads(unmapped), "wrong": A.to_reads(wrong)}).drop("qual")


@query("""SELECT 'single' AS layout, flag, count(*) AS n FROM {tagged} WHERE flag IN (0, 16) AND nh = '1' GROUP BY ALL
    UNION ALL SELECT 'paired', flag, count(*) FROM {tagged} WHERE flag IN (99, 147, 83, 163) AND nh = '1' GROUP BY ALL""")
def unique_spliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "tagged").withColumn("tags", F.create_map(F.lit("NH"), "nh"))
    kinds = {k: A.unique_spliced(rows, p).groupBy("flag").agg(F.count(F.lit(1)).alias("n")) for k, p in (("single", False), ("paired", True))}
    return A.with_source(kinds, "layout")


@query("""WITH r AS (SELECT concat('v', cast(s_suppkey as string)) AS id, 100 + s_suppkey % 30 AS n FROM supplier), v AS (SELECT DISTINCT concat('v', cast(p_partkey as string), '/m1') AS name, concat('v', cast(p_partkey as string)) AS id FROM part)
    SELECT id AS name, n AS length FROM r UNION ALL SELECT name, coalesce(n, 1000) FROM v LEFT JOIN r USING (id)""")
def contigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    key = F.col("s_suppkey").cast("int")
    reference = read("supplier").select(F.concat(F.lit("v"), key).alias("id"), F.repeat(F.lit("A"), 100 + key % 30).alias("seq"))
    names = read("part").select(F.concat(F.lit("v"), "p_partkey", F.lit("/m1")).alias("var_id"))
    return M.contigs(reference, names).select("name", F.col("length").cast("bigint").alias("length"))


@query(f"SELECT * REPLACE (concat(chrom, '_m1/alt') AS chrom) FROM ({ORACLE_SQL['junction_annotation']})")
def junction_annotation_mutated(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = J.coordinates(table(spark, sf_dir, "bed")).select(F.concat("chrom", F.lit("_m1/alt")).alias("chrom"), "strand", "donor", "acceptor", "coverage")
    exons = table(spark, sf_dir, "exons").withColumn("var_id", F.concat("var_id", F.lit("_wt")))
    return J.annotate(rows, exons, mutated=True)


_LONG = f"""WITH t AS (SELECT seq, {rc('seq')} AS back FROM {{long_reads}}),
    x AS (SELECT seq, back, u AS bu, d AS bd, raw AS b FROM {_extracted('t')}), y AS (SELECT * EXCLUDE (u, d, raw), u AS vu, d AS vd, raw AS v FROM {_extracted('x', 'seq', *VHH)}), z AS (SELECT * EXCLUDE (u, d, raw), u AS tu, d AS td, raw AS t FROM {_extracted('y', 'seq', *TARGET)}),
    x2 AS (SELECT * EXCLUDE (u, d, raw), u AS bu2, d AS bd2, raw AS b2 FROM {_extracted('z', 'back')}), y2 AS (SELECT * EXCLUDE (u, d, raw), u AS vu2, d AS vd2, raw AS v2 FROM {_extracted('x2', 'back', *VHH)}), z2 AS (SELECT * EXCLUDE (u, d, raw), u AS tu2, d AS td2, raw AS t2 FROM {_extracted('y2', 'back', *TARGET)}),
    g AS (SELECT *, (CASE WHEN b IS NULL THEN 1 ELSE 0 END) + (CASE WHEN v IS NULL THEN 1 ELSE 0 END) + (CASE WHEN t IS NULL THEN 1 ELSE 0 END) >= 2 AS again FROM z2),
    p AS (SELECT {', '.join(f'CASE WHEN again THEN {c}2 ELSE {c} END AS {c}' for c in ('bu', 'bd', 'b', 'vu', 'vd', 'v', 'tu', 'td', 't'))} FROM g),
    e AS (SELECT {_checked('b')} AS barcode_seq, v AS vhh_seq, t AS target_seq, CASE WHEN bu < 0 THEN 'barcode_up' WHEN bd < 0 THEN 'barcode_down' WHEN {_checked('b')} IS NULL THEN 'barcode_template' WHEN vu < 0 THEN 'vhh_up' WHEN vd < 0 THEN 'vhh_down'
                 WHEN length(v) NOT IN (10, 12) THEN 'vhh_length' WHEN tu < 0 THEN 'target_up' WHEN td < 0 THEN 'target_down' WHEN length(t) NOT IN (8) THEN 'target_length' END AS early FROM p),
    r AS (SELECT *, coalesce(early, CASE WHEN count < 2 THEN 'coverage' END) AS reason FROM (SELECT barcode_seq, vhh_seq, target_seq, early, count(*) AS count FROM e GROUP BY ALL))"""


def _long(spark, sf_dir):
    return V.associate_long_reads(table(spark, sf_dir, "long_reads"), (UP, DOWN), VHH, TARGET, TEMPLATE, [10, 12], [8])


@query(_LONG + " SELECT barcode_seq, vhh_seq, target_seq, count FROM (SELECT *, row_number() OVER (PARTITION BY barcode_seq ORDER BY count DESC, vhh_seq, target_seq) AS n FROM r WHERE reason IS NULL) WHERE n = 1")
def associate_longread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _long(spark, sf_dir)[0]


@query(_LONG + f" SELECT s AS step, cast(coalesce(sum(count), 0) as bigint) AS n FROM (SELECT unnest({[*V.LONG_STEPS, 'accepted']}) AS s) LEFT JOIN r ON coalesce(reason, 'accepted') = s GROUP BY s")
def associate_longread_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.step_statistics(_long(spark, sf_dir)[1], V.LONG_STEPS)


@query("""SELECT name, cast(sum(v) as bigint) AS value FROM (SELECT CASE WHEN i = 0 THEN 'reads passed filter' WHEN i = 1 THEN 'Combined pairs' WHEN i = 2 THEN 'Uncombined pairs' WHEN i = 3 THEN 'Total' WHEN i = 5 THEN 'Mapped' END AS name,
    cast(regexp_extract(value, ':\\s*(\\d+)', 1) as bigint) AS v FROM {logs}) WHERE name IS NOT NULL GROUP BY name""")
def stats_scrape(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "logs").select("value")
    return A.add_statistics(readers.trim_statistics(lines), readers.aligner_statistics(lines))


@query("""WITH t AS (SELECT run, sum(CASE WHEN i = 3 THEN v END) AS t, sum(CASE WHEN i = 4 THEN v END) AS a0, sum(CASE WHEN i = 5 THEN v END) AS a1, sum(CASE WHEN i = 6 THEN v END) AS am FROM (SELECT run, i, cast(regexp_extract(value, ':\\s*(\\d+)', 1) as bigint) AS v FROM {logs}) GROUP BY run)
    SELECT run, unnest(['Total', 'Aligned 0 time', 'Aligned 1 time', 'Aligned >1 times', 'Overall alignment rate']) AS name, unnest([cast(t as bigint), cast(a0 as bigint), cast(a1 as bigint), cast(am as bigint), cast(CASE WHEN t > 0 THEN (a1 + am) * 100 // t END as bigint)]) AS value FROM t""")
def aligner_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.aligner_totals(table(spark, sf_dir, "logs"), ["run"])


@query("""SELECT cast(sum(CASE WHEN flag = 99 AND rname LIKE '%_inclusion%' THEN 1 ELSE 0 END) as bigint) AS inclusion_reads, cast(sum(CASE WHEN flag = 99 AND rname LIKE '%_skipping%' THEN 1 ELSE 0 END) as bigint) AS skipping_reads FROM {aligned_mates}""")
def idxstats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.reference_totals(A.reference_counts(table(spark, sf_dir, "aligned_mates").where("flag = 99")))


_GENES = "SELECT concat('G_e', cast(p_size as string), '_', cast(p_partkey as string)) AS var_id, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE cast(p_size as double) END AS psi1, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_retailprice END AS psi2 FROM {part}"


def _genes(spark, sf_dir):
    return spark.sql(_GENES, part=spark.read.parquet(f"{sf_dir}/part.parquet"))


_GENES_SQL = _GENES.replace("{part}", "part")


@query(f"""SELECT 'complete' AS kind, count(*) AS n FROM ({_GENES_SQL}) WHERE psi1 IS NOT NULL AND psi2 IS NOT NULL UNION ALL SELECT 'any', count(*) FROM ({_GENES_SQL}) WHERE psi1 IS NOT NULL OR psi2 IS NOT NULL
    UNION ALL SELECT 'exon prefix', count(*) FROM ({_GENES_SQL}) WHERE var_id LIKE 'G\\_e1%' ESCAPE '\\' UNION ALL SELECT 'exon', count(*) FROM ({_GENES_SQL}) WHERE var_id LIKE 'G\\_e1\\_%' ESCAPE '\\' UNION ALL SELECT 'range', count(*) FROM ({_GENES_SQL}) WHERE psi1 >= 10 AND psi1 <= 30""")
def report_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _genes(spark, sf_dir)
    kinds = {"complete": R.complete_rows(rows, ["psi1", "psi2"]), "any": R.any_value(rows.drop("var_id")), "exon prefix": R.of_exon(rows, "G_e1"), "exon": R.of_exon(rows, "G_e1", whole=True), "range": R.within(rows, "psi1", 10, 30)}
    return A.with_source({k: d.agg(F.count(F.lit(1)).alias("n")) for k, d in kinds.items()}, "kind")


@query(f"SELECT DISTINCT concat_ws('_', split_part(var_id, '_', 1), split_part(var_id, '_', 2)) AS exon_id FROM ({_GENES_SQL})")
def report_exon_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.exon_ids(_genes(spark, sf_dir).select("var_id").unionByName(spark.createDataFrame([("elib",)], "var_id string")))


@query("SELECT rep, round(regr_slope(skipping, inclusion), 6) AS slope, round(regr_intercept(skipping, inclusion), 4) AS intercept, round(regr_r2(skipping, inclusion), 6) AS r2, count(*) AS n FROM {counts} WHERE inclusion <> 0 AND skipping <> 0 GROUP BY rep")
def linear_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    fit = R.linear_fit(table(spark, sf_dir, "counts"), "inclusion", "skipping", ["rep"])
    return fit.select("rep", F.round("slope", 6).alias("slope"), F.round("intercept", 4).alias("intercept"), F.round("r2", 6).alias("r2"), "n")


@query("""WITH r AS (SELECT rep, cast(inclusion AS double) AS x, cast(skipping AS double) AS y FROM {counts} WHERE inclusion <> 0 AND skipping <> 0),
    n AS (SELECT rep, min(x) AS low, max(x) AS high, floor(0.5 * count(*) + 0.00001) AS q FROM r GROUP BY rep),
    g AS (SELECT *, low + i * (high - low) / cast(19 AS double) AS g FROM n CROSS JOIN (SELECT unnest(range(20)) AS i)),
    d AS (SELECT g.*, x, y, row_number() OVER (PARTITION BY g.rep, i ORDER BY abs(x - g)) AS place FROM g JOIN r ON r.rep = g.rep),
    h AS (SELECT *, max(CASE WHEN place = q THEN abs(x - g) END) OVER (PARTITION BY rep, i) AS h FROM d),
    w AS (SELECT *, (x - g) / h AS u, pow(greatest(0, 1 - pow(abs(x - g) / h, 3)), 3) AS w FROM h),
    m AS (SELECT rep, i, any_value(g) AS g, sum(w) AS s0, sum(w * u) AS s1, sum(w * u * u) AS s2, sum(w * u * u * u) AS s3, sum(w * u * u * u * u) AS s4, sum(w * y) AS t0, sum(w * u * y) AS t1, sum(w * u * u * y) AS t2 FROM w GROUP BY rep, i)
    SELECT rep, round(g, 4) AS x, round((t0 * (s2 * s4 - s3 * s3) - s1 * (t1 * s4 - s3 * t2) + s2 * (t1 * s3 - s2 * t2)) / (s0 * (s2 * s4 - s3 * s3) - s1 * (s1 * s4 - s3 * s2) + s2 * (s1 * s3 - s2 * s2)), 3) AS fit FROM m""")
def local_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    fit = R.local_regression(table(spark, sf_dir, "counts"), "inclusion", "skipping", ["rep"], points=20, bins=1 << 16)
    return fit.select("rep", F.round("x", 4).alias("x"), F.round("fit", 3).alias("fit"))


@query("""WITH b AS (SELECT CASE WHEN v <= 5 THEN 0 ELSE ceil(v / 5.0) * 5 - 5 END AS low, count(*) AS n FROM (SELECT l_quantity AS v FROM lineitem) GROUP BY 1)
    SELECT cast(low as double) AS low, cast(low + 5 as double) AS high, n, round(n / max(n) OVER (), 6) AS height FROM b""")
def coverage_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_quantity")
    return P.round_all(R.histogram(rows, "l_quantity", range(0, 55, 5)), 6)


@query("SELECT concat('S', cast(o_custkey % 40 as string)) AS sample, array_to_string(list(concat('r', cast(r as string)) ORDER BY r), ',') AS replicates FROM (SELECT DISTINCT o_custkey, o_orderkey % 12 AS r, o_custkey % 40 AS s FROM (SELECT o_custkey % 40 AS o_custkey, o_orderkey FROM orders)) GROUP BY 1")
def replicate_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet")
    sheet = rows.select(F.concat(F.lit("S"), F.col("o_custkey") % 40).alias("sample"), F.concat(F.lit("r"), F.col("o_orderkey") % 12).alias("replicate")).distinct()
    return R.sample_replicates(sheet.withColumn("sample_id", F.concat_ws("_", "sample", "replicate"))).select("sample", F.array_join("replicates", ",").alias("replicates"))


@query("""SELECT p_partkey, x[1] AS before, split_part(x[2], 'N', 1) AS middle, x[3] AS after FROM (SELECT p_partkey, ['ACGT', concat(upper(substr(md5(cast(p_partkey as string)), 1, 0)), 'GG', CASE WHEN p_partkey % 2 = 0 THEN 'NNAA' ELSE '' END), 'TTT'] AS x FROM part)""")
def reference_exons(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    seq = F.concat(F.lit("ACGTNNACaaGG"), F.when(F.col("p_partkey") % 2 == 0, "NNAA").otherwise(""), F.lit("ccTTTaa"))
    return part.select("p_partkey", S.reference_exons(seq).alias("e")).select("p_partkey", "e.*")


def _run(spark, sf_dir):
    layout = pipeline.layouts(table(spark, sf_dir, "sheet"), table(spark, sf_dir, "sample_references"))
    return pipeline.canonical_step(layout, table(spark, sf_dir, "sample_barcodes"), table(spark, sf_dir, "sample_reads"))


_UP_AT, _DOWN_AT = loc("seq", "barcode_up"), loc("seq", "barcode_down", 2, "u + 16")
_RUN = f"""
    WITH y AS (SELECT sample_id, barcode_up, barcode_down, barcode_temp, split_part(regexp_extract(seq, '^[A-Z]+'), 'N', 1) AS before, regexp_extract(seq, '[A-Z]+$') AS after FROM {{sheet}} JOIN {{sample_references}} USING (sample_id)),
    u AS (SELECT *, {_UP_AT} AS u FROM {{sample_reads}} JOIN y USING (sample_id)),
    d AS (SELECT *, CASE WHEN u >= 0 THEN {_DOWN_AT} ELSE -1 END AS d FROM u),
    x AS (SELECT *, CASE WHEN d >= 0 THEN substr(seq, cast(u as int) + 17, cast(d - u as int) - 16) END AS raw FROM d),
    b AS (SELECT *, CASE WHEN length(raw) = 12 THEN CASE WHEN barcode_temp LIKE 'NNNNAT%' THEN {_checked()} ELSE raw END END AS barcode FROM x),
    m AS (SELECT sample_id, barcode, max_by(var_id, line) AS var_id, regexp_replace(max_by(variant, line), '[^A-Z]', '', 'g') AS exon FROM {{sample_barcodes}} GROUP BY ALL),
    c AS (SELECT b.*, m.var_id, CASE WHEN b.barcode IS NULL THEN 'no_barcode' WHEN m.var_id IS NULL THEN 'no_variant' WHEN {loc('seq', 'concat(before, exon, after)')} >= 0 THEN 'exon_inclusion' WHEN {loc('seq', 'concat(before, after)')} >= 0 THEN 'exon_skipping' ELSE 'leftover' END AS status
          FROM b LEFT JOIN m ON b.sample_id = m.sample_id AND b.barcode = m.barcode)"""


@query(_RUN + " SELECT sample_id, var_id AS read_ref, var_id, barcode, status AS ref_type, count(*) AS count FROM c WHERE status LIKE 'exon%' GROUP BY ALL")
def run_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir)["canonical"]


@query(_RUN + " SELECT sample_id, count(*) FILTER (status = 'no_barcode') AS reads_without_barcodes, count(*) FILTER (status = 'no_variant') AS reads_without_variants FROM c GROUP BY sample_id")
def run_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir)["unknown"]


_KEYED = "(SELECT * REPLACE (concat(sample_id, '|', {0}) AS {0}) FROM {{{1}}})"
_MERGED_RUNS = catalog._MERGED.replace("{bed}", _KEYED.format("chrom", "sample_bed"))
_LABELLED = catalog._ANNOTATED.replace("start + 10 AS d, start + cast(split_part(blockStarts, ',', 2) as int) AS a, coverage FROM {bed}", f"donor AS d, acceptor AS a, coverage FROM ({_MERGED_RUNS})").replace("{exons}", _KEYED.format("var_id", "sample_exons"))
_COUNTED = _RUN + f""", o AS (SELECT concat(sample_id, '|', var_id) AS v, count(*) FILTER (status = 'exon_inclusion') AS inclusion, count(*) FILTER (status = 'exon_skipping') AS skipping FROM c WHERE var_id IS NOT NULL GROUP BY 1),
    n AS (SELECT v, {', '.join(f"coalesce(sum(CASE WHEN e = '{e}' THEN coverage END), 0) AS {e}" for e in EVENTS)} FROM (SELECT chrom AS v, coverage, unnest(string_split(annotation, ';')) AS e FROM ({_LABELLED})) GROUP BY v),
    k AS (SELECT DISTINCT sample_id, var_id, concat(sample_id, '|', var_id) AS v FROM {{sample_barcodes}}),
    t AS (SELECT sample_id, sample, replicate AS rep, var_id, cast(coalesce(inclusion, 0) as bigint) AS inclusion, cast(coalesce(skipping, 0) as bigint) AS skipping, {', '.join(f"cast(coalesce({e}, 0) as bigint) AS {e}" for e in EVENTS)}
          FROM k JOIN {{sheet}} USING (sample_id) LEFT JOIN o USING (v) LEFT JOIN n USING (v)),
    w AS (SELECT *, {' + '.join(EVENTS)} AS others FROM t)"""


def _run_counts(spark, sf_dir):
    known = table(spark, sf_dir, "sample_barcodes").select("sample_id", "var_id")
    parts = (table(spark, sf_dir, t) for t in ("sample_bed", "sample_exons"))
    return pipeline.counts_step(table(spark, sf_dir, "sheet"), known, _run(spark, sf_dir)["canonical"], *parts)


@query(_COUNTED + " SELECT sample_id, sample, rep, var_id, inclusion, skipping, others, " + ", ".join(EVENTS) + " FROM w")
def run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_counts(spark, sf_dir).select("sample_id", "sample", "rep", "var_id", "inclusion", "skipping", "others", *EVENTS)


@query(catalog._psi_sql("(inclusion + skipping)", f"({_COUNTED} SELECT * FROM w WHERE sample IN (SELECT sample FROM {{sheet}} GROUP BY sample HAVING count(*) = 3))", group="sample"))
def run_psi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheet to corrected PSI of all samples with three replicates, with a fixed additive variance."""
    runs = table(spark, sf_dir, "sheet").select("sample", "replicate").collect()
    return P.round_all(pipeline.psi_step(_run_counts(spark, sf_dir), variances={tuple(r): P.START_VARIANCE for r in runs}))


@query(None)
def run_psi_fitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheet to corrected PSI of all samples with three replicates, with variances fitted for all samples together."""
    return P.round_all(pipeline.psi_step(_run_counts(spark, sf_dir)))
