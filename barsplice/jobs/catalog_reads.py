"""Catalogue queries on sequences, reads, alignments, associations and id mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import sequence as S
from ..operators import alignments as A
from ..operators import association as V
from ..operators import idmap as I
from ..operators import matching as M
from ..operators import psi as P
from ..operators import report as R
from ..sources import shared
from ..streaming import canonical
from .catalog import REPS, query
from .tables import AFTER, BEFORE, DOWN, TEMPLATE, UP, dna, rc, table

LAYOUT = {"before": BEFORE, "after": AFTER, "up": UP, "down": DOWN, "template": TEMPLATE}


def loc(seq: str, pattern: str, k: int = 2, begin: str = "0") -> str:
    """Leftmost window within k mismatches, as DuckDB SQL."""
    return f"coalesce(list_filter(range({begin}, length({seq}) - length({pattern}) + 1), lambda i: hamming(substr({seq}, cast(i as int) + 1, length({pattern})), {pattern}) <= {k})[1], -1)"


def _extracted(source: str, seq: str = "seq", up: str = UP, down: str = DOWN) -> str:
    """Adds u, d (places of both flanks) and raw (the text between)."""
    return f"""(SELECT *, CASE WHEN u >= 0 AND d >= 0 THEN substr({seq}, cast(u as int) + {len(up) + 1}, cast(d - u as int) - {len(up)}) END AS raw FROM (
        SELECT *, CASE WHEN u >= 0 THEN {loc(seq, f"'{down}'", 2, f'u + {len(up)}')} ELSE -1 END AS d FROM (SELECT *, {loc(seq, f"'{up}'")} AS u FROM {source})))"""


def _checked(raw: str = "raw") -> str:
    """The barcode with the template's fixed bases, null if it does not fit."""
    return f"""CASE WHEN length({raw}) = {len(TEMPLATE)} AND (CASE WHEN substr({raw}, 5, 1) <> 'A' THEN 1 ELSE 0 END) + (CASE WHEN substr({raw}, 6, 1) <> 'T' THEN 1 ELSE 0 END) <= 1
        THEN concat(substr({raw}, 1, 4), 'AT', substr({raw}, 7)) END"""


@query(f"SELECT p_partkey, {rc('s')} AS rc FROM (SELECT p_partkey, concat({dna('a', 'p_partkey')}, 'nN', lower({dna('c', 'p_partkey')})) AS s FROM part)")
def revcomp(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    s = F.expr(f"concat({dna('a', 'p_partkey')}, 'nN', lower({dna('c', 'p_partkey')}))")
    return part.select("p_partkey", S.revcomp(s).alias("rc"))


@query(f"SELECT pos, count(*) AS n FROM (SELECT {loc('seq', chr(39) + UP + chr(39))} AS pos FROM {{reads}}) GROUP BY pos")
def hamming_locate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "reads").select(S.locate(F.col("seq"), F.lit(UP), 2).cast("bigint").alias("pos")).groupBy("pos").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT pos, count(*) AS n FROM (SELECT coalesce(list_filter(range(0, length(seq) - 5), lambda i: levenshtein(substr(seq, cast(i as int) + 1, 6), 'GATTAC') <= 2)[1], -1) AS pos FROM {barcode_map_sequences}) GROUP BY pos""".replace("{barcode_map_sequences}", "(SELECT upper(variant) AS seq FROM {barcode_map})"))
def levenshtein_locate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "barcode_map").select(F.upper("variant").alias("seq"))
    return rows.select(S.locate_edit(F.col("seq"), F.lit("GATTAC"), 2).cast("bigint").alias("pos")).groupBy("pos").agg(F.count(F.lit(1)).alias("n"))


@query(f"""SELECT status, length, count(*) AS n FROM (SELECT CASE WHEN u < 0 THEN 'upstream not found' WHEN d < 0 THEN 'downstream not found' ELSE 'ok' END AS status, coalesce(length(raw), -1) AS length FROM {_extracted('{reads}')}) GROUP BY ALL""")
def extract_flanked(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "reads").select(S.extract(F.col("seq"), F.lit(UP), F.lit(DOWN), 2).alias("x"))
    return rows.select("x.status", F.coalesce(F.length("x.value"), F.lit(-1)).cast("bigint").alias("length")).groupBy("status", "length").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT line, {_checked('b')} AS barcode FROM (SELECT line, CASE line % 4 WHEN 0 THEN barcode WHEN 1 THEN concat(substr(barcode, 1, 4), 'C', substr(barcode, 6)) WHEN 2 THEN concat(substr(barcode, 1, 4), 'CC', substr(barcode, 7)) ELSE substr(barcode, 2) END AS b FROM {{barcode_map}})")
def barcode_template_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = F.expr("CASE line % 4 WHEN 0 THEN barcode WHEN 1 THEN concat(substr(barcode, 1, 4), 'C', substr(barcode, 6)) WHEN 2 THEN concat(substr(barcode, 1, 4), 'CC', substr(barcode, 7)) ELSE substr(barcode, 2) END")
    return table(spark, sf_dir, "barcode_map").select("line", S.check_barcode(b, F.lit(TEMPLATE), 1).alias("barcode"))


_EXONS = "concat(upper(substr(variant, 1, 3)), variant, 'ACGGT', lower(variant), 'GGATT')"


@query(f"""SELECT line, array_to_string(x, '') AS inclusion, CASE WHEN len(x) >= 3 THEN array_to_string([x[i] for i in range(1, len(x) + 1) if i <> len(x) // 2 + 1], '') END AS skipping, len(x) AS n_exons, length(x[1]) AS first_end
    FROM (SELECT line, regexp_extract_all({_EXONS}, '[A-Z]+') AS x FROM {{barcode_map}})""")
def exon_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.expr(_EXONS)
    rows = table(spark, sf_dir, "barcode_map").select("line", S.inclusion_reference(s).alias("inclusion"), S.skipping_reference(s).alias("skipping"), S.exon_positions(s).alias("p"))
    return rows.select("line", "inclusion", "skipping", F.size("p").cast("bigint").alias("n_exons"), F.get("p", F.lit(0))["end"].cast("bigint").alias("first_end"))


_CLASSIFIED = f"""
    WITH f AS (SELECT header, seq, qual, raw AS raw1 FROM {_extracted('{reads}')}),
    r AS (SELECT header, seq, qual, raw1, raw AS raw2 FROM {_extracted(f"(SELECT *, {rc('seq')} AS other FROM f)", "other")}),
    b AS (SELECT header, seq, raw1 IS NULL AND raw2 IS NOT NULL AS flipped, {_checked('coalesce(raw1, raw2)')} AS barcode FROM r),
    m AS (SELECT barcode, var_id, regexp_replace(variant, '[^A-Z]', '', 'g') AS exon FROM (SELECT *, row_number() OVER (PARTITION BY barcode ORDER BY line DESC) AS n FROM {{barcode_map}}) WHERE n = 1),
    j AS (SELECT b.*, m.var_id, m.exon, CASE WHEN flipped THEN {rc('seq')} ELSE seq END AS o FROM b LEFT JOIN m USING (barcode)),
    c AS (SELECT *, CASE WHEN barcode IS NULL THEN 'no_barcode' WHEN var_id IS NULL THEN 'no_variant'
                         WHEN {loc('o', f"concat('{BEFORE}', exon, '{AFTER}')")} >= 0 THEN 'exon_inclusion'
                         WHEN {loc('o', f"'{BEFORE}{AFTER}'")} >= 0 THEN 'exon_skipping' ELSE 'leftover' END AS status FROM j)"""


def _classified(spark, sf_dir):
    return M.canonical_single(table(spark, sf_dir, "reads"), table(spark, sf_dir, "barcode_map"), **LAYOUT)


@query(_CLASSIFIED + " SELECT var_id AS read_ref, var_id, barcode, status AS ref_type, count(*) AS count FROM c WHERE status IN ('exon_inclusion', 'exon_skipping') GROUP BY ALL")
def canonical_se(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.canonical_counts(_classified(spark, sf_dir), F.col("var_id"))


@query(_CLASSIFIED + " SELECT 'reads' AS read_ref, var_id, barcode, status AS ref_type, count(*) AS count FROM c WHERE status IN ('exon_inclusion', 'exon_skipping') GROUP BY ALL")
def canonical_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reads as a stream of files, counted batch by batch into a table."""
    folder = shared.new_folder(spark)
    table(spark, sf_dir, "reads").write.parquet(f"{folder}/reads")
    stream = spark.readStream.schema("header string, seq string, qual string").option("maxFilesPerTrigger", 4).parquet(f"{folder}/reads")
    run = canonical.start_table(stream, table(spark, sf_dir, "barcode_map"), f"{folder}/counts", f"{folder}/checkpoint", {"availableNow": True}, **LAYOUT)
    run.awaitTermination()
    canonical.compact(spark, f"{folder}/counts")
    return canonical.current(spark, f"{folder}/counts")


@query(_CLASSIFIED + " SELECT count(*) FILTER (status = 'no_barcode') AS reads_without_barcodes, count(*) FILTER (status = 'no_variant') AS reads_without_variants FROM c")
def canonical_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.unknown_counts(_classified(spark, sf_dir))


@query(_CLASSIFIED + " SELECT unnest(['exon_inclusion', 'exon_skipping']) AS event, unnest([count(*) FILTER (status = 'exon_inclusion'), count(*) FILTER (status = 'exon_skipping')]) AS total FROM c")
def canonical_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.event_totals(M.canonical_counts(_classified(spark, sf_dir), F.col("var_id")))


@query(_CLASSIFIED + f""", l AS (SELECT *, {loc('o', f"'{BEFORE}'")} AS cut FROM c WHERE status = 'leftover')
    SELECT CASE WHEN cut >= 0 THEN concat(header, '||', var_id) ELSE header END AS header, CASE WHEN cut >= 0 THEN substr(seq, cast(cut as int) + 1) ELSE seq END AS seq FROM l""")
def canonical_leftovers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.leftovers(_classified(spark, sf_dir)).select("header", "seq")


_PRODUCTS = f"""WITH e AS (SELECT *, {_checked()} AS barcode, {loc('seq', chr(39) + DOWN + chr(39))} AS dw FROM {_extracted('{spliced_reads}')}),
    m AS (SELECT barcode, max_by(var_id, line) AS var_id FROM {{barcode_map}} GROUP BY barcode),
    x AS (SELECT 'ref' AS read_ref, m.var_id, e.barcode, CASE WHEN dw >= 0 AND dw - 12 > 0 AND cigar IN ('20M30N10M', '20M20N10M') THEN substr(seq, 1, cast(dw as int) - 12) ELSE 'unavail' END AS spliced_sequence
          FROM e LEFT JOIN m USING (barcode) WHERE e.barcode IS NOT NULL)"""


def _rescued(spark, sf_dir):
    return M.novel_single(table(spark, sf_dir, "spliced_reads"), table(spark, sf_dir, "barcode_map"), UP, DOWN, TEMPLATE)


@query(_PRODUCTS + " SELECT read_ref, var_id, barcode, count(*) AS count FROM x GROUP BY ALL")
def novel_barcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.novel_counts(_rescued(spark, sf_dir))


@query(_PRODUCTS + " SELECT read_ref, var_id, barcode, spliced_sequence, count(*) AS count FROM x GROUP BY ALL")
def spliced_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.novel_counts(_rescued(spark, sf_dir), products=True)


@query("""SELECT unnest(['unmapped', 'primary_mapped', 'proper', 'improper']) AS name,
    unnest([count(*) FILTER (flag & 4 <> 0), count(*) FILTER (flag & 4 = 0 AND flag & 256 = 0 AND flag & 2048 = 0), count(*) FILTER (flag & 2 <> 0 AND flag & 256 = 0 AND flag & 2048 = 0), count(*) FILTER (flag & 2 = 0)]) AS n FROM {alignments}""")
def flag_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "alignments").select("flag")
    kinds = (("unmapped", A.unmapped), ("primary_mapped", A.primary_mapped), ("proper", A.proper_pairs), ("improper", A.improper))
    out = None
    for name, f in kinds:
        one = f(rows).agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


@query("""SELECT first, last, count(*) AS n FROM (SELECT coalesce(try_cast(regexp_extract(cigar, '^(\\d+)S', 1) as int), 0) AS first, coalesce(try_cast(regexp_extract(cigar, '(\\d+)S$', 1) as int), 0) AS last FROM {alignments}) GROUP BY ALL""")
def softclip_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "alignments").select(S.softclips(F.col("cigar")).alias("c")).select("c.*").groupBy("first", "last").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH a AS (SELECT rname AS chrom, CASE WHEN flag & 16 <> 0 THEN '-' ELSE '+' END AS strand, pos, cast(regexp_extract(cigar, '(\\d+)M\\d+N', 1) as int) AS l, cast(regexp_extract(cigar, '(\\d+)N', 1) as int) AS g, cast(regexp_extract(cigar, 'N(\\d+)M', 1) as int) AS r
              FROM {alignments} WHERE cigar LIKE '%N%')
    SELECT chrom, strand, pos + l AS donor, pos + l + g AS acceptor, count(*) AS coverage FROM a WHERE g >= 20 GROUP BY ALL HAVING max(l) >= 5 AND max(r) >= 5""")
def cigar_junctions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.junctions import from_alignments

    return from_alignments(table(spark, sf_dir, "alignments"))


_PAIRS = f"""
    WITH v AS (SELECT s2, u AS vu, d AS vd, raw AS variant_seq FROM {_extracted('{pairs}', 's1', BEFORE, AFTER)}),
    b AS (SELECT variant_seq, vu, vd, u, d, {_checked()} AS barcode_seq FROM {_extracted('v', 's2')}),
    e AS (SELECT variant_seq, barcode_seq, CASE WHEN vu < 0 THEN 'variant_up' WHEN vd < 0 THEN 'variant_down' WHEN u < 0 THEN 'barcode_up' WHEN d < 0 THEN 'barcode_down'
                 WHEN length(variant_seq) < 11 THEN 'variant_length' WHEN barcode_seq IS NULL THEN 'barcode_template' END AS early FROM b),
    c AS (SELECT variant_seq, barcode_seq, early, count(*) AS count FROM e GROUP BY ALL),
    r AS (SELECT *, coalesce(early, CASE WHEN count < 2 THEN 'coverage' END) AS reason FROM c)"""


def _associated(spark, sf_dir):
    return V.associate_pairs(table(spark, sf_dir, "pairs"), (BEFORE, AFTER), (UP, DOWN), TEMPLATE, 11)


@query(_PAIRS + " SELECT barcode_seq, variant_seq, count FROM (SELECT *, row_number() OVER (PARTITION BY barcode_seq ORDER BY count DESC, variant_seq) AS n FROM r WHERE reason IS NULL) WHERE n = 1")
def associate_pe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _associated(spark, sf_dir)[0]


@query(_PAIRS + f" SELECT s AS step, cast(coalesce(sum(count), 0) as bigint) AS n FROM (SELECT unnest({[*V.PAIR_STEPS, 'accepted']}) AS s) LEFT JOIN r ON coalesce(reason, 'accepted') = s GROUP BY s")
def associate_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.step_statistics(_associated(spark, sf_dir)[1], V.PAIR_STEPS)


@query(f"""WITH k AS (SELECT upper(seq) AS seq, max_by(id, line) AS id, min(line) AS ord FROM {{ids}} GROUP BY upper(seq)),
    q AS (SELECT DISTINCT upper(seq) AS seq FROM {{queries}}), x AS (SELECT min(length(seq)) AS lo, max(length(seq)) AS hi FROM k),
    f AS (SELECT q.seq, {rc('q.seq')} AS rc FROM q, x WHERE length(q.seq) BETWEEN lo - 4 AND hi + 4),
    h AS (SELECT f.seq, CASE WHEN k.seq = f.seq THEN 0 WHEN k.seq = f.rc THEN 1 ELSE 2 END AS stage, k.ord, k.id FROM f, k WHERE levenshtein(f.seq, k.seq) <= 4 OR levenshtein(f.rc, k.seq) <= 4),
    b AS (SELECT seq, arg_min(id, stage * 1000000000 + ord) AS id FROM h GROUP BY seq)
    SELECT q.seq, coalesce(b.id, 'not_found') AS id FROM q LEFT JOIN b USING (seq)""")
def id_map_fuzzy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.map_first(table(spark, sf_dir, "queries"), table(spark, sf_dir, "ids"))


@query("""WITH e AS (SELECT var_id, count(*) AS expected FROM {barcode_map} GROUP BY var_id),
    d AS (SELECT var_id, barcode, sum(count) AS c FROM {canonical} WHERE var_id <> 'NA' GROUP BY ALL), g AS (SELECT var_id, count(*) AS recovered, avg(c) AS m FROM d GROUP BY var_id)
    SELECT var_id, expected, coalesce(recovered, 0) AS recovered, round(m, 6) AS mean_count, round(100.0 * coalesce(recovered, 0) / expected, 2) AS pct FROM e LEFT JOIN g USING (var_id)""")
def barcode_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.round_all(R.barcode_summary(table(spark, sf_dir, "barcode_map"), table(spark, sf_dir, "canonical")), 6)


_WIDE = "SELECT var_id, " + ", ".join(f"coalesce(sum(CASE WHEN rep = '{r}' THEN inclusion END), 0) AS {r}" for r in REPS) + " FROM {counts} GROUP BY var_id"


@query(f"""WITH w AS ({_WIDE}), t AS (SELECT {', '.join(f'sum({r}) AS t_{r}' for r in REPS)} FROM w), l AS (SELECT {', '.join(f'log2(cast({r} as double) / t_{r} * 1e6 + 1) AS {r}' for r in REPS)} FROM w, t)
    SELECT * FROM (SELECT unnest(['r1', 'r1', 'r2']) AS a, unnest(['r2', 'r3', 'r3']) AS b, unnest([round(corr(r1, r2), 6), round(corr(r1, r3), 6), round(corr(r2, r3), 6)]) AS signed, unnest([round(abs(corr(r1, r2)), 6), round(abs(corr(r1, r3)), 6), round(abs(corr(r2, r3)), 6)]) AS r FROM l)""")
def replicate_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = [F.coalesce(F.sum(F.when(F.col("rep") == r, F.col("inclusion"))), F.lit(0)).alias(r) for r in REPS]
    wide = table(spark, sf_dir, "counts").groupBy("var_id").agg(*cells)
    return P.round_all(R.correlations(R.log_cpm(wide, REPS), REPS), 6)


@query("SELECT var_id AS sample, rep AS replicate FROM {counts} WHERE var_id IN (SELECT var_id FROM {counts} WHERE others > 60 GROUP BY var_id HAVING count(*) = 3) AND others > 60")
def replicate_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    sheet = table(spark, sf_dir, "counts").where("others > 60").select(F.col("var_id").alias("sample"), F.col("rep").alias("replicate"))
    return R.complete_samples(sheet)


_TEMPLATE_EXONS = [("t", "E1", 1, 50), ("t", "E2", 151, 250), ("t", "E3", 351, 500)]


@query("""WITH j AS (SELECT chrom AS var_id, start + 10 AS donor, start + cast(split_part(blockStarts, ',', 2) as int) AS acceptor FROM {bed}),
    x AS (SELECT var_id, segment, s, e, t0, t1 FROM (
            SELECT var_id, exon_id AS segment, exon_start AS s, exon_end AS e FROM {exons}
            UNION ALL SELECT a.var_id, concat('I', substr(a.exon_id, 2)), a.exon_end + 1, b.exon_start - 1 FROM {exons} a JOIN {exons} b ON a.var_id = b.var_id AND cast(substr(b.exon_id, 2) as int) = cast(substr(a.exon_id, 2) as int) + 1)
          JOIN (VALUES ('E1', 1, 50), ('I1', 51, 150), ('E2', 151, 250), ('I2', 251, 350), ('E3', 351, 500)) t(segment, t0, t1) USING (segment))
    SELECT var_id, donor, acceptor, cast(min(CASE WHEN donor BETWEEN s AND e THEN round(t0 + cast(donor - s as double) / (e - s) * (t1 - t0)) END) as bigint) AS donor_scaled,
           cast(min(CASE WHEN acceptor BETWEEN s AND e THEN round(t0 + cast(acceptor - s as double) / (e - s) * (t1 - t0)) END) as bigint) AS acceptor_scaled FROM j JOIN x USING (var_id) GROUP BY ALL""")
def rescale_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.junctions import coordinates

    rows = coordinates(table(spark, sf_dir, "bed")).select(F.col("chrom").alias("var_id"), "donor", "acceptor")
    template = R.segments(spark.createDataFrame(_TEMPLATE_EXONS, "var_id string, exon_id string, exon_start int, exon_end int"))
    return R.rescale(rows, R.segments(table(spark, sf_dir, "exons")), template)


_HEADERS = "CASE line % 4 WHEN 0 THEN concat('h', cast(line as string)) WHEN 1 THEN concat('h||', var_id) WHEN 2 THEN concat('h||', var_id, '_del101to121') ELSE concat('h||', var_id, '_del5to9') END"


@query(f"""WITH h AS (SELECT line, {_HEADERS} AS header FROM {{barcode_map}}), x AS (SELECT line, header, CASE WHEN header LIKE '%||%' THEN split_part(header, '||', 2) END AS id FROM h),
    y AS (SELECT line, header, CASE WHEN id LIKE '%_del101to121' THEN replace(id, '_del101to121', '_del21nt') ELSE id END AS exon_id FROM x)
    SELECT exon_id, header, line FROM y WHERE exon_id IN (SELECT concat(var_id, '_del21nt') FROM {{barcode_map}} WHERE line % 3 = 0 UNION SELECT var_id FROM {{barcode_map}} WHERE line % 3 = 1)""")
def exon_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "barcode_map")
    known = rows.where("line % 3 = 0").select(F.concat("var_id", F.lit("_del21nt")).alias("exon_id")).unionByName(rows.where("line % 3 = 1").select(F.col("var_id").alias("exon_id")))
    return A.split_by_exon(rows.select(F.expr(_HEADERS).alias("header"), "line"), known).select("exon_id", "header", "line")


@query("""SELECT name, cast(sum(value) as bigint) AS value FROM (SELECT ref_type AS name, count AS value FROM {canonical} UNION ALL SELECT 'exon_skipping', skipping FROM {counts} UNION ALL SELECT 'others', others FROM {counts}) GROUP BY name""")
def stat_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = table(spark, sf_dir, "canonical").select(F.col("ref_type").alias("name"), F.col("count").alias("value"))
    counts = table(spark, sf_dir, "counts")
    two = counts.select(F.lit("exon_skipping").alias("name"), F.col("skipping").alias("value"))
    return A.add_statistics(one, two, counts.select(F.lit("others").alias("name"), F.col("others").alias("value")))


@query("""SELECT coalesce(var_id, 'NA') AS var_id, part, round(100.0 * v / t, 2) AS pct FROM (SELECT var_id, unnest(['inclusion', 'skipping']) AS part, unnest([sum(inclusion), sum(skipping)]) AS v, sum(inclusion + skipping + others) AS t FROM {counts} GROUP BY var_id)""")
def reads_summary_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "counts").groupBy("var_id").agg(*(F.sum(c).alias(c) for c in ("inclusion", "skipping")), F.sum(F.expr("inclusion + skipping + others")).alias("total"))
    return R.read_percentages(rows, "total", ["inclusion", "skipping"], "var_id")


@query("""WITH m AS (SELECT barcode AS k, 'canonical' AS s FROM {canonical} UNION ALL SELECT barcode, 'known' FROM {barcode_map} UNION ALL SELECT barcode, 'inclusion' FROM {canonical} WHERE ref_type = 'exon_inclusion')
    SELECT region, count(*) AS n FROM (SELECT k, concat_ws('&', CASE WHEN bool_or(s = 'canonical') THEN 'canonical' END, CASE WHEN bool_or(s = 'known') THEN 'known' END, CASE WHEN bool_or(s = 'inclusion') THEN 'inclusion' END) AS region FROM m GROUP BY k) GROUP BY region""")
def barcode_venn(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen, known = table(spark, sf_dir, "canonical"), table(spark, sf_dir, "barcode_map")
    rows = seen.select("barcode", F.lit("canonical").alias("s")).unionByName(known.select("barcode", F.lit("known").alias("s")))
    rows = rows.unionByName(seen.where("ref_type = 'exon_inclusion'").select("barcode", F.lit("inclusion").alias("s")))
    return R.venn(rows, ["barcode"], "s", ["canonical", "known", "inclusion"])


@query("SELECT var_id, barcode, ref_type, count, 'se' AS layout FROM {canonical} WHERE count > 45 UNION ALL SELECT var_id, barcode, ref_type, count, 'pe' FROM {canonical} WHERE count <= 2")
def union_se_pe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "canonical")
    return rows.where("count > 45").withColumn("layout", F.lit("se")).unionByName(rows.where("count <= 2").withColumn("layout", F.lit("pe")))


_ALIGNED = f"""WITH a AS (SELECT seq, length(header) % 13 AS pos, length(header) % 13 + length(seq) AS pos_end, CASE WHEN length(header) % 2 = 0 THEN 'exon_inclusion_x' ELSE 'exon_skipping_x' END AS rname FROM {{reads}}),
    b AS (SELECT substr(rname, 1, length(rname) - 2) AS ref_type, 'x' AS read_ref, raw AS barcode, 15 - pos > 5 AND pos_end - CASE WHEN rname = 'exon_inclusion_x' THEN 27 ELSE 15 END > 5 AS spans, {_checked()} IS NOT NULL AS fits FROM {_extracted('a')})"""


def _aligned(spark, sf_dir, spanning=False):
    n = F.length("header")
    rows = table(spark, sf_dir, "reads").select(
        "seq", (n % 13).alias("pos"), (n % 13 + F.length("seq")).alias("pos_end"), F.when(n % 2 == 0, "exon_inclusion_x").otherwise("exon_skipping_x").alias("rname")
    )
    return M.aligned_single(rows, table(spark, sf_dir, "aligned_exons"), UP, DOWN, TEMPLATE, spanning=spanning)


@query(_ALIGNED + " SELECT ref_type, spans, barcode, count(*) AS count FROM (SELECT ref_type, spans, CASE WHEN fits THEN barcode END AS barcode FROM b) GROUP BY ALL")
def canonical_align_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _aligned(spark, sf_dir).groupBy("ref_type", "spans", "barcode").agg(F.count(F.lit(1)).alias("count"))


@query(_ALIGNED + """, c AS (SELECT read_ref, barcode, ref_type, count(*) AS count FROM b WHERE spans AND fits GROUP BY ALL)
    SELECT read_ref, m.var_id, c.barcode, ref_type, cast(sum(c.count) as bigint) AS count FROM c LEFT JOIN {barcode_map} m ON c.barcode = m.barcode GROUP BY ALL""")
def canonical_align_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.aligned_counts(_aligned(spark, sf_dir, spanning=True), table(spark, sf_dir, "barcode_map"))


@query(f"""WITH k AS (SELECT upper(seq) AS seq, max_by(id, line) AS id, min(line) AS ord FROM {{ids}} GROUP BY upper(seq)),
    q AS (SELECT DISTINCT upper(seq) AS seq FROM {{queries}}), x AS (SELECT min(length(seq)) AS lo, max(length(seq)) AS hi FROM k),
    f AS (SELECT q.seq, unnest([0, 1]) AS rc, unnest([q.seq, {rc('q.seq')}]) AS s FROM q, x WHERE length(q.seq) BETWEEN lo - 2 AND hi + 2),
    d AS (SELECT f.seq, f.rc, k.ord, k.id, levenshtein(f.s, k.seq) AS d, CASE WHEN length(f.s) = length(k.seq) THEN hamming(f.s, k.seq) END AS h FROM f, k WHERE levenshtein(f.s, k.seq) <= 4),
    h AS (SELECT seq, rc, ord, id, CASE WHEN d = 0 THEN rc WHEN h <= 2 THEN 2 + rc ELSE 4 END AS stage, d FROM d),
    b AS (SELECT seq, arg_min(id, [stage, CASE WHEN stage = 4 THEN d ELSE 0 END, ord, rc]) AS id FROM h GROUP BY seq)
    SELECT q.seq, coalesce(b.id, '') AS id FROM q LEFT JOIN b USING (seq)""")
def id_map_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.map_staged(table(spark, sf_dir, "queries"), table(spark, sf_dir, "ids"))
