"""Domain tables derived from the given star-schema tables, in SQL that Spark and DuckDB both run.

Names in braces are tables.  Sequences come from MD5 digits read as bases, so keys give
the same DNA everywhere.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

UP, DOWN = "GCAGTCCATGAC", "CTACGGTTAGCA"
BEFORE, AFTER = "TTGACCGATC", "GGATCATTCG"
TEMPLATE = "NNNNATNNNNNN"


def dna(prefix: str, key: str) -> str:
    return f"translate(md5(concat('{prefix}', cast({key} as string))), '0123456789abcdef', 'ACGTACGTACGTACGT')"


def rc(expr: str) -> str:
    return f"reverse(translate({expr}, 'ACGTacgt', 'TGCAtgca'))"


def _barcode(key: str, prefix: str = "b") -> str:
    return f"concat(substr({dna(prefix, key)}, 1, 4), 'AT', substr({dna(prefix, key)}, 5, 6))"


PAIR_BEFORE, PAIR_AFTER = f"{BEFORE}AAGGCT", f"{AFTER}CCTAAG"
_BARCODE_OF_ORDER = _barcode("o_custkey % 1500")
_EXON_OF_ORDER = f"substr({dna('x', 'o_custkey % 1500')}, 1, 12)"
_NOISE = dna("n", "o_orderkey")
_OTHER = dna("m", "o_orderkey")
_dna_of_line = dna("n", "l_orderkey"), dna("m", "l_orderkey")
VHH, TARGET = ("GGTTGCATCA", "TAGGATCCTA"), ("ACACGTGTAC", "TGAGCTCATT")

LABELS = ("intron_retention_I1", "intron_retension_5p_I2", "exon_splicing_3p_E1", "exon_splicing_5p_E2", "exon_skipping_E2", "out_of_range", "exon_splicing_3p_E3")
_label = lambda key: f"split_part('{','.join(LABELS)}', ',', cast({key} % {len(LABELS)} + 1 as int))"

TABLES = {
    "counts": """
        SELECT concat('v', cast(l_partkey % 500 as string)) AS var_id, concat('r', cast(l_linenumber % 3 + 1 as string)) AS rep,
               cast(sum(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END) as bigint) AS inclusion,
               cast(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) as bigint) AS skipping,
               cast(sum(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0 END) as bigint) AS others
        FROM {lineitem} GROUP BY 1, 2""",
    "variants": "SELECT concat('v', cast(p_partkey % 400 as string)) AS var_id FROM {part}",
    "canonical": f"""
        SELECT CASE WHEN l_suppkey % 17 = 0 THEN 'NA' ELSE concat('v', cast(l_partkey % 400 as string)) END AS var_id,
               {_barcode('l_partkey % 900')} AS barcode, cast(l_quantity as bigint) AS count,
               CASE l_returnflag WHEN 'A' THEN 'exon_inclusion' ELSE 'exon_skipping' END AS ref_type
        FROM {{lineitem}} WHERE l_returnflag <> 'N'""",
    "labelled": f"""
        SELECT concat('v', cast(l_partkey % 400 as string)) AS chrom, concat('r', cast(l_linenumber % 3 + 1 as string)) AS rep,
               cast(l_orderkey % 9 as int) AS donor, cast(l_suppkey % 7 as int) + 100 AS acceptor,
               CASE WHEN l_suppkey % 3 = 0 THEN concat({_label('l_suppkey')}, ';', {_label('l_suppkey + 2')}) ELSE {_label('l_suppkey')} END AS annotation,
               cast(sum(l_quantity) as bigint) AS coverage
        FROM {{lineitem}} GROUP BY 1, 2, 3, 4, 5""",
    "bed": """
        SELECT chrom, donor - 10 AS start, acceptor + 12 AS "end", concat('J', cast(donor as string), '_', cast(acceptor as string)) AS name, coverage, strand,
               donor - 10 AS thickStart, acceptor + 12 AS thickEnd, '255,0,0' AS itemRgb, 2 AS blockCount, '10,12' AS blockSizes,
               concat('0,', cast(acceptor - donor + 10 as string)) AS blockStarts
        FROM (SELECT concat('c', cast(l_suppkey as string)) AS chrom, CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand,
                     cast(l_orderkey % 410 as int) AS donor, cast(l_partkey % 405 as int) AS acceptor, cast(sum(l_quantity) as bigint) AS coverage
              FROM {lineitem} WHERE l_orderkey % 410 < l_partkey % 405 GROUP BY 1, 2, 3, 4)""",
    "exons": """
        SELECT concat('c', cast(s_suppkey as string)) AS var_id, concat('E', cast(i as string)) AS exon_id,
               CASE i WHEN 1 THEN 1 WHEN 2 THEN 101 ELSE 301 END AS exon_start,
               CASE i WHEN 1 THEN 20 WHEN 2 THEN 150 ELSE 400 END + cast(s_suppkey % 3 as int) AS exon_end
        FROM {supplier} CROSS JOIN (SELECT 1 AS i UNION ALL SELECT 2 UNION ALL SELECT 3) WHERE s_suppkey % 11 <> 0""",
    "barcode_map": f"""
        SELECT {_barcode('p_partkey % 1500')} AS barcode,
               concat(lower(substr({dna('i', 'p_partkey')}, 1, 8)), substr({dna('x', 'p_partkey % 1500')}, 1, 12), lower(substr({dna('j', 'p_partkey')}, 1, 8))) AS variant,
               concat('v', cast(p_partkey as string)) AS var_id, cast(p_size as bigint) AS count, p_partkey AS line
        FROM {{part}}""",
    "plain_reads": f"""
        SELECT l_orderkey AS k, l_linenumber AS n, l_linestatus AS s,
               concat(CASE l_returnflag
                        WHEN 'A' THEN concat('{BEFORE}', substr({dna('x', 'l_partkey % 1500')}, 1, 12), '{AFTER}')
                        WHEN 'R' THEN concat('{BEFORE}', '{AFTER}', substr({dna('f', 'l_orderkey')}, 1, 12))
                        ELSE concat(substr({dna('g', 'l_orderkey')}, 1, 4), CASE WHEN l_suppkey % 2 = 0 THEN '{BEFORE}' ELSE '{AFTER}' END, substr({dna('f', 'l_orderkey')}, 1, 12)) END,
                      '{UP}', CASE WHEN l_linenumber = 5 THEN {_barcode('l_orderkey', 'z')} ELSE {_barcode('l_partkey % 1500')} END, '{DOWN}') AS seq
        FROM {{lineitem}}""",
    "reads": f"""
        SELECT concat('read', cast(k as string)) AS header, CASE WHEN n = 4 THEN {rc('seq')} ELSE seq END AS seq, translate(seq, 'ACGT', 'FFGG') AS qual
        FROM (SELECT k, n, CASE WHEN s = 'F' THEN concat(substr(seq, 1, cast(k % 60 as int)), 'A', substr(seq, cast(k % 60 as int) + 2, 100)) ELSE seq END AS seq FROM {{plain_reads}} p) m""",
    "alignments": """
        SELECT concat('q', cast(l_orderkey as string)) AS qname, cast(CASE l_linenumber WHEN 1 THEN 0 WHEN 2 THEN 16 WHEN 3 THEN 4 WHEN 4 THEN 256 WHEN 5 THEN 2064 WHEN 6 THEN 99 ELSE 147 END as int) AS flag,
               concat('c', cast(l_suppkey as string)) AS rname, cast(l_orderkey % 50 as int) AS pos,
               concat(CASE WHEN l_linenumber % 2 = 0 THEN concat(cast(l_partkey % 9 as string), 'S') ELSE '' END, cast(5 + l_suppkey % 20 as string), 'M',
                      CASE WHEN l_returnflag = 'A' THEN concat(cast(10 + l_partkey % 40 as string), 'N', cast(3 + l_orderkey % 30 as string), 'M') ELSE '' END,
                      CASE WHEN l_returnflag = 'R' THEN '2I7M3D4M6S' ELSE '' END) AS cigar
        FROM {lineitem}""",
    "ids": f"SELECT concat('id', cast(p_partkey as string)) AS id, substr({dna('k', 'p_partkey - CASE WHEN p_partkey % 20 = 0 THEN 3 ELSE 0 END')}, 1, cast(24 + p_partkey % 3 as int)) AS seq, p_partkey AS line FROM {{part}}",
    "queries": f"""
        SELECT CASE o_orderkey % 4 WHEN 0 THEN seq WHEN 1 THEN {rc('seq')}
                    WHEN 2 THEN concat(substr(seq, 1, 6), 'A', substr(seq, 8, 5), 'C', substr(seq, 14, 30)) ELSE concat(substr(seq, 1, 9), substr(seq, 11, 30), 'G') END AS seq
        FROM (SELECT o_orderkey, substr({dna('k', 'o_custkey')}, 1, 25) AS seq FROM {{orders}}) q""",
    "pairs": f"""
        SELECT concat('{BEFORE}', substr({dna('x', 'l_partkey % 60')}, 1, cast(9 + l_partkey % 5 as int)), '{AFTER}', substr({dna('f', 'l_orderkey')}, 1, 6)) AS s1,
               concat(substr({dna('f', 'l_orderkey')}, 1, 5), CASE WHEN l_linenumber = 6 THEN 'ACGTAACGTAAC' ELSE '{UP}' END,
                      CASE WHEN l_linenumber = 5 THEN substr({dna('z', 'l_orderkey')}, 1, 12) ELSE {_barcode('l_partkey % 70')} END, '{DOWN}') AS s2
        FROM {{lineitem}}""",
    # Pairs of orders: events across both reads, a lost base, half of the second reads turned round.
    "plain_pairs": f"""
        SELECT o_orderkey AS k,
               CASE o_orderkey % 5 WHEN 2 THEN concat(substr({_NOISE}, 1, 4), '{PAIR_BEFORE}')
                 WHEN 3 THEN concat(substr({_NOISE}, 1, cast(o_orderkey % 9 as int)), '{PAIR_BEFORE}', substr({_OTHER}, 1, 10))
                 WHEN 4 THEN substr({_OTHER}, 1, 30)
                 ELSE concat(substr({_NOISE}, 1, 4), '{PAIR_BEFORE}', substr({_EXON_OF_ORDER}, 1, 6)) END AS s1,
               concat(CASE o_orderkey % 5 WHEN 2 THEN '{PAIR_AFTER}' WHEN 3 THEN substr({_NOISE}, 9, 12) WHEN 4 THEN substr({_NOISE}, 5, 12) ELSE concat(substr({_EXON_OF_ORDER}, 7, 6), '{PAIR_AFTER}') END,
                      CASE WHEN o_orderkey % 11 = 0 THEN 'ACGTAACGTAAC' ELSE '{UP}' END, {_BARCODE_OF_ORDER}, '{DOWN}') AS s2
        FROM {{orders}}""",
    "read_pairs": f"""
        SELECT k, concat('p', cast(k as string), '/1') AS h1, s1, translate(s1, 'ACGT', 'FFGG') AS q1, concat('p', cast(k as string), '/2') AS h2, s2, translate(s2, 'ACGT', 'FFGG') AS q2
        FROM (SELECT k, CASE WHEN k % 7 = 0 THEN concat(substr(s1, 1, 8), substr(s1, 10, 100)) ELSE s1 END AS s1, CASE WHEN k % 2 = 1 THEN {rc('s2')} ELSE s2 END AS s2 FROM {{plain_pairs}} x) y""",
    # Mates of 50 bases from fragments of 30 to 96, so that short ones run into adapters; bad tails, poor pairs, a lost call, a wrong base.
    "raw_pairs": f"""
        SELECT k, concat('p', cast(k as string), '/1') AS h1, s1, CASE WHEN k % 4 = 0 THEN concat(substr(q1, 1, 38), repeat('#', 12)) ELSE q1 END AS q1,
               concat('p', cast(k as string), '/2') AS h2, s2, CASE WHEN k % 29 = 0 THEN repeat('#', 50) WHEN k % 6 = 1 THEN concat(substr(q2, 1, 45), repeat('#', 5)) ELSE q2 END AS q2
        FROM (SELECT k, s1, translate(s1, 'ACGTN', 'F8:C#') AS q1, s2, translate(s2, 'ACGT', '9GB6') AS q2 FROM (
            SELECT k, CASE WHEN k % 5 = 0 THEN concat(substr(s1, 1, 39), 'N', substr(s1, 41, 10)) WHEN k % 31 = 3 THEN concat(substr(s1, 1, 20), 'NNNNNN', substr(s1, 27, 24)) ELSE s1 END AS s1,
                   CASE WHEN k % 3 = 0 THEN concat(substr(s2, 1, 10), 'A', substr(s2, 12, 39)) ELSE s2 END AS s2
            FROM (SELECT k, substr(concat(f, {dna('a1', 'k % 7')}), 1, 50) AS s1, substr(concat({rc('f')}, {dna('a2', 'k % 7')}), 1, 50) AS s2
                  FROM (SELECT o_orderkey AS k, substr(concat({dna('u', 'o_orderkey')}, {dna('w', 'o_custkey')}, {dna('y', 'o_orderkey')}), 1, cast(30 + o_custkey % 67 as int)) AS f FROM {{orders}}) q) w) v) u""",
    "aligned_mates": """
        SELECT k, qname, flag, rname, pos, cigar, seq FROM (
            SELECT k, concat('p', cast(k as string)) AS qname, 99 AS flag, CASE WHEN k % 3 = 0 THEN 'exon_skipping_x' ELSE 'exon_inclusion_x' END AS rname,
                   cast(k % 13 as int) AS pos, concat('9M', CASE WHEN k % 8 = 0 THEN '' ELSE concat(cast(k % 8 as string), 'S') END) AS cigar, s1 AS seq FROM {read_pairs}
            UNION ALL
            SELECT k, concat('p', cast(k as string)), 147, CASE WHEN k % 17 = 0 THEN 'exon_inclusion_y' WHEN k % 3 = 0 THEN 'exon_skipping_x' ELSE 'exon_inclusion_x' END,
                   cast(8 + k % 19 as int), CASE WHEN k % 4 = 0 THEN '7M22N8M' WHEN k % 4 = 1 THEN '7M12N8M' ELSE concat(cast(k % 7 as string), 'S15M') END, s2 FROM {read_pairs}) m""",
    # Genes of three exons of 64 bases, with introns of 68; reads of whole products, of products and of unspliced genes, some turned, some with another base.
    "genes": f"""
        SELECT concat('g', cast(s_suppkey as string)) AS gene, concat({dna('g1', 's_suppkey')}, {dna('g2', 's_suppkey')}) AS e1, concat({dna('g3', 's_suppkey')}, {dna('g4', 's_suppkey')}) AS e2, concat({dna('g5', 's_suppkey')}, {dna('g6', 's_suppkey')}) AS e3,
               concat('GT', {dna('g7', 's_suppkey')}, {dna('g8', 's_suppkey')}, 'AG') AS i1, concat('GT', {dna('g9', 's_suppkey')}, {dna('g0', 's_suppkey')}, 'AG') AS i2 FROM {{supplier}}""",
    "exon_references": "SELECT gene, concat('exon_inclusion_', gene) AS rname, concat(e1, e2, e3) AS seq FROM {genes} UNION ALL SELECT gene, concat('exon_skipping_', gene), concat(e1, e3) FROM {genes}",
    "minigenes": "SELECT gene, gene AS rname, concat(e1, lower(i1), e2, lower(i2), e3) AS seq FROM {genes}",
    "plain_exon_reads": f"""
        SELECT k, n, gene, kind, place, truth, CASE WHEN n = 2 THEN concat(substr(truth, 1, cast(20 + k % 10 as int)), 'A', substr(truth, cast(22 + k % 10 as int), 50)) ELSE truth END AS seq FROM (
            SELECT l_orderkey AS k, l_linenumber AS n, gene, kind, place, CASE kind WHEN 'random' THEN substr(concat({_dna_of_line[0]}, {_dna_of_line[1]}), 1, 50) WHEN 'inclusion' THEN substr(concat(e1, e2, e3), place + 1, 50) ELSE substr(concat(e1, e3), place + 1, 50) END AS truth
            FROM (SELECT *, cast(CASE WHEN l_partkey % 3 > 0 THEN l_orderkey % 143 WHEN l_orderkey % 2 = 0 THEN l_partkey % 15 ELSE 22 + l_partkey % 35 END as int) AS place, CASE WHEN l_linenumber = 7 THEN 'random' WHEN l_partkey % 3 > 0 THEN 'inclusion' ELSE 'skipping' END AS kind
                  FROM {{lineitem}} JOIN {{genes}} ON gene = concat('g', cast(l_suppkey as string))) a) b""",
    "exon_reads": f"SELECT gene, header, CASE WHEN n % 2 = 0 THEN {rc('seq')} ELSE seq END AS seq, translate(seq, 'ACGT', 'FFGG') AS qual FROM (SELECT gene, n, concat('r', cast(k as string), '_', cast(n as string)) AS header, seq FROM {{plain_exon_reads}}) q",
    "plain_gene_reads": """
        SELECT k, n, gene, kind, place, CASE kind WHEN 'skipping' THEN substr(concat(e1, e3), place + 1, 60) WHEN 'first' THEN substr(concat(e1, e2), place + 1, 60) WHEN 'second' THEN substr(concat(e2, e3), place + 1, 60) ELSE substr(concat(e1, i1, e2, i2, e3), place + 1, 60) END AS seq
        FROM (SELECT *, l_orderkey AS k, l_linenumber AS n, CASE l_partkey % 4 WHEN 0 THEN 'skipping' WHEN 1 THEN 'first' WHEN 2 THEN 'second' ELSE 'whole' END AS kind, cast(CASE WHEN l_partkey % 4 = 3 THEN l_orderkey % 269 ELSE 16 + l_orderkey % 33 END as int) AS place
              FROM {lineitem} JOIN {genes} ON gene = concat('g', cast(l_suppkey as string))) a""",
    "gene_reads": f"SELECT gene, header, CASE WHEN n % 2 = 0 THEN {rc('seq')} ELSE seq END AS seq, translate(seq, 'ACGT', 'FFGG') AS qual FROM (SELECT gene, n, concat('r', cast(k as string), '_', cast(n as string)) AS header, seq FROM {{plain_gene_reads}}) q",
    # Mates of 50 bases at both ends of products of 128 or 192 bases.
    "exon_pairs": f"""
        SELECT gene, concat('p', cast(k as string), '/1') AS h1, substr(f, 1, 50) AS s1, repeat('F', 50) AS q1, concat('p', cast(k as string), '/2') AS h2, substr({rc('f')}, 1, 50) AS s2, repeat('G', 50) AS q2
        FROM (SELECT gene, o_orderkey AS k, substr(CASE WHEN o_orderkey % 3 = 0 THEN concat(e1, e3) ELSE concat(e1, e2, e3) END, cast(30 + o_orderkey % 4 as int), 94) AS f
              FROM {{orders}} JOIN {{supplier}} ON s_suppkey = o_custkey % 10 + 1 JOIN {{genes}} ON gene = concat('g', cast(s_suppkey as string))) q""",
    "aligned_exons": "SELECT * FROM (VALUES ('x', 'E1', 1, 15), ('x', 'E2', 101, 112), ('x', 'E3', 201, 260), ('y', 'E1', 1, 15), ('y', 'E2', 101, 112), ('y', 'E3', 201, 260)) AS t(var_id, exon_id, exon_start, exon_end)",
    # Some reads hold a downstream flank before their barcode.
    "spliced_reads": f"""
        SELECT concat(CASE cast(substr(header, 5, 20) as bigint) % 9 WHEN 0 THEN '{DOWN}' WHEN 1 THEN concat(substr(seq, 1, 5), '{DOWN}') WHEN 2 THEN concat(substr(seq, 1, 15), '{DOWN}') ELSE '' END, seq) AS seq,
               CASE cast(substr(header, 5, 20) as bigint) % 4 WHEN 0 THEN '20M30N10M' WHEN 1 THEN '20M20N10M' WHEN 2 THEN '20M19N10M' ELSE '50M' END AS cigar, 'ref' AS rname FROM {{reads}}""",
    "long_reads": f"""
        SELECT k, CASE WHEN k % 2 = 1 THEN {rc('seq')} ELSE seq END AS seq FROM (
            SELECT o_orderkey AS k, concat(substr({_NOISE}, 1, 5), CASE WHEN o_orderkey % 13 = 0 THEN 'AAAACCCCAAAA' ELSE '{UP}' END,
                   CASE WHEN o_orderkey % 10 = 3 THEN substr({_NOISE}, 7, 12) ELSE {_barcode('o_custkey % 40')} END, '{DOWN}',
                   CASE WHEN o_orderkey % 17 = 0 THEN 'AAAACCCCAA' ELSE '{VHH[0]}' END, substr({dna('v', 'o_custkey % 20')}, 1, cast(10 + o_custkey % 3 as int)), '{VHH[1]}',
                   substr({_OTHER}, 1, 6), '{TARGET[0]}', substr({dna('t', 'o_custkey % 25')}, 1, cast(8 + o_custkey % 2 as int)),
                   CASE WHEN o_orderkey % 19 = 0 THEN 'AAAACCCCAA' ELSE '{TARGET[1]}' END) AS seq FROM {{orders}}) q""",
    "tagged": "SELECT *, CASE pos % 4 WHEN 0 THEN '10' WHEN 1 THEN '2' ELSE '1' END AS nh FROM {alignments}",
    "logs": """
        SELECT concat('s', cast(s_nationkey as string)) AS run, s_suppkey AS k, v.i AS i,
               CASE v.i WHEN 0 THEN concat('reads passed filter: ', cast(s_suppkey * 10 as string)) WHEN 1 THEN concat('[FLASH]   Combined pairs:   ', cast(s_suppkey * 3 as string))
                 WHEN 2 THEN concat('[FLASH]   Uncombined pairs: ', cast(s_suppkey * 2 as string)) WHEN 3 THEN concat('    Total ', CASE WHEN s_suppkey % 2 = 0 THEN 'reads' ELSE 'pairs' END, ': ', cast(s_suppkey * 5 as string))
                 WHEN 4 THEN concat('        Aligned 0 time: ', cast(s_suppkey as string), ' (20.00%)')
                 WHEN 5 THEN concat('        Aligned ', CASE WHEN s_suppkey % 2 = 0 THEN '' ELSE 'concordantly ' END, '1 time: ', cast(s_suppkey * 3 as string), ' (60.00%)')
                 WHEN 6 THEN concat('        Aligned ', CASE WHEN s_suppkey % 2 = 0 THEN '' ELSE 'concordantly ' END, '>1 times: ', cast(s_suppkey as string), ' (20.00%)')
                 ELSE '    Overall alignment rate: 80.00%' END AS value
        FROM {supplier} CROSS JOIN (SELECT 0 AS i UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4 UNION ALL SELECT 5 UNION ALL SELECT 6 UNION ALL SELECT 7) v""",
    # Four samples of three replicates and one of two, each with its own flanks and template.
    "sheet": f"""
        SELECT concat(s, '_', r) AS sample_id, s AS sample, r AS replicate, concat('{UP}', substr({dna('su', 's')}, 1, 4)) AS barcode_up, concat('{DOWN}', substr({dna('sd', 's')}, 1, 4)) AS barcode_down,
               CASE WHEN s = 'n1' THEN 'NNNNATNNNNNN' ELSE 'NNNNNNNNNNNN' END AS barcode_temp
        FROM (SELECT concat('n', cast(n_nationkey % 5 as string)) AS s, CASE WHEN n_nationkey % 15 = 4 THEN 'r1' ELSE concat('r', cast(n_nationkey % 3 + 1 as string)) END AS r FROM {{nation}} GROUP BY 1, 2) x""",
    "sample_references": f"SELECT sample_id, concat('{BEFORE}', substr({dna('se', 'sample')}, 1, 3), 'NNNNaacc', 'ACGTTGCA', 'ggtt', '{AFTER}') AS seq FROM {{sheet}}",
    "sample_barcodes": f"""
        SELECT sample_id, {_barcode("concat(sample, cast(p_partkey % 300 as string))")} AS barcode, concat('aa', substr({dna('x', 'p_partkey % 300')}, 1, 12), 'cc') AS variant,
               concat('v', cast(p_partkey % 300 as string)) AS var_id, cast(1 as bigint) AS count, p_partkey AS line FROM {{sheet}} CROSS JOIN {{part}}""",
    "sample_reads": f"""
        SELECT sample_id, concat('o', cast(o_orderkey as string)) AS header, seq, translate(seq, 'ACGT', 'FFGG') AS qual FROM (
            SELECT sample_id, o_orderkey, concat('{BEFORE}', substr({dna('se', 'sample')}, 1, 3), CASE WHEN o_orderkey % 5 < 3 THEN substr({dna('x', 'o_custkey % 310')}, 1, 12) WHEN o_orderkey % 5 = 3 THEN '' ELSE 'TTTTTTTTTTTTTTTTTT' END, '{AFTER}',
                   barcode_up, {_barcode("concat(sample, cast(o_custkey % 310 as string))")}, barcode_down) AS seq
            FROM {{sheet}} JOIN {{orders}} ON cast(substr(sample, 2, 1) as int) = o_orderkey % 5 AND cast(substr(replicate, 2, 1) as int) = o_custkey % 3 + 1) q""",
    "sample_bed": """
        SELECT sample_id, chrom, donor - 10 AS start, acceptor + 12 AS "end", concat('J', cast(donor as string), '_', cast(acceptor as string)) AS name, coverage, strand, '10,12' AS blockSizes,
               concat('0,', cast(acceptor - donor + 10 as string)) AS blockStarts
        FROM (SELECT sample_id, concat('v', cast(l_partkey % 300 as string)) AS chrom, '+' AS strand, cast(l_orderkey % 60 as int) AS donor, cast(60 + l_suppkey % 90 as int) AS acceptor, cast(sum(l_quantity) as bigint) AS coverage
              FROM {sheet} JOIN {lineitem} ON cast(substr(sample, 2, 1) as int) = l_orderkey % 5 AND cast(substr(replicate, 2, 1) as int) = l_linenumber % 3 + 1 GROUP BY 1, 2, 3, 4, 5)""",
    "sample_exons": """
        SELECT sample_id, concat('v', cast(v as string)) AS var_id, concat('E', cast(i as string)) AS exon_id, CASE i WHEN 1 THEN 1 WHEN 2 THEN 61 ELSE 121 END AS exon_start, CASE i WHEN 1 THEN 20 WHEN 2 THEN 80 ELSE 149 END + v % 3 AS exon_end
        FROM {sheet} CROSS JOIN (SELECT DISTINCT cast(p_partkey % 300 as int) AS v FROM {part}) p CROSS JOIN (SELECT 1 AS i UNION ALL SELECT 2 UNION ALL SELECT 3) e""",
}


def sql(name: str, quote: str = '"') -> str:
    """The table's SQL with names of derived tables filled in; base tables keep their braces."""
    text = re.sub(r"\{(\w+)\}", lambda m: f"({sql(m[1], quote)})" if m[1] in TABLES else m[0], TABLES[name])
    return text.replace('"', quote)


#: Tables whose rows go through the sequence kernel.
READS = ("reads", "pairs", "spliced_reads", "read_pairs", "long_reads", "aligned_mates", "sample_reads", "raw_pairs", "exon_reads", "gene_reads", "exon_pairs")


def spread(scan: DataFrame) -> DataFrame:
    """A scan of few unsplittable parts is dealt to all cores before the kernel or a sink; a scan of many parts stays as it is."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = sql(name, "`")
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in set(re.findall(r"\{(\w+)\}", text))}
    if name in READS:
        used = {t: spread(scan) for t, scan in used.items()}
    return spark.sql(text, **used)


def oracle(text: str) -> str:
    """Oracle SQL: every name in braces becomes the derived table's SQL in parentheses."""
    text = re.sub(r"\{(\w+)\}", lambda m: f"({sql(m[1])})" if m[1] in TABLES else m[0], text)
    return re.sub(r"\{(\w+)\}", r"\1", text)
