"""Explicit schemas of the domain tables (Spark DDL) and fixed names."""

SAMPLE_SHEET = (
    "sample string, replicate string, directory string, read1 string, read2 string, reference string, "
    "barcode string, barcode_up string, barcode_down string, barcode_temp string"
)
BARCODE_MAP = "barcode string, variant string, var_id string, count bigint"
REFERENCE = "id string, seq string"
READS = "header string, seq string, qual string"
READ_PAIRS = "h1 string, s1 string, q1 string, h2 string, s2 string, q2 string"
EXON_POSITIONS = "var_id string, exon_id string, exon_start int, exon_end int"
ALIGNMENTS = (
    "qname string, flag int, rname string, pos int, mapq int, cigar string, rnext string, pnext int, tlen int, "
    "seq string, qual string, tags map<string,string>"
)
BED12 = (
    "chrom string, start int, end int, name string, coverage bigint, strand string, thickStart int, thickEnd int, "
    "itemRgb string, blockCount int, blockSizes string, blockStarts string"
)
CANONICAL_BARCODES = "read_ref string, var_id string, barcode string, count bigint, ref_type string"
NOVEL_BARCODES = "read_ref string, var_id string, barcode string, count bigint"
ID_LIST = "id string, seq string"

# Column names of the published event table, spellings included.
EVENTS = (
    "intron_retention_I1",
    "intron_retention_I2",
    "intron_retension_5p_I1",
    "intron_retension_5p_I2",
    "intron_retension_3p_I1",
    "intron_retension_3p_I2",
    "exon_splicing_3p_E1",
    "exon_splicing_3p_E2",
    "exon_splicing_3p_E3",
    "exon_splicing_5p_E1",
    "exon_splicing_5p_E2",
    "exon_splicing_5p_E3",
    "exon_skipping_E2",
)
REF_TYPES = {"canonical_inclusion": "exon_inclusion", "canonical_skipping": "exon_skipping"}
