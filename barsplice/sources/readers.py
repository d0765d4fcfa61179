"""Readers and writers of sequencing and table formats, all with explicit schemas."""

from __future__ import annotations

import datetime
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from . import fastq

READ_SUFFIXES = fastq.SUFFIXES
REFERENCE_SUFFIXES = (".fa", ".fasta")
BARCODE_HEADER = ("barcode", "variant", "var_id", "count")


def _bytes(size: str) -> int:
    number, unit = re.fullmatch(r"(\d+)([kmgt]?)b?", size.lower()).groups()
    return int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


def read_fastq(spark: SparkSession, paths: Sequence[str], mates: Sequence[str] = (), split_bytes: int | None = None) -> DataFrame:
    """Reads, or read pairs if there are ``mates``, from any file system that Arrow opens.

    Plain files are split (by ``spark.sql.files.maxPartitionBytes`` unless ``split_bytes`` is
    given) and read record by record without a shuffle.  A compressed file is unpacked by one
    task; if there are fewer tasks than cores, its records are then dealt to all.  Pairs are
    zipped by position, which shuffles each side once, and end with the shorter file.  A
    truncated record is an error.  A path given twice is read twice.  Rows have no order.
    """
    size = split_bytes or _bytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    if not mates:
        rows = fastq.scan(spark, paths, size).select("header", "seq", "qual")
        parts, cores = fastq.splits(paths, size), spark.sparkContext.defaultParallelism
        return rows.repartition(cores) if len(parts) < cores and any(p.compressed for p in parts) else rows
    if len(mates) != len(paths):
        raise ValueError("as many mates as paths are needed")
    side = lambda names, i: fastq.numbered(spark, names, size).select("source", "record", *(F.col(c).alias(f"{c[0]}{i}") for c in ("header", "seq", "qual")))
    return side(paths, 1).join(side(mates, 2), ["source", "record"]).select("h1", "s1", "q1", "h2", "s2", "q2")


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """``id, seq``: the id ends at the first white space, lines of a sequence are joined."""
    rows = spark.read.option("lineSep", ">").text(path).where("trim(value) <> ''")
    head = F.substring_index("value", "\n", 1)
    body = F.expr("substring(value, length(substring_index(value, '\n', 1)) + 1)")
    return rows.select(F.regexp_extract(head, r"^\s*(\S+)", 1).alias("id"), F.regexp_replace(body, r"\s", "").alias("seq"))


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """Alignment text without header lines; positions from 0, tags as a map."""
    f = F.split("value", "\t")
    names = [c.split()[0] for c in schema.ALIGNMENTS.split(", ")][:11]
    rows = spark.read.text(path).where(~F.col("value").startswith("@"))
    columns = [f[i].cast("int").alias(n) if n in ("flag", "pos", "mapq", "pnext", "tlen") else f[i].alias(n) for i, n in enumerate(names)]
    tags = F.map_from_entries(F.transform(F.slice(f, F.lit(12), F.greatest(F.size(f) - 11, F.lit(0))), lambda t: F.struct(F.substring(t, 1, 2), F.substring(t, 6, 1 << 20))))
    return rows.select(*columns, tags.alias("tags")).withColumn("pos", F.col("pos") - 1)


def read_tsv(spark: SparkSession, path: str, ddl: str, header: bool = True, sep: str = "\t", comment: str | None = None) -> DataFrame:
    reader = spark.read.option("sep", sep).option("header", header).option("nullValue", "NA")
    return (reader.option("comment", comment) if comment else reader).schema(ddl).csv(path)


def read_bed12(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, schema.BED12, header=False)


def read_exon_positions(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, schema.EXON_POSITIONS, header=False)


def separator(first_line: str) -> str:
    """Tab or comma, whichever a header has more of; an error for a tie."""
    tabs, commas = first_line.count("\t"), first_line.count(",")
    if tabs == commas:
        raise ValueError("neither tab nor comma separates the header")
    return "\t" if tabs > commas else ","


def read_delimited(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """A table whose separator is told from its first line."""
    first = spark.read.text(path).limit(1).collect()
    if not first:
        return spark.createDataFrame([], ddl)
    return read_tsv(spark, path, ddl, sep=separator(first[0][0]))


def read_sample_sheet(spark: SparkSession, path: str) -> DataFrame:
    """The sheet with ``sample_id``; tab separated if named ``.tsv``, else by commas.  Missing columns are an error."""
    sep = "\t" if path.endswith(".tsv") else ","
    rows = spark.read.option("sep", sep).option("header", True).csv(path)
    missing = [c.split()[0] for c in schema.SAMPLE_SHEET.split(", ") if c.split()[0] not in rows.columns]
    if missing:
        raise ValueError(f"sample sheet lacks {', '.join(missing)}")
    return rows.withColumn("sample_id", F.concat_ws("_", "sample", "replicate"))


def check_names(read_path: str, reference_path: str, barcode_header: str) -> list[str]:
    """What is wrong with a sample's files, judged by names and the barcode header."""
    wrong = []
    if not read_path.endswith(READ_SUFFIXES):
        wrong.append(f"{read_path}: not a FASTQ name")
    if not reference_path.endswith(REFERENCE_SUFFIXES):
        wrong.append(f"{reference_path}: not a FASTA name")
    if tuple(re.split(r"[\t,]", barcode_header.strip().lower())[:4]) != BARCODE_HEADER:
        wrong.append("barcode table: unexpected header")
    return wrong


def trim_statistics(lines: DataFrame) -> DataFrame:
    """``(name, value)`` from logs of the trimmer and merger."""
    labels = ("reads passed filter:", "Combined pairs:", "Uncombined pairs:")
    rows = [F.when(F.contains(F.col("value"), F.lit(x)) & (F.lit(x != "Combined pairs:") | ~F.contains(F.col("value"), F.lit("Uncombined"))), F.lit(x.rstrip(":"))) for x in labels]
    named = lines.withColumn("name", F.coalesce(*rows)).where("name is not null")
    return named.select("name", F.regexp_extract("value", r":\s*(\d+)", 1).cast("bigint").alias("value"))


def aligner_statistics(lines: DataFrame) -> DataFrame:
    """Rows ``Mapped`` and ``Total`` from spliced-aligner summaries of single reads or pairs."""
    number = F.regexp_extract("value", r":\s*(\d+)", 1).try_cast("bigint")
    mapped = F.regexp_like(F.col("value"), F.lit(r"Aligned (concordantly )?1 time:"))
    total = F.regexp_like(F.col("value"), F.lit(r"Total (reads|pairs):"))
    named = lines.select(F.when(mapped, "Mapped").when(total, "Total").alias("name"), number.alias("value")).where("name is not null")
    return named.groupBy("name").agg(F.sum("value").alias("value"))


_TOTALS = {
    "Total": r"Total (reads|pairs):",
    "Aligned 0 time": r"Aligned (concordantly or discordantly |concordantly )?0 times?:",
    "Aligned 1 time": r"Aligned (concordantly )?1 time:",
    "Aligned >1 times": r"Aligned (concordantly )?>1 times:",
}


def aligner_totals(lines: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(name, value)`` summed over the summaries of all exons, and the overall rate in whole per cent (null without reads)."""
    name = F.coalesce(*(F.when(F.regexp_like(F.col("value"), F.lit(p)), F.lit(n)) for n, p in _TOTALS.items()))
    named = lines.select(*by, name.alias("name"), F.regexp_extract("value", r":\s*(\d+)", 1).try_cast("bigint").alias("value")).where("name is not null")
    cells = [F.coalesce(F.sum(F.when(F.col("name") == n, F.col("value"))), F.lit(0)).cast("bigint").alias(n) for n in _TOTALS]
    one = named.groupBy(*by).agg(*cells)
    rate = F.expr("CASE WHEN `Total` > 0 THEN (`Aligned 1 time` + `Aligned >1 times`) * 100 div `Total` END")
    return one.withColumn("Overall alignment rate", rate).unpivot(list(by), [*_TOTALS, "Overall alignment rate"], "name", "value")


def read_idxstats(spark: SparkSession, path: str) -> DataFrame:
    """``rname, mapped`` of an index statistics file; the row of reads without a reference is left out."""
    rows = read_tsv(spark, path, "rname string, length bigint, mapped bigint, unmapped bigint", header=False)
    return rows.where("rname <> '*'").select("rname", "mapped")


def missing_files(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Paths that do not exist on the file system they name."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    return [p for p in paths if not path(p).getFileSystem(conf).exists(path(p))]


def run_metadata(spark: SparkSession, sheet: DataFrame, name: str, version: str, command: str, at: datetime.datetime | None = None) -> DataFrame:
    """One row per sample of a run: when, what and by which command, beside the sheet's columns."""
    started = at or datetime.datetime.now(datetime.timezone.utc)
    about = {"pipeline": name, "version": version, "command": command, "started": started.strftime("%Y-%m-%d %H:%M:%S")}
    return sheet.select(*(F.lit(v).alias(c) for c, v in about.items()), *sheet.columns)


def publish(tables: dict[str, DataFrame], folder: str, by: Sequence[str] = ()) -> None:
    """Every table as Parquet under its name, in folders by sample if asked for; a rerun replaces what lies there."""
    for name, df in tables.items():
        df.write.mode("overwrite").partitionBy(*by).parquet(f"{folder.rstrip('/')}/{name}")


def write_sam(spark: SparkSession, alignments: DataFrame, contigs: DataFrame, path: str) -> None:
    """Rewritten alignments as text without order (positions from 1, tags behind), and their header lines in ``<path>.header``."""
    tags = F.transform(F.map_entries("tags"), lambda t: F.concat(t["key"], F.when(t["value"].rlike("^-?\\d+$"), ":i:").otherwise(":Z:"), t["value"]))
    names = [c.split()[0] for c in schema.ALIGNMENTS.split(", ")][:11]
    fields = [(F.col(n) + 1 if n == "pos" else F.coalesce(F.col(n).cast("string"), F.lit("*"))).cast("string") for n in names]
    alignments.select(F.concat_ws("\t", *fields, F.array_join(tags, "\t")).alias("value")).write.mode("overwrite").text(path)
    header = contigs.select(F.concat(F.lit("@SQ\tSN:"), "name", F.lit("\tLN:"), F.col("length").cast("string")).alias("value"))
    header.write.mode("overwrite").text(f"{path.rstrip('/')}.header")


def write_tsv(df: DataFrame, path: str, sort: Sequence[str] = ()) -> None:
    """Tab separated with a header; nulls are NA.  Sorting happens only here."""
    (df.orderBy(*sort) if sort else df).write.mode("overwrite").option("sep", "\t").option("header", True).option("nullValue", "NA").option("emptyValue", "").csv(path)


def write_fastq(reads: DataFrame, path: str) -> None:
    text = F.concat_ws("\n", F.concat(F.lit("@"), "header"), "seq", F.lit("+"), "qual")
    reads.select(text.alias("value")).write.mode("overwrite").option("compression", "gzip").text(path)


def write_by_exon(reads: DataFrame, path: str, fasta: bool = False) -> None:
    """Reads with an ``exon_id`` in a folder of each exon, ``exon_id=<id>``, as compressed FASTQ or FASTA.

    Reads are brought together by exon, and exons of many reads are dealt over several tasks
    and files, so that no task holds a whole one.  Reads without an exon id are left out.
    """
    lines = [F.concat(F.lit(">" if fasta else "@"), "header"), F.col("seq"), *([] if fasta else [F.lit("+"), F.col("qual")])]
    rows = reads.where("exon_id is not null").select("exon_id", F.concat_ws("\n", *lines).alias("value"))
    rows.hint("rebalance", "exon_id").write.mode("overwrite").partitionBy("exon_id").option("compression", "gzip").text(path)
