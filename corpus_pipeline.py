"""The corpus pipeline: toxicity, near-duplicates, secrets, packing.

Each stage works on all documents that its predecessor kept, and its decisions take
effect: toxic documents go, one document of each near-duplicate group stays, secrets are
replaced in the texts, and the rest is packed into training sequences.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barsplice.llm import minhash, packing, secrets, toxicity
from barsplice.llm.common import cut, read, table


def _columns(docs: DataFrame) -> list[Column]:
    """All columns, whatever characters their names hold."""
    return [docs["`" + c.replace("`", "``") + "`"] for c in docs.columns]


def _free(docs: DataFrame, name: str) -> str:
    """A name that no column has."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below 0.5, all columns as they were, whatever their names.

    Every row is judged by its own text: rows with null or repeated ids, null and very long
    texts too.  Texts without words are scored half the toxic share and stay.  An empty
    table stays empty.
    """
    model = toxicity.train(docs, read(spark, sf_dir, "labels"), test_fold=None)
    score = _free(docs, "toxic_score")
    scored = toxicity.score(docs, model, score_col=score).where(F.col(score) < 0.5)
    return scored.drop(score)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group linked at a similarity of 0.8: that of the smallest id, then of the smallest text hash.

    Rows are told apart by id and text, so a row is not lost for another one of its id; of
    rows that repeat both one stays.  Rows without an id or without words all stay.  Other
    columns are kept as they were, whatever their names, nulls included; of rows that differ
    only there the first in JSON order stays.  An empty table stays empty.
    """
    # The whole row is one column from here on, so that no name of the input meets one of the stage.
    rows = docs.select(F.struct(*_columns(docs)).alias("row"))
    key = F.when(F.col("row.doc_id").isNotNull(), F.struct("row.doc_id", F.xxhash64("row.text").alias("text_hash")))
    keyed = rows.select(key.alias("key"), "row")
    groups = minhash.near_duplicates(keyed.select("key", F.col("row.text").alias("text")), "key", percent=80)
    settled = groups.where(F.col("key").isNotNull() & (F.col("n_shingles") > 0)).groupBy("key").agg(F.min("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    settled = cut(settled.where(~F.col("kept") | (F.col("n") > 1)).select("key", "kept"))
    rest = keyed.join(settled, "key", "left_anti").select("row.*")
    repeated = settled.where("kept").select("key")
    if repeated.isEmpty():
        return rest
    once = keyed.join(repeated, "key").groupBy("key").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return rest.unionByName(once.select("row.*"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with secrets replaced by their kind; ``n_chars`` follows the text.

    Rows with null or repeated ids count like any other, null texts stay null.  Other columns
    are kept as they were, whatever their names.
    """
    clean = secrets.redact(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 1024 ids; a null or empty text is its end id alone."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("secret_scan", redact_secrets),
    ("packing", pack),
]

#: A trained classifier and a tokenizer are beyond SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and reread by the next."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = table(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
