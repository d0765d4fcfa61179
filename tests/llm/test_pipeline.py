"""The pipeline against its stages' brute-force decisions."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from barsplice.llm import toxicity

DDL = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def folder(spark, tmp_path):
    rows = [(i, f"plain text number {i} about topic {i * 7} and nothing else {i * 13} at all {i}", "en", "s", 1) for i in range(40)]
    rows += [(100, rows[4][1], "en", "s", 1), (101, 'the password = "Abc123def456ghi" is here', "en", None, None), (102, None, None, None, None), (103, "", "en", "s", 0), (None, "no id", "en", "s", 5)]
    rows += [(200 + i, f"you idiot number {i} scum idiot {i}", "en", "s", 9) for i in range(30)]
    spark.createDataFrame(rows, DDL).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, int(i >= 200)) for i in [*range(40), *range(200, 230)]]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path), rows


def test_stages(spark, folder):
    path, rows = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    out = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, out, path)
        assert out.columns == docs.columns, name
    kept = {r.doc_id: r.text for r in out.collect()}
    assert set(kept) == {*range(40), 101, 102, 103, None}
    assert kept[101] == 'the [ASSIGN]" is here' and kept[102] is None
    pieces = corpus_pipeline.run(spark, path)
    assert {r.doc_id for r in pieces.collect()} == set(kept)
    assert pieces.agg(F.sum("length")).first()[0] == pieces.where("start = 0").agg(F.sum("doc_tokens")).first()[0]


def test_stages_on_empty_tables(spark, tmp_path):
    spark.createDataFrame([], DDL).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert toxicity.constant(0.0).prior == 0.0


def test_near_duplicates_stage_by_rows(spark):
    """Links from 0.8 on, and one row of each group whatever ids repeat."""
    base = [f"w{i}" for i in range(200)]

    def edited(*places):
        return " ".join(f"e{i}" if i in places else w for i, w in enumerate(base))

    def similarity(a, b):
        a, b = ({tuple(x.split()[k : k + 5]) for k in range(len(x.split()) - 4)} for x in (a, b))
        return len(a & b) / len(a | b)

    near, far = edited(20, 60, 100, 140), edited(20, 50, 80, 110, 140)
    assert 0.8 <= similarity(edited(), near) < 0.85 and similarity(edited(), far) < 0.8
    alone = "a clean row of its own under an id that repeats"
    twice = "the same words twice under one id without another copy"
    rows = [(1, edited(), "en", "s", 1), (2, near, "en", "s", 1), (3, far, "de", "s", 1), (4, edited(), "en", "s", 1), (4, alone, "en", "s", 1)]
    rows += [(5, twice, "en", "s", 1), (5, twice, "en", "s", 1), (5, twice, "de", None, 1), (6, "", "en", "s", 1), (6, "", "en", "s", 1), (None, twice, "en", "s", 1), (None, twice, "en", "s", 1)]
    docs = spark.createDataFrame(rows, DDL).repartition(3)
    got = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert got.columns == docs.columns
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=key) == [(1, edited()), (3, far), (4, alone), (5, twice), (6, ""), (6, ""), (None, twice), (None, twice)]


def test_stages_keep_columns_of_any_name(spark, folder):
    """Names that stages use, names with a dot, and a text of a million words."""
    path, _ = folder
    extra = ["kept", "__row", "row", "key", "__toxic", "toxic_score", "n", "spans", "c0", "__blob", "__text", "a.b", "component_id", "n_shingles"]
    base = spark.read.parquet(f"{path}/documents.parquet").where("doc_id < 30 or doc_id in (100, 101)")
    long_text = " ".join(f"w{i % 9973}v{i // 9973}" for i in range(1_000_000)) + ' password = "Abc123def456ghi"'
    base = base.unionByName(spark.createDataFrame([(500, long_text, "en", "s", None)], DDL))
    docs = base.select("*", *(F.concat(F.lit(f"{c} "), "doc_id").alias(c) for c in extra))
    docs = docs.unionByName(docs.where("doc_id = 7"))  # a repeated row
    out = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, out, path)
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema], name
    rows = {r[0]: r for r in out.collect()}
    assert sorted(rows) == [*range(30), 101, 500] and out.count() == len(rows)
    assert all(r[5 + i] == f"{c} {k}" for k, r in rows.items() for i, c in enumerate(extra))
    assert rows[500][1] == long_text[: long_text.rindex("password")] + '[ASSIGN]"' and rows[500][4] == len(rows[500][1])
    assert {r.doc_id for r in corpus_pipeline.pack(spark, out, path).select("doc_id").distinct().collect()} == set(rows)
