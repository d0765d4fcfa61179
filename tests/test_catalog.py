"""Every catalogue query against its DuckDB oracle on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from barsplice.jobs import catalog, catalog_aligning, catalog_fragments, catalog_reads, catalog_runs  # noqa: F401

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def key(row):
    return tuple("" if v is None else f"{v:.6g}" if isinstance(v, float) and not math.isnan(v) else str(v) for v in row)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables here")
@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_oracle(spark, duck, name):
    got = catalog.QUERIES[name](spark, FOLDER)
    columns = sorted(got.columns)
    want = duck.sql(catalog.ORACLE_SQL[name])
    assert sorted(want.columns) == columns
    rows = want.project(", ".join(f'"{c}"' for c in columns)).fetchall()
    assert sorted(map(key, got.select(*(f"`{c}`" for c in columns)).collect())) == sorted(map(key, rows))


def test_entry_points():
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
