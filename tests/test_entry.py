"""Every catalogue query against its SQL twin, and that it finds something to say."""

from __future__ import annotations

import math

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from postlode import catalogue
from postlode.operators import similarity

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
#: Too few rows at the smallest scale for these to find any.
MAY_BE_EMPTY = {"salaries", "secret_scan", "series_recurring_error", "series_zero_return", "series_stale", "dedup_cascade", "dedup_mirrors", "series_drop", "series_regression", "sweet_spot", "company_cap_hidden"}


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "null"
    return f"{v:.6f}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query(spark, db, name):
    found = entry.queries()[name](spark, SF)
    columns = sorted(found.columns)
    rows = sorted(tuple(plain(r[c]) for c in columns) for r in found.collect())
    assert rows or name in MAY_BE_EMPTY
    if name in catalogue.ORACLES:
        twin = db.sql(catalogue.ORACLES[name])
        assert sorted(twin.columns) == columns
        at = [twin.columns.index(c) for c in columns]
        assert rows == sorted(tuple(plain(r[i]) for i in at) for r in twin.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_distinctive_topics_are_in_no_document(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(similarity.words(F.col("text")))
    known = {w for r in docs.collect() for w in r[0]}
    found = {r.w for r in entry.queries()["distinctive_topics"](spark, SF).collect()}
    assert found and not found & known
