"""Every registered query against its DuckDB SQL on the sf0.001 tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from feedloom.plans.oracle import ORACLE_SQL
from feedloom.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(records, cols):
    return sorted((tuple(_norm(r[c]) for c in cols) for r in records), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_sql():
    assert set(ORACLE_SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = [r.asDict() for r in df.collect()]
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    want = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    assert _rows(got, cols) == _rows(want, cols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "good_review_ratio" in df.columns
