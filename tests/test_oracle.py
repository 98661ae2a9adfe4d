"""Every registered query against its DuckDB oracle on sf0.001."""

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tidemark.plans.catalog import QUERIES
from tidemark.plans.streaming import STREAM_QUERIES
from tidemark.sources.tables import TABLES

from conftest import SF_SMALL


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN"}


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v)
    return v


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["t", "u", "clicks", "shows"]
    assert df.count() == 25


def test_every_query_has_an_oracle():
    assert (set(QUERIES) | set(STREAM_QUERIES)) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted([*QUERIES, *STREAM_QUERIES]))
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = _sorted([tuple(_norm(r[c]) for c in cols) for r in df.collect()])
    rel = con.sql(oracle_sql()[name])
    assert sorted(rel.columns) == cols
    duck = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    for f in df.schema.fields:
        assert SPARK_TO_DUCK.get(f.dataType.simpleString()) == duck[f.name], (f.name, f.dataType)
    idx = [rel.columns.index(c) for c in cols]
    want = _sorted([tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()])
    assert got == want
