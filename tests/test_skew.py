"""A key holding a third of all rows: every events-based query still equals
its oracle. The fixture is sf0.01 ``events`` with user 0 and content item 0
taking every row whose event_id is a multiple of 3."""

import math
import tempfile

import duckdb
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from tidemark.plans.oracle import ORACLE_SQL
from tidemark.plans.streaming import STREAM_QUERIES

from conftest import SF_ORACLE

SKIP = ("frame_",)


@pytest.fixture(scope="module")
def skewed(spark):
    d = tempfile.mkdtemp(prefix="tidemark-skew-")
    ev = spark.read.parquet(f"{SF_ORACLE}/events.parquet")
    hot = F.col("event_id") % 3 == 0
    (ev.withColumn("user_id", F.when(hot, F.lit(0).cast("bigint")).otherwise(F.col("user_id")))
       .withColumn("props", F.when(hot, F.lit('{"k": 0}')).otherwise(F.col("props")))
       .repartition(8).write.parquet(f"{d}/events.parquet"))  # a folder of part files, in no order of time
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{d}/events.parquet/*.parquet')")
    return d, con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return v


@pytest.mark.parametrize("name", sorted(n for n in {**ORACLE_SQL, **STREAM_QUERIES} if not n.startswith(SKIP)))
def test_hot_key(spark, skewed, name):
    d, con = skewed
    df = queries()[name](spark, d)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=str)
    rel = con.sql(oracle_sql()[name])
    want = sorted((tuple(_norm(r[rel.columns.index(c)]) for c in cols) for r in rel.fetchall()), key=str)
    assert got == want
