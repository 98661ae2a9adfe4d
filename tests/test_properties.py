"""Property tests of the skew-safe per-key operators against brute force."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators.keyed import running_totals, time_block
from tidemark.operators.windows import rolling_sums

EPOCH = dt.datetime(1970, 1, 1)

rows_strategy = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 50),
                                   st.integers(-5, 5)), min_size=1, max_size=25)


@settings(max_examples=6, deadline=None)
@given(rows=rows_strategy, block=st.integers(1, 20))
def test_running_totals_blocked(spark, rows, block):
    data = [(i, k, s, v) for i, (k, s, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "id long, k string, s long, v long")
    out = running_totals(df, "k", ["s", "id"], time_block(df, "s", block), {"run": F.col("v")})
    got = {r["id"]: r["run"] for r in out.collect()}
    for i, k, s, v in data:
        want = sum(v2 for i2, k2, s2, v2 in data if k2 == k and (s2, i2) <= (s, i))
        assert got[i] == want


@settings(max_examples=6, deadline=None)
@given(rows=rows_strategy, length=st.integers(0, 60))
def test_rolling_blocked(spark, rows, length):
    data = [(i, k, EPOCH + dt.timedelta(seconds=s), v) for i, (k, s, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "id long, k string, ts timestamp_ntz, v long")
    got = {r["id"]: (r["rolling_v"], r["rolling_n"])
           for r in rolling_sums(df, "k", ["v"], length).collect()}
    for i, (k, s, v) in enumerate(rows):
        live = [v2 for k2, s2, v2 in rows if k2 == k and s - length <= s2 <= s]
        assert got[i] == (sum(live), len(live))


@settings(max_examples=6, deadline=None)
@given(rows=rows_strategy, length=st.integers(1, 60))
def test_live_intervals(spark, rows, length):
    from tidemark.operators.windows import live_intervals

    data = [(k, EPOCH + dt.timedelta(seconds=s), v) for k, s, v in rows]
    df = spark.createDataFrame(data, "k string, ts timestamp_ntz, v long")
    got = {}
    for r in live_intervals(df, "k", ["v"], length).collect():
        for t in range(r["t_from"], r["t_to"]):
            got[r["k"], t] = (r["v"], r["n"])
    want = {}
    for t in range(0, 60 + length):
        for key in {k for k, _, _ in rows}:
            live = [v for k, s, v in rows if k == key and t - length <= s < t]
            if live:
                want[key, t] = (sum(live), len(live))
    assert got == want


@settings(max_examples=6, deadline=None)
@given(rows=rows_strategy, m=st.integers(2, 3), length=st.integers(2, 12), step=st.integers(1, 6),
       mode=st.sampled_from(["inclusive", "half_open"]))
def test_gate_vs_bruteforce(spark, rows, m, length, step, mode):
    from tidemark.config import WindowSpec
    from tidemark.operators.metrics import click_show_metrics

    data = [(EPOCH + dt.timedelta(seconds=s), k, 1, 0) for k, s, _ in rows]
    df = spark.createDataFrame(data, "ts timestamp_ntz, u string, clicks long, shows long")
    got = {(r["t"], r["u"]): r["clicks"]
           for r in click_show_metrics(df, WindowSpec(length, step, mode, m)).collect()}
    want = {}
    for t in range(0, 50 + length + step + 1, step):
        live = [k for k, s, _ in rows
                if (t - length <= s <= t if mode == "inclusive" else t - length <= s < t)]
        if len(live) >= m:
            for k in set(live):
                want[(t, k)] = live.count(k)
    assert got == want


@settings(max_examples=6, deadline=None)
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 5),
                               st.one_of(st.none(), st.integers(-9, 9))), min_size=1, max_size=15))
def test_sequence_summary_vs_bruteforce(spark, rows):
    from tidemark.operators.sequences import sequence_summary

    data = [(k, EPOCH + dt.timedelta(seconds=s), i, v) for i, (k, s, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k string, ts timestamp_ntz, i long, v long")
    got = {r["k"]: r for r in sequence_summary(df, "k", "v", ["ts", "i"]).collect()}
    for k in {r[0] for r in rows}:
        seq = [v for (_, _, _, v) in sorted((d for d in data if d[0] == k), key=lambda d: (d[1], d[2]))]
        valid = [j for j, v in enumerate(seq) if v is not None]
        g = got[k]
        assert (g["length"], g["head"], g["tail"], g["tail_idx"]) == (len(seq), seq[0], seq[-1], len(seq) - 1)
        if valid:
            assert (g["valid_head"], g["valid_head_idx"], g["valid_tail"], g["valid_tail_idx"],
                    g["valid_length"]) == (seq[valid[0]], valid[0], seq[valid[-1]], valid[-1],
                                           valid[-1] - valid[0] + 1)
        else:
            assert (g["valid_head"], g["valid_head_idx"], g["valid_tail_idx"], g["valid_length"]) == \
                (None, -1, -1, 0)


def test_sequence_summary_single_order_column(spark):
    from tidemark.operators.sequences import sequence_summary

    df = spark.createDataFrame([("k", 3, None), ("k", 1, None), ("k", 2, 7), ("k", 5, 9), ("k", 4, None)],
                               "k string, i long, v long")
    g = sequence_summary(df, "k", "v", ["i"]).collect()[0]
    assert (g["head"], g["valid_head"], g["valid_head_idx"], g["valid_tail"], g["valid_tail_idx"],
            g["valid_length"], g["length"]) == (None, 7, 1, 9, 4, 4, 5)
    plan = sequence_summary(df, "k", "v", ["i"])._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
