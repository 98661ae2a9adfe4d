"""Reduce (A1, A2), profiles (A5, A6, P10) and keyed merges (K1, K2):
FIXTURES.md sections 4 and 5."""

import datetime as dt
import math
import re

import pytest

from tidemark.config import WindowSpec
from tidemark.operators.keyed import accumulate_merge, first_write_merge
from tidemark.operators.metrics import click_show_metrics, completion_metrics
from tidemark.operators.profiles import feed_profile, read_profile, user_profile

T0 = dt.datetime(2024, 1, 1)


def _ts(s):
    return T0 + dt.timedelta(seconds=s)


def test_click_show_reduce(spark):
    rows = [(_ts(1), "a", 1, 0), (_ts(2), "a", 0, 1), (_ts(3), "b", 0, 1), (_ts(4), "a", 1, 0)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, u string, clicks long, shows long")
    got = {r["u"]: (r["clicks"], r["shows"]) for r in click_show_metrics(df, WindowSpec(60)).collect()}
    assert got == {"a": (2, 1), "b": (0, 1)}


def test_completion_is_ratio_of_sums(spark):
    rows = [(_ts(1), "a", 5.0, 10.0), (_ts(2), "a", 30.0, 30.0), (_ts(3), "b", 1.0, 0.0)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, u string, tm double, duration double")
    got = {r["u"]: r for r in completion_metrics(df, WindowSpec(60), exact_scale=2).collect()}
    assert (got["a"]["tm"], got["a"]["duration"], got["a"]["rpt"]) == (35.0, 40.0, 0.875)
    assert got["b"]["rpt"] == math.inf


def test_user_profile_gates_kinds_separately(spark):
    cs = spark.createDataFrame([(_ts(1), "a", 1, 0), (_ts(2), "b", 0, 1)],
                               "ts timestamp_ntz, u string, clicks long, shows long")
    vv = spark.createDataFrame([(_ts(3), "a", 5.0, 10.0)],
                               "ts timestamp_ntz, u string, tm double, duration double")
    prof = {r["u"]: r for r in user_profile(cs, vv, WindowSpec(60, min_records=2)).collect()}
    # the single video-view record is gated away; the two actions pass
    assert (prof["a"]["rt_u_click"], prof["a"]["rt_u_reveal"], prof["a"]["rt_u_rpt"]) == (1, 0, None)
    assert prof["b"]["rt_u_reveal"] == 1
    read = {r["u"]: r for r in read_profile(user_profile(cs, vv, WindowSpec(60, min_records=2))).collect()}
    assert read["a"]["rt_u_rpt"] == 0.0


def test_feed_profile_lengths(spark):
    # trigger at 14400 s after midnight; rows 100 s, 3000 s and 10000 s before it
    end = 14400
    cs = spark.createDataFrame([(_ts(end - 100), "c", 1, 0), (_ts(end - 3000), "c", 0, 1),
                                (_ts(end - 10000), "c", 1, 0)],
                               "ts timestamp_ntz, contid string, clicks long, shows long")
    vv = spark.createDataFrame([(_ts(end - 100), "c", 1.0, 2.0), (_ts(end - 10000), "c", 3.0, 2.0)],
                               "ts timestamp_ntz, contid string, tm double, duration double")
    r = feed_profile(cs, vv, (300, 7200, 14400), exact_scale=2).collect()[0]
    assert (r["rt_f_click"], r["rt_f_reveal"], r["rt_f_rpt"]) == (1, 0, 0.5)
    assert (r["rt_f_2h_click"], r["rt_f_2h_reveal"], r["rt_f_2h_rpt"]) == (1, 1, 0.5)
    assert (r["rt_f_4h_click"], r["rt_f_4h_reveal"], r["rt_f_4h_rpt"]) == (2, 1, 1.0)


def _results(spark):
    return spark.createDataFrame([(300, "a", 2, 1), (600, "a", 3, 0), (900, "a", 1, 1)],
                                 "t long, u string, clicks long, shows long")


def test_first_write(spark):
    out = first_write_merge(_results(spark), key_template="USER_CLICK_SHOW_5MIN_%s").orderBy("t").collect()
    assert [(r["rt_u_click"], r["rt_u_reveal"]) for r in out] == [(2, 1), (5, 1), (3, 2)]
    assert {(r["stored_click"], r["stored_reveal"]) for r in out} == {(2, 1)}
    assert out[0]["store_key"] == "USER_CLICK_SHOW_5MIN_a"


def test_accumulate(spark):
    out = accumulate_merge(_results(spark), spec=WindowSpec(300), block_seconds=600).orderBy("t").collect()
    assert [(r["rt_u_click"], r["rt_u_reveal"]) for r in out] == [(2, 1), (5, 1), (6, 2)]


def test_accumulate_refuses_overlapping_windows(spark):
    with pytest.raises(ValueError):
        accumulate_merge(_results(spark), spec=WindowSpec(300, 60))


def test_accumulate_needs_the_geometry(spark):
    with pytest.raises(TypeError):
        accumulate_merge(_results(spark))


def test_exact_sum_keeps_ieee_values(spark):
    from pyspark.sql import functions as F
    from tidemark.operators.metrics import exact_sum, exact_value

    inf, nan = float("inf"), float("nan")
    cases = {"a": ([1.0, nan], nan), "b": ([1.0, inf], inf), "c": ([inf, -inf], nan), "d": ([0.1] * 10, 1.0),
             "e": ([1e300, 1.0], 1e300), "f": ([2.125, 2.125], 4.25), "g": ([None, None], None), "h": ([None, 0.01], 0.01)}
    df = spark.createDataFrame([(k, v) for k, (vs, _) in cases.items() for v in vs], "k string, v double")
    out = df.groupBy("k").agg(*exact_sum("v", "v", 2)).select("k", exact_value("v", 2).alias("s"))
    for r in out.collect():
        want = cases[r["k"]][1]
        assert r["s"] == want or (want != want and r["s"] != r["s"]), r


@pytest.mark.parametrize("name", ["user_click_show_tumbling", "user_completion_sliding", "user_profile"])
def test_gate_exchanges_the_aggregate_once(spark, name):
    """Without broadcasts the gate's join keeps the aggregate's partitioning."""
    from tidemark.plans.catalog import QUERIES

    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        df = QUERIES[name](spark, "/root/testdata/sf0.001")
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        for k in keys:
            spark.conf.unset(k)
    by_group = [line for line in plan.splitlines()
                if re.search(r"Exchange hashpartitioning\(w#\w+, [^,]+, [^,]+, \d+\)", line)]
    # the aggregate's own exchange (its reuse does not count), and none between it and the joins
    assert sum("Reused" not in line for line in by_group) == 1, plan
    assert "coalesce" not in "".join(line for line in plan.splitlines() if "Exchange" in line), plan


def test_serialize_profile(spark):
    from tidemark.streaming.sinks import read_serialized, serialize_profile
    df = spark.createDataFrame([("a", 2, None)], "u string, rt_u_click long, rt_u_reveal long")
    js = serialize_profile(df, "u", ["rt_u_click", "rt_u_reveal"], fmt="json").collect()[0]
    assert js["value"] == '{"rt_u_click":2}'
    st = serialize_profile(df, "u", ["rt_u_click", "rt_u_reveal"]).collect()[0]
    assert st["value"]["rt_u_click"] == 2 and st["value"]["rt_u_reveal"] is None
    for fmt in ("json", "struct"):
        back = read_serialized(serialize_profile(df, "u", ["rt_u_click", "rt_u_reveal"], fmt), "u",
                               "rt_u_click long, rt_u_reveal long")
        assert [tuple(r) for r in back.collect()] == [("a", 2, None)]


@pytest.mark.parametrize("spec", [WindowSpec(900, 300, min_records=2), WindowSpec(300, 60, "inclusive", 2),
                                  WindowSpec(600, 400, min_records=2), WindowSpec(300, 900, "inclusive", 2)])
def test_bucket_pre_aggregation_is_exact(spark, spec):
    from tidemark.plans.catalog import click_show_records, vv

    sf = "/root/testdata/sf0.001"
    cs = click_show_records(spark, sf)
    for key in ("u", "contid"):
        a = {tuple(r) for r in click_show_metrics(cs, spec, key=key).collect()}
        b = {tuple(r) for r in click_show_metrics(cs, spec, key=key, pre_aggregate_buckets=True).collect()}
        assert a == b and a
    v = vv(spark, sf)
    a = {tuple(r) for r in completion_metrics(v, spec, exact_scale=2).collect()}
    b = {tuple(r) for r in completion_metrics(v, spec, exact_scale=2, pre_aggregate_buckets=True).collect()}
    assert {x for x in a if x[4] == x[4]} == {x for x in b if x[4] == x[4]}
