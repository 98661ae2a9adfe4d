"""Expiry and windows (T2-T9): FIXTURES.md section 3."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.config import WindowSpec
from tidemark.operators.metrics import click_show_metrics
from tidemark.operators.windows import live_set_at, rolling_sums, window_snapshot

EPOCH = dt.datetime(1970, 1, 1)


def _items(spark, secs, users=None):
    users = users or ["a"] * len(secs)
    rows = [(i, EPOCH + dt.timedelta(seconds=s), users[i], 1, 0) for i, s in enumerate(secs)]
    return spark.createDataFrame(rows, "id long, ts timestamp_ntz, u string, clicks long, shows long")


def _snap(df, spec):
    out = {}
    for r in window_snapshot(df.select("id", "ts"), spec).collect():
        out.setdefault(r["t"], set()).add(r["id"])
    return out


def test_inclusive_live_sets(spark):
    df = _items(spark, [0, 4, 5, 10])
    snap = _snap(df, WindowSpec(5, 5, mode="inclusive"))
    assert snap[0] == {0}
    assert snap[5] == {0, 1, 2}
    assert snap[10] == {2, 3}
    assert live_set_at(df, 16, 5).count() == 0


def test_half_open_live_sets(spark):
    df = _items(spark, [0, 4, 5, 10])
    snap = _snap(df, WindowSpec(5, 5, mode="half_open"))
    assert snap[5] == {0, 1}
    assert snap[10] == {2}
    assert snap[15] == {3}


def test_gate_two_records(spark):
    df = _items(spark, [0, 4, 5, 10])
    closed = click_show_metrics(df, WindowSpec(5, 5, "inclusive", min_records=2))
    assert sorted(r["t"] for r in closed.collect()) == [5, 10]
    half = click_show_metrics(df, WindowSpec(5, 5, "half_open", min_records=2))
    assert [r["t"] for r in half.collect()] == [5]


def test_live_set_half_open(spark):
    df = _items(spark, [0, 4, 5, 10])
    assert sorted(r["id"] for r in live_set_at(df, 5, 5, mode="half_open").collect()) == [0, 1]
    assert sorted(r["id"] for r in live_set_at(df, 10, 5, mode="half_open").collect()) == [2]


def test_library_demo(spark):
    df = _items(spark, [0, 0])
    assert live_set_at(df, 5, 10).count() == 2
    assert live_set_at(df, 14, 10).count() == 0


def test_gap_windows(spark):
    # step longer than the window: each row falls in at most one window
    df = _items(spark, [0, 4, 5, 10, 12, 19])
    snap = _snap(df, WindowSpec(3, 10, mode="inclusive"))
    assert snap == {0: {0}, 10: {3}, 20: {5}}
    half = _snap(df, WindowSpec(3, 10, mode="half_open"))
    assert half == {20: {5}}


def test_fanout_guard(spark):
    import pytest
    df = _items(spark, [0])
    with pytest.raises(ValueError):
        window_snapshot(df, WindowSpec(4 * 3600 + 1, 1))
    window_snapshot(df, WindowSpec(4 * 3600, 1))
    window_snapshot(df, WindowSpec(8 * 3600, 1, max_fanout=30000))


def test_rolling_matches_bruteforce(spark):
    secs = [0, 1, 1, 3, 7, 8, 15, 16, 30, 31]
    users = ["a", "b", "a", "a", "b", "a", "a", "b", "a", "a"]
    df = _items(spark, secs, users)
    for length in (5, 2, 1, 0, 40):
        got = {r["id"]: (r["rolling_clicks"], r["rolling_n"])
               for r in rolling_sums(df, "u", ["clicks"], length).collect()}
        for i, (s, u) in enumerate(zip(secs, users)):
            n = sum(1 for s2, u2 in zip(secs, users) if u2 == u and s - length <= s2 <= s)
            assert got[i] == (n, n), (length, i)


def test_group_keys_keep_their_type(spark):
    """NULL is a key of its own, beside the value that stands in for it."""
    import datetime as dt

    from pyspark.sql import functions as F

    from tidemark.operators.windows import group_key, grouped_key

    day = dt.date(1970, 1, 1)
    rows = [(0, "", 0.0, False, day), (None, None, None, None, None), (5, "x", 1.5, True, dt.date(2024, 1, 2))] * 2
    df = spark.createDataFrame(rows, "a int, b string, c double, d boolean, e date")
    for c in df.columns:
        out = df.groupBy(*group_key(c, df)).agg(F.count("*").alias("n")).select(grouped_key(c), "n")
        assert out.schema[c].dataType == df.schema[c].dataType
        assert sorted(map(tuple, out.collect()), key=repr) == sorted({(getattr(r, c), 2) for r in df.collect()}, key=repr)


@settings(max_examples=8, deadline=None)
@given(length=st.integers(1, 12), step=st.integers(1, 9), mode=st.sampled_from(["inclusive", "half_open"]),
       secs=st.lists(st.integers(0, 60), min_size=1, max_size=12))
def test_windows_match_predicate(spark, length, step, mode, secs):
    df = _items(spark, secs)
    got = set()
    for t, ids in _snap(df, WindowSpec(length, step, mode=mode)).items():
        got |= {(t, i) for i in ids}
    want = set()
    for i, s in enumerate(secs):
        for t in range(0, 60 + length + step + 1, step):
            live = (t - length <= s <= t) if mode == "inclusive" else (t - length <= s < t)
            if live:
                want.add((t, i))
    assert got == want


def test_tumbling_partitions_rows(spark):
    df = _items(spark, [0, 3, 7, 9, 14, 29, 30])
    snap = _snap(df, WindowSpec(10))
    ids = [i for v in snap.values() for i in v]
    assert sorted(ids) == list(range(7))


def test_gate_three_records(spark):
    df = _items(spark, [0, 4, 5, 10], users=["a", "b", "a", "b"])
    got = click_show_metrics(df, WindowSpec(5, 5, "inclusive", min_records=3)).collect()
    assert sorted((r["t"], r["u"], r["clicks"]) for r in got) == [(5, "a", 2), (5, "b", 1)]


def test_profile_gate_three_records(spark):
    from tidemark.operators.profiles import user_profile
    cs = _items(spark, [0, 1, 2, 7], users=["a", "b", "a", "a"])
    vv = spark.createDataFrame([(EPOCH + dt.timedelta(seconds=s), u, 1.0, 2.0)
                                for s, u in [(1, "a"), (8, "a"), (9, "b"), (9, "a")]],
                               "ts timestamp_ntz, u string, tm double, duration double")
    prof = {(r["t"], r["u"]): (r["rt_u_click"], r["rt_u_rpt"])
            for r in user_profile(cs, vv, WindowSpec(5, min_records=3)).collect()}
    # window 5: three actions pass, one view fails; window 10: one action fails, three views pass
    assert prof == {(5, "a"): (2, None), (5, "b"): (1, None), (10, "a"): (None, 0.5),
                    (10, "b"): (None, 0.5)}
