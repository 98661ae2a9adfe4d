"""Ordered answers inside the live set and bounded intake with expiry, against brute force."""

import datetime as dt
import random

import pytest

from tidemark.operators.sequences import live_intake, rolling_sequence

START = dt.datetime(2024, 1, 1)


def rows_of(seed, n, span, keys=("hot", "hot", "hot", "a", None)):
    rnd = random.Random(seed)
    return [(rnd.choice(keys), START + dt.timedelta(seconds=rnd.randint(0, span)), i, None if rnd.random() < 0.4 else rnd.randint(0, 99))
            for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, ts timestamp_ntz, i long, v long").repartition(4)


def sec(t):
    return int((t - dt.datetime(1970, 1, 1)).total_seconds())


@pytest.mark.parametrize("seed, n, span, length", [(1, 250, 4000, 300), (2, 250, 200, 50), (3, 100, 10, 0), (4, 150, 5000, 4999)])
def test_rolling_sequence(spark, seed, n, span, length):
    rows = rows_of(seed, n, span)
    want = {}
    for k, t, i, _ in rows:
        live = sorted((r for r in rows if r[0] == k and sec(t) - length <= sec(r[1]) <= sec(t)), key=lambda r: (r[1], r[2]))
        valid = [p for p, r in enumerate(live) if r[3] is not None]
        want[i] = (sec(t), len(live), live[0][3], live[-1][3], live[valid[0]][3] if valid else None,
                   live[valid[-1]][3] if valid else None, valid[-1] - valid[0] + 1 if valid else 0,
                   min((r[3] for r in live if r[3] is not None), default=None), sec(live[0][1]))
    got = rolling_sequence(frame(spark, rows), "k", "v", ["ts", "i"], length, "ts").collect()
    cols = ["sec", "length", "head", "tail", "valid_head", "valid_tail", "valid_length", "lowest", "oldest_sec"]
    assert len(got) == n and {r["i"]: tuple(r[c] for c in cols) for r in got} == want


def admitted(rows, capacity, length):
    live, out = {}, {}
    for k, t, i, _ in sorted(rows, key=lambda r: (r[1], r[2])):
        held = [s for s in live.get(k, []) if s + length >= sec(t)]
        ok = len(held) < capacity
        live[k] = held + [sec(t)] * ok
        out[i] = (ok, len(live[k]))
    return out


@pytest.mark.parametrize("capacity, length, block", [(1, 30, 100), (3, 100, 100), (2, 400, 60), (5, 50, 10**6), (4, 3000, 200)])
def test_live_intake(spark, capacity, length, block):
    """A hot key over many blocks, windows longer than a block included."""
    rows = rows_of(capacity, 300, 3000)
    got = live_intake(frame(spark, rows), "k", ["ts", "i"], capacity, length, "ts", block, block_rows=1 + capacity * 3).collect()
    assert {r["i"]: (r["accepted"], r["size"]) for r in got} == admitted(rows, capacity, length) and len(got) == len(rows)


def test_live_intake_edges(spark):
    assert live_intake(frame(spark, []), "k", ["ts", "i"], 2, 10, "ts").collect() == []
    with pytest.raises(ValueError):
        live_intake(frame(spark, []), "k", ["ts"], 0, 10, "ts")
    ties = [("k", START, i, None) for i in range(6)]
    got = live_intake(frame(spark, ties), "k", ["ts", "i"], 2, 0, "ts").collect()
    assert sorted((r["i"], r["accepted"]) for r in got) == [(i, i < 2) for i in range(6)]
