"""Keyed operations: the blocked scan against one pass, for operations that do not commute either."""

import random
from dataclasses import dataclass

import pytest
from pyspark.sql import functions as F

from tidemark.config import WindowSpec
from tidemark.operators import keyed
from tidemark.operators.operations import Accumulate, FirstWrite, KeepMost, KeyedOperation, ValueOps


@dataclass
class LastTwo(KeyedOperation):
    """The last two values: associative, but order matters."""

    def fields(self):
        return {"last": "bigint", "before": "bigint"}

    def lift(self, order):
        return {"last": F.col("clicks"), "before": F.lit(None)}

    def merge(self, a, b, ops):
        return {"last": ops.if_absent(b["last"], a["last"], b["last"]),
                "before": ops.if_absent(b["last"], a["before"], ops.if_absent(b["before"], a["last"], b["before"]))}

    def returned(self, before):
        return {"last": before("last"), "before": before("before")}


OPS = [FirstWrite(), Accumulate(WindowSpec(300)), KeepMost(), LastTwo()]


@pytest.fixture(scope="module")
def results(spark):
    rnd = random.Random(2)
    rows = [(300 * t, rnd.choice(["hot", "hot", "hot", "a", "b", None]), rnd.randint(0, 50), 1)
            for t in rnd.sample(range(4000), 900)]
    rows += [(300 * 10**6, "hot", 7, 2), (-900, "hot", 3, 4)]
    return rows, spark.createDataFrame(rows, "t long, u string, clicks long, shows long").repartition(5)


def one_pass(rows, op):
    """State before each row, by ``merge`` on plain values."""
    names, stored, out = list(op.fields()), {}, {}
    for t, u, clicks, shows in sorted(rows, key=lambda r: r[0]):
        lift = {"at": t, "clicks": clicks, "shows": shows, "most": clicks, "last": clicks, "before": None}
        before = stored.get(u, dict.fromkeys(names))
        out[t, u] = tuple(before[n] for n in names)
        stored[u] = op.merge(before, {n: lift[n] for n in names}, ValueOps)
    return out


@pytest.mark.parametrize("op", OPS, ids=lambda o: type(o).__name__)
@pytest.mark.parametrize("at_once, block", [(1024, 300 * 64), (64, 900), (3, 300 * 10**7)])
def test_blocked_scan(results, monkeypatch, op, at_once, block):
    rows, df = results
    monkeypatch.setattr(keyed, "BLOCKS_AT_ONCE", at_once)
    op.block_seconds = block
    got = keyed.keyed_scan(df, op, "u", "t").collect()
    assert len(got) == len(rows)
    assert {(r["t"], r["u"]): tuple(r["__before"]) for r in got} == one_pass(rows, op)


def test_merged_results_equal_the_hand_written_merges(results):
    rows, df = results
    for op, want in ((FirstWrite(), keyed.first_write_merge(df)),
                     (Accumulate(WindowSpec(300)), keyed.accumulate_merge(df, spec=WindowSpec(300)))):
        got = keyed.keyed_merge(df, op).select(*want.columns)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_no_task_holds_a_whole_key(results):
    """The plan has no window function, and its groups are blocks of a key."""
    _, df = results
    plan = keyed.keyed_merge(df, KeepMost())._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "__blk" in plan
