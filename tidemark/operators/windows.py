"""Time windows over arrival seconds.

A record stamped at whole second ``sec`` is live at trigger ``T`` when

* ``half_open``: ``T - length <= ts < T``  (Spark's own ``window``), or
* ``inclusive``: ``T - length <= sec <= T`` (a timeout queue with whole-second
  stamps that evicts strictly older records; length + 1 distinct seconds).

Triggers are the multiples of ``step`` since the epoch and a window ends at
its trigger. In batch a window is identified by its trigger second ``T``, a
``bigint`` column ``w``: tumbling windows are a projection, overlapping
windows an ``explode`` of each row's own trigger range (which also covers
steps longer than the window). Streams group by ``window(ts, span, step,
offset)`` (watermarks need it) and turn its struct into ``T`` per micro-batch
(``struct_to_trigger``), so everything after the aggregation is shared.
Either way the copies are made inside the map stage and only per-task partial
aggregates cross a shuffle. Inclusive windows need no truncation of ``ts``:
every boundary is a whole second.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    NumericType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

from tidemark.config import WindowSpec
from tidemark.functions.scalars import epoch_seconds

WINDOW_COL = "w"


def _offset(spec: WindowSpec) -> int:
    # Windows end at triggers T (multiples of step) and start at T - length,
    # so starts are aligned to -length modulo step in both modes.
    return (-spec.length) % spec.slide


def stream_windows(df: DataFrame, spec: WindowSpec, ts: str = "ts") -> DataFrame:
    """Add column ``w``, the ``window()`` struct of each window a row is in.

    Steps longer than the window take tumbling windows as long as the step
    and keep the rows of the last ``span`` seconds of each.
    """
    spec.check_fanout()
    if spec.slide <= spec.span:
        if spec.slide == spec.span and _offset(spec) == 0:
            return df.withColumn(WINDOW_COL, F.window(ts, f"{spec.span} seconds"))
        return df.withColumn(WINDOW_COL, F.window(ts, f"{spec.span} seconds", f"{spec.slide} seconds",
                                                  f"{_offset(spec)} seconds"))
    length = f"{spec.slide} seconds"
    end_offset = "1 seconds" if spec.mode == "inclusive" else "0 seconds"
    return (df.withColumn(WINDOW_COL, F.window(ts, length, length, end_offset))
            .filter(F.col(ts) >= F.col(f"{WINDOW_COL}.end") - F.expr(f"INTERVAL {spec.span} SECONDS")))


def with_windows(df: DataFrame, spec: WindowSpec, ts: str = "ts") -> DataFrame:
    """Add column ``w``: the trigger second ``T`` of each window the row is in.

    A row appears once per window it belongs to; rows in no window (or with
    no timestamp) drop out. Overlapping windows explode exactly the row's own
    trigger range, so no post-filter differs between two branches reading
    the same windowed aggregate and Spark reuses its shuffle.
    """
    spec.check_fanout()
    sec = epoch_seconds(df, ts)
    s = spec.slide
    if spec.is_tumbling:
        trig = (F.floor(sec / F.lit(s)).cast("bigint") + 1) * s
        return df.filter(F.col(ts).isNotNull()).withColumn(WINDOW_COL, trig)
    # half-open: T in [sec + 1, sec + length]; inclusive: T in [sec, sec + length]
    first = sec + 1 if spec.mode == "half_open" else sec
    lo = F.ceil(first / F.lit(s)).cast("bigint") * s
    hi = F.floor((sec + spec.length) / F.lit(s)).cast("bigint") * s
    # an empty range still yields [lo], removed by the filter below
    trig = F.explode(F.sequence(lo, F.greatest(hi, lo), F.lit(s).cast("bigint")))
    return df.select("*", trig.alias(WINDOW_COL)).filter(F.col(WINDOW_COL) <= hi)


def struct_to_trigger(df: DataFrame, spec: WindowSpec, w: str = WINDOW_COL) -> DataFrame:
    """Replace a ``window()`` struct column by its trigger second ``T``."""
    end = F.unix_timestamp(F.col(f"{w}.end"))
    return df.withColumn(w, end - 1 if spec.mode == "inclusive" else end)


def _as_timestamp(df: DataFrame, ts: str, seconds: Column) -> Column:
    """Epoch seconds as a timestamp of the same type as column ``ts``."""
    if isinstance(df.schema[ts].dataType, TimestampNTZType):
        return F.timestamp_add("SECOND", seconds, F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))
    return F.timestamp_seconds(seconds)


def base_bucket(spec: WindowSpec) -> int:
    """Largest bucket (seconds) such that every window is a union of buckets:
    gcd(length, step) for half-open windows, 1 s for inclusive ones (their
    length + 1 seconds end on a trigger)."""
    if spec.mode == "inclusive":
        return 1
    return math.gcd(spec.length, spec.slide)


def pre_aggregate(df: DataFrame, spec: WindowSpec, key: str, sums: list[Column],
                  ts: str = "ts") -> DataFrame:
    """Collapse rows to one per (key, base bucket) before windowing.

    Returns ``(ts, key, *sums, __n)`` with ``ts`` the bucket start (same type
    as the input); window assignment then copies bucket rows, not raw rows.
    Exact because all seconds of a bucket fall in the same windows.
    """
    g = base_bucket(spec)
    sec = epoch_seconds(df, ts)
    b = F.floor(sec / F.lit(g)).cast("bigint") * g
    agg = df.groupBy(key, b.alias("__bs")).agg(*sums, F.count(F.lit(1)).alias("__n"))
    return agg.withColumn(ts, _as_timestamp(df, ts, F.col("__bs"))).drop("__bs")


# A grouping key as two never-null columns, so that joins on it are plain
# equalities and keep the partitioning of the aggregate.
GROUP_COLS = ("__k", "__knull")


def _stand_in(kind: DataType) -> Column | None:
    """Some value of a key's type, for NULL keys."""
    if isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
        return F.lit("1970-01-01").cast(kind)
    values = {StringType: "", BooleanType: False, NumericType: 0}
    return next((F.lit(v).cast(kind) for k, v in values.items() if isinstance(kind, k)), None)


def group_key(key: str, df: DataFrame) -> list[Column]:
    """``key`` of ``df`` as the grouping columns ``GROUP_COLS`` (a NULL key is a group). Its type is kept, unless
    it is nested or binary: then its text."""
    stand_in = _stand_in(df.schema[key].dataType)
    held = F.col(key).cast("string") if stand_in is None else F.col(key)
    return [F.coalesce(held, F.lit("") if stand_in is None else stand_in).alias(GROUP_COLS[0]),
            F.col(key).isNull().alias(GROUP_COLS[1])]


def grouped_key(key: str) -> Column:
    """The key back from ``GROUP_COLS``."""
    return F.when(~F.col(GROUP_COLS[1]), F.col(GROUP_COLS[0])).alias(key)


def trigger_second(spec: WindowSpec, w: str = WINDOW_COL) -> Column:
    """Trigger ``T`` (epoch seconds) of the window column ``w``."""
    return F.col(w)


def min_records_gate(agg: DataFrame, count_col: str, min_records: int,
                     w: str = WINDOW_COL) -> DataFrame:
    """Drop every row of a window whose total ``count_col`` is below ``min_records``.

    ``agg`` holds one row per window and ``GROUP_COLS``. The per-window totals
    are a partial aggregate. For the common gate of two records a failing
    window holds exactly one row, so the failing rows are anti-joined by plain
    equality on the window and ``GROUP_COLS``, the very partitioning ``agg``
    already has: ``agg`` is exchanged once, broadcast or not, and no task
    gathers a whole window. Other gates anti-join the (small) set of failing
    windows, which shuffles ``agg`` by window unless AQE broadcasts that set.
    """
    if min_records <= 1:
        return agg
    # Windows are never NULL; saying so on both branches keeps their plans
    # identical after constraint inference (so the shuffle is reused).
    agg = agg.filter(F.col(w).isNotNull())
    # Every column of ``agg`` is referenced (``__same``) so column pruning leaves
    # both branches with the same aggregate and the shuffle below is reused.
    others = [c for c in agg.columns if c not in (w, count_col, *GROUP_COLS)]
    totals = agg.groupBy(w).agg(
        F.sum(count_col).alias("__total"), *[F.min(c).alias(f"__f{c}") for c in GROUP_COLS],
        F.max(F.hash(*[F.col(c) for c in others] or [F.lit(0)])).alias("__same"))
    failing = totals.filter(F.col("__total") < min_records).withColumnRenamed(w, "__w")
    # A failing window's rows all have count < min_records. Stating that in the
    # join condition keeps the anti-join above the aggregate, so raw rows are
    # never shuffled for it and map-side combining stays in place. The test of
    # ``__same`` is always true (a hash is an int) and keeps it alive.
    cond = ((agg[w] == failing["__w"]) & (F.col(count_col) < min_records)
            & (failing["__same"] >= F.lit(-(2 ** 31))))
    if min_records == 2:
        for c in GROUP_COLS:
            cond = cond & (agg[c] == failing[f"__f{c}"])
    return agg.join(failing, cond, "left_anti")


def live_set_at(df: DataFrame, trigger, length: int, ts: str = "ts",
                mode: str = "inclusive") -> DataFrame:
    """Records live at trigger second ``trigger`` (T2): a plain range filter.

    ``trigger`` may be an int or a Column (e.g. a scalar subquery).
    """
    t = trigger if isinstance(trigger, Column) else F.lit(int(trigger))
    # whole-second bounds on ts itself (sec >= b iff ts >= b), so that they reach the scan
    stamp = lambda seconds: _as_timestamp(df, ts, seconds)
    return df.filter((F.col(ts) >= stamp(t - length))
                     & (F.col(ts) < stamp(t + 1 if mode == "inclusive" else t)))


def window_snapshot(df: DataFrame, spec: WindowSpec, ts: str = "ts") -> DataFrame:
    """Un-aggregated content of every window (T8): each row once per window,
    with its trigger second ``t``."""
    out = with_windows(df, spec, ts)
    return out.withColumn("t", trigger_second(spec)).drop(WINDOW_COL)


def _live_totals(df: DataFrame, key: str, values: list[str], enter: int, leave: int, ts: str) -> DataFrame:
    """Per key and second at which its live set changes: ``(*GROUP_COLS, __blk, sec,
    own, __live__<value>..., __live__n)``, the sums after the change.

    A value enters ``enter`` and leaves ``leave`` seconds after its own second.
    Time is cut into blocks as long as a value stays, so what enters in one
    block leaves in the next: what a block begins with is what leaves in it, and a
    running sum inside the block does the rest. A task holds one block of a key, at most one
    row per second and kind of change whatever the key's rows, and the cost does not grow with
    the window. ``own``: some row is stamped ``sec - enter``. Sums of whole
    numbers are exact; doubles would carry the rounding of a running difference.
    """
    held, stay = [f"__{v}" for v in values] + ["__n"], leave - enter
    rows = df.filter(F.col(ts).isNotNull()).select(
        *group_key(key, df), epoch_seconds(df, ts).alias("sec"),
        *[F.coalesce(F.col(v), F.lit(0)).alias(f"__{v}") for v in values])
    per_second = rows.groupBy(*GROUP_COLS, "sec").agg(
        *[F.sum(f"__{v}").alias(f"__{v}") for v in values], F.count(F.lit(1)).alias("__n"))
    at = F.col("sec") + enter
    block = F.floor(at / stay).cast("bigint")
    change = F.explode(F.array(
        F.struct(block.alias("__blk"), at.alias("sec"), F.lit(True).alias("own"), *[F.col(c).alias(c) for c in held]),
        F.struct((block + 1).alias("__blk"), (at + stay).alias("sec"), F.lit(False).alias("own"),
                 *[(-F.col(c)).alias(c) for c in held])))
    changes = (per_second.select(*GROUP_COLS, change.alias("c")).select(*GROUP_COLS, "c.*")
               .repartition(*GROUP_COLS, "__blk")  # serves the sums per second and the windows
               .groupBy(*GROUP_COLS, "__blk", "sec")
               .agg(F.max("own").alias("own"), *[F.sum(c).alias(c) for c in held],
                    *[F.sum(F.when(~F.col("own"), F.col(c))).alias(f"__gone{c}") for c in held]))
    whole = Window.partitionBy(*GROUP_COLS, "__blk")
    running = whole.orderBy("sec").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return changes.select(*GROUP_COLS, "__blk", "sec", "own", *[
        (F.sum(c).over(running) - F.coalesce(F.sum(f"__gone{c}").over(whole), F.lit(0))).alias(f"__live{c}") for c in held])


def rolling_sums(df: DataFrame, key: str, values: list[str], length: int, ts: str = "ts") -> DataFrame:
    """Per-record live-set sums (T9): for every row, the sums of ``values`` over
    the same key's rows with ``sec - length <= sec' <= sec`` (ties included);
    rows find the live sums of their second by (key, second)."""
    live = _live_totals(df, key, values, 0, length + 1, ts).filter("own").select(
        *[F.col(c).alias(f"__r{c}") for c in GROUP_COLS], F.col("sec").alias("__sec"),
        *[F.col(f"__live__{v}").alias(f"rolling_{v}") for v in values],
        F.col("__live__n").alias("rolling_n"))
    out = df.withColumn("sec", epoch_seconds(df, ts)).withColumns(dict(zip(GROUP_COLS, group_key(key, df))))
    return (out.join(live, [F.col(c) == F.col(f"__r{c}") for c in GROUP_COLS] + [F.col("sec") == F.col("__sec")])
            .drop(*GROUP_COLS, *[f"__r{c}" for c in GROUP_COLS], "__sec"))


def live_intervals(df: DataFrame, key: str, values: list[str], length: int, ts: str = "ts") -> DataFrame:
    """Half-open windows of ``length`` seconds at every whole second, as the
    intervals of triggers ``[t_from, t_to)`` between two changes of a key's
    live set: ``(key, t_from, t_to, *values, n)``. A long window at a step of one second
    costs two changes per row and second instead of ``length`` copies."""
    live = _live_totals(df, key, values, 1, length + 1, ts)
    blocks = live.groupBy(*GROUP_COLS, "__blk").agg(F.min("sec").alias("first"))
    following = blocks.withColumn("next_first", F.lead("first").over(
        Window.partitionBy(*GROUP_COLS).orderBy("__blk"))).drop("first")  # the few blocks of a key
    inside = Window.partitionBy(*GROUP_COLS, "__blk").orderBy("sec")
    out = (live.withColumn("__next", F.lead("sec").over(inside))
           .join(following, [*GROUP_COLS, "__blk"]).filter(F.col("__live__n") > 0))
    return out.select(grouped_key(key), F.col("sec").alias("t_from"),
                      F.coalesce("__next", "next_first").alias("t_to"),
                      *[F.col(f"__live__{v}").alias(v) for v in values], F.col("__live__n").alias("n"))
