"""Window aggregations (A1-A4).

* click/show counts per window and key (user: A1, content item: A3);
* completion rate per window and key as a ratio of sums,
  ``sum(tm) / sum(duration)`` with IEEE division (A2, A4).

Sums are algebraic, so Spark's partial (map-side) aggregation already bounds
what crosses the shuffle: a hot key sends at most one partial row per task
and window. ``exact_scale`` sums watch time and duration exactly at that
decimal scale, independent of row order and partitioning (plain double sums
are not): a value with that many decimals counts as a ``bigint`` number of
units (a decimal sum would widen past 18 digits into slow arbitrary-precision
arithmetic). Every other value (more decimals, NaN, infinities, a billion or
more) goes to a plain double sum beside it, and the two are added at the end,
so nothing is rounded and IEEE rules hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import ActionConfig, WindowSpec
from tidemark.functions.scalars import ieee_divide, one_hot
from tidemark.operators.windows import (
    WINDOW_COL,
    group_key,
    grouped_key,
    min_records_gate,
    pre_aggregate,
    trigger_second,
    with_windows,
)


def to_click_show(actions: DataFrame, cfg: ActionConfig) -> DataFrame:
    """Keep click and show actions (P5) and add one-hot counters."""
    return (actions.filter(F.col("t").isin(cfg.click_value, cfg.show_value))
            .withColumn("clicks", one_hot("t", cfg.click_value))
            .withColumn("shows", one_hot("t", cfg.show_value)))


REST = "__rest"  # suffix of the double sum beside a sum of units
MAX_EXACT = 1e9  # larger values could overflow a bigint of units


def exact_sum(name: str, c, exact_scale: int | None) -> list[Column]:
    """Aggregates ``name`` (and ``name__rest``) that ``exact_value`` reads."""
    col = F.col(c) if isinstance(c, str) else c
    if exact_scale is None:
        return [F.sum(col).alias(name)]
    scale = float(10 ** exact_scale)
    small = F.when(F.abs(col) < MAX_EXACT, col)  # NULL for NaN, which Spark holds largest
    units = F.round(small * scale)
    exact = F.coalesce(units / scale == col, F.lit(False))
    return [F.sum(F.when(exact, units.cast("bigint"))).alias(name),
            F.sum(F.when(~exact, col)).alias(name + REST)]


def exact_sum_again(name: str, exact_scale: int | None) -> list[Column]:
    """Sums of the sums of ``exact_sum``."""
    return [F.sum(n).alias(n) for n in exact_columns(name, exact_scale)]


def exact_columns(name: str, exact_scale: int | None) -> list[str]:
    return [name] if exact_scale is None else [name, name + REST]


def exact_value(name: str, exact_scale: int | None) -> Column:
    """The double value of an ``exact_sum``; NULL when no value was summed."""
    if exact_scale is None:
        return F.col(name).cast("double")
    whole, rest = F.col(name).cast("double") / float(10 ** exact_scale), F.col(name + REST)
    return F.when(rest.isNull(), whole).when(whole.isNull(), rest).otherwise(whole + rest)


def click_show_metrics(click_show: DataFrame, spec: WindowSpec, key: str = "u",
                       ts: str = "ts", pre_aggregate_buckets: bool = False) -> DataFrame:
    """``(t, key, clicks, shows)`` per window trigger ``t`` and key.

    ``pre_aggregate_buckets`` first collapses rows per (key, base bucket)
    (``windows.pre_aggregate``): worth it for long overlapping windows over
    keys with many rows per bucket (content items), one extra shuffle else.
    """
    rows = click_show.select(ts, key, "clicks", "shows")
    if pre_aggregate_buckets:
        rows = pre_aggregate(rows, spec, key, [F.sum(c).alias(c) for c in ("clicks", "shows")], ts)
        count = F.sum("__n")
    else:
        count = F.count(F.lit(1))
    g = (with_windows(rows, spec, ts)
         .groupBy(WINDOW_COL, *group_key(key, rows))
         .agg(F.sum("clicks").alias("clicks"), F.sum("shows").alias("shows"),
              count.alias("__n")))
    return finish_click_show(g, spec, key)


def finish_click_show(g: DataFrame, spec: WindowSpec, key: str) -> DataFrame:
    """Gate, then ``(t, key, clicks, shows)``."""
    g = min_records_gate(g, "__n", spec.min_records)
    return g.select(trigger_second(spec).alias("t"), grouped_key(key), "clicks", "shows")


def completion_metrics(vv: DataFrame, spec: WindowSpec, key: str = "u", ts: str = "ts",
                       exact_scale: int | None = None,
                       pre_aggregate_buckets: bool = False) -> DataFrame:
    """``(t, key, tm, duration, rpt)`` with ``rpt = sum(tm) / sum(duration)``."""
    rows = vv.select(ts, key, "tm", "duration")
    if pre_aggregate_buckets:
        rows = pre_aggregate(rows, spec, key, completion_sums(exact_scale), ts)
        count = F.sum("__n")
        sums = exact_sum_again("tm", exact_scale) + exact_sum_again("duration", exact_scale)
    else:
        count, sums = F.count(F.lit(1)), completion_sums(exact_scale)
    g = (with_windows(rows, spec, ts)
         .groupBy(WINDOW_COL, *group_key(key, rows))
         .agg(*sums, count.alias("__n")))
    return finish_completion(g, spec, key, exact_scale)


def completion_sums(exact_scale: int | None) -> list[Column]:
    return exact_sum("tm", "tm", exact_scale) + exact_sum("duration", "duration", exact_scale)


def finish_completion(g: DataFrame, spec: WindowSpec, key: str, exact_scale: int | None) -> DataFrame:
    """Gate, then ``(t, key, tm, duration, rpt)``."""
    g = min_records_gate(g, "__n", spec.min_records)
    tm, dur = exact_value("tm", exact_scale), exact_value("duration", exact_scale)
    return g.select(trigger_second(spec).alias("t"), grouped_key(key), tm.alias("tm"),
                    dur.alias("duration"), ieee_divide(tm, dur).alias("rpt"))
