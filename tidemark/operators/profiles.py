"""Profile rows (A5, A6) and the reader-side defaults (P10).

* user profile: click, reveal (show) and completion rate of a user per
  window; the two message kinds are gated separately, as their queues are.
  Built from one tagged union and one aggregation on (window, user) instead
  of a full outer join of two aggregates.
* feed profile: per content item at every trigger of the longest length,
  the click, reveal and completion figures of several trailing lengths side
  by side (5 min, 2 h, 4 h by default), in one pass over tumbling windows of
  the longest length with conditional sums by age.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.config import FEED_LENGTHS_SECONDS, WindowSpec
from tidemark.functions.scalars import epoch_seconds, ieee_divide
from tidemark.operators.metrics import exact_columns, exact_sum, exact_value
from tidemark.operators.route import ACT, KIND_COL, VV, tag_union
from tidemark.operators.windows import (
    GROUP_COLS,
    WINDOW_COL,
    group_key,
    grouped_key,
    pre_aggregate,
    trigger_second,
    with_windows,
)

USER_PROFILE_COLUMNS = ("rt_u_click", "rt_u_reveal", "rt_u_rpt")


def kind_gate_flags(g: DataFrame, counts: dict[str, str], min_records: int,
                    w: str = WINDOW_COL) -> DataFrame:
    """Add ``__pass_<name>`` per count column: does the window's total of that
    count reach ``min_records``? (see ``windows.min_records_gate``).

    One per-window totals aggregate serves every kind; it references all
    columns of ``g`` so the shuffle below ``g`` is reused rather than
    recomputed. With the two-record gate a failing kind has a single record
    in its window, hence one row, and each kind is one left join by plain
    equality on the window and ``GROUP_COLS``: the partitioning ``g`` has.
    """
    if min_records <= 1:
        for name in counts:
            g = g.withColumn(f"__pass_{name}", F.lit(True))
        return g
    g = g.filter(F.col(w).isNotNull())  # see windows.min_records_gate
    others = [c for c in g.columns if c not in (w, *GROUP_COLS)]
    aggs = [F.max(F.hash(*[F.col(c) for c in others])).alias("__same")]
    for name, c in counts.items():
        aggs.append(F.sum(c).alias(f"__tot_{name}"))
        aggs += [F.min(F.when(F.col(c) > 0, F.col(k))).alias(f"__f{k}_{name}") for k in GROUP_COLS]
    totals = g.groupBy(w).agg(*aggs)
    out = g
    for name in counts:
        tot, wn = F.col(f"__tot_{name}"), f"__w_{name}"
        # ``__same`` is always >= the smallest int; the test keeps it alive
        alive = F.col("__same") >= F.lit(-(2 ** 31))
        if min_records == 2:
            f = totals.filter((tot == 1) & alive).select(F.col(w).alias(wn),
                                                         *[f"__f{k}_{name}" for k in GROUP_COLS])
            cond = out[w] == f[wn]
            for k in GROUP_COLS:
                cond = cond & (out[k] == f[f"__f{k}_{name}"])
        else:
            f = totals.filter((tot < min_records) & alive).select(F.col(w).alias(wn))
            cond = out[w] == f[wn]
        out = (out.join(f, cond, "left")
               .withColumn(f"__pass_{name}", F.col(wn).isNull())
               .drop(*[c for c in f.columns]))
    return out


def user_profile_aggs(exact_scale: int | None = None) -> list:
    """Aggregates of a tagged (action + video-view) union per (window, user)."""
    is_act, is_vv = F.col(KIND_COL) == ACT, F.col(KIND_COL) == VV
    return [F.sum("clicks").alias("__c"), F.sum("shows").alias("__s"),
            *exact_sum("__tm", "tm", exact_scale), *exact_sum("__d", "duration", exact_scale),
            F.count(F.when(is_act, 1)).alias("__na"), F.count(F.when(is_vv, 1)).alias("__nv")]


def finish_user_profile(g: DataFrame, spec: WindowSpec, key: str = "u",
                        exact_scale: int | None = None) -> DataFrame:
    """Gate each kind and project ``(t, key, rt_u_click, rt_u_reveal, rt_u_rpt)``."""
    g = kind_gate_flags(g, {"act": "__na", "vv": "__nv"}, spec.min_records)
    act_ok = F.col("__pass_act") & (F.col("__na") > 0)
    vv_ok = F.col("__pass_vv") & (F.col("__nv") > 0)
    tm, dur = exact_value("__tm", exact_scale), exact_value("__d", exact_scale)
    return (g.filter(act_ok | vv_ok)
            .select(trigger_second(spec).alias("t"), grouped_key(key),
                    F.when(act_ok, F.col("__c")).alias("rt_u_click"),
                    F.when(act_ok, F.col("__s")).alias("rt_u_reveal"),
                    F.when(vv_ok, ieee_divide(tm, dur)).alias("rt_u_rpt")))


def user_profile(click_show: DataFrame, vv: DataFrame, spec: WindowSpec, key: str = "u",
                 ts: str = "ts", exact_scale: int | None = None) -> DataFrame:
    """``(t, key, rt_u_click, rt_u_reveal, rt_u_rpt)``: a user present in either
    kind's (gated) result; the absent kind's fields are NULL."""
    tagged = tag_union(click_show, vv, key, ts)
    g = (with_windows(tagged, spec, ts).groupBy(WINDOW_COL, *group_key(key, tagged))
         .agg(*user_profile_aggs(exact_scale)))
    return finish_user_profile(g, spec, key, exact_scale)


def feed_prefix(length: int, shortest: int) -> str:
    """Column prefix of a trailing length: the shortest is ``rt_f_``, the
    others ``rt_f_<n>h_`` (or ``<n>m`` / ``<n>s`` when not whole hours)."""
    if length == shortest:
        return "rt_f_"
    if length % 3600 == 0:
        return f"rt_f_{length // 3600}h_"
    if length % 60 == 0:
        return f"rt_f_{length // 60}m_"
    return f"rt_f_{length}s_"


def feed_profile_aggs(lengths: Sequence[int], inside, exact_scale: int | None = None) -> list:
    """Conditional aggregates of a tagged union inside one window of the
    longest length: ``inside(L)`` is the Column "row is in the trailing L s"."""
    lengths = sorted(set(int(x) for x in lengths))
    shortest, aggs = lengths[0], []
    for L in lengths:
        p, cond = feed_prefix(L, shortest), inside(L)
        aggs += [F.sum(F.when(cond, F.col("clicks"))).alias(p + "click"),
                 F.sum(F.when(cond, F.col("shows"))).alias(p + "reveal"),
                 *exact_sum(f"__tm_{L}", F.when(cond, F.col("tm")), exact_scale),
                 *exact_sum(f"__d_{L}", F.when(cond, F.col("duration")), exact_scale)]
    return aggs


def finish_feed_profile(g: DataFrame, lengths: Sequence[int], key: str = "contid",
                        exact_scale: int | None = None) -> DataFrame:
    """``(t, key, <prefix>click, <prefix>reveal, <prefix>rpt, ...)`` from the
    aggregates of ``feed_profile_aggs`` (window column holding the trigger)."""
    lengths = sorted(set(int(x) for x in lengths))
    cols = [F.col(WINDOW_COL).alias("t"), key]
    for L in lengths:
        p = feed_prefix(L, lengths[0])
        cols += [F.col(p + "click"), F.col(p + "reveal"),
                 ieee_divide(exact_value(f"__tm_{L}", exact_scale),
                             exact_value(f"__d_{L}", exact_scale)).alias(p + "rpt")]
    return g.select(*cols)


def feed_profile(click_show: DataFrame, vv: DataFrame,
                 lengths: Sequence[int] = FEED_LENGTHS_SECONDS, key: str = "contid",
                 ts: str = "ts", exact_scale: int | None = None,
                 step: int | None = None) -> DataFrame:
    """``(t, key, <prefix>click, <prefix>reveal, <prefix>rpt, ...)`` at every
    trigger ``t`` (a multiple of ``step``; default: of the longest length),
    half-open lengths ``[t - length, t)``. Without a step there are no window
    copies: each row lands in one window of the longest length and counts
    toward the shorter lengths by its age. With one, rows are first summed per
    (key, bucket) of gcd(lengths, step) seconds, and only buckets are copied."""
    longest = max(int(x) for x in lengths)
    tagged = tag_union(click_show, vv, key, ts)
    spec = WindowSpec(longest, step)
    if spec.is_tumbling:
        rows, aggs = tagged, feed_profile_aggs
    else:
        bucket = WindowSpec(math.gcd(*(int(x) for x in lengths), spec.slide))
        rows = pre_aggregate(tagged, bucket, key, feed_bucket_sums(exact_scale), ts)
        aggs = feed_profile_aggs_again
    wdf = with_windows(rows, spec, ts)
    sec = epoch_seconds(wdf, ts)
    inside = lambda L: (sec >= F.col(WINDOW_COL) - L) if L < longest else F.lit(True)
    return finish_feed_profile(wdf.groupBy(WINDOW_COL, key).agg(*aggs(lengths, inside, exact_scale)),
                               lengths, key, exact_scale)


def feed_bucket_sums(exact_scale: int | None = None) -> list:
    """Sums of a tagged union's rows per key and bucket, which ``feed_profile_aggs_again`` reads."""
    return [F.sum("clicks").alias("clicks"), F.sum("shows").alias("shows"),
            *exact_sum("tm", "tm", exact_scale), *exact_sum("duration", "duration", exact_scale)]


def feed_profile_aggs_again(lengths: Sequence[int], inside, exact_scale: int | None = None) -> list:
    """``feed_profile_aggs`` over bucket rows."""
    lengths = sorted(set(int(x) for x in lengths))
    aggs = []
    for L in lengths:
        p, cond = feed_prefix(L, lengths[0]), inside(L)
        aggs += [F.sum(F.when(cond, F.col("clicks"))).alias(p + "click"),
                 F.sum(F.when(cond, F.col("shows"))).alias(p + "reveal")]
        for name, out in (("tm", f"__tm_{L}"), ("duration", f"__d_{L}")):
            aggs += [F.sum(F.when(cond, F.col(a))).alias(b) for a, b in
                     zip(exact_columns(name, exact_scale), exact_columns(out, exact_scale))]
    return aggs


def read_profile(profile: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Reader view of a profile: absent (NULL) fields read as 0 (P10)."""
    cols = columns or [c for c in profile.columns if c.startswith("rt_")]
    out = profile
    for c in cols:
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(0).cast(profile.schema[c].dataType)))
    return out
