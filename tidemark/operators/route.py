"""Record kinds (P8): tag rows of the two message streams, union them, and
route a union back to one kind. One tagged union lets a single aggregation
serve both kinds (one shuffle instead of a join of two aggregates)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ACT = "act"
VV = "vv"
KIND_COL = "kind"

_ACT_COLS = ("clicks", "shows")
_VV_COLS = ("tm", "duration")


def tag_union(click_show: DataFrame, vv: DataFrame, key: str, ts: str = "ts",
              extra: tuple[str, ...] = ()) -> DataFrame:
    """``(ts, key, kind, clicks, shows, tm, duration, *extra)``; the other
    kind's measure columns are NULL."""
    a = click_show.select(ts, key, *extra, F.lit(ACT).alias(KIND_COL),
                          *[F.col(c).cast("bigint").alias(c) for c in _ACT_COLS],
                          *[F.lit(None).cast("double").alias(c) for c in _VV_COLS])
    v = vv.select(ts, key, *extra, F.lit(VV).alias(KIND_COL),
                  *[F.lit(None).cast("bigint").alias(c) for c in _ACT_COLS],
                  *[F.col(c).cast("double").alias(c) for c in _VV_COLS])
    return a.unionByName(v)


def route(tagged: DataFrame, kind: str) -> DataFrame:
    """Rows of one kind only."""
    return tagged.filter(F.col(KIND_COL) == kind)
