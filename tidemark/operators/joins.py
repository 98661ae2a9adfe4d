"""Join a per-group result back to the group's rows.

Keys are compared null-safe: ``groupBy`` treats NULL as a group, so its
result must find its NULL-keyed rows again. Null-safe keys also keep the
optimizer from inferring ``IS NOT NULL`` filters that would differ between
two branches reading the same upstream, which would stop Spark from reusing
that upstream's shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_back(left: DataFrame, right: DataFrame, keys: str | Sequence[str],
              how: str = "inner") -> DataFrame:
    """``left JOIN right USING (keys)`` with null-safe key equality; the
    key columns appear once (from ``left``)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    r = right.select(*[F.col(c).alias(f"__r_{c}") if c in keys else F.col(c)
                       for c in right.columns])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"__r_{k}"])
        cond = c if cond is None else cond & c
    out = left.join(r, cond, how)
    if how in ("left_semi", "left_anti", "semi", "anti", "leftsemi", "leftanti"):
        return out
    return out.drop(*[f"__r_{k}" for k in keys])
