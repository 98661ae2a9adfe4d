"""Message parsing (P1-P7): JSON text -> typed records, with reject reasons.

Both paths keep every input row and label it: ``reason`` is NULL for a good
record, else the first failed check in this order:

* ``parse``: not one JSON object (P1);
* ``required``: a required field is missing or empty (P2);
* ``type``: action path, type is neither click nor show (P5);
* ``number``: video-view path, watch time or duration is not a strict
  decimal number (P4).

Action path: the user id is trimmed of spaces after the emptiness check (P3),
so an all-space id survives as the empty key. Video-view path: nothing is
trimmed; ``rpt = tm / duration`` with IEEE semantics (P7).
Split good rows and rejects with ``good()`` / ``rejects()``; both are cheap
filters over the same lazy plan.

Non-string JSON values (``"tm": 5``) are read as their text by default;
``strict_strings=True`` rejects them as ``required`` (a string getter fails
on them), checked through ``try_parse_json`` and the value's variant type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import ActionConfig
from tidemark.functions.json import json_scalar_fields
from tidemark.functions.scalars import ieee_divide, one_hot, strict_double, trim_spaces

REASON = "reason"


def _present(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def computed_once(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
    """Add ``cols`` through a one-row ``inline`` generator.

    Catalyst pushes a filter below a projection by inlining the projected
    expressions, which would evaluate JSON parsing and number checks once in
    the filter and again in the projection. A filter cannot move below a
    generator whose output it reads, so these values are computed once.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))))


def _parsed(raw: DataFrame, keys: list[str], value: str, keep: tuple[str, ...]) -> DataFrame:
    j = json_scalar_fields(F.col(value), keys)
    out = computed_once(raw.select(*dict.fromkeys([*keep, value])), {"__j": j})
    return out if value in keep else out.drop(value)


def _not_all_strings(value: str, keys: list[str]) -> Column:
    """True when some present key of the JSON object holds a non-string."""
    v = F.expr(f"try_parse_json(`{value}`)")
    bad = None
    for k in keys:
        path = "$['" + k.replace("'", "\\'") + "']"
        typ = F.schema_of_variant(F.try_variant_get(v, path, "variant"))
        c = typ.isNotNull() & (typ != F.lit("STRING"))
        bad = c if bad is None else bad | c
    return F.coalesce(bad, F.lit(False))


def _failed_parse() -> Column:
    return F.col("__j").isNull()


def parse_actions(raw: DataFrame, cfg: ActionConfig = ActionConfig(), value: str = "value",
                  keep: tuple[str, ...] = ("key", "ts"), strict_strings: bool = False) -> DataFrame:
    """``(*keep, u, t, contid, clicks, shows, reason)``."""
    keys = [cfg.type_key, cfg.user_key, cfg.content_key]
    p = _parsed(raw, keys, value, keep + ((value,) if strict_strings else ()))
    t, u, c = (F.col(f"__j.{k}") for k in keys)
    required = _present(t) & _present(u) & _present(c)
    if strict_strings:
        required = required & ~_not_all_strings(value, keys)
    reason = (F.when(_failed_parse(), F.lit("parse"))
              .when(~required, F.lit("required"))
              .when(~t.isin(cfg.click_value, cfg.show_value), F.lit("type")))
    return p.select(*keep, trim_spaces(u).alias("u"), t.alias("t"), c.alias("contid"),
                    one_hot(t, cfg.click_value).alias("clicks"),
                    one_hot(t, cfg.show_value).alias("shows"), reason.alias(REASON))


def parse_vv(raw: DataFrame, cfg: ActionConfig = ActionConfig(), value: str = "value",
             keep: tuple[str, ...] = ("key", "ts"), strict_strings: bool = False) -> DataFrame:
    """``(*keep, u, t, contid, tm, duration, rpt, reason)``."""
    keys = [cfg.type_key, cfg.user_key, cfg.content_key, cfg.watch_key, cfg.duration_key]
    p = _parsed(raw, keys, value, keep + ((value,) if strict_strings else ()))
    t, u, c, tm_s, dur_s = (F.col(f"__j.{k}") for k in keys)
    p = computed_once(p, {"__tm": strict_double(tm_s), "__dur": strict_double(dur_s)})
    tm, dur = F.col("__tm"), F.col("__dur")
    required = _present(t) & _present(u) & _present(c) & _present(tm_s) & _present(dur_s)
    if strict_strings:
        required = required & ~_not_all_strings(value, keys)
    reason = (F.when(_failed_parse(), F.lit("parse"))
              .when(~required, F.lit("required"))
              .when(tm.isNull() | dur.isNull(), F.lit("number")))
    return p.select(*keep, u.alias("u"), t.alias("t"), c.alias("contid"), tm.alias("tm"),
                    dur.alias("duration"), ieee_divide(tm, dur).alias("rpt"), reason.alias(REASON))


def good(parsed: DataFrame) -> DataFrame:
    """Accepted records only, without the ``reason`` column."""
    return parsed.filter(F.col(REASON).isNull()).drop(REASON)


def rejects(parsed: DataFrame) -> DataFrame:
    """Rejected rows with their reason."""
    return parsed.filter(F.col(REASON).isNotNull())


def reason_counts(parsed: DataFrame, path: str) -> DataFrame:
    """``(path, reason, n)`` with ``reason = 'ok'`` for accepted rows."""
    return (parsed.groupBy(F.coalesce(F.col(REASON), F.lit("ok")).alias(REASON))
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit(path).alias("path"), REASON, "n"))
