"""Adapters from the ``events`` table to the two message kinds.

* action record: ``t`` = event_type, ``u`` = user id as text, ``contid`` =
  ``props.k``; the show action is spelled ``view`` in this table.
* video-view record: every event; ``tm`` = value, ``duration`` =
  (event_id * 7) % 240 (zeros included, so the IEEE paths are exercised).
* raw messages: the records above serialised to JSON text with deterministic
  damage keyed by ``event_id`` (blank contid, truncated text, odd or
  non-numeric tm, negative zero duration, space-padded user id, text around
  or after the object, single quotes, a bare NaN) so the parse operators see
  dirty input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import ActionConfig

EVENTS_ACTION_CONFIG = ActionConfig(click_value="click", show_value="view")

# Damage rules of the raw-message fixture, by event_id modulus.
BLANK_CONTENT_MOD = 17
TRUNCATE_TEXT_MOD = 19
BAD_NUMBER_MOD = 23
PAD_USER_MOD = 29
ODD_NUMBER_MOD = 31     # tm is one of ODD_NUMBERS, by event_id / 31
ODD_NUMBERS = ("nan", "inf", "-Infinity", "1e300", "0x1.8p3", "-0", "2.125", "1e400")
NEGATIVE_ZERO_MOD = 37  # duration is -0
ODD_TEXT_MOD = 41       # the message is one of _odd_text's, by event_id / 41
DURATION_FACTOR = 7
DURATION_MODULUS = 240


def _content_id() -> Column:
    return F.get_json_object(F.col("props"), "$.k")


def action_records(events: DataFrame) -> DataFrame:
    """Typed action rows: ``(event_id, ts, u, t, contid)``."""
    return events.select(
        "event_id", "ts",
        F.col("user_id").cast("string").alias("u"),
        F.col("event_type").alias("t"),
        _content_id().alias("contid"),
    )


def vv_records(events: DataFrame) -> DataFrame:
    """Typed video-view rows: ``(event_id, ts, u, contid, tm, duration)``."""
    return events.select(
        "event_id", "ts",
        F.col("user_id").cast("string").alias("u"),
        F.col("event_type").alias("t"),
        _content_id().alias("contid"),
        F.col("value").alias("tm"),
        ((F.col("event_id") * DURATION_FACTOR) % DURATION_MODULUS).cast("double").alias("duration"),
    )


def _damage(df: DataFrame, fields: dict[str, Column], cfg: ActionConfig) -> DataFrame:
    eid = F.col("event_id")
    fields = dict(fields)
    fields[cfg.content_key] = F.when(eid % BLANK_CONTENT_MOD == 0, F.lit("")).otherwise(
        fields[cfg.content_key])
    fields[cfg.user_key] = F.when(eid % PAD_USER_MOD == 0,
                                  F.concat(F.lit("  "), fields[cfg.user_key], F.lit("  "))
                                  ).otherwise(fields[cfg.user_key])
    if cfg.watch_key in fields:
        odd = F.get(F.array(*map(F.lit, ODD_NUMBERS)),
                    (F.floor(eid / ODD_NUMBER_MOD) % len(ODD_NUMBERS)).cast("int"))
        fields[cfg.watch_key] = (F.when(eid % BAD_NUMBER_MOD == 0, F.lit("abc"))
                                 .when(eid % ODD_NUMBER_MOD == 0, odd)
                                 .otherwise(fields[cfg.watch_key]))
        fields[cfg.duration_key] = F.when(eid % NEGATIVE_ZERO_MOD == 0, F.lit("-0")).otherwise(
            fields[cfg.duration_key])
    json_text = F.to_json(F.struct(*[c.alias(k) for k, c in fields.items()]))
    truncated = F.expr("left(__json, length(__json) div 2)")
    return (df.select(eid.alias("key"), "ts", json_text.alias("__json"))
            .select("key", "ts",
                    F.when(F.col("key") % TRUNCATE_TEXT_MOD == 0, truncated)
                    .when(F.col("key") % ODD_TEXT_MOD == 0, _odd_text(F.col("__json")))
                    .otherwise(F.col("__json")).alias("value")))


def _odd_text(j: Column) -> Column:
    """Text that is not one JSON object, in six ways by ``key``; the seventh is an object after all."""
    texts = [F.concat(j, F.lit(" xyz")), F.concat(j, F.lit(",")), F.concat(j, j),
             F.replace(j, F.lit('"'), F.lit("'")), F.concat(j, F.lit("] ["), j),
             F.concat(F.lit('{"x":NaN,'), F.substring(j, F.lit(2), F.length(j))),
             F.concat(F.lit('  {"x":[1,{"y":"]"}],'), F.substring(j, F.lit(2), F.length(j)), F.lit(" "))]
    return F.get(F.array(*texts), (F.floor(F.col("key") / ODD_TEXT_MOD) % len(texts)).cast("int"))


def raw_action_messages(events: DataFrame, cfg: ActionConfig = EVENTS_ACTION_CONFIG) -> DataFrame:
    """Action messages as JSON text: ``(key, ts, value)``."""
    rec = action_records(events)
    fields = {cfg.type_key: F.col("t"), cfg.user_key: F.col("u"), cfg.content_key: F.col("contid")}
    return _damage(rec, fields, cfg)


def raw_vv_messages(events: DataFrame, cfg: ActionConfig = EVENTS_ACTION_CONFIG) -> DataFrame:
    """Video-view messages as JSON text: ``(key, ts, value)``; numbers as strings."""
    rec = vv_records(events)
    fields = {cfg.type_key: F.col("t"), cfg.user_key: F.col("u"), cfg.content_key: F.col("contid"),
              cfg.watch_key: F.col("tm").cast("string"),
              cfg.duration_key: F.col("duration").cast("bigint").cast("string")}
    return _damage(rec, fields, cfg)
