"""Registered queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Every query reads whole tables from ``sf_dir`` and returns a lazy DataFrame.
Window parameters are fixed per query (see ``SPECS``); the reference's own
five-second geometry is registered as ``*_reference``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import REFERENCE_SPEC, USER_KEY_TEMPLATE, WindowSpec
from tidemark.functions.json import json_path, json_variant, variant_kind, variant_number, variant_text
from tidemark.functions.scalars import epoch_seconds, profile_key
from tidemark.functions.wire import FEED_PROFILE, USER_PROFILE
from tidemark.operators import frame_log, frames as fr
from tidemark.operators.keyed import accumulate_merge, first_write_merge, keyed_merge, store_snapshot
from tidemark.operators.metrics import click_show_metrics, completion_metrics, to_click_show
from tidemark.operators.operations import KeepMost
from tidemark.operators.parse import good, parse_actions, parse_vv, reason_counts
from tidemark.operators.profiles import feed_profile, read_profile, user_profile
from tidemark.operators.route import tag_union
from tidemark.operators.sequences import bounded_intake, live_intake, rolling_sequence, sequence_summary
from tidemark.operators.windows import (
    WINDOW_COL,
    live_intervals,
    live_set_at,
    rolling_sums,
    trigger_second,
    window_snapshot,
    with_windows,
)
from tidemark.session import scratch_path
from tidemark.sources.adapters import (
    EVENTS_ACTION_CONFIG,
    action_records,
    raw_action_messages,
    raw_vv_messages,
    vv_records,
)
from tidemark.sources.tables import read_table
from tidemark.streaming.sinks import read_serialized, serialize_profile

# Watch time and duration are summed exactly at 2 decimals (the inputs' scale).
EXACT_SCALE = 2

SPECS = {
    "tumbling": WindowSpec(300, mode="half_open", min_records=2),
    "sliding": WindowSpec(900, 300, mode="half_open", min_records=2),
    "inclusive": WindowSpec(300, 60, mode="inclusive", min_records=2),
    "reference": REFERENCE_SPEC,
    # step longer than the window: one closed 5-minute window every 15 minutes
    "gapped": WindowSpec(300, 900, mode="inclusive", min_records=2),
}
FEEDS = {"5m": 300, "2h": 7200, "4h": 14400}
LIVE_SET_SECONDS = 14400          # live set: last 4 h before the newest second
ROLLING_SECONDS = 7200            # per-event rolling live set: 2 h
SNAPSHOT_SPEC = WindowSpec(300, 60, mode="inclusive")
ROUTE_SPEC = WindowSpec(300)
INTAKE_CAPACITY = 8
NULL_EVERY = 3                    # sequence fixture: value is NULL where event_id % 3 = 0
# Frame fixture damage by doc_id: % 10 = 0 alters the last byte, % 10 = 5 sends
# only the first bytes of the frame.
FRAME_DAMAGE_MOD = 10
FRAME_SHORT_BYTES = 10

QueryFn = Callable[[SparkSession, str], DataFrame]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


def click_show_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_click_show(action_records(events(spark, sf_dir)), EVENTS_ACTION_CONFIG)


def vv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vv_records(events(spark, sf_dir))


def _user_click_show(spec: WindowSpec) -> QueryFn:
    return lambda spark, sf: click_show_metrics(click_show_records(spark, sf), spec, key="u")


def _user_completion(spec: WindowSpec) -> QueryFn:
    return lambda spark, sf: completion_metrics(vv(spark, sf), spec, key="u",
                                                exact_scale=EXACT_SCALE)


def _feed_click_show(length: int) -> QueryFn:
    return lambda spark, sf: click_show_metrics(click_show_records(spark, sf),
                                                WindowSpec(length), key="contid")


def _feed_completion(length: int) -> QueryFn:
    return lambda spark, sf: completion_metrics(vv(spark, sf), WindowSpec(length),
                                                key="contid", exact_scale=EXACT_SCALE)


# The declared 2 h feed window, sliding every 5 min, over bucket pre-aggregates.
FEED_SLIDING_SPEC = WindowSpec(7200, 300)


def q_feed_click_show_sliding(spark: SparkSession, sf: str) -> DataFrame:
    return click_show_metrics(click_show_records(spark, sf), FEED_SLIDING_SPEC, key="contid",
                              pre_aggregate_buckets=True)


def q_feed_completion_sliding(spark: SparkSession, sf: str) -> DataFrame:
    return completion_metrics(vv(spark, sf), FEED_SLIDING_SPEC, key="contid",
                              exact_scale=EXACT_SCALE, pre_aggregate_buckets=True)


def q_user_profile(spark: SparkSession, sf: str) -> DataFrame:
    return user_profile(click_show_records(spark, sf), vv(spark, sf), SPECS["tumbling"],
                        key="u", exact_scale=EXACT_SCALE)


def q_user_profile_read(spark: SparkSession, sf: str) -> DataFrame:
    return read_profile(q_user_profile(spark, sf))


def q_feed_profile(spark: SparkSession, sf: str) -> DataFrame:
    return feed_profile(click_show_records(spark, sf), vv(spark, sf), tuple(FEEDS.values()),
                        key="contid", exact_scale=EXACT_SCALE)


def q_parse_actions(spark: SparkSession, sf: str) -> DataFrame:
    raw = raw_action_messages(events(spark, sf))
    return good(parse_actions(raw, EVENTS_ACTION_CONFIG)).drop("ts")


def q_parse_vv(spark: SparkSession, sf: str) -> DataFrame:
    raw = raw_vv_messages(events(spark, sf))
    return good(parse_vv(raw, EVENTS_ACTION_CONFIG)).drop("ts")


def q_reject_reasons(spark: SparkSession, sf: str) -> DataFrame:
    ev = events(spark, sf)
    a = reason_counts(parse_actions(raw_action_messages(ev), EVENTS_ACTION_CONFIG), "action")
    v = reason_counts(parse_vv(raw_vv_messages(ev), EVENTS_ACTION_CONFIG), "vv")
    return a.unionByName(v)


def q_route_kinds(spark: SparkSession, sf: str) -> DataFrame:
    tagged = tag_union(click_show_records(spark, sf), vv(spark, sf), "u")
    return (with_windows(tagged, ROUTE_SPEC).groupBy(WINDOW_COL, "kind")
            .agg(F.count(F.lit(1)).alias("n"))
            .select(trigger_second(ROUTE_SPEC).alias("t"), "kind", "n"))


def q_props_extract(spark: SparkSession, sf: str) -> DataFrame:
    ev = events(spark, sf)
    k = json_path("props", "$.k")
    return ev.select("event_id", k.alias("contid"), k.cast("bigint").alias("k"))


def q_live_set_at(spark: SparkSession, sf: str) -> DataFrame:
    ev = events(spark, sf)
    now = ev.select(F.max(epoch_seconds(ev, "ts"))).scalar()
    cs = click_show_records(spark, sf)
    return (live_set_at(cs, now, LIVE_SET_SECONDS, mode="inclusive")
            .select("event_id", "u", epoch_seconds(cs, "ts").alias("sec"), "clicks", "shows"))


def q_window_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    cs = click_show_records(spark, sf).select("event_id", "ts", "u", "clicks", "shows")
    return window_snapshot(cs, SNAPSHOT_SPEC).drop("ts")


def q_user_rolling(spark: SparkSession, sf: str) -> DataFrame:
    cs = click_show_records(spark, sf).select("event_id", "ts", "u", "clicks", "shows")
    return rolling_sums(cs, "u", ["clicks", "shows"], ROLLING_SECONDS).drop("ts", "clicks", "shows")


def q_keyed_first_write(spark: SparkSession, sf: str) -> DataFrame:
    res = QUERIES["user_click_show_tumbling"](spark, sf)
    return first_write_merge(res, key="u", order="t", key_template=USER_KEY_TEMPLATE)


def q_profile_store(spark: SparkSession, sf: str) -> DataFrame:
    res = QUERIES["user_click_show_tumbling"](spark, sf)
    return store_snapshot(res, key="u", order="t", key_template=USER_KEY_TEMPLATE)


def q_keyed_first_write_reference(spark: SparkSession, sf: str) -> DataFrame:
    """The original click/show pipeline end to end: 5 s windows every 1 s,
    both ends closed, two-record gate, first-write merge into the keyed store."""
    res = QUERIES["user_click_show_reference"](spark, sf)
    return first_write_merge(res, key="u", order="t", key_template=USER_KEY_TEMPLATE)


def q_messages_click_show(spark: SparkSession, sf: str) -> DataFrame:
    """Entry 1 from raw action messages: parse, 5 s / 1 s closed windows,
    gate, per-user counts, first-write keyed store."""
    cs = good(parse_actions(raw_action_messages(events(spark, sf)), EVENTS_ACTION_CONFIG))
    res = click_show_metrics(cs, SPECS["reference"], key="u")
    return first_write_merge(res, key="u", order="t", key_template=USER_KEY_TEMPLATE)


def newer_than(ev: DataFrame, thirds: int) -> Column:
    """The first second after so many thirds of the time that the events cover."""
    sec = epoch_seconds(ev, "ts")
    lo, hi = F.min(sec), F.max(sec)
    return ev.select(lo + F.floor((hi - lo + 3) * thirds / 3).cast("bigint")).scalar()


def q_messages_click_show_newer(spark: SparkSession, sf: str) -> DataFrame:
    """Entry 1, with five-minute windows, over the messages of the newer two thirds of the time."""
    ev = events(spark, sf)
    newer = ev.where(epoch_seconds(ev, "ts") >= newer_than(ev, 1))
    cs = good(parse_actions(raw_action_messages(newer), EVENTS_ACTION_CONFIG))
    res = click_show_metrics(cs, SPECS["tumbling"], key="u")
    return first_write_merge(res, key="u", order="t", key_template=USER_KEY_TEMPLATE)


def q_messages_completion(spark: SparkSession, sf: str) -> DataFrame:
    """Entry 2 from raw video-view messages: parse, 5 s / 1 s closed windows,
    gate, per-user watch time / duration / ratio (user ids not trimmed)."""
    v = good(parse_vv(raw_vv_messages(events(spark, sf)), EVENTS_ACTION_CONFIG))
    return completion_metrics(v, SPECS["reference"], key="u", exact_scale=EXACT_SCALE)


def q_feed_profile_sliding(spark: SparkSession, sf: str) -> DataFrame:
    """The feed profile every 5 minutes, over 5-minute bucket sums."""
    return feed_profile(click_show_records(spark, sf), vv(spark, sf), tuple(FEEDS.values()),
                        key="contid", exact_scale=EXACT_SCALE, step=300)


def q_feed_click_show_4h_live(spark: SparkSession, sf: str) -> DataFrame:
    """The declared 4 h feed window at the declared 1 s step, as intervals of equal triggers."""
    return live_intervals(click_show_records(spark, sf), "contid", ["clicks", "shows"], FEEDS["4h"])


def q_keyed_most_clicks(spark: SparkSession, sf: str) -> DataFrame:
    """A user-defined operation in batch: the most clicks of a user so far; the streams run the same object."""
    res = QUERIES["user_click_show_tumbling"](spark, sf)
    return keyed_merge(res, KeepMost(), "u", "t", USER_KEY_TEMPLATE)


PROFILE_FIELDS = ("rt_u_click", "rt_u_reveal", "rt_u_rpt")


def q_profile_value_read(spark: SparkSession, sf: str) -> DataFrame:
    """Profiles as stored JSON values, read back with the reader's defaults."""
    p = q_user_profile(spark, sf)
    keyed = p.withColumn("store_key", F.concat_ws(":", profile_key("u", USER_KEY_TEMPLATE), "t"))
    stored = serialize_profile(keyed, "store_key", PROFILE_FIELDS, "json")
    return read_profile(read_serialized(stored, "store_key",
                                        "rt_u_click bigint, rt_u_reveal bigint, rt_u_rpt double"))


def q_profile_value_bytes(spark: SparkSession, sf: str) -> DataFrame:
    """Profiles as stored wire bytes, read back with the reader's defaults."""
    p = q_user_profile(spark, sf)
    keyed = p.withColumn("store_key", F.concat_ws(":", profile_key("u", USER_KEY_TEMPLATE), "t"))
    stored = serialize_profile(keyed, "store_key", USER_PROFILE, "protobuf")
    return read_profile(read_serialized(stored, "store_key", USER_PROFILE))


def q_feed_value_bytes(spark: SparkSession, sf: str) -> DataFrame:
    """The nine figures of a feed profile as stored wire bytes, read back."""
    keyed = q_feed_profile(spark, sf).withColumn("at", F.struct("t", "contid"))
    stored = serialize_profile(keyed, "at", FEED_PROFILE, "protobuf")
    return read_profile(read_serialized(stored, "at", FEED_PROFILE).select("at.t", "at.contid", *FEED_PROFILE))


def q_props_variant(spark: SparkSession, sf: str) -> DataFrame:
    """Typed access to the events' own JSON text: what kind of value, and the value if it is of that kind."""
    v = F.col("v")
    return events(spark, sf).select("event_id", json_variant("props").alias("v")).select(
        "event_id", F.when(variant_kind(v).startswith("OBJECT"), "OBJECT").otherwise(variant_kind(v)).alias("kind"),
        variant_kind(v, "$.k").alias("k_kind"), variant_number(v, "$.k").alias("k"), variant_text(v, "$.k").alias("k_text"),
        variant_kind(v, "$.k.deeper").isNull().alias("no_deeper"))


def q_props_nested(spark: SparkSession, sf: str) -> DataFrame:
    """JSON access to an object, an array, a null, a boolean and a number."""
    ev = events(spark, sf)
    nested = F.to_json(F.struct(
        F.struct(F.col("user_id").cast("string").alias("id"), (F.col("user_id") % 2 == 0).alias("vip")).alias("user"),
        F.array("event_id", json_path("props", "$.k").cast("bigint")).alias("items"),
        F.lit(None).cast("string").alias("none"), (F.col("event_id") % 10).alias("n")),
        {"ignoreNullFields": "false"})
    j = F.col("j")
    return ev.select("event_id", nested.alias("j")).select(
        "event_id", json_path(j, "$.user").alias("user_json"), json_path(j, "$.user.id").alias("user_id"),
        json_path(j, "$.items[1]").alias("second_item"), json_path(j, "$.none").alias("none"),
        json_path(j, "$.user.vip").alias("vip"), json_path(j, "$.n").cast("bigint").alias("n"))


def q_feed_profile_read(spark: SparkSession, sf: str) -> DataFrame:
    return read_profile(q_feed_profile(spark, sf))


def q_keyed_accumulate(spark: SparkSession, sf: str) -> DataFrame:
    res = QUERIES["user_click_show_tumbling"](spark, sf)
    return accumulate_merge(res, key="u", order="t", spec=SPECS["tumbling"],
                            key_template=USER_KEY_TEMPLATE)


def _nullable_values(spark: SparkSession, sf: str) -> DataFrame:
    ev = events(spark, sf)
    return ev.select("user_id", "event_id", "ts",
                     F.when(F.col("event_id") % NULL_EVERY != 0, F.col("value")).alias("value"))


def q_sequence_summary(spark: SparkSession, sf: str) -> DataFrame:
    return sequence_summary(_nullable_values(spark, sf), "user_id", "value",
                            ["ts", "event_id"], ts="ts")


def q_bounded_intake(spark: SparkSession, sf: str) -> DataFrame:
    ev = events(spark, sf).select("user_id", "event_id", "ts")
    return bounded_intake(ev, "user_id", ["ts", "event_id"], INTAKE_CAPACITY).drop("ts")


def q_user_sequence_2h(spark: SparkSession, sf: str) -> DataFrame:
    """Head, tail, least and oldest of every event's live set of two hours."""
    rows = _nullable_values(spark, sf)
    return rolling_sequence(rows, "user_id", "value", ["ts", "event_id"], ROLLING_SECONDS, "ts").drop("ts", "value")


INTAKE_LIVE = 3  # of a kind of event, at most so many live in two hours


def q_bounded_intake_2h(spark: SparkSession, sf: str) -> DataFrame:
    """Bounded intake where what was accepted expires after two hours, per kind of event (five hot keys)."""
    ev = events(spark, sf).select("event_type", "event_id", "ts")
    return live_intake(ev, "event_type", ["ts", "event_id"], INTAKE_LIVE, ROLLING_SECONDS, "ts").drop("ts")


def _sent_frames(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as frames, ``(doc_id, payload, sent)``: some with an altered last byte, some cut off."""
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    payload = F.encode(F.col("text"), "UTF-8")
    framed = docs.select("doc_id", payload.alias("payload"),
                         fr.encode_frame("doc_id", payload).alias("frame"))
    last = F.substring("frame", -1, 1)
    altered = F.concat(F.expr("substring(frame, 1, octet_length(frame) - 1)"),
                       F.when(last == F.unhex(F.lit("00")), F.unhex(F.lit("01")))
                       .otherwise(F.unhex(F.lit("00"))))
    damage = F.col("doc_id") % FRAME_DAMAGE_MOD
    sent = (F.when(damage == 0, altered)
            .when(damage == 5, F.expr(f"substring(frame, 1, {FRAME_SHORT_BYTES})"))
            .otherwise(F.col("frame")))
    return framed.select("doc_id", "payload", sent.alias("sent"))


def _frames(spark: SparkSession, sf: str) -> DataFrame:
    return _sent_frames(spark, sf).select("doc_id", "payload", fr.decode_frame(fr.strip_size_prefix("sent")).alias("d"))


def _frame_log(spark: SparkSession, sf: str) -> DataFrame:
    """The sent frames as byte files in the shared folder, one after another in the order of doc_id, scanned again."""
    folder = scratch_path(spark, "frame-log")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sent = _sent_frames(spark, sf).repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id")
    frame_log.write_frame_log(sent, folder, "sent")
    return frame_log.read_frame_log(spark, folder)


def q_frame_log_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Good frames found in a byte log with damaged and cut-off frames in it."""
    return frame_log.good_frames(_frame_log(spark, sf)).select("msg_id", F.md5("data").alias("payload_md5"))


def q_frame_log_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """The bad stretches of that log, with their sizes; what a cut-off frame leaves has no id."""
    bad = frame_log.quarantined(_frame_log(spark, sf))
    return bad.select("status", F.when(F.col("status") == fr.STATUS_CHECKSUM, F.col("msg_id")).alias("msg_id"),
                      F.octet_length("bytes").cast("bigint").alias("size"))


def q_frame_integrity(spark: SparkSession, sf: str) -> DataFrame:
    ok = F.col("d.status") == fr.STATUS_OK
    return _frames(spark, sf).select(
        "doc_id", F.col("d.status").alias("status"), F.col("d.msg_id").alias("msg_id"),
        F.col("d.size").alias("size"), F.octet_length("d.data").cast("bigint").alias("payload_len"),
        F.when(ok, F.col("d.data") == F.col("payload")).alias("payload_ok"))


def q_frame_status_counts(spark: SparkSession, sf: str) -> DataFrame:
    return fr.status_counts(_frames(spark, sf).select(F.col("d.status").alias("status")))


QUERIES: dict[str, QueryFn] = {
    "user_click_show_tumbling": _user_click_show(SPECS["tumbling"]),
    "user_click_show_sliding": _user_click_show(SPECS["sliding"]),
    "user_click_show_inclusive": _user_click_show(SPECS["inclusive"]),
    "user_click_show_reference": _user_click_show(SPECS["reference"]),
    "user_click_show_gapped": _user_click_show(SPECS["gapped"]),
    "user_completion_tumbling": _user_completion(SPECS["tumbling"]),
    "user_completion_sliding": _user_completion(SPECS["sliding"]),
    "user_completion_inclusive": _user_completion(SPECS["inclusive"]),
    "user_completion_reference": _user_completion(SPECS["reference"]),
    "user_completion_gapped": _user_completion(SPECS["gapped"]),
    **{f"feed_click_show_{n}": _feed_click_show(L) for n, L in FEEDS.items()},
    **{f"feed_completion_{n}": _feed_completion(L) for n, L in FEEDS.items()},
    "feed_click_show_sliding": q_feed_click_show_sliding,
    "feed_completion_sliding": q_feed_completion_sliding,
    "user_profile": q_user_profile,
    "user_profile_read": q_user_profile_read,
    "feed_profile": q_feed_profile,
    "feed_profile_read": q_feed_profile_read,
    "feed_profile_sliding": q_feed_profile_sliding,
    "feed_click_show_4h_live": q_feed_click_show_4h_live,
    "profile_value_read": q_profile_value_read,
    "keyed_most_clicks": q_keyed_most_clicks,
    "props_nested": q_props_nested,
    "parse_actions": q_parse_actions,
    "parse_vv": q_parse_vv,
    "reject_reasons": q_reject_reasons,
    "route_kinds": q_route_kinds,
    "props_extract": q_props_extract,
    "live_set_at": q_live_set_at,
    "window_snapshot": q_window_snapshot,
    "user_rolling": q_user_rolling,
    "keyed_first_write": q_keyed_first_write,
    "keyed_accumulate": q_keyed_accumulate,
    "keyed_first_write_reference": q_keyed_first_write_reference,
    "profile_store": q_profile_store,
    "messages_click_show": q_messages_click_show,
    "messages_click_show_newer": q_messages_click_show_newer,
    "messages_completion": q_messages_completion,
    "sequence_summary": q_sequence_summary,
    "bounded_intake": q_bounded_intake,
    "bounded_intake_2h": q_bounded_intake_2h,
    "user_sequence_2h": q_user_sequence_2h,
    "profile_value_bytes": q_profile_value_bytes,
    "feed_value_bytes": q_feed_value_bytes,
    "props_variant": q_props_variant,
    "frame_integrity": q_frame_integrity,
    "frame_status_counts": q_frame_status_counts,
    "frame_log_scan": q_frame_log_scan,
    "frame_log_quarantine": q_frame_log_quarantine,
}
