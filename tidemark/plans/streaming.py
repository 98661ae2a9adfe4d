"""Streaming twins of batch queries.

Each twin replays the ``events`` table, a file or a folder of part files, as a
file stream with ``availableNow`` into a ``foreachBatch`` sink under the shared
checkpoint folder. A second run on the same checkpoint reads the flush marker,
which closes the last windows, wherever its folder lies. The result must equal the batch twin's,
so it shares the batch twin's oracle SQL. Rows that a watermark drops end the run
with ``LateRows``. What a replay writes besides its result is removed after it.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from tidemark.app import start_click_show, start_click_show_on_state, start_completion
from tidemark.config import USER_KEY_TEMPLATE, WindowSpec
from tidemark.functions.scalars import as_instant, epoch_seconds, profile_key
from tidemark.functions.wire import USER_PROFILE
from tidemark.operators.metrics import to_click_show
from tidemark.operators.operations import Accumulate, FirstWrite, KeepMost, KeyedOperation
from tidemark.operators.profiles import (
    feed_bucket_sums,
    feed_profile_aggs,
    feed_profile_aggs_again,
    finish_feed_profile,
    finish_user_profile,
    read_profile,
    user_profile_aggs,
)
from tidemark.operators.route import tag_union
from tidemark.operators.windows import WINDOW_COL, group_key, grouped_key, stream_windows, struct_to_trigger
from tidemark.plans.catalog import EXACT_SCALE, FEEDS, ROLLING_SECONDS, SPECS, events, newer_than
from tidemark.session import scratch_path
from tidemark.sources.adapters import (
    EVENTS_ACTION_CONFIG,
    action_records,
    raw_action_messages,
    raw_vv_messages,
    vv_records,
)
from tidemark.sources.message_log import append_messages, read_message_log
from tidemark.streaming.sinks import KeyedTableSink, ResultTableSink, read_serialized, serialize_profile
from tidemark.streaming.sources import (
    FLUSH_USER,
    make_folder,
    read_files_stream,
    remove_folder,
    table_stream,
    write_flush_marker,
    write_slice,
)
from tidemark.streaming.state import gated, live_intervals_on_state, merge_on_state, read_state
from tidemark.streaming.windowed import (
    DEFAULT_WATERMARK,
    await_complete,
    every_step,
    gate_click_show,
    gate_completion,
    rolling_on_stream,
    start,
    windowed_click_show,
    windowed_completion,
    with_event_time,
)

SPEC = SPECS["tumbling"]


@dataclass
class Replay:
    """A bounded stream of ``events`` (no watermark yet) and how to close its last windows."""

    stream: DataFrame
    scratch: str
    flush: Callable[[], None]
    watermark: str = DEFAULT_WATERMARK

    @property
    def timed(self) -> DataFrame:
        return with_event_time(self.stream, delay=self.watermark)


def event_replay(spark: SparkSession, sf_dir: str, scratch: str, max_files_per_trigger: int | None = None,
                 watermark: str = DEFAULT_WATERMARK) -> Replay:
    """``events`` of ``sf_dir`` as a stream. ``watermark`` must cover how far out of order the files are."""
    ev, flush = events(spark, sf_dir), f"{scratch}/flush"
    make_folder(spark, flush)
    data = table_stream(spark, sf_dir, "events", ev.schema, max_files_per_trigger)
    marker = read_files_stream(spark, flush, "*.parquet", ev.schema)
    return Replay(data.unionByName(marker), scratch,
                  lambda: write_flush_marker(ev, flush, "1000 days"), watermark)


#: Rows of a replay's micro-batch, per core: the windows they open are written to the state at once.
SLICE_ROWS = 50_000


def sliced_replay(spark: SparkSession, sf_dir: str, scratch: str) -> Replay:
    """``event_replay`` with a micro-batch per slice of time, oldest first, so that the open windows are those of two
    slices however large the table is. Slices have about as many rows each and end between two seconds; a table of
    one slice is read as it is."""
    ev, files = events(spark, sf_dir), state_partitions(spark)
    slices = -(-ev.count() // (SLICE_ROWS * files))
    if slices <= 1:
        return event_replay(spark, sf_dir, scratch)
    sec = epoch_seconds(ev, "ts")
    shares = [k / slices for k in range(1, slices)]
    bounds = sorted(set(ev.select(F.percentile_approx(sec, shares)).first()[0] or []))
    number = F.size(F.filter(F.lit(bounds), lambda b: b <= sec)) if bounds else F.lit(0)
    cut, into = f"{scratch}/cut", f"{scratch}/in/events.parquet"
    (ev.withColumn("__slice", number).repartition("__slice", F.pmod(F.xxhash64(*ev.columns), F.lit(files)))
     .write.partitionBy("__slice").parquet(cut))
    whole = spark.read.schema(StructType([*ev.schema.fields, StructField("__slice", IntegerType())])).parquet(cut)
    for k in range(len(bounds) + 1):
        write_slice(whole.where(F.col("__slice") == k).drop("__slice"), into, files, (k + 1) * files)
    remove_folder(spark, cut)
    return event_replay(spark, f"{scratch}/in", scratch, max_files_per_trigger=files)


def state_partitions(spark: SparkSession) -> int:
    """State partitions of a replay: one per core of the cluster."""
    return max(1, spark.sparkContext.defaultParallelism)


def run_replay(replay: Replay, begin: Callable[[], StreamingQuery], keep: bool = False) -> None:
    """Run the query over the table, then once more over the flush marker."""
    spark = replay.stream.sparkSession
    await_complete(begin())
    replay.flush()
    await_complete(begin())
    for name in ("flush",) if keep else ("flush", "checkpoint"):
        remove_folder(spark, f"{replay.scratch}/{name}")


def _run(agg: DataFrame, sink, replay: Replay, rocksdb: bool = False, keep: bool = False) -> None:
    run_replay(replay, lambda: start(agg, sink, f"{replay.scratch}/checkpoint",
                                     state_partitions=state_partitions(agg.sparkSession), rocksdb=rocksdb), keep)


def click_show_twin(replay: Replay, spec: WindowSpec = SPEC) -> DataFrame:
    agg = windowed_click_show(to_click_show(action_records(replay.timed), EVENTS_ACTION_CONFIG), spec, "u")
    sink = ResultTableSink(f"{replay.scratch}/out", gate_click_show(spec, "u"))
    _run(agg, sink, replay)
    return sink.read(replay.stream.sparkSession).select("t", "u", "clicks", "shows")


def completion_twin(replay: Replay, spec: WindowSpec = SPEC) -> DataFrame:
    agg = windowed_completion(vv_records(replay.timed), spec, "u", exact_scale=EXACT_SCALE)
    sink = ResultTableSink(f"{replay.scratch}/out", gate_completion(spec, "u", EXACT_SCALE))
    _run(agg, sink, replay)
    return sink.read(replay.stream.sparkSession).select("t", "u", "tm", "duration", "rpt")


def _tagged(replay: Replay, key: str) -> DataFrame:
    timed = replay.timed
    return tag_union(to_click_show(action_records(timed), EVENTS_ACTION_CONFIG), vv_records(timed), key)


def profile_twin(replay: Replay) -> DataFrame:
    tagged = _tagged(replay, "u")
    agg = (stream_windows(tagged, SPEC, "ts").groupBy(WINDOW_COL, *group_key("u", tagged))
           .agg(*user_profile_aggs(EXACT_SCALE)))
    sink = ResultTableSink(f"{replay.scratch}/out", lambda b: finish_user_profile(struct_to_trigger(b, SPEC), SPEC, "u", EXACT_SCALE))
    _run(agg, sink, replay)
    return sink.read(replay.stream.sparkSession).select("t", "u", "rt_u_click", "rt_u_reveal", "rt_u_rpt")


def feed_click_show_twin(replay: Replay, length: int) -> DataFrame:
    """A3 on a stream: tumbling windows per content item, no gate."""
    spec = WindowSpec(length)
    agg = windowed_click_show(to_click_show(action_records(replay.timed), EVENTS_ACTION_CONFIG), spec,
                              "contid")
    sink = ResultTableSink(f"{replay.scratch}/out", gate_click_show(spec, "contid"))
    _run(agg, sink, replay)
    return sink.read(replay.stream.sparkSession).select("t", "contid", "clicks", "shows")


def feed_completion_twin(replay: Replay, length: int) -> DataFrame:
    """A4 on a stream: tumbling windows per content item, no gate."""
    spec = WindowSpec(length)
    agg = windowed_completion(vv_records(replay.timed), spec, "contid", exact_scale=EXACT_SCALE)
    sink = ResultTableSink(f"{replay.scratch}/out", gate_completion(spec, "contid", EXACT_SCALE))
    _run(agg, sink, replay)
    return sink.read(replay.stream.sparkSession).select("t", "contid", "tm", "duration", "rpt")


def feed_profile_twin(replay: Replay) -> DataFrame:
    """A6 on a stream: 4 h windows per content item, shorter lengths by age
    against the window end."""
    lengths = tuple(FEEDS.values())
    spec = WindowSpec(max(lengths))
    wdf = stream_windows(_tagged(replay, "contid"), spec, "ts")

    def inside(L):
        if L >= spec.length:
            return F.lit(True)
        return F.col("ts") >= F.col(f"{WINDOW_COL}.end") - F.expr(f"INTERVAL {L} SECONDS")

    agg = wdf.groupBy(WINDOW_COL, "contid").agg(*feed_profile_aggs(lengths, inside, EXACT_SCALE))
    sink = ResultTableSink(f"{replay.scratch}/out", lambda b: finish_feed_profile(
        struct_to_trigger(b, spec), lengths, "contid", EXACT_SCALE))
    _run(agg, sink, replay)
    return sink.read(replay.stream.sparkSession).drop("batch_id")


def feed_profile_panes_twin(replay: Replay, step: int) -> DataFrame:
    """A6 on a stream at a short step, by two chained aggregates: sums per content item and pane (the longest
    time that divides all lengths and the step), then windows of the longest length over the panes."""
    lengths = tuple(FEEDS.values())
    spec = WindowSpec(max(lengths), step)
    pane = f"{math.gcd(*lengths, step)} seconds"
    panes = (_tagged(replay, "contid").groupBy(F.window("ts", pane).alias("__pane"), "contid")
             .agg(*feed_bucket_sums(EXACT_SCALE))
             .withColumn("ts", F.window_time("__pane")).withColumn("__from", F.col("__pane.start")).drop("__pane"))
    inside = lambda L: F.col("__from") >= F.col(f"{WINDOW_COL}.end") - F.expr(f"INTERVAL {L} SECONDS")
    agg = (stream_windows(panes, spec, "ts").groupBy(WINDOW_COL, "contid")
           .agg(*feed_profile_aggs_again(lengths, inside, EXACT_SCALE)))
    sink = ResultTableSink(f"{replay.scratch}/out", lambda b: finish_feed_profile(
        struct_to_trigger(b, spec), lengths, "contid", EXACT_SCALE))
    _run(agg, sink, replay)
    return sink.read(replay.stream.sparkSession).drop("batch_id")


def rolling_twin(replay: Replay) -> DataFrame:
    """T9 on a stream: rows meet the last two hours of their user in an interval join."""
    cs = to_click_show(action_records(replay.timed), EVENTS_ACTION_CONFIG).select("event_id", "ts", "u", "clicks", "shows")
    out = rolling_on_stream(cs, "u", ["clicks", "shows"], ROLLING_SECONDS)
    sink = ResultTableSink(f"{replay.scratch}/out")
    _run(out, sink, replay)
    return sink.read(replay.stream.sparkSession).select("event_id", "u", "sec", "rolling_clicks", "rolling_shows",
                                                        "rolling_n")


def live_twin(replay: Replay) -> DataFrame:
    """T2 on a stream: the declared 4 h feed window at the declared 1 s step, by timers."""
    cs = to_click_show(action_records(replay.timed), EVENTS_ACTION_CONFIG).select("ts", "contid", "clicks", "shows")
    out = live_intervals_on_state(cs, "contid", ["clicks", "shows"], FEEDS["4h"])
    sink = ResultTableSink(f"{replay.scratch}/out")
    _run(out, sink, replay, rocksdb=True)
    return sink.read(replay.stream.sparkSession).select("contid", "t_from", "t_to", "clicks", "shows", "n")


def processing_time_twin(replay: Replay, spec: WindowSpec = SPEC) -> DataFrame:
    """T5: a live stream, triggered every step of processing time; the marker closes its last windows."""
    agg = windowed_click_show(to_click_show(action_records(replay.timed), EVENTS_ACTION_CONFIG), spec, "u")
    sink = ResultTableSink(f"{replay.scratch}/out", gate_click_show(spec, "u"))
    q = start(agg, sink, f"{replay.scratch}/checkpoint", every_step(WindowSpec(1)),
              state_partitions=state_partitions(agg.sparkSession))
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    _run(agg, sink, replay)
    return sink.read(replay.stream.sparkSession).select("t", "u", "clicks", "shows")


FIRST_WRITE_COLS = ["t", "u", "store_key", "rt_u_click", "rt_u_reveal", "stored_click", "stored_reveal"]
ACCUMULATE_COLS = ["t", "u", "store_key", "rt_u_click", "rt_u_reveal"]
MOST_COLS = ["t", "u", "store_key", "most_clicks"]


def table_twin(replay: Replay, operation: KeyedOperation, cols) -> DataFrame:
    """A keyed operation into a keyed table, micro-batch by micro-batch."""
    agg = windowed_click_show(to_click_show(action_records(replay.timed), EVENTS_ACTION_CONFIG), SPEC, "u")
    sink = KeyedTableSink(f"{replay.scratch}/out", f"{replay.scratch}/state", operation, key="u", order="t",
                          key_template=USER_KEY_TEMPLATE, transform=gate_click_show(SPEC, "u"))
    _run(agg, sink, replay)
    return sink.read(replay.stream.sparkSession).select(*cols)


def gated_results(replay: Replay) -> DataFrame:
    """The flagship's results, ``(t, u, clicks, shows)``, as a stream with the gate inside the plan."""
    cs = to_click_show(action_records(replay.timed), EVENTS_ACTION_CONFIG)
    agg = gated(windowed_click_show(cs, SPEC, "u"), cs, SPEC)
    return struct_to_trigger(agg, SPEC).select(F.col(WINDOW_COL).alias("t"), grouped_key("u"), "clicks", "shows")


def keyed_twin(replay: Replay, operation: KeyedOperation, cols) -> DataFrame:
    """A keyed operation on the state store, chained after the window aggregate and its gate."""
    out = merge_on_state(gated_results(replay), operation, "u", "t", profile_key("u", USER_KEY_TEMPLATE))
    sink = ResultTableSink(f"{replay.scratch}/out")
    _run(out, sink, replay, rocksdb=True)
    return sink.read(replay.stream.sparkSession).select(*cols)


def store_twin(replay: Replay) -> DataFrame:
    """What the state store holds at the end (S3 as a reader sees it), read from the checkpoint."""
    op = FirstWrite()
    out = merge_on_state(gated_results(replay), op, "u", "t")
    sink = ResultTableSink(f"{replay.scratch}/out")
    _run(out, sink, replay, rocksdb=True, keep=True)
    stored = read_state(replay.stream.sparkSession, f"{replay.scratch}/checkpoint")
    return stored.select(profile_key("u", USER_KEY_TEMPLATE).alias("store_key"),
                         *[F.col(v).alias(n) for v, n in zip(op.values, op.names)])


def messages_click_show_twin(replay: Replay, on_state: bool = False) -> DataFrame:
    """Raw action messages, derived on the stream itself, through the app's click/show pipeline."""
    msgs, d, sinks = raw_action_messages(replay.stream), replay.scratch, []
    begin_app = start_click_show_on_state if on_state else start_click_show
    places = [f"{d}/out", f"{d}/checkpoint"] if on_state else [f"{d}/out", f"{d}/state", f"{d}/checkpoint"]

    def begin() -> StreamingQuery:
        q, sink = begin_app(msgs, SPECS["reference"], EVENTS_ACTION_CONFIG, *places, watermark=replay.watermark,
                            state_partitions=state_partitions(msgs.sparkSession))
        sinks[:] = [sink]
        return q

    run_replay(replay, begin)
    return sinks[0].read(msgs.sparkSession).select(*FIRST_WRITE_COLS)


LOG_PARTITIONS = 4


def log_twin(spark: SparkSession, sf: str) -> DataFrame:
    """Entry 1 from a message log (S1): a third of the messages lies there before the first start and is skipped, a third
    comes while the query runs, and a third after it was stopped, which it finds from its checkpoint's offsets."""
    ev, d = events(spark, sf), scratch_path(spark, "stream_log")
    root, msgs = f"{d}/log", raw_action_messages(ev).withColumn("ts", as_instant(ev, "ts"))
    sec, bounds = epoch_seconds(ev, "ts"), [newer_than(ev, k) for k in (1, 2)]
    thirds = [msgs.where(epoch_seconds(msgs, "ts") < bounds[0]),
              msgs.where((epoch_seconds(msgs, "ts") >= bounds[0]) & (epoch_seconds(msgs, "ts") < bounds[1])),
              msgs.where(epoch_seconds(msgs, "ts") >= bounds[1])]
    add = lambda df: append_messages(df, root, LOG_PARTITIONS)

    def begin(trigger: dict | None = None):
        return start_click_show(read_message_log(spark, root), SPEC, EVENTS_ACTION_CONFIG, f"{d}/out",
                                f"{d}/state", f"{d}/checkpoint", trigger, state_partitions=state_partitions(spark))

    add(thirds[0])
    q, _ = begin(every_step(WindowSpec(1)))
    try:
        q.processAllAvailable()
        add(thirds[1])
        q.processAllAvailable()
    finally:
        q.stop()
    add(thirds[2])
    marker = ev.agg(F.max(sec).alias("sec")).select(
        F.lit(FLUSH_USER).cast("string").alias("key"), F.timestamp_seconds(F.col("sec") + 86400).alias("ts"),
        F.to_json(F.struct(F.lit("click").alias("t"), F.lit(str(FLUSH_USER)).alias("u"), F.lit("-1").alias("contid"))).alias("value"))
    for last in (None, marker):
        if last is not None:
            add(last)
        q, sink = begin()
        await_complete(q)
    for name in ("log", "checkpoint"):
        remove_folder(spark, f"{d}/{name}")
    return sink.read(spark).select(*FIRST_WRITE_COLS)


def value_bytes_twin(replay: Replay) -> DataFrame:
    """User profiles stored by a stream as wire bytes, read back from the store."""
    tagged = _tagged(replay, "u")
    agg = (stream_windows(tagged, SPEC, "ts").groupBy(WINDOW_COL, *group_key("u", tagged))
           .agg(*user_profile_aggs(EXACT_SCALE)))

    def stored(batch: DataFrame) -> DataFrame:
        rows = finish_user_profile(struct_to_trigger(batch, SPEC), SPEC, "u", EXACT_SCALE)
        key = F.concat_ws(":", profile_key("u", USER_KEY_TEMPLATE), "t")
        return serialize_profile(rows.withColumn("store_key", key), "store_key", USER_PROFILE, "protobuf")

    sink = ResultTableSink(f"{replay.scratch}/out", stored)
    _run(agg, sink, replay)
    return read_profile(read_serialized(sink.read(replay.stream.sparkSession), "store_key", USER_PROFILE))


def messages_completion_twin(replay: Replay) -> DataFrame:
    """Raw video-view messages through the app's completion pipeline."""
    msgs, d, sinks = raw_vv_messages(replay.stream), replay.scratch, []

    def begin() -> StreamingQuery:
        q, sink = start_completion(msgs, SPECS["reference"], EVENTS_ACTION_CONFIG, f"{d}/out", f"{d}/checkpoint",
                                   watermark=replay.watermark, exact_scale=EXACT_SCALE,
                                   state_partitions=state_partitions(msgs.sparkSession))
        sinks[:] = [sink]
        return q

    run_replay(replay, begin)
    return sinks[0].read(msgs.sparkSession).select("t", "u", "tm", "duration", "rpt")


def _twin(name: str, build, replayed=event_replay):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        scratch = scratch_path(spark, name)
        out = build(replayed(spark, sf, scratch))
        remove_folder(spark, f"{scratch}/in")
        return out
    run.__name__ = f"q_{name}"
    return run


BATCHES = 6


def _batched(name: str, build, in_order: bool):
    """The table cut into ``BATCHES`` slices, a micro-batch per slice: by time, oldest first, with a watermark
    of one slice (its files come in any order), or spread over the whole time with one that covers it. A slice
    has a file per core, however many partitions the table is read in; its files are one trigger's."""
    def run(spark: SparkSession, sf: str) -> DataFrame:
        scratch, ev = scratch_path(spark, name), events(spark, sf)
        lo, hi = ev.select(F.min(epoch_seconds(ev, "ts")), F.max(epoch_seconds(ev, "ts"))).first()
        lo, span = lo or 0, (hi or 0) - (lo or 0) + 1
        sec = epoch_seconds(ev, "ts")
        part = F.floor((sec - lo) * BATCHES / span) if in_order else F.pmod("event_id", F.lit(BATCHES))
        files = state_partitions(spark)
        for k in range(BATCHES):
            ev.where(part == k).repartition(files).write.mode("append").parquet(f"{scratch}/in/events.parquet")
        replay = event_replay(spark, f"{scratch}/in", scratch, max_files_per_trigger=files,
                              watermark=f"{span // BATCHES + 10 if in_order else span} seconds")
        out = build(replay)
        remove_folder(spark, f"{scratch}/in")
        return out
    run.__name__ = f"q_{name}"
    return run


STREAM_QUERIES = {name: (_twin(name, build), twin) for name, build, twin in [
    ("stream_user_click_show", click_show_twin, "user_click_show_tumbling"),
    ("stream_user_click_show_gapped", lambda r: click_show_twin(r, SPECS["gapped"]), "user_click_show_gapped"),
    ("stream_user_completion", completion_twin, "user_completion_tumbling"),
    ("stream_user_completion_gapped", lambda r: completion_twin(r, SPECS["gapped"]), "user_completion_gapped"),
    ("stream_user_profile", profile_twin, "user_profile"),
    ("stream_feed_profile", feed_profile_twin, "feed_profile"),
    *[(f"stream_feed_click_show_{n}", lambda r, L=L: feed_click_show_twin(r, L), f"feed_click_show_{n}")
      for n, L in FEEDS.items()],
    *[(f"stream_feed_completion_{n}", lambda r, L=L: feed_completion_twin(r, L), f"feed_completion_{n}")
      for n, L in FEEDS.items()],
    ("stream_keyed_first_write", lambda r: keyed_twin(r, FirstWrite(), FIRST_WRITE_COLS), "keyed_first_write"),
    ("stream_keyed_accumulate", lambda r: keyed_twin(r, Accumulate(SPEC), ACCUMULATE_COLS), "keyed_accumulate"),
    ("stream_profile_store", store_twin, "profile_store"),
    ("stream_profile_value_bytes", value_bytes_twin, "profile_value_bytes"),
    ("stream_user_rolling", rolling_twin, "user_rolling"),
    ("stream_feed_click_show_4h_live", live_twin, "feed_click_show_4h_live"),
    ("stream_feed_profile_sliding", lambda r: feed_profile_panes_twin(r, 300), "feed_profile_sliding"),
    ("stream_user_click_show_every_step", processing_time_twin, "user_click_show_tumbling"),
    ("stream_messages_click_show_state", lambda r: messages_click_show_twin(r, True), "messages_click_show"),
]}
STREAM_QUERIES.update({name: (_twin(name, build, sliced_replay), twin) for name, build, twin in [
    ("stream_messages_click_show", messages_click_show_twin, "messages_click_show"),
    ("stream_messages_completion", messages_completion_twin, "messages_completion"),
]})
STREAM_QUERIES["stream_log_click_show"] = (log_twin, "messages_click_show_newer")
STREAM_QUERIES.update({name: (_batched(name, build, in_order), twin) for name, build, in_order, twin in [
    ("stream_user_click_show_batches", click_show_twin, False, "user_click_show_tumbling"),
    ("stream_keyed_first_write_batches", lambda r: keyed_twin(r, FirstWrite(), FIRST_WRITE_COLS), True,
     "keyed_first_write"),
    ("stream_keyed_accumulate_batches", lambda r: keyed_twin(r, Accumulate(SPEC), ACCUMULATE_COLS), True,
     "keyed_accumulate"),
    ("stream_keyed_custom_batches", lambda r: keyed_twin(r, KeepMost(), MOST_COLS), True, "keyed_most_clicks"),
    ("stream_keyed_table_batches", lambda r: table_twin(r, KeepMost(), MOST_COLS), True, "keyed_most_clicks"),
]})
