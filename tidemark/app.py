"""The two streaming pipelines of the original application, on Spark.

* click/show: action messages -> parse (P1-P6) -> windows with the gate ->
  per-user counts -> keyed first-write store (``USER_CLICK_SHOW_5MIN_<u>``);
* completion: video-view messages -> parse (P1-P4, P7) -> windows with the
  gate -> per-user watch time, duration and ratio -> result table.

Both read Kafka topics (``--kafka``), message logs with offsets (``--log``) or
folders of ``(key, value, ts)`` parquet message files, and trigger once per window step (``--once`` replays
what is available and stops). Run with ``spark-submit tidemark/app.py ...``
or call the ``start_*`` functions from a session.
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):  # run as a script: make the package importable
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.config import REFERENCE_SPEC, USER_KEY_TEMPLATE, ActionConfig, WindowSpec
from tidemark.functions.scalars import as_instant, profile_key
from tidemark.operators.parse import good, parse_actions, parse_vv
from tidemark.operators.windows import WINDOW_COL, grouped_key, struct_to_trigger
from tidemark.sources.message_log import read_message_log
from tidemark.streaming.state import gated, merge_on_state
from tidemark.streaming.windowed import (
    DEFAULT_WATERMARK,
    ROCKSDB_STATE_STORE,
    STATE_STORE,
    await_complete,
    every_step,
    gate_click_show,
    gate_completion,
    start,
    windowed_click_show,
    windowed_completion,
)
from tidemark.operators.operations import FirstWrite
from tidemark.streaming.sinks import KeyedTableSink, ResultTableSink
from tidemark.streaming.sources import read_kafka, read_message_files

HDFS_STATE_STORE = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"


def click_show_rows(messages: DataFrame, cfg: ActionConfig, watermark: str = DEFAULT_WATERMARK,
                    strict_strings: bool = False) -> DataFrame:
    """Click/show records of an action message stream, with a watermark."""
    m = messages.withColumn("ts", as_instant(messages, "ts")).withWatermark("ts", watermark)
    return good(parse_actions(m, cfg, strict_strings=strict_strings))


def click_show_stream(messages: DataFrame, spec: WindowSpec, cfg: ActionConfig,
                      watermark: str = DEFAULT_WATERMARK, strict_strings: bool = False) -> DataFrame:
    """Windowed per-user click/show aggregate of an action message stream."""
    return windowed_click_show(click_show_rows(messages, cfg, watermark, strict_strings), spec, key="u")


def completion_stream(messages: DataFrame, spec: WindowSpec, cfg: ActionConfig,
                      watermark: str = DEFAULT_WATERMARK, exact_scale: int | None = None,
                      strict_strings: bool = False) -> DataFrame:
    """Windowed per-user completion aggregate of a video-view message stream."""
    m = messages.withColumn("ts", as_instant(messages, "ts")).withWatermark("ts", watermark)
    return windowed_completion(good(parse_vv(m, cfg, strict_strings=strict_strings)), spec,
                               key="u", exact_scale=exact_scale)


def start_click_show(messages: DataFrame, spec: WindowSpec, cfg: ActionConfig, out: str,
                     state: str, checkpoint: str, trigger: dict | None = None,
                     state_partitions: int | None = None, strict_strings: bool = False,
                     watermark: str = DEFAULT_WATERMARK) -> tuple[StreamingQuery, KeyedTableSink]:
    """Click/show pipeline into the keyed first-write store, a table."""
    sink = KeyedTableSink(out, state, FirstWrite(), key="u", order="t",
                          key_template=USER_KEY_TEMPLATE, transform=gate_click_show(spec, "u"))
    q = start(click_show_stream(messages, spec, cfg, watermark, strict_strings), sink,
              checkpoint, trigger, state_partitions=state_partitions, lean=True)
    return q, sink


def start_click_show_on_state(messages: DataFrame, spec: WindowSpec, cfg: ActionConfig, out: str, checkpoint: str,
                              trigger: dict | None = None, state_partitions: int | None = None,
                              strict_strings: bool = False, watermark: str = DEFAULT_WATERMARK
                              ) -> tuple[StreamingQuery, ResultTableSink]:
    """The same pipeline with the first-write store on the state store; ``streaming.state.read_state`` reads it."""
    rows = click_show_rows(messages, cfg, watermark, strict_strings)
    results = struct_to_trigger(gated(windowed_click_show(rows, spec, "u"), rows, spec), spec).select(
        F.col(WINDOW_COL).alias("t"), grouped_key("u"), "clicks", "shows")
    sink = ResultTableSink(out)
    merged = merge_on_state(results, FirstWrite(), "u", "t", profile_key("u", USER_KEY_TEMPLATE))
    return start(merged, sink, checkpoint, trigger, state_partitions=state_partitions, rocksdb=True), sink


def start_completion(messages: DataFrame, spec: WindowSpec, cfg: ActionConfig, out: str,
                     checkpoint: str, trigger: dict | None = None,
                     exact_scale: int | None = None, state_partitions: int | None = None,
                     strict_strings: bool = False, watermark: str = DEFAULT_WATERMARK
                     ) -> tuple[StreamingQuery, ResultTableSink]:
    """Completion pipeline into a result table."""
    sink = ResultTableSink(out, gate_completion(spec, "u", exact_scale))
    q = start(completion_stream(messages, spec, cfg, watermark, exact_scale, strict_strings), sink,
              checkpoint, trigger, state_partitions=state_partitions, lean=True)
    return q, sink


def _args(argv=None):
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("--kafka", help="bootstrap servers; without it the sources are folders")
    p.add_argument("--log", action="store_true",
                   help="the folders are message logs, read from their newest offsets at the first start")
    p.add_argument("--actions", required=True, help="action topic, log or folder")
    p.add_argument("--views", required=True, help="video-view topic, log or folder")
    p.add_argument("--out", required=True, help="output folder (results, keyed store, checkpoints)")
    p.add_argument("--length", type=int, default=REFERENCE_SPEC.length)
    p.add_argument("--step", type=int, default=REFERENCE_SPEC.slide)
    p.add_argument("--mode", default=REFERENCE_SPEC.mode, choices=["inclusive", "half_open"])
    p.add_argument("--min-records", type=int, default=REFERENCE_SPEC.min_records)
    p.add_argument("--watermark", default=DEFAULT_WATERMARK,
                   help="how late a message may come; later ones end the run (see --allow-late)")
    p.add_argument("--allow-late", action="store_true",
                   help="drop messages later than the watermark instead of ending the run")
    p.add_argument("--kafka-option", action="append", default=[], metavar="NAME=VALUE",
                   help="further option of the Kafka source, e.g. maxOffsetsPerTrigger=1000000")
    p.add_argument("--once", action="store_true", help="process what is available, then stop")
    p.add_argument("--store", default="table", choices=["table", "state"],
                   help="where the click/show values are kept: a table reread in each batch, or Spark's state store")
    p.add_argument("--strict-strings", action="store_true",
                   help="reject messages whose fields are JSON numbers instead of strings")
    p.add_argument("--state-partitions", type=int, default=None,
                   help="state-store partitions of a new query (default: session setting)")
    for f in ("type_key", "user_key", "content_key", "watch_key", "duration_key",
              "click_value", "show_value"):
        p.add_argument("--" + f.replace("_", "-"), default=getattr(ActionConfig(), f))
    return p.parse_args(argv)


def main(argv=None) -> None:
    a = _args(argv)
    spark = SparkSession.builder.appName("tidemark").getOrCreate()
    if spark.conf.get(STATE_STORE, None) in (None, "", HDFS_STATE_STORE):
        spark.conf.set(STATE_STORE, ROCKSDB_STATE_STORE)  # open windows off the heap
    cfg = ActionConfig(a.type_key, a.user_key, a.content_key, a.watch_key, a.duration_key,
                       a.click_value, a.show_value)
    spec = WindowSpec(a.length, a.step, a.mode, a.min_records)
    if a.kafka:
        extra = dict(x.split("=", 1) for x in a.kafka_option)
        acts, views = (read_kafka(spark, a.kafka, topic, **extra) for topic in (a.actions, a.views))
    elif a.log:
        acts, views = read_message_log(spark, a.actions), read_message_log(spark, a.views)
    else:
        acts, views = read_message_files(spark, a.actions), read_message_files(spark, a.views)
    trigger = {"availableNow": True} if a.once else every_step(spec)
    out = a.out.rstrip("/")
    store = [f"{out}/user_click_show_state"] if a.store == "table" else []
    begin = start_click_show if a.store == "table" else start_click_show_on_state
    q1, _ = begin(acts, spec, cfg, f"{out}/user_click_show", *store, f"{out}/_checkpoints/click_show", trigger,
                  a.state_partitions, a.strict_strings, a.watermark)
    q2, _ = start_completion(views, spec, cfg, f"{out}/user_completion",
                          f"{out}/_checkpoints/completion", trigger,
                             state_partitions=a.state_partitions, strict_strings=a.strict_strings,
                             watermark=a.watermark)
    late = await_complete(q1, q2, fail_on_late=not a.allow_late)
    if late:
        print(f"{late} messages came later than the watermark allows and were dropped", file=sys.stderr)


if __name__ == "__main__":
    main()
