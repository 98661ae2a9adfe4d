"""Streaming pipelines: parse/adapt -> watermark -> window aggregate
(append mode) -> ``foreachBatch`` gate -> sink.

In append mode a window is emitted once, when the watermark passes its end,
and all keys of that window are emitted in the same micro-batch. The
two-record gate (a per-window total over all keys) is therefore exact when
applied to each micro-batch with the batch operator. Triggers run every
``step`` (T5) on a live stream, or ``availableNow`` for a bounded replay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.config import WindowSpec
from tidemark.functions.scalars import as_instant
from tidemark.operators.metrics import completion_sums, finish_click_show, finish_completion
from tidemark.operators.windows import (
    GROUP_COLS,
    WINDOW_COL,
    group_key,
    stream_windows,
    struct_to_trigger,
)

DEFAULT_WATERMARK = "10 seconds"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB_STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Without a read before each write (which only counts the stored rows for the progress report), and with a batch's
# changes written at its end instead of the store's files.
LEAN_ROCKSDB = {"spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
                "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}


def with_event_time(stream: DataFrame, ts: str = "ts", delay: str = DEFAULT_WATERMARK) -> DataFrame:
    """Event-time column as an instant, with a watermark of ``delay``."""
    return stream.withColumn(ts, as_instant(stream, ts)).withWatermark(ts, delay)


def windowed_click_show(stream: DataFrame, spec: WindowSpec, key: str = "u",
                        ts: str = "ts") -> DataFrame:
    """Streaming ``(w, *GROUP_COLS, clicks, shows, __n)`` per window (append mode)."""
    return (stream_windows(stream, spec, ts).groupBy(WINDOW_COL, *group_key(key, stream))
            .agg(F.sum("clicks").alias("clicks"), F.sum("shows").alias("shows"),
                 F.count(F.lit(1)).alias("__n")))


def windowed_completion(stream: DataFrame, spec: WindowSpec, key: str = "u", ts: str = "ts",
                        exact_scale: int | None = None) -> DataFrame:
    """Streaming ``(w, *GROUP_COLS, <sums>, __n)`` per window (append mode)."""
    return (stream_windows(stream, spec, ts).groupBy(WINDOW_COL, *group_key(key, stream))
            .agg(*completion_sums(exact_scale), F.count(F.lit(1)).alias("__n")))


def gate_click_show(spec: WindowSpec, key: str = "u"):
    """Batch transform for ``foreachBatch``: gate, then ``(t, key, clicks, shows)``."""
    return lambda batch: finish_click_show(struct_to_trigger(batch, spec), spec, key)


def gate_completion(spec: WindowSpec, key: str = "u", exact_scale: int | None = None):
    """Batch transform for ``foreachBatch``: gate, then ``(t, key, tm, duration, rpt)``
    (``exact_scale`` as given to ``windowed_completion``)."""
    return lambda batch: finish_completion(struct_to_trigger(batch, spec), spec, key, exact_scale)


def every_step(spec: WindowSpec) -> dict:
    """Trigger of a live stream: one micro-batch per window step (T5)."""
    return {"processingTime": f"{spec.slide} seconds"}


class LateRows(RuntimeError):
    """A watermark dropped rows: it was too short for how late the input came."""


def await_complete(*queries: StreamingQuery, fail_on_late: bool = True, poll: float = 2.0) -> int:
    """Wait until the queries end; the number of rows their watermarks dropped.

    When one fails, or drops late rows (``fail_on_late``), the others are
    stopped and the error is raised. Progress is read while the queries run,
    so no micro-batch's report is missed.
    """
    dropped: dict[tuple, int] = {}
    while True:
        active = [q.isActive for q in queries]
        for q in queries:
            for p in q.recentProgress:
                dropped[q.runId, p["batchId"]] = max(dropped.get((q.runId, p["batchId"]), 0), sum(
                    o.get("numRowsDroppedByWatermark", 0) for o in p["stateOperators"]))
        late = sum(dropped.values())
        error = next((q.exception() for q in queries if q.exception() is not None), None)
        if error is not None or (late and fail_on_late):
            for q in queries:
                q.stop()
            raise error or LateRows(f"{late} rows came later than the watermark allows; use a longer one")
        if not any(active):
            return late
        next(q for q, on in zip(queries, active) if on).awaitTermination(poll)


def start(agg: DataFrame, sink, checkpoint: str, trigger: dict | None = None,
          name: str | None = None, state_partitions: int | None = None, rocksdb: bool = False,
          lean: bool = False) -> StreamingQuery:
    """Start ``agg`` in append mode into a ``foreachBatch`` sink.

    ``trigger`` is passed to ``DataStreamWriter.trigger``; the default is a
    bounded replay (``availableNow``). ``state_partitions`` sets the number
    of state-store partitions of a new query (it is then fixed by the
    checkpoint), ``rocksdb`` its state store, ``lean`` how a RocksDB store writes
    (``LEAN_ROCKSDB``); the query's session is cloned at start, so the caller's
    session settings are restored right after.
    """
    w = (agg.writeStream.outputMode("append").foreachBatch(sink)
         .option("checkpointLocation", checkpoint))
    if name:
        w = w.queryName(name)
    w = w.trigger(**(trigger or {"availableNow": True}))
    conf = agg.sparkSession.conf
    wanted = {"spark.sql.shuffle.partitions": state_partitions and str(state_partitions),
              STATE_STORE: ROCKSDB_STATE_STORE if rocksdb else None}
    wanted.update(LEAN_ROCKSDB if lean else {})
    before = {k: conf.get(k, None) for k, v in wanted.items() if v}
    try:
        for k in before:
            conf.set(k, wanted[k])
        return w.start()
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)


def rolling_on_stream(rows: DataFrame, key: str, values: list[str], length: int, ts: str = "ts") -> DataFrame:
    """The stream's twin of ``windows.rolling_sums`` (T9): every row with ``sec`` and the sums of ``values`` over
    the same key's rows of the ``length`` seconds before it, its own second included.

    A stream-to-stream interval join: rows meet the sums per (key, second) of
    their last ``length`` seconds, so a hot key pairs a row with one row a second at
    most; both sides leave the state when the watermark is past their interval. The join's
    rows are summed again per row, which comes out once the watermark has passed it.
    """
    keyed = rows.where(F.col(ts).isNotNull()).withColumns(dict(zip(GROUP_COLS, group_key(key, rows))))
    sums = (keyed.groupBy(F.window(ts, "1 second").alias(WINDOW_COL), *[F.col(c).alias(f"__r{c}") for c in GROUP_COLS])
            .agg(*[F.sum(F.coalesce(F.col(v), F.lit(0))).alias(f"__r_{v}") for v in values],
                 F.count(F.lit(1)).alias("__r_n"))
            .withColumn("__at", F.window_time(WINDOW_COL))
            .withColumn("__sec", F.unix_timestamp(F.col(f"{WINDOW_COL}.start"))).drop(WINDOW_COL))
    left = keyed.withColumn("sec", F.unix_timestamp(ts))
    # bounds on the event times let Spark drop state; whole seconds decide
    near = (F.col("__at") >= F.col(ts) - F.expr(f"INTERVAL {length + 1} SECONDS")) & (
        F.col("__at") <= F.col(ts) + F.expr("INTERVAL 1 SECOND"))
    exact = F.col("__sec").between(F.col("sec") - length, F.col("sec"))
    same = [F.col(c) == F.col(f"__r{c}") for c in GROUP_COLS]
    joined = left.join(sums, [*same, near, exact])
    return (joined.groupBy(*rows.columns, "sec")
            .agg(*[F.sum(f"__r_{v}").alias(f"rolling_{v}") for v in values], F.sum("__r_n").alias("rolling_n")))


def console(agg: DataFrame, trigger: dict | None = None) -> StreamingQuery:
    """Print every emitted window."""
    return (agg.writeStream.outputMode("append").format("console")
            .option("truncate", "false").trigger(**(trigger or {"availableNow": True})).start())
