"""Keyed merges and live sets on Spark's state store.

``merge_on_state`` keeps one value per key in a ``transformWithState``
operator chained after the window aggregate, so a result reaches its key's
stored value without rereading a table: a micro-batch touches only the keys
that have results in it, the state store keeps deltas and snapshots, and a
replayed batch starts from the state before it (the checkpoint pins both).
Keys reach the operator in buckets, so that what a call of it and a row cost is shared by many.
The key's partition sees at most one result per window and key, whatever the
skew of the raw rows, because the window aggregate comes first.

``live_intervals_on_state`` holds what is live in a sliding window of whole
seconds per key: a second's records enter when they are summed and an
event-time timer fires when they leave. State is one entry per second and key
inside the window.

``gated`` is the two-record gate as a plan: window totals joined to the
aggregate on the window, both closed by the same watermark.

Both operators need the RocksDB state store; ``start`` of ``windowed`` sets it
for a query (``rocksdb=True``). ``read_state`` reads a checkpoint's stored
values as a table.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tidemark import config
from tidemark.config import WindowSpec
from tidemark.operators import joins, operations
from tidemark.operators.operations import KeyedOperation, ValueOps
from tidemark.operators.windows import WINDOW_COL, stream_windows

# The processors and the operations they run travel to the Python workers by value: the worker that Spark starts
# beside the driver to set a query up sees no shipped files. A user's own operation class must be importable there, or
# registered in the same way.
for _module in (sys.modules[__name__], operations, joins, config):
    cloudpickle.register_pickle_by_value(_module)

STORED, LIVE, LEAVING = "stored", "live", "leaving"  # state variables


def gated(agg: DataFrame, rows: DataFrame, spec: WindowSpec, ts: str = "ts") -> DataFrame:
    """The rows of a streaming window aggregate whose window has at least ``spec.min_records`` records.

    ``rows`` is the aggregate's input. Totals are one partial row per task and
    window; a window's rows and its total are closed by the same watermark,
    so the join meets them in one micro-batch and holds only the totals in its state.
    """
    if spec.min_records <= 1:
        return agg
    totals = (stream_windows(rows, spec, ts).groupBy(WINDOW_COL).agg(F.count(F.lit(1)).alias("__total"))
              .where(F.col("__total") >= spec.min_records))
    # the totals first: only rows of the left side that are about to leave are held by the join, those of the right pass
    return totals.join(agg, WINDOW_COL).select(*agg.columns)


# Groups of keys that go to the stateful operator at once: fixed, as the state is kept by group.
BUCKETS = 1 << 13
_BUCKET, _PACK = "__bucket", "__pack"
_PACK_BYTES = 32 << 20  # of Arrow data that a task sorts into packs at once


def _pack(batch: pa.RecordBatch | pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write(batch)
    return sink.getvalue().to_pybytes()


def _unpack(pack: bytes) -> pa.Table:
    return pa.ipc.open_stream(pack).read_all()


def _packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with a bucket as ``(bucket, pack)``: one pack for the rows of a bucket, or several of a large task."""
    held: list[pa.RecordBatch] = []

    def dealt() -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        order = pc.sort_indices(table[_BUCKET])
        table, buckets = table.drop_columns([_BUCKET]).take(order), table[_BUCKET].take(order).to_numpy()
        firsts = [0, *(np.flatnonzero(np.diff(buckets)) + 1).tolist()] if len(buckets) else []
        for at in range(0, len(firsts), 64):
            some = firsts[at:at + 65]
            ends = [*some[1:], len(buckets)] if len(some) <= 64 else some[1:]
            yield pa.RecordBatch.from_arrays(
                [pa.array([buckets[a] for a in some[:len(ends)]], pa.int32()),
                 pa.array([_pack(table.slice(a, b - a).combine_chunks()) for a, b in zip(some, ends)], pa.binary())],
                [_BUCKET, _PACK])

    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) >= _PACK_BYTES:
            yield from dealt()
            held = []
    if held:
        yield from dealt()


def _rows_of_packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for pack in batch.column(0):
            yield from _unpack(pack.as_py()).to_batches(max_chunksize=10_000)


class _Merge(StatefulProcessor):
    """Rows of a key in order, each with the value stored before it; the value after the last is kept.

    The operator's group is a bucket of keys, its state a map of their values: a key's own value is
    read once in a batch and written if it changed.
    """

    def __init__(self, op: KeyedOperation, key: str, key_type: str, order: str, columns: list[str]):
        self.op, self.key, self.key_type, self.order, self.columns = op, key, key_type, order, columns
        self.names = list(op.fields())

    def init(self, handle) -> None:
        self.stored = handle.getMapState(STORED, f"`{self.key}` {self.key_type}",
                                         ", ".join(f"{n} {t}" for n, t in self.op.fields().items()))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        # the windows that closed since the last batch
        table = pa.concat_tables([_unpack(r[_PACK]) for r in rows]).combine_chunks()
        keys, at = table[self.key].to_pylist(), table[self.order].to_pylist()
        own = list(zip(*[table[f"__s_{n}"].to_pylist() for n in self.names]))
        members: dict = {}
        for i in sorted(range(len(keys)), key=at.__getitem__):
            members.setdefault(keys[i], []).append(i)
        before: list = [None] * len(keys)
        for k, its in members.items():
            held = self.stored.getValue((k,))
            first = state = dict(zip(self.names, held)) if held is not None else dict.fromkeys(self.names)
            for i in its:
                before[i] = state
                state = self.op.merge(state, dict(zip(self.names, own[i])), ValueOps)
            if held is None or state != first:
                self.stored.updateValue((k,), tuple(state[n] for n in self.names))
        out = table.select(self.columns)
        for n in self.names:
            out = out.append_column(f"__b_{n}", pa.array([b[n] for b in before], table.schema.field(f"__s_{n}").type))
        yield Row(**{_PACK: _pack(out)})

    def close(self) -> None:
        pass


def merge_on_state(results: DataFrame, op: KeyedOperation, key: str = "u", order: str = "t",
                   store_key: Column | None = None) -> DataFrame:
    """``(order, key, [store_key], *returned)`` of a stream of results, merged per key in the state store.

    A micro-batch's results of a key are merged in ``order``; results of later
    batches come later, as windows close in the order of the watermark. Rows go to the
    Python workers and back as packs of Arrow data, one for a bucket of keys.
    """
    columns = results.columns
    lifted = results.select(*columns, *[c.cast(op.fields()[n]).alias(f"__s_{n}") for n, c in op.lift(order).items()])
    bucket = F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int").alias(_BUCKET)
    packs = lifted.select("*", bucket).repartition(_BUCKET).mapInArrow(_packs, f"{_BUCKET} int, {_PACK} binary")
    out = packs.groupBy(_BUCKET).transformWithState(
        _Merge(op, key, results.schema[key].dataType.simpleString(), order, columns), f"{_PACK} binary", "Append", "None")
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in results.schema.fields]
                       + [f"`__b_{n}` {t}" for n, t in op.fields().items()])
    out = out.mapInArrow(_rows_of_packs, schema)
    before = F.struct(*[F.col(f"__b_{n}").alias(n) for n in op.fields()])
    out = op.project(out.withColumn("__before", before), key, order)
    return out if store_key is None else out.withColumn("store_key", store_key)


class _Live(StatefulProcessor):
    """Sums of the records live per key, as intervals between the seconds at which they change."""

    def __init__(self, key: str, values: list[str], length: int):
        self.key, self.values, self.length = key, values, length

    def init(self, handle) -> None:
        self.handle = handle
        sums = ", ".join(f"`{v}` bigint" for v in (*self.values, "n"))
        self.live = handle.getValueState(LIVE, f"since bigint, {sums}")
        self.leaving = handle.getMapState(LEAVING, "sec bigint", sums)

    def _change(self, key, at: int, live: list[int], change: tuple, sign: int) -> Iterator[Row]:
        since, *sums = live
        if at > since and sums[-1]:
            yield Row(**{self.key: key[0], "t_from": since, "t_to": at}, **dict(zip((*self.values, "n"), sums)))
        live[:] = [at, *[a + sign * b for a, b in zip(sums, change)]]

    def _until(self, key, live: list[int], pending: list[int], enters: dict[int, tuple], end: int) -> Iterator[Row]:
        """Changes up to second ``end``: entries one second after their own, departures ``length`` later."""
        changes = sorted([(s + 1, 1, s) for s in enters] + [(s + 1 + self.length, -1, s) for s in pending
                                                            if s + 1 + self.length <= end])
        added = set(enters)
        at = 0
        while at < len(changes):
            second = changes[at][0]
            total = [0] * (len(self.values) + 1)
            while at < len(changes) and changes[at][0] == second:
                _, sign, s = changes[at]
                held = enters[s] if s in added else tuple(self.leaving.getValue((s,)))
                total = [a + sign * b for a, b in zip(total, held)]
                if sign < 0:
                    self.leaving.removeKey((s,))
                at += 1
            yield from self._change(key, second, live, tuple(total), 1)

    def _held(self) -> list[int]:
        held = self.live.get()
        return list(held) if held is not None else [0] * (len(self.values) + 2)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        live = self._held()
        enters = {r["sec"]: tuple(r[v] for v in (*self.values, "n")) for r in rows}
        pending = sorted({k[0] for k in self.leaving.keys()} | set(enters))
        for s, sums in enters.items():
            self.leaving.updateValue((s,), sums)
        end = max(enters) + 1
        yield from self._until(key, live, pending, enters, end)
        self.live.update(tuple(live))
        self._alarm(pending, end)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        live = self._held()
        pending = sorted(k[0] for k in self.leaving.keys())
        # rows of a second reach this operator once the watermark is past its end: all up to it have entered
        end = timerValues.getCurrentWatermarkInMs() // 1000
        yield from self._until(key, live, pending, {}, end)
        self.live.update(tuple(live))
        self._alarm(pending, end)

    def _alarm(self, pending: list[int], end: int) -> None:
        """One timer: when the oldest second still live leaves."""
        wanted = next(((s + 1 + self.length) * 1000 for s in pending if s + 1 + self.length > end), None)
        timers = list(self.handle.listTimers())
        for old in timers:
            if old != wanted:
                self.handle.deleteTimer(old)
        if wanted is not None and wanted not in timers:
            self.handle.registerTimer(wanted)

    def close(self) -> None:
        pass


def live_intervals_on_state(rows: DataFrame, key: str, values: list[str], length: int, ts: str = "ts") -> DataFrame:
    """The stream's twin of ``windows.live_intervals``: ``(key, t_from, t_to, *values, n)``.

    ``rows`` has a watermark on ``ts``. Rows are summed per (key, second)
    first, so a hot key brings one row per second to its state. An interval
    is emitted when a record that enters or leaves ends it.
    """
    w = F.window(ts, "1 second")
    sums = (rows.groupBy(w.alias(WINDOW_COL), key)
            .agg(*[F.sum(F.coalesce(F.col(v), F.lit(0)).cast("bigint")).alias(v) for v in values],
                 F.count(F.lit(1)).alias("n")))
    seconds = sums.select(F.window_time(WINDOW_COL).alias(ts), F.unix_timestamp(F.col(f"{WINDOW_COL}.start")).alias("sec"),
                          key, *values, "n")
    kind = rows.schema[key].dataType.simpleString()
    schema = ", ".join([f"`{key}` {kind}", "t_from bigint", "t_to bigint", *[f"`{v}` bigint" for v in values], "n bigint"])
    return seconds.groupBy(key).transformWithState(_Live(key, list(values), length), schema, "Append", "EventTime")


def read_state(spark: SparkSession, checkpoint: str, variable: str = STORED, operator: int = 0) -> DataFrame:
    """Stored values of a checkpoint's latest committed batch: the key's columns and the value's fields."""
    state = (spark.read.format("statestore").option("path", checkpoint).option("operatorId", operator)
             .option("stateVarName", variable).load())
    if "value" in state.columns:
        return state.select("key.*", "value.*")
    return state.select("key.*", "user_map_key.*", "user_map_value.*").drop(_BUCKET)
