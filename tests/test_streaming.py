"""Stream = batch: the events table split into time-ordered files, one file
per micro-batch, must give the batch twin's results; so must a query that
stops and restarts from its checkpoint."""

import os
import tempfile
from unittest import mock

import pytest
from pyspark.sql import functions as F

from tidemark.config import USER_KEY_TEMPLATE, WindowSpec
from tidemark.plans.catalog import QUERIES, SPECS
from tidemark.plans.streaming import (
    ACCUMULATE_COLS,
    FIRST_WRITE_COLS,
    SPEC,
    click_show_twin,
    completion_twin,
    event_replay,
    feed_click_show_twin,
    feed_completion_twin,
    feed_profile_twin,
    MOST_COLS,
    feed_profile_panes_twin,
    gated_results,
    keyed_twin,
    live_twin,
    messages_click_show_twin,
    messages_completion_twin,
    processing_time_twin,
    profile_twin,
    rolling_twin,
    run_replay,
    store_twin,
    table_twin,
)
from tidemark.operators.metrics import to_click_show
from tidemark.app import start_click_show, start_completion
from tidemark.sources.adapters import EVENTS_ACTION_CONFIG, action_records, raw_action_messages, raw_vv_messages
from tidemark.operators.operations import Accumulate, FirstWrite, KeepMost, KeyedOperation
from tidemark.streaming.sinks import KeyedTableSink, ResultTableSink, SegmentedTable
from tidemark.streaming.sources import kafka_options
from tidemark.streaming.windowed import LateRows, await_complete, every_step, gate_click_show, start, windowed_click_show

from conftest import SF_SMALL

N_FILES = 8
LONG = "40 days"  # covers the whole table


def _split(spark, part):
    d = tempfile.mkdtemp(prefix="tidemark-split-")
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    for k in range(N_FILES):
        ev.filter(part(ev) == k).coalesce(1).write.mode("append").parquet(f"{d}/events.parquet")
    return d


@pytest.fixture(scope="module")
def ordered_dir(spark):
    """events of sf0.001 as a folder of N_FILES files, oldest first."""
    n = spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    return _split(spark, lambda ev: F.floor(F.col("event_id") * N_FILES / n))


@pytest.fixture(scope="module")
def mixed_dir(spark):
    """The same with every file spread over the whole time."""
    return _split(spark, lambda ev: F.pmod("event_id", F.lit(N_FILES)))


def _rows(df, cols):
    norm = lambda v: "nan" if isinstance(v, float) and v != v else v
    return sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)


def _replay(spark, folder, watermark=LONG):
    return event_replay(spark, folder, tempfile.mkdtemp(prefix="tidemark-stream-"), 1, watermark)


TWINS = {
    "user_click_show_tumbling": click_show_twin,
    "user_click_show_gapped": lambda r: click_show_twin(r, SPECS["gapped"]),
    "user_completion_tumbling": completion_twin,
    "user_profile": profile_twin,
    "feed_profile": feed_profile_twin,
    "feed_click_show_5m": lambda r: feed_click_show_twin(r, 300),
    "feed_completion_5m": lambda r: feed_completion_twin(r, 300),
    "keyed_first_write": lambda r: keyed_twin(r, FirstWrite(), FIRST_WRITE_COLS),
    "keyed_accumulate": lambda r: keyed_twin(r, Accumulate(SPEC), ACCUMULATE_COLS),
    "keyed_most_clicks": lambda r: table_twin(r, KeepMost(), MOST_COLS),
    "profile_store": store_twin,
    "user_rolling": rolling_twin,
    "feed_click_show_4h_live": live_twin,
    "feed_profile_sliding": lambda r: feed_profile_panes_twin(r, 300),
    "messages_click_show": messages_click_show_twin,
    "messages_completion": messages_completion_twin,
}


@pytest.mark.parametrize("name", sorted(TWINS))
def test_stream_equals_batch_out_of_order(spark, mixed_dir, name):
    """A folder of files in no order of time, one per micro-batch, and a sufficient watermark."""
    want = QUERIES[name](spark, SF_SMALL)
    assert _rows(TWINS[name](_replay(spark, mixed_dir)), want.columns) == _rows(want, want.columns)


def test_late_rows_end_the_run(spark, mixed_dir):
    with pytest.raises(LateRows):
        click_show_twin(_replay(spark, mixed_dir, "10 seconds"))


IN_ORDER = {
    "keyed_first_write": lambda r: keyed_twin(r, FirstWrite(), FIRST_WRITE_COLS),
    "keyed_accumulate": lambda r: table_twin(r, Accumulate(SPEC), ACCUMULATE_COLS),
    "keyed_most_clicks": lambda r: keyed_twin(r, KeepMost(), MOST_COLS),
    "user_rolling": rolling_twin,
    "feed_click_show_4h_live": live_twin,
    "feed_profile_sliding": lambda r: feed_profile_panes_twin(r, 300),
    "user_click_show_tumbling": processing_time_twin,
}


@pytest.mark.parametrize("name", sorted(IN_ORDER))
def test_stream_equals_batch_across_batches(spark, ordered_dir, name):
    """The oldest file first, one per micro-batch and a short watermark: results come batch by batch."""
    replay = _replay(spark, ordered_dir, "10 seconds")
    want = QUERIES[name](spark, SF_SMALL)
    assert _rows(IN_ORDER[name](replay), want.columns) == _rows(want, want.columns)
    assert SegmentedTable(f"{replay.scratch}/out").read(spark).select("batch_id").distinct().count() > 3


def _click_show(replay):
    return windowed_click_show(to_click_show(action_records(replay.timed), EVENTS_ACTION_CONFIG), SPEC, "u")


def test_keyed_sink_compaction(spark, ordered_dir):
    """Snapshots every two batches give the same keyed results."""
    replay = _replay(spark, ordered_dir, "10 seconds")
    d = replay.scratch
    sink = KeyedTableSink(f"{d}/out", f"{d}/state", Accumulate(SPEC), key="u", order="t",
                          key_template=USER_KEY_TEMPLATE, transform=gate_click_show(SPEC, "u"), compact_every=2)
    run_replay(replay, lambda: start(_click_show(replay), sink, f"{d}/checkpoint"))
    got = spark.read.parquet(f"{d}/out")
    assert _rows(got, ACCUMULATE_COLS) == _rows(QUERIES["keyed_accumulate"](spark, SF_SMALL), ACCUMULATE_COLS)


def test_restart_from_checkpoint(spark, ordered_dir):
    """Stop after two files, restart on the same checkpoint: same result."""
    replay = _replay(spark, ordered_dir, "10 seconds")
    d = replay.scratch
    sink = ResultTableSink(f"{d}/out", gate_click_show(SPEC, "u"))
    q = start(_click_show(replay), sink, f"{d}/checkpoint", {"processingTime": "0 seconds"})
    while (q.lastProgress or {}).get("batchId", -1) < 1:
        q.awaitTermination(0.2)
    q.stop()
    run_replay(replay, lambda: start(_click_show(replay), sink, f"{d}/checkpoint"))
    want = QUERIES["user_click_show_tumbling"](spark, SF_SMALL)
    assert _rows(spark.read.parquet(f"{d}/out"), want.columns) == _rows(want, want.columns)


def test_processing_time_trigger(spark, ordered_dir):
    """T5: a live stream runs one micro-batch per step."""
    assert every_step(WindowSpec(5, 1)) == {"processingTime": "1 seconds"}
    replay = _replay(spark, ordered_dir, "10 seconds")
    sink = ResultTableSink(f"{replay.scratch}/out", gate_click_show(SPEC, "u"))
    q = start(_click_show(replay), sink, f"{replay.scratch}/checkpoint", every_step(WindowSpec(5, 1)))
    while (q.lastProgress or {}).get("batchId", -1) < 2:
        q.awaitTermination(0.2)
    starts = [p["timestamp"] for p in q.recentProgress]
    q.stop()
    assert len(set(starts)) == len(starts) >= 3


def test_streaming_accumulate_refuses_overlap():
    with pytest.raises(ValueError):
        Accumulate(spec=WindowSpec(300, 60))
    with pytest.raises(TypeError):
        Accumulate()
    Accumulate(spec=WindowSpec(300))


def test_user_defined_keyed_operation(spark):
    """K3: any object with state() and merge_batch() drives the keyed table."""
    class KeepMax:
        def state(self, deltas, key, order):
            return deltas.groupBy(key).agg(F.max("best").alias("best"))

        def merge_batch(self, batch, state, key, order):
            best = batch.groupBy(key).agg(F.max("clicks").alias("best"))
            if state is not None:
                best = best.unionByName(state).groupBy(key).agg(F.max("best").alias("best"))
            return best, best

    d = tempfile.mkdtemp(prefix="tidemark-k3-")
    sink = KeyedTableSink(f"{d}/o", f"{d}/s", KeepMax(), key="u", order="t")
    schema = "t long, u string, clicks long"
    sink(spark.createDataFrame([(1, "a", 3), (1, "b", 1)], schema), 0)
    sink(spark.createDataFrame([(2, "a", 2), (2, "b", 5)], schema), 1)
    got = {(r["batch_id"], r["u"], r["best"]) for r in sink.read(spark).collect()}
    assert got == {(0, "a", 3), (0, "b", 1), (1, "a", 3), (1, "b", 5)}


@pytest.fixture
def without_aqe(spark):
    """As inside foreachBatch of a stateful stream."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


STORES = {"first": (FirstWrite(), ["t", "u", "rt_u_click", "stored_click"]), "total": (Accumulate(SPEC), ["t", "u", "rt_u_click"]),
          "most": (KeepMost(), ["t", "u", "most_clicks"])}


def _results(n):
    """n batches of one result for some of 7 users."""
    return [[(300 * b, f"u{u}", (b * 5 + u * 3) % 11, 1) for u in range(7) if (b + u) % 3] for b in range(n)]


def _one_pass(batches):
    stored, out = {}, {k: [] for k in STORES}
    for t, u, c, _ in (r for b in batches for r in b):
        first, total, most = stored.get(u, (None, 0, None))
        out["first"].append((t, u, c if first is None else first + c, c if first is None else first))
        out["total"].append((t, u, total + c))
        out["most"].append((t, u, c if most is None else max(most, c)))
        stored[u] = (c if first is None else first, total + c, c if most is None else max(most, c))
    return {k: sorted(v) for k, v in out.items()}, stored


def _run_batches(spark, sink, batches, crash=()):
    """Every batch is replayed; before some, a try of it dies at one of its writes."""
    for n, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "t long, u string, clicks long, shows long").coalesce(1)
        if n in crash:
            done, commit = [], SegmentedTable._commit

            def dies(self, spark_, df_, segment):
                if len(done) == crash[n]:
                    df_.write.mode("overwrite").parquet(self._folder(segment))  # written, not committed
                    raise OSError("lost")
                done.append(segment)
                commit(self, spark_, df_, segment)

            SegmentedTable._commit = dies
            try:
                with pytest.raises(OSError):
                    sink(df, n)
            finally:
                SegmentedTable._commit = commit
        sink(df, n)
        sink(df, n)


@pytest.mark.parametrize("kind", sorted(STORES))
def test_keyed_table_survives_replays_and_crashes(spark, without_aqe, kind):
    """Each of 20 batches replayed, some after a crash between a write and its commit: as one pass."""
    d = tempfile.mkdtemp(prefix="tidemark-replay-")
    op, cols = STORES[kind]
    batches = _results(20)
    sink = KeyedTableSink(f"{d}/o", f"{d}/s", op, compact_every=3)
    _run_batches(spark, sink, batches, crash={2: 0, 3: 1, 6: 0, 9: 2, 15: 0})
    want, _ = _one_pass(batches)
    assert sorted(tuple(r[c] for c in cols) for r in sink.read(spark).collect()) == want[kind]


def test_keyed_table_follows_changed_parameters(spark, without_aqe):
    """``compact_every`` changes at restarts; folders stay few; the stored values are those of one pass."""
    import os

    d = tempfile.mkdtemp(prefix="tidemark-params-")
    batches, n = _results(60), 0
    for k, every in enumerate((2, 3, 10, 2, 5, 3)):
        sink = KeyedTableSink(f"{d}/o", f"{d}/s", Accumulate(SPEC), compact_every=every)
        for b in range(10 * k, 10 * k + 10):
            sink(spark.createDataFrame(batches[b], "t long, u string, clicks long, shows long").coalesce(1), b)
            n = max(n, len(os.listdir(f"{d}/s")), len(os.listdir(f"{d}/o")))
    want, stored = _one_pass(batches)
    assert sorted((r["t"], r["u"], r["rt_u_click"]) for r in sink.read(spark).collect()) == want["total"]
    assert {r["u"]: r["__s"]["clicks"] for r in sink.read_store(spark).collect()} == {u: s[1] for u, s in stored.items()}
    assert n <= 25


def test_result_table_stays_bounded(spark):
    """A result table has some folders for each power of ten of its batches."""
    import os

    d = tempfile.mkdtemp(prefix="tidemark-bounded-")
    sink = ResultTableSink(f"{d}/r", merge_at=4)
    for b in range(70):
        sink(spark.createDataFrame([(b, b * 2)], "t long, v long").coalesce(1), b)
        assert len(os.listdir(f"{d}/r")) <= 14
    assert sorted((r["t"], r["v"], r["batch_id"]) for r in sink.read(spark).collect()) == [(b, b * 2, b) for b in range(70)]


def test_console_prints_every_window(spark):
    """The console sink gets the rows of every closed window (its text goes to the JVM's own output)."""
    from tidemark.streaming.windowed import console

    replay = event_replay(spark, SF_SMALL, tempfile.mkdtemp(prefix="tidemark-console-"))
    replay.flush()
    agg = windowed_click_show(to_click_show(action_records(replay.timed), EVENTS_ACTION_CONFIG), SPEC, "u")
    q = console(agg.select("clicks", "shows", "__n"))
    q.awaitTermination()
    windows = to_click_show(action_records(spark.read.parquet(f"{SF_SMALL}/events.parquet")), EVENTS_ACTION_CONFIG)
    groups = windows.groupBy(F.window("ts", "300 seconds"), "u").count().count()
    assert q.exception() is None and all("Console" in p["sink"]["description"] for p in q.recentProgress)
    assert sum(max(p["sink"]["numOutputRows"], 0) for p in q.recentProgress) == groups


def test_state_store_survives_restarts_and_a_failing_sink(spark, ordered_dir):
    """K2 on the state store: the query dies after each batch it has written once; the results are those of one pass."""
    from tidemark.streaming.state import merge_on_state

    replay = _replay(spark, ordered_dir, "10 seconds")
    out = merge_on_state(gated_results(replay), Accumulate(SPEC), "u", "t")
    table, tried = ResultTableSink(f"{replay.scratch}/out"), set()

    def dies_once(batch, batch_id):
        table(batch, batch_id)
        if batch_id not in tried:
            tried.add(batch_id)
            raise OSError("lost after writing")

    begin = lambda: start(out, dies_once, f"{replay.scratch}/checkpoint", rocksdb=True, state_partitions=2)
    flushed = False
    for _ in range(40):
        q = begin()
        try:
            q.awaitTermination()
        except Exception as e:
            assert "lost after writing" in str(e)
            continue
        if flushed:
            break
        replay.flush()
        flushed = True
    want = QUERIES["keyed_accumulate"](spark, SF_SMALL)
    cols = ["t", "u", "rt_u_click", "rt_u_reveal"]
    assert len(tried) > 5 and _rows(table.read(spark), cols) == _rows(want, cols)


def test_kafka_options():
    o = kafka_options("b1:9092,b2:9092", "act", maxOffsetsPerTrigger=1000)
    assert o["subscribe"] == "act" and o["startingOffsets"] == "latest"
    assert "failOnDataLoss" not in o  # lost offsets end the query
    assert o["kafka.bootstrap.servers"] == "b1:9092,b2:9092" and o["maxOffsetsPerTrigger"] == "1000"


def test_sinks_read_empty(spark):
    """Sinks that only saw empty batches read back as empty typed tables."""
    from tidemark.streaming.sinks import KeyedTableSink, ResultTableSink
    d = tempfile.mkdtemp(prefix="tidemark-empty-")
    empty = spark.createDataFrame([], "t long, u string, clicks long, shows long")
    r = ResultTableSink(f"{d}/r")
    r(empty, 0)
    assert r.read(spark).count() == 0 and "clicks" in r.read(spark).columns
    k = KeyedTableSink(f"{d}/o", f"{d}/s", FirstWrite(), key_template="K_%s")
    k(empty, 0)
    assert k.read(spark).count() == 0 and "store_key" in k.read(spark).columns


def test_keys_reach_the_state_in_packs(spark):
    """A pack holds a bucket's rows, however many, and keys and values come back as they were, nulls too."""
    import pyarrow as pa

    from tidemark.streaming.state import _packs, _rows_of_packs

    u = [None, "a", "b", "a", None, "c"]
    batches = [pa.RecordBatch.from_pydict({"u": u, "v": pa.array([2 ** 60 + i, 1, 2, None, 4, 5], pa.int64()),
                                           "__bucket": pa.array([i % 3 for i in range(6)], pa.int32())}) for i in range(2)]
    packs = list(_packs(iter(batches)))
    assert sorted(b for p in packs for b in p.column(0).to_pylist()) == [0, 1, 2]
    back = [r for p in packs for b in _rows_of_packs(iter([p.select([1])])) for r in b.to_pylist()]
    want = [r for b in batches for r in b.select(["u", "v"]).to_pylist()]
    assert sorted(back, key=repr) == sorted(want, key=repr)
    many = pa.RecordBatch.from_pydict({"v": list(range(1000)), "__bucket": pa.array([i // 2 for i in range(1000)], pa.int32())})
    packs = list(_packs(iter([many])))
    assert [b for p in packs for b in p.column(0).to_pylist()] == list(range(500))
    assert [r["v"] for p in packs for b in _rows_of_packs(iter([p.select([1])])) for r in b.to_pylist()] == list(range(1000))


def test_a_slice_is_one_micro_batch(spark, mixed_dir):
    """However many partitions the table is read in."""
    from tidemark.plans.streaming import BATCHES, _batched

    sizes = []

    def build(replay):
        q = (replay.stream.writeStream.foreachBatch(lambda b, n: sizes.append(b.count()))
             .option("checkpointLocation", f"{replay.scratch}/checkpoint").trigger(availableNow=True).start())
        q.awaitTermination()
        return replay.stream

    _batched("test_slices", build, True)(spark, mixed_dir)
    assert len(sizes) == BATCHES and sum(sizes) == spark.read.parquet(f"{SF_SMALL}/events.parquet").count()


def _own_events(spark, n=600, files=3):
    """Events of a few users in no order of time, several of them in a second, some without a time or a user."""
    d = tempfile.mkdtemp(prefix="tidemark-own-")
    at = F.pmod(F.col("id") * 7919, F.lit(n // 3))
    (spark.range(n).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 97 != 5, F.timestamp_seconds(F.lit(1_700_000_000) + at * 3)).alias("ts"),
        F.when(F.col("id") % 89 != 7, F.col("id") % 11).alias("user_id"),
        F.when(F.col("id") % 3 == 0, "click").otherwise("view").alias("event_type"),
        (F.col("id") % 50 / 4).alias("value"),
        F.format_string('{"k": %d}', F.col("id") % 5).alias("props"))
     .repartition(files).write.parquet(f"{d}/events.parquet"))
    return d


@pytest.mark.parametrize("path", ["click_show", "completion"])
def test_a_sink_runs_its_batch_once(spark, path):
    """A window leaves the state once, however often the plans of a sink refer to the batch."""
    replay = event_replay(spark, _own_events(spark), tempfile.mkdtemp(prefix="tidemark-once-"))
    d, spec, cfg = replay.scratch, SPECS["reference"], EVENTS_ACTION_CONFIG
    if path == "click_show":
        q, sink = start_click_show(raw_action_messages(replay.stream), spec, cfg, f"{d}/out", f"{d}/state",
                                   f"{d}/checkpoint", state_partitions=2)
    else:
        q, sink = start_completion(raw_vv_messages(replay.stream), spec, cfg, f"{d}/out", f"{d}/checkpoint",
                                   state_partitions=2)
    await_complete(q)
    ops = [p["stateOperators"][0] for p in q.recentProgress]
    came, left = (sum(o[n] for o in ops) for n in ("numRowsUpdated", "numRowsRemoved"))
    assert came / 2 < left <= came and sink.read(spark).count() > 100
    assert not os.path.exists(f"{d}/out/_staged")


def test_first_write_batch_equals_scan(spark):
    """The first write's short way through a batch gives what the blocked scan of any operation does."""
    op = FirstWrite()
    batch = spark.range(3000).select(
        (F.col("id") * 37 % 3000 * 50).alias("t"),
        F.when(F.col("id") % 7 != 0, F.concat(F.lit("u"), F.col("id") % 5)).alias("u"),
        (F.col("id") % 4).alias("clicks"), F.when(F.col("id") % 3 != 0, F.col("id") % 6).alias("shows"))
    state = batch.where("u = 'u1' and t > 1000").limit(1).select("u", F.col("t").alias("__o"), op.lifted("t").alias("__s"))
    for stored in (None, state.localCheckpoint()):
        out, delta = op.merge_batch(batch, stored, "u", "t")
        with mock.patch.object(FirstWrite, "scan_batch", KeyedOperation.scan_batch):
            want_out, want_delta = op.merge_batch(batch, stored, "u", "t")
        assert _rows(out, want_out.columns) == _rows(want_out, want_out.columns)
        assert _rows(delta, want_delta.columns) == _rows(want_delta, want_delta.columns)
    tied = spark.createDataFrame([(1, "a", 1, 1), (1, "a", 1, 1), (2, "a", 1, 1)], "t long, u string, clicks long, shows long")
    out, delta = op.merge_batch(tied, None, "u", "t")
    assert sorted(r["rt_u_click"] for r in out.collect()) == [1, 2, 2] and delta.count() == 1


@pytest.mark.parametrize("name", ["messages_click_show", "messages_completion"])
def test_messages_come_in_slices_of_time(spark, name, monkeypatch):
    """A table larger than a slice comes oldest first, a micro-batch per slice; the results are the batch twin's."""
    from tidemark.plans import streaming

    folder, scratch = _own_events(spark), tempfile.mkdtemp(prefix="tidemark-slices-")
    monkeypatch.setattr(streaming, "SLICE_ROWS", 100, raising=False)
    monkeypatch.setattr(streaming, "state_partitions", lambda spark: 1)
    monkeypatch.setattr(streaming, "scratch_path", lambda spark, name: scratch)
    want = QUERIES[name](spark, folder)
    got = streaming.STREAM_QUERIES[f"stream_{name}"][0](spark, folder)
    assert _rows(got, want.columns) == _rows(want, want.columns) and got.count() > 100
    assert SegmentedTable(f"{scratch}/out").read(spark).select("batch_id").distinct().count() >= 5
    assert sorted(x for x in os.listdir(scratch) if x in ("in", "cut", "checkpoint")) == []


def test_slices_are_a_number_of_files(spark):
    """Whatever the rows of a slice, it has the files that one trigger takes."""
    from tidemark.streaming.sources import write_slice

    into = f"{tempfile.mkdtemp(prefix='tidemark-files-')}/t"
    for k, n in enumerate((10, 1, 0, 3)):
        write_slice(spark.range(n), into, 4, (k + 1) * 4)
        assert sum(f.endswith(".parquet") for f in os.listdir(into)) == (k + 1) * 4
    assert spark.read.parquet(into).count() == 14
