"""The application entry point on message folders equals the batch pipelines."""

import tempfile

from tidemark import app
from tidemark.functions.scalars import as_instant
from tidemark.plans.catalog import QUERIES
from tidemark.sources.adapters import raw_action_messages, raw_vv_messages

from conftest import SF_ORACLE as SF_SMALL


def _write_messages(spark, raw, path):
    raw.select("key", "value", as_instant(raw, "ts").alias("ts")).write.parquet(path)


def test_main_on_folders(spark):
    d = tempfile.mkdtemp(prefix="tidemark-app-")
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    _write_messages(spark, raw_action_messages(ev), f"{d}/actions")
    _write_messages(spark, raw_vv_messages(ev), f"{d}/views")
    # message keys of the events table: 'view' is the show action
    app.main(["--actions", f"{d}/actions", "--views", f"{d}/views", "--out", f"{d}/out",
              "--show-value", "view", "--once"])
    got_cs = spark.read.parquet(f"{d}/out/user_click_show")
    got_vv = spark.read.parquet(f"{d}/out/user_completion")
    want_cs = QUERIES["messages_click_show"](spark, SF_SMALL)
    want_vv = QUERIES["messages_completion"](spark, SF_SMALL)
    # without a flush message the newest windows stay open: every emitted
    # row must be a batch row, and all batch rows of closed windows appear
    cs_cols = ["t", "u", "rt_u_click", "rt_u_reveal", "stored_click", "stored_reveal"]
    got = {tuple(r[c] for c in cs_cols) for r in got_cs.collect()}
    want = {tuple(r[c] for c in cs_cols) for r in want_cs.collect()}
    assert got and got <= want
    last = max(r["t"] for r in got_cs.collect())
    assert {w for w in want if w[0] <= last - 15} <= got
    vv_cols = ["t", "u", "tm", "duration", "rpt"]
    gv = {tuple(r[c] for c in vv_cols) for r in got_vv.collect()}
    wv = {tuple(r[c] for c in vv_cols) for r in want_vv.collect()}
    assert gv and {x for x in gv if x[4] == x[4]} <= wv  # NaN never compares equal


def test_command_line(spark, capsys):
    from tidemark.__main__ import main
    main(["list"])
    names = capsys.readouterr().out.split()
    assert "user_click_show_tumbling" in names and "stream_feed_profile" in names
    out = tempfile.mkdtemp(prefix="tidemark-cli-") + "/r"
    main(["run", "profile_store", "--tables", "/root/testdata/sf0.001", "--out", out])
    assert spark.read.parquet(out).count() == QUERIES["profile_store"](spark, "/root/testdata/sf0.001").count()


def test_main_on_message_logs_with_the_state_store(spark):
    """What lies in the logs before the first run is skipped; a second run goes on from its checkpoint."""
    from pyspark.sql import functions as F

    from tidemark.config import WindowSpec
    from tidemark.functions.scalars import epoch_seconds
    from tidemark.operators.keyed import first_write_merge
    from tidemark.operators.metrics import click_show_metrics
    from tidemark.operators.parse import good, parse_actions
    from tidemark.sources.adapters import EVENTS_ACTION_CONFIG
    from tidemark.sources.message_log import append_messages
    from tidemark.streaming.sinks import SegmentedTable

    d = tempfile.mkdtemp(prefix="tidemark-app-log-")
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    sec = epoch_seconds(ev, "ts")
    middle = ev.select(F.percentile_approx(sec, 0.5)).first()[0] // 300 * 300

    def add(rows):
        for raw, name in ((raw_action_messages(rows), "actions"), (raw_vv_messages(rows), "views")):
            append_messages(raw.select("key", "value", as_instant(raw, "ts").alias("ts")), f"{d}/{name}", 2)

    args = ["--log", "--actions", f"{d}/actions", "--views", f"{d}/views", "--out", f"{d}/out", "--length", "300", "--step", "300",
            "--mode", "half_open", "--show-value", "view", "--once", "--store", "state", "--state-partitions", "2"]
    add(ev.where(sec < middle))
    app.main(args)
    assert SegmentedTable(f"{d}/out/user_click_show").read(spark) is None
    add(ev.where(sec >= middle))
    app.main(args)
    got = SegmentedTable(f"{d}/out/user_click_show").read(spark).collect()
    records = good(parse_actions(raw_action_messages(ev.where(sec >= middle)), EVENTS_ACTION_CONFIG))
    want = first_write_merge(click_show_metrics(records, WindowSpec(300, min_records=2)), key_template="USER_CLICK_SHOW_5MIN_%s")
    rows = sorted(tuple(r[c] for c in want.columns) for r in got)
    assert len(rows) > 300 and rows == sorted(tuple(r) for r in want.collect() if r["t"] <= rows_last(got))


def rows_last(rows):
    """The newest window that was closed; later ones wait for newer messages."""
    return max(r["t"] for r in rows)
