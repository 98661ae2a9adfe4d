"""Sequences and frames (R1-R5, C1-C2): FIXTURES.md section 6."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import frames as fr
from tidemark.operators.sequences import bounded_intake, sequence_summary


def _seq(spark, key, values):
    return [(key, i, dt.datetime(2024, 1, 1, 0, 0, i), v) for i, v in enumerate(values)]


def test_sequence_summary(spark):
    rows = _seq(spark, "k", [None, 7.0, None, 9.0, None]) + _seq(spark, "n", [None, None]) + \
        _seq(spark, "one", [4.0])
    df = spark.createDataFrame(rows, "key string, i long, ts timestamp_ntz, v double")
    got = {r["key"]: r for r in sequence_summary(df, "key", "v", ["ts", "i"], ts="ts").collect()}
    k = got["k"]
    assert (k["head"], k["head_idx"], k["tail"], k["tail_idx"]) == (None, 0, None, 4)
    assert (k["valid_head"], k["valid_head_idx"], k["valid_tail"], k["valid_tail_idx"]) == (7.0, 1, 9.0, 3)
    assert (k["length"], k["valid_length"]) == (5, 3)
    n = got["n"]
    assert (n["valid_head"], n["valid_head_idx"], n["valid_tail_idx"], n["valid_length"]) == (None, -1, -1, 0)
    o = got["one"]
    assert (o["valid_head_idx"], o["valid_tail_idx"], o["valid_length"]) == (0, 0, 1)


def test_bounded_intake(spark):
    df = spark.createDataFrame([("k", 1), ("k", 2), ("k", 3)], "key string, item long")
    two = bounded_intake(df, "key", ["item"], 2).orderBy("item").collect()
    assert [r["item"] for r in two] == [1, 2]
    assert (two[0]["size"], two[0]["rejected"], two[0]["full"]) == (2, 1, True)
    unl = bounded_intake(df, "key", ["item"], -1).collect()
    assert len(unl) == 3 and not unl[0]["full"] and unl[0]["rejected"] == 0
    # unlimited capacity across several blocks: positions still run 0..n-1
    many = spark.createDataFrame([("k", i) for i in range(10)], "key string, item long")
    pos = {r["item"]: r["pos"] for r in bounded_intake(many, "key", ["item"], -1, block_size=3).collect()}
    assert pos == {i: i for i in range(10)}


def test_frame_round_trip(spark):
    df = spark.createDataFrame([(1, bytearray(b"message codec test..."))], "id int, data binary")
    enc = df.select(fr.encode_frame("id", "data").alias("f"))
    f = enc.collect()[0]["f"]
    assert len(f) == 4 + 4 + 21 + 4 and int.from_bytes(f[:4], "little") == 29
    dec = enc.select(fr.decode_frame(fr.strip_size_prefix("f")).alias("d")).collect()[0]["d"]
    assert (dec["status"], dec["msg_id"], bytes(dec["data"]), dec["size"]) == \
        ("ok", 1, b"message codec test...", 29)


def test_frame_damage(spark):
    df = spark.createDataFrame([(1, bytearray(b"message codec test..."))], "id int, data binary")
    f = bytes(df.select(fr.encode_frame("id", "data").alias("f")).collect()[0]["f"])
    bad = f[:-1] + bytes([f[-1] ^ 0xFF])
    frames = spark.createDataFrame([(bytearray(bad[4:]),), (bytearray(b"\x01\x02\x03"),), (None,)], "f binary")
    st = [r["d"]["status"] for r in frames.select(fr.decode_frame("f").alias("d")).collect()]
    assert st == ["checksum", "short", "short"]
    counts = {r["status"]: r["n"] for r in fr.status_counts(
        frames.select(fr.decode_frame("f")["status"].alias("status"))).collect()}
    assert counts == {"checksum": 1, "short": 2}
