"""Stored bytes (S5) against hand-made messages; VARIANT access."""

import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from tidemark.functions.json import json_variant, variant_kind, variant_number, variant_text
from tidemark.functions.wire import DOUBLE, INT64, USER_PROFILE, decode_message, encode_message
from tidemark.operators.profiles import read_profile
from tidemark.streaming.sinks import read_serialized, serialize_profile

SPEC = {"a": (1, INT64), "b": (2, INT64), "c": (30, DOUBLE)}


def varint(n):
    n, out = n % 2 ** 64, b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def message(a=None, b=None, c=None):
    out = b"" if a is None else b"\x08" + varint(a)
    out += b"" if b is None else b"\x10" + varint(b)
    return out + (b"" if c is None else varint(30 << 3 | 1) + struct.pack("<d", c))


def decoded(spark, messages):
    df = spark.createDataFrame([(i, bytearray(m) if m is not None else None) for i, m in enumerate(messages)], "i int, m binary")
    rows = df.select("i", decode_message(F.col("m"), SPEC).alias("d")).orderBy("i").collect()
    return [(r["d"]["a"], r["d"]["b"], r["d"]["c"], r["d"]["ok"]) for r in rows]


def same(x, y):
    return x == y or (isinstance(x, float) and isinstance(y, float) and
                      (math.isnan(x) and math.isnan(y) or struct.pack("<d", x) == struct.pack("<d", y)))


def test_bytes_are_those_of_the_format(spark):
    rnd = random.Random(1)
    whole = [0, 1, 127, 128, 300, -1, 2 ** 63 - 1, -2 ** 63, 2 ** 35, None]
    real = [0.0, -0.0, 0.1, 1e308, 5e-324, float("inf"), float("-inf"), float("nan"), None]
    rows = [(rnd.choice(whole), rnd.choice(whole), rnd.choice(real)) for _ in range(300)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a long, b long, c double")
    got = [bytes(r["m"]) for r in df.select("i", encode_message(SPEC).alias("m")).orderBy("i").collect()]
    assert got == [message(*r) for r in rows]
    for back, row in zip(decoded(spark, got), rows):
        assert back[3] and all(same(x, y) for x, y in zip(back, row))


def test_reader_takes_any_message(spark):
    c = varint(30 << 3 | 1) + struct.pack("<d", 2.5)
    skipped = (b"\x1a\x03abc" + b"\x22\x00" + b"\x2d\x01\x02\x03\x04" + varint(7 << 3 | 1) + b"12345678"
               + varint(400 << 3) + varint(-5))
    cases = [(b"", (None, None, None, True)),
             (c + message(5, -7), (5, -7, 2.5, True)),  # any order
             (message(5) + message(6), (6, None, None, True)),  # the last counts
             (skipped + message(1, 2) + skipped, (1, 2, None, True)),
             (b"\x09" + b"12345678", (None, None, None, True)),  # number 1 as eight bytes: not this field
             (b"\x08\x80\x80\x00", (0, None, None, True)),  # a long spelling of zero
             (b"\x08", (None, None, None, False)), (b"\x08\x80", (None, None, None, False)),
             (c[:-1], (None, None, None, False)), (b"\x1a\x05abc", (None, None, None, False)),
             (b"\x0b", (None, None, None, False)), (b"\x00\x01", (None, None, None, False)),
             (b"\x08" + b"\xff" * 11 + b"\x01", (None, None, None, False)), (None, (None, None, None, False))]
    got = decoded(spark, [m for m, _ in cases])
    for (m, want), back in zip(cases, got):
        assert back == want or m is None and back[3] in (None, False), m


def test_stored_profiles_read_absent_fields_as_zero(spark):
    p = spark.createDataFrame([("k1", 3, None, 0.5), ("k2", None, None, None)],
                              "store_key string, rt_u_click long, rt_u_reveal long, rt_u_rpt double")
    stored = serialize_profile(p, "store_key", USER_PROFILE, "protobuf")
    assert dict(stored.dtypes)["value"] == "binary"
    back = {r["store_key"]: tuple(r)[1:] for r in read_profile(read_serialized(stored, "store_key", USER_PROFILE)).collect()}
    assert back == {"k1": (3, 0, 0.5), "k2": (0, 0, 0.0)}


@pytest.mark.parametrize("text, kind, number, string", [
    ('{"k": 5}', "BIGINT", 5, None), ('{"k": "5"}', "STRING", None, "5"), ('{"k": null}', "VOID", None, None),
    ('{"k": true}', "BOOLEAN", None, None), ('{"k": [1, 2]}', "ARRAY<BIGINT>", None, None),
    ('{"k": {"x": "y"}}', "OBJECT<x: STRING>", None, None), ('{"j": 1}', None, None, None), ("[1]", None, None, None),
    ("{bad", None, None, None), ("", None, None, None), (None, None, None, None), ('{"k": -7}', "BIGINT", -7, None),
])
def test_variant_access(spark, text, kind, number, string):
    v = F.col("v")
    row = (spark.createDataFrame([(text,)], "j string").select(json_variant("j").alias("v"))
           .select(variant_kind(v, "$.k").alias("kind"), variant_number(v, "$.k").alias("n"), variant_text(v, "$.k").alias("s")).first())
    assert (row["kind"], row["n"], row["s"]) == (kind, number, string)
