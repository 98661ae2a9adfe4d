"""Stored bytes of a profile (S5): the protobuf wire format in column expressions.

A message is a run of fields, each a varint tag (``number << 3 | wire type``)
and a value: whole numbers as varints of 7 bits a byte, lowest first (a
negative one has ten bytes), doubles as eight little-endian bytes. Absent
(NULL) fields are not written. A reader takes fields in any order, the last of
several with one number, skips numbers and wire types it does not know, and
reads an absent field as NULL (``profiles.read_profile`` makes it 0).

Both directions are built-in functions on the JVM side; no descriptor, no
package and no Python worker is needed.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

INT64, DOUBLE = "int64", "double"
_VARINT, _FIXED64, _BYTES, _FIXED32 = 0, 1, 2, 5  # wire types

# Field numbers and kinds of the two stored profiles.
USER_PROFILE = {"rt_u_click": (1, INT64), "rt_u_reveal": (2, INT64), "rt_u_rpt": (3, DOUBLE)}
FEED_PROFILE = {"rt_f_click": (1, INT64), "rt_f_reveal": (2, INT64), "rt_f_rpt": (3, DOUBLE),
                "rt_f_2h_click": (4, INT64), "rt_f_2h_reveal": (5, INT64), "rt_f_2h_rpt": (6, DOUBLE),
                "rt_f_4h_click": (7, INT64), "rt_f_4h_reveal": (8, INT64), "rt_f_4h_rpt": (9, DOUBLE)}


def _shift_right(x: Column, bits: Column) -> Column:
    return F.call_function("shiftrightunsigned", x, bits.cast("int"))


def _shift_left(x: Column, bits: Column) -> Column:
    return F.call_function("shiftleft", x, bits.cast("int"))


def _hex_byte(x: Column) -> Column:
    return F.lpad(F.hex(x), 2, "0")


def _varint(x: Column) -> Column:
    """Hex digits of a whole number as a varint."""
    groups = F.ceil(F.length(F.bin(x)) / 7).cast("int")
    more = lambda i: F.when(i < groups - 1, F.lit(128)).otherwise(F.lit(0)).cast("bigint")
    return F.array_join(F.transform(F.sequence(F.lit(0), groups - 1), lambda i: _hex_byte(
        _shift_right(x, i * 7).bitwiseAND(F.lit(127).cast("bigint")).bitwiseOR(more(i)))), "")


def _double_bits(x: Column) -> Column:
    return F.java_method(F.lit("java.lang.Double"), F.lit("doubleToRawLongBits"), x).cast("bigint")


def _bits_double(x: Column) -> Column:
    return F.java_method(F.lit("java.lang.Double"), F.lit("longBitsToDouble"), x).cast("double")


def _fixed64(bits: Column) -> Column:
    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: _hex_byte(
        _shift_right(bits, i * 8).bitwiseAND(F.lit(255).cast("bigint")))), "")


def _tag(number: int, wire: int) -> str:
    n, out = number << 3 | wire, b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return (out + bytes([n])).hex()


def encode_message(fields: Mapping[str, tuple[int, str]], columns: Mapping[str, Column] | None = None) -> Column:
    """Binary message of the named columns, in the order of their field numbers."""
    parts = []
    for name, (number, kind) in sorted(fields.items(), key=lambda f: f[1][0]):
        c = (columns or {}).get(name, F.col(name))
        if kind == INT64:
            c = c.cast("bigint")
            body = F.concat(F.lit(_tag(number, _VARINT)), _varint(c))
        else:
            c = c.cast("double")
            body = F.concat(F.lit(_tag(number, _FIXED64)), _fixed64(_double_bits(F.coalesce(c, F.lit(0.0)))))
        parts.append(F.when(c.isNotNull(), body).otherwise(F.lit("")))
    return F.unhex(F.concat(*parts))


# What the reader waits for: a tag, a varint value, 8 or 4 bytes, a length, bytes to skip.
_AT_TAG, _AT_VARINT, _AT_FIXED64, _AT_FIXED32, _AT_LENGTH, _AT_SKIP = range(6)


def decode_message(message: Column, fields: Mapping[str, tuple[int, str]]) -> Column:
    """Struct of the fields (absent ones NULL) and ``ok``: whether the bytes are a whole message.

    One pass over the bytes, a fold whose state is what it waits for. Of bytes
    that are no message every field is NULL.
    """
    big = lambda x: F.lit(x).cast("bigint")
    kinds = {"at": "int", "acc": "bigint", "shift": "int", "number": "bigint", "left": "bigint", "bad": "boolean",
             **{f"f_{n}": "bigint" for n in fields}}
    start = F.struct(F.lit(_AT_TAG).alias("at"), big(0).alias("acc"), F.lit(0).alias("shift"), big(0).alias("number"),
                     big(0).alias("left"), F.lit(False).alias("bad"), *[F.lit(None).cast("bigint").alias(f"f_{n}") for n in fields])
    digits = F.hex(message)
    byte = lambda i: F.conv(F.substring(digits, i * 2 + 1, F.lit(2)), 16, 10).cast("bigint")

    def step(s: Column, i: Column) -> Column:
        b = byte(i)
        at = lambda k: s["at"] == k
        varint = s["at"].isin(_AT_TAG, _AT_VARINT, _AT_LENGTH)
        low = F.when(varint, b.bitwiseAND(big(127))).otherwise(b)
        acc = F.when(at(_AT_SKIP) | at(_AT_FIXED32), s["acc"]).otherwise(s["acc"].bitwiseOR(_shift_left(low, s["shift"])))
        shift = s["shift"] + F.when(varint, F.lit(7)).otherwise(F.lit(8))
        left = F.when(at(_AT_SKIP), s["left"] - 1).otherwise(s["left"])
        done = (F.when(varint, b < 128).when(at(_AT_FIXED64), shift == 64).when(at(_AT_FIXED32), shift == 32)
                .otherwise(left == 0))
        wire = acc.bitwiseAND(big(7))
        known = wire.isin(_VARINT, _FIXED64, _BYTES, _FIXED32) & (_shift_right(acc, F.lit(3)) > 0)
        bad = s["bad"] | (varint & ~done & (shift > 63)) | (done & at(_AT_TAG) & ~known) | (
            done & at(_AT_LENGTH) & (acc < 0))
        after_tag = (F.when(wire == _VARINT, _AT_VARINT).when(wire == _FIXED64, _AT_FIXED64)
                     .when(wire == _FIXED32, _AT_FIXED32).otherwise(_AT_LENGTH))
        after = (F.when(~done, s["at"]).when(at(_AT_TAG), after_tag)
                 .when(at(_AT_LENGTH) & (acc > 0), F.lit(_AT_SKIP)).otherwise(F.lit(_AT_TAG)))
        values = []
        for name, (number, kind) in fields.items():
            mine = done & (s["number"] == number) & at(_AT_VARINT if kind == INT64 else _AT_FIXED64)
            values.append(F.when(mine, acc).otherwise(s[f"f_{name}"]).alias(f"f_{name}"))
        out = {"at": after, "acc": F.when(done, big(0)).otherwise(acc), "shift": F.when(done, F.lit(0)).otherwise(shift),
               "number": F.when(done & at(_AT_TAG), _shift_right(acc, F.lit(3))).otherwise(s["number"]),
               "left": F.when(done & at(_AT_LENGTH), acc).otherwise(left), "bad": bad}
        return F.struct(*[F.coalesce(c, F.lit(None)).cast(kinds[n]).alias(n) for n, c in out.items()], *values)

    size = F.octet_length(message)
    places = F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.array().cast("array<int>"))
    end = F.aggregate(places, start, step)
    return F.transform(F.array(end), lambda s: _fields_of(s, fields, message.isNotNull()))[0]


def _fields_of(s: Column, fields: Mapping[str, tuple[int, str]], there: Column) -> Column:
    ok = there & (s["at"] == _AT_TAG) & (s["shift"] == 0) & ~s["bad"]
    out = []
    for name, (_, kind) in fields.items():
        bits = s[f"f_{name}"]
        value = bits if kind == INT64 else F.when(bits.isNotNull(), _bits_double(F.coalesce(bits, F.lit(0).cast("bigint"))))
        out.append(F.when(ok, value).alias(name))
    return F.struct(*out, F.coalesce(ok, F.lit(False)).alias("ok"))
