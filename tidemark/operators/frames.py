"""Framed binary messages.

Layout (little endian): ``size int32 | msg_id int32 | data | adler32 uint32``
with ``size = len(data) + 8`` and the checksum taken over ``msg_id | data``.
The reader receives a frame without its 4-byte size prefix (the transport
consumed it) and never compares the size.

Packing and Adler-32 are not Spark built-ins, so both directions are Arrow
``pandas_udf``s: a small per-batch helper inside Spark tasks; the data stay
partitioned and the status counts are ordinary aggregates. Whole documents
travel to Python in Arrow batches bounded by
``spark.sql.execution.arrow.maxBytesPerBatch`` (64 MB by default) as well as
by record count, so large texts do not inflate a worker's memory.
"""

from __future__ import annotations

import struct
import sys
import zlib

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# Decode status labels.
STATUS_OK = "ok"
STATUS_CHECKSUM = "checksum"
STATUS_SHORT = "short"

DECODED = StructType([
    StructField("status", StringType(), False),
    StructField("msg_id", IntegerType(), True),
    StructField("data", BinaryType(), True),
    StructField("checksum", LongType(), True),
    StructField("size", IntegerType(), True),
])

# The UDF bodies travel to the Python workers by value, so executors need no
# copy of this package (cloudpickle would otherwise pickle them by module).
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _encode_one(msg_id, data) -> bytes | None:
    if msg_id is None or data is None:
        return None
    body = struct.pack("<i", int(msg_id)) + bytes(data)
    return struct.pack("<i", len(data) + 8) + body + struct.pack("<I", zlib.adler32(body))


def _decode_one(frame) -> tuple:
    if frame is None:
        return (STATUS_SHORT, None, None, None, None)
    b = bytes(frame)
    if len(b) < 8:
        return (STATUS_SHORT, None, None, None, None)
    msg_id = struct.unpack_from("<i", b, 0)[0]
    data, checksum = b[4:-4], struct.unpack_from("<I", b, len(b) - 4)[0]
    if zlib.adler32(b[:-4]) != checksum:
        return (STATUS_CHECKSUM, None, None, None, None)
    return (STATUS_OK, msg_id, data, checksum, len(b))


@F.pandas_udf(BinaryType())
def _encode(msg_id: pd.Series, data: pd.Series) -> pd.Series:
    return pd.Series([_encode_one(i, d) for i, d in zip(msg_id, data)], dtype=object)


@F.pandas_udf(DECODED)
def _decode(frame: pd.Series) -> pd.DataFrame:
    rows = [_decode_one(f) for f in frame]
    return pd.DataFrame(rows, columns=[f.name for f in DECODED.fields])


def encode_frame(msg_id, data) -> Column:
    """Full frame (with size prefix) of an int32 id and a binary payload (C2);
    NULL for an id beyond int32 or a NULL payload."""
    i = F.col(msg_id) if isinstance(msg_id, str) else msg_id
    d = F.col(data) if isinstance(data, str) else data
    return _encode(i.try_cast("int"), d.cast("binary"))


def decode_frame(frame) -> Column:
    """Struct ``(status, msg_id, data, checksum, size)`` of a frame given
    without its size prefix (C1); fields are NULL unless status is ok."""
    f = F.col(frame) if isinstance(frame, str) else frame
    return _decode(f)


def strip_size_prefix(frame) -> Column:
    """What the reader receives: the frame minus its first 4 bytes."""
    f = F.col(frame) if isinstance(frame, str) else frame
    return F.substring(f, 5, 2_147_483_647)


def status_counts(decoded: DataFrame, status: str = "status") -> DataFrame:
    """``(status, n)``: frames per decode status."""
    return decoded.groupBy(status).agg(F.count(F.lit(1)).alias("n"))
