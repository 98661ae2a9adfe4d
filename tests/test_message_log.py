"""The message log: offsets, segments, the streaming source; frames out of a byte log."""

import json
import os
import random
import struct
import tempfile
import zlib

import pytest

from tidemark.operators import frame_log
from tidemark.sources import message_log
from tidemark.sources.message_log import append_messages, end_offsets, read_message_log


def numbers(spark, lo, hi):
    return spark.range(lo, hi).selectExpr("cast(id as string) key", "concat('v', id) value", "timestamp_seconds(id) ts")


def run(spark, root, checkpoint, starting="latest", **options):
    """Rows that a query reads until nothing is left."""
    rows = []
    q = (read_message_log(spark, root, starting, **options).writeStream
         .foreachBatch(lambda b, i: rows.extend(b.collect())).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return rows


def test_offsets_count_messages(spark):
    root = tempfile.mkdtemp(prefix="tidemark-log-") + "/log"
    assert end_offsets(root) == {}
    append_messages(numbers(spark, 0, 500), root, 3, rows_per_segment=40)
    first = end_offsets(root)
    assert sorted(first) == [0, 1, 2] and sum(first.values()) == 500
    append_messages(numbers(spark, 500, 520), root, 3, rows_per_segment=40)
    assert sum(end_offsets(root).values()) == 520
    names = sorted(os.listdir(f"{root}/partition=0"))
    assert names[1] == f"{40:020d}.parquet" and not [n for n in names if n.startswith("_")]
    rows = run(spark, root, tempfile.mkdtemp(), "earliest", rowsPerTask="17")
    assert sorted(int(r["key"]) for r in rows) == list(range(520))
    by = {}
    for r in rows:
        by.setdefault(r["partition"], []).append((r["offset"], int(r["key"]), r["value"], r["ts"].timestamp()))
    for k, held in by.items():
        held.sort()
        assert [o for o, *_ in held] == list(range(end_offsets(root)[k]))
        assert all(v == f"v{key}" and t == key for _, key, v, t in held)
        assert [key for _, key, *_ in held] == sorted(key for _, key, *_ in held)  # a key's messages stay in order


def test_starts_at_the_newest_and_resumes(spark):
    root, ck = tempfile.mkdtemp(prefix="tidemark-log-") + "/log", tempfile.mkdtemp()
    append_messages(numbers(spark, 0, 100), root, 2)
    assert run(spark, root, ck) == []
    append_messages(numbers(spark, 100, 150), root, 2)
    append_messages(numbers(spark, 150, 160), root, 4)  # more partitions: the new ones from their start
    assert sorted(int(r["key"]) for r in run(spark, root, ck)) == list(range(100, 160))
    assert run(spark, root, ck) == []
    append_messages(numbers(spark, 160, 161), root, 4)
    assert [int(r["key"]) for r in run(spark, root, ck)] == [160]


def test_given_offsets_and_lost_messages(spark):
    root = tempfile.mkdtemp(prefix="tidemark-log-") + "/log"
    append_messages(numbers(spark, 0, 100), root, 1, rows_per_segment=10)
    rows = run(spark, root, tempfile.mkdtemp(), json.dumps({"0": 93}))
    assert sorted(r["offset"] for r in rows) == list(range(93, 100))
    os.rename(f"{root}/partition=0/{0:020d}.parquet", f"{root}/partition=0/_gone")
    with pytest.raises(Exception, match="are gone"):
        run(spark, root, tempfile.mkdtemp(), "earliest")


def test_ranges_split_segments():
    reader = message_log._LogReader({"path": "unused", "rowspertask": "10"})
    fs = tempfile.mkdtemp(prefix="tidemark-ranges-")
    os.makedirs(f"{fs}/partition=0")
    for first in (0, 25):
        open(f"{fs}/partition=0/{first:020d}.parquet", "w").close()
    reader.root = fs
    got = [(r.first, r.start, r.end) for r in reader.partitions({"0": 3}, {"0": 31})]
    assert got == [(0, 3, 13), (0, 13, 23), (0, 23, 25), (25, 25, 31)]


# --- frames --------------------------------------------------------------------------------------


def frame(msg_id, data):
    body = struct.pack("<i", msg_id) + data
    return struct.pack("<i", len(data) + 8) + body + struct.pack("<I", zlib.adler32(body))


def is_good(data, at):
    if at + 12 > len(data):
        return False
    size = struct.unpack_from("<i", data, at)[0]
    if size < 8 or at + 4 + size > len(data):
        return False
    return zlib.adler32(data[at + 4:at + size]) == struct.unpack_from("<I", data, at + size)[0]


def scan_slowly(data):
    at, out = 0, []
    while at < len(data):
        size = struct.unpack_from("<i", data, at)[0] if at + 4 <= len(data) else -1
        end = at + 4 + size
        if is_good(data, at):
            out.append((at, end, "ok"))
        elif size >= 8 and end <= len(data) and (end == len(data) or is_good(data, end)):
            out.append((at, end, "checksum"))
        else:
            end = next((k for k in range(at + 1, len(data)) if is_good(data, k)), len(data))
            out.append((at, end, "lost"))
        at = end
    return out


def damaged_log(rnd, n):
    out = b""
    for i in range(n):
        f = frame(i - 3, bytes(rnd.choice([0, 0, 1, 8, 255, 65]) for _ in range(rnd.choice([0, 0, 1, 7, 60]))))
        kind = rnd.random()
        if kind < 0.1:
            f = f[:rnd.randint(0, len(f) - 1)]
        elif kind < 0.2:
            k = rnd.randrange(len(f))
            f = f[:k] + bytes([f[k] ^ rnd.randint(1, 255)]) + f[k + 1:]
        elif kind < 0.25:
            f += bytes(rnd.randint(0, 255) for _ in range(rnd.randint(1, 9)))
        out += f
    return out


def test_scan_of_damaged_logs():
    rnd = random.Random(6)
    for _ in range(60):
        data = damaged_log(rnd, rnd.randint(0, 25))
        assert frame_log.good_starts(data).tolist() == [k for k in range(len(data)) if is_good(data, k)]
        assert list(frame_log.frames_of(data)) == scan_slowly(data)
    assert list(frame_log.frames_of(b"")) == [] and list(frame_log.frames_of(b"abc")) == [(0, 3, "lost")]


def test_a_megabyte_of_damage_is_read_once():
    import time

    data = frame(1, b"x" * 1000) + struct.pack("<i", 9000) * 300_000 + frame(2, b"y" * 1000)
    began = time.perf_counter()
    got = list(frame_log.frames_of(data))
    assert [s for _, _, s in got] == ["ok", "lost", "ok"] and time.perf_counter() - began < 3


def test_frame_log_through_files(spark):
    folder = tempfile.mkdtemp(prefix="tidemark-frames-")
    rnd = random.Random(2)
    sent = [(i, bytearray(frame(i, b"data %d " % i * rnd.randint(1, 30)))) for i in range(400)]
    for i in range(0, 400, 50):
        sent[i] = (i, sent[i][1][:5])
    df = spark.createDataFrame([*sent, (400, None)], "i int, frame binary").repartitionByRange(3, "i").sortWithinPartitions("i")
    frame_log.write_frame_log(df, folder, file_bytes=5000)
    assert len(os.listdir(folder)) > 6
    found = frame_log.read_frame_log(spark, folder).cache()
    good = {r["msg_id"]: bytes(r["data"]) for r in frame_log.good_frames(found).collect()}
    assert good == {i: bytes(f[8:-4]) for i, f in sent if i % 50}
    bad = frame_log.quarantined(found).collect()
    assert [(r["status"], r["msg_id"], len(r["bytes"])) for r in bad] == [("lost", None, 5)] * 8
