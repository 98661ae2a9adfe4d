"""A message log in a shared folder: partitions, offsets, a streaming source.

``{root}/partition=<k>/<first offset, 20 digits>.parquet`` holds the messages
of a partition from that offset on, ``(key, value, ts)`` in order. A
message's offset is its segment's first offset plus its row. Segments are
written whole and never changed, so a partition's end is the last segment's first
offset and its row count, which stands in the file's footer.

``append_messages`` deals a DataFrame to the partitions by key and writes new
segments in Spark tasks. ``read_message_log`` is a streaming DataFrame over the
log, by a Python data source: it starts at the newest offset of every
partition (as the original consumers do) or at the oldest or given ones, keeps
its offsets in the query's checkpoint, resumes there, and finds partitions that are added
later (read from their start). A range of offsets is read in tasks of
``rowsPerTask`` messages, as Arrow batches of the row groups that hold them.

Folders are reached through ``pyarrow.fs``: local and mounted paths, and the
stores it knows by URI (``s3://``, ``gs://``, ``hdfs://``).
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

# The source and the writer travel to the Python workers by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "key string, value string, partition int, offset bigint, ts timestamp"
_STORED = pa.schema([("key", pa.string()), ("value", pa.string()), ("ts", pa.timestamp("us", tz="UTC"))])
ROWS_PER_TASK = 1_000_000


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The store of a path or URI, and the path in it."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def _listed(fs: pafs.FileSystem, folder: str) -> list[str]:
    return [f.path for f in fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True))]


def _name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def partitions_of(root: str) -> dict[int, str]:
    """Folder of each partition."""
    fs, folder = file_system(root)
    return {int(_name(p)[10:]): p for p in _listed(fs, folder) if _name(p).startswith("partition=")}


def segments_of(fs: pafs.FileSystem, folder: str) -> list[tuple[int, str]]:
    """(first offset, path) of a partition's segments, ascending; files being written start with ``_``."""
    return sorted((int(_name(p)[:-8]), p) for p in _listed(fs, folder) if _name(p).endswith(".parquet")
                  and _name(p)[0] != "_")


def end_offsets(root: str) -> dict[int, int]:
    """The offset after the newest message of each partition: one footer read per partition."""
    fs, _ = file_system(root)
    out = {}
    for k, folder in partitions_of(root).items():
        segments = segments_of(fs, folder)
        out[k] = segments[-1][0] + pq.read_metadata(segments[-1][1], filesystem=fs).num_rows if segments else 0
    return out


def append_messages(messages: DataFrame, root: str, partitions: int, rows_per_segment: int = ROWS_PER_TASK) -> None:
    """Append ``(key, value, ts)`` rows: dealt by a hash of the key, in the order of ``ts`` inside a partition.

    One writer at a time. A retried task replaces its own segments; a job
    that failed may have appended some partitions (as any producer without transactions).
    """
    fs, folder = file_system(root)
    for k in range(partitions):
        fs.create_dir(f"{folder}/partition={k}", recursive=True)
    ends = end_offsets(root)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = file_system(root)
        writers: dict[int, _SegmentWriter] = {}
        for batch in batches:
            at = 0
            parts = batch.column(0).to_numpy()
            while at < len(parts):  # rows of a partition follow each other
                k = int(parts[at])
                end = int(parts.searchsorted(k, "right"))
                if k not in writers:
                    for other in writers.values():
                        other.close()
                    writers[k] = _SegmentWriter(store, f"{base}/partition={k}", ends.get(k, 0), rows_per_segment)
                writers[k].write(batch.select(["key", "value", "ts"]).slice(at, end - at))
                at = end
        for one in writers.values():
            one.close()
        yield pa.RecordBatch.from_arrays([pa.array([sum(w.rows for w in writers.values())], pa.int64())], ["n"])

    part = F.pmod(F.xxhash64(F.coalesce(F.col("key").cast("string"), F.lit(""))), F.lit(partitions)).cast("int")
    (messages.select(part.alias("part"), F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
                     F.col("ts").cast("timestamp").alias("ts"))
     .repartition(partitions, "part").sortWithinPartitions("part", "ts", "key", "value")
     .mapInArrow(write, "n bigint").agg(F.sum("n")).collect())


class _SegmentWriter:
    """Segments of one partition, from an offset on."""

    def __init__(self, fs: pafs.FileSystem, folder: str, first: int, limit: int):
        self.fs, self.folder, self.next, self.limit = fs, folder, first, limit
        self.rows = self.held = 0
        self.writer = None

    def write(self, batch: pa.RecordBatch) -> None:
        table = pa.Table.from_batches([batch]).cast(_STORED)
        while table.num_rows:
            if self.writer is None:
                task = TaskContext.get()
                self.path = f"{self.folder}/_{self.next:020d}.{task.taskAttemptId() if task else 0}"
                self.writer = pq.ParquetWriter(self.fs.open_output_stream(self.path), _STORED, compression="zstd")
            piece = table.slice(0, self.limit - self.held)
            self.writer.write_table(piece)
            self.held += piece.num_rows
            self.rows += piece.num_rows
            table = table.slice(piece.num_rows)
            if self.held == self.limit:
                self.close()

    def close(self) -> None:
        if self.writer is not None:
            self.writer.close()
            self.fs.move(self.path, f"{self.folder}/{self.next:020d}.parquet")  # seen whole or not at all
            self.next, self.held, self.writer = self.next + self.held, 0, None


@dataclass
class Range(InputPartition):
    """Messages ``[start, end)`` of one segment."""

    partition: int
    path: str
    first: int
    start: int
    end: int


class _LogReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.root = options["path"]
        self.starting = options.get("startingoffsets", "latest")
        self.per_task = int(options.get("rowspertask", ROWS_PER_TASK))

    def initialOffset(self) -> dict:
        """Used at a query's first start only; later its checkpoint says where to go on."""
        if self.starting == "latest":
            return self.latestOffset()
        if self.starting == "earliest":
            return {str(k): 0 for k in partitions_of(self.root)}
        return json.loads(self.starting)

    def latestOffset(self) -> dict:
        return {str(k): n for k, n in sorted(end_offsets(self.root).items())}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        fs, _ = file_system(self.root)
        out = []
        for k, folder in sorted(partitions_of(self.root).items()):
            lo, hi = start.get(str(k), 0), end.get(str(k), 0)
            segments = segments_of(fs, folder) if lo < hi else []
            if segments and segments[0][0] > lo:
                raise RuntimeError(f"messages {lo} to {segments[0][0]} of partition {k} are gone")
            for (first, path), (after, _) in zip(segments, [*segments[1:], (hi, "")]):
                a, b = max(lo, first), min(hi, after)
                out += [Range(k, path, first, x, min(x + self.per_task, b)) for x in range(a, b, self.per_task)]
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        fs, _ = file_system(self.root)
        with fs.open_input_file(partition.path) as source:
            file = pq.ParquetFile(source)
            at = partition.first
            for group in range(file.metadata.num_row_groups):
                n = file.metadata.row_group(group).num_rows
                if at < partition.end and at + n > partition.start:
                    lo = at
                    for batch in file.iter_batches(row_groups=[group]):
                        a, b = max(partition.start - lo, 0), min(partition.end - lo, batch.num_rows)
                        if a < b:
                            yield _with_offsets(batch.slice(a, b - a), partition.partition, lo + a)
                        lo += batch.num_rows
                at += n

    def commit(self, end: dict) -> None:
        """Nothing to do: the log is kept by whoever owns it."""


def _with_offsets(batch: pa.RecordBatch, partition: int, first: int) -> pa.RecordBatch:
    n = batch.num_rows
    return pa.RecordBatch.from_arrays(
        [batch.column(0), batch.column(1), pa.array([partition] * n, pa.int32()),
         pa.array(range(first, first + n), pa.int64()), batch.column(2)], ["key", "value", "partition", "offset", "ts"])


class MessageLogSource(DataSource):
    """``spark.readStream.format("message_log")``: options path, startingOffsets (latest, earliest or JSON), rowsPerTask."""

    @classmethod
    def name(cls) -> str:
        return "message_log"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _LogReader({k.lower(): v for k, v in self.options.items()})


def read_message_log(spark: SparkSession, root: str, starting_offsets: str = "latest", **options: str) -> DataFrame:
    """``(key, value, partition, offset, ts)`` of a message log as a stream, from its newest messages on."""
    spark.dataSource.register(MessageLogSource)
    # else an availableNow run over a Python source is a single batch, which closes no window
    spark.conf.set("spark.sql.streaming.triggerAvailableNowWrapper.enabled", "true")
    return (spark.readStream.format("message_log")
            .options(startingOffsets=starting_offsets, **options).load(root))
