"""Streaming sinks (S3-S6, K3), all written through ``foreachBatch``.

Tables are made of segments (``SegmentedTable``): a micro-batch writes the segment
of its own number, whole, and commits it with a marker file, so a batch
replayed after a failure replaces its segment. Segments of earlier batches are
merged by tens, so a table has a few of them however many batches ran;
a segment goes only when one that covers it is committed, and no batch
ever reads or replaces what it wrote itself.

A micro-batch DataFrame is a leaf RDD: each action would run the micro-batch
again (input read and stateful operator included), and so would each further
reference to it in a plan, cached or not: Spark's cache does not know a partitioned leaf
again under new column ids. So a sink writes its batch to files first, works on
these and removes them at the end. Their size is known, so a plan broadcasts only
what is small; the leaf's size is that of the batch's input, nothing when
a batch only closes windows. Inside
``foreachBatch`` of a stateful query Spark turns adaptive execution off, so
nothing here relies on it: a key's rows are window results, one per window.

* ``ResultTableSink``: appends a batch's result rows (S4 as a table).
* ``KeyedTableSink``: a keyed store in a table, driven by a keyed operation
  (``operators.operations``) or any object with ``state`` and ``merge_batch``.
  The state seen by batch N is the merge of the segments before N. It is
  read whole in each batch: for stores much larger than a batch use
  ``state.merge_on_state``.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.scalars import profile_key
from tidemark.functions.wire import decode_message, encode_message
from tidemark.operators.joins import join_back
from tidemark.operators.operations import FirstWrite
from tidemark.streaming.sources import remove_folder

BATCH_COL = "batch_id"
MERGE_AT = 10  # segments of about the same number of batches that are merged into one
_COMMITTED = "_committed.json"
_STAGED = "_staged"  # what a sink works on, in its table's folder


def serialize_profile(df: DataFrame, key: str, fields, fmt: str = "struct",
                      out: str = "value") -> DataFrame:
    """``(key, value)`` with the profile fields packed into one stored value.

    ``struct`` keeps a typed struct column; ``json`` writes JSON text and
    ``protobuf`` wire bytes (``functions.wire``; ``fields`` then maps names to
    numbers and kinds), both with absent fields omitted (so readers fall back to 0, P10).
    """
    if fmt == "protobuf":
        return df.select(F.col(key), encode_message(fields).alias(out))
    if fmt not in ("json", "struct"):
        raise ValueError(f"unknown format {fmt!r}")
    packed = F.struct(*[F.col(c) for c in fields])
    return df.select(F.col(key), (F.to_json(packed) if fmt == "json" else packed).alias(out))


def read_serialized(df: DataFrame, key: str, schema, value: str = "value") -> DataFrame:
    """``(key, *fields)`` of stored values, JSON text, structs or wire bytes; ``schema`` names the fields
    (for bytes: names to numbers and kinds)."""
    kind = df.schema[value].dataType.simpleString()
    if kind == "binary":
        return df.select(F.col(key), decode_message(F.col(value), schema).alias("__f")).select(
            key, *[f"__f.{c}" for c in schema])
    fields = F.from_json(F.col(value), schema) if kind == "string" else F.col(value)
    return df.select(F.col(key), fields.alias("__f")).select(key, "__f.*")


@contextmanager
def _persisted(df: DataFrame):
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


@contextmanager
def _staged(df: DataFrame, path: str):
    """The rows of a micro-batch from files in folder ``path``, so that it runs once."""
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove_folder(spark, path)


def _with_batch_col(df: DataFrame, batch_id: int = 0) -> DataFrame:
    return df.withColumn(BATCH_COL, F.lit(batch_id).cast("bigint"))


class SegmentedTable:
    """A table written a micro-batch at a time: folders ``seg=<first>_<last>`` of batch numbers.

    ``merge``: how the rows of several segments become those of one (the rows as they are by default).
    """

    def __init__(self, path: str, merge: Callable[[DataFrame], DataFrame] = lambda df: df, merge_at: int = MERGE_AT):
        self.path, self.merge, self.merge_at = path.rstrip("/"), merge, merge_at

    def _fs(self, spark: SparkSession, path: str):
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p

    def segments(self, spark: SparkSession, below: int | None = None) -> list[tuple[int, int]]:
        """(first, last) of the committed segments that no other covers, ascending; only batches before ``below``."""
        fs, p = self._fs(spark, f"{self.path}/seg=*/{_COMMITTED}")
        found = sorted({tuple(map(int, st.getPath().getParent().getName()[4:].split("_"))) for st in fs.globStatus(p) or []},
                       key=lambda s: (s[0], -s[1]))
        out: list[tuple[int, int]] = []
        for first, last in found:
            if (not out or last > out[-1][1]) and (below is None or last < below):
                out.append((first, last))
        return out

    def _folder(self, segment: tuple[int, int]) -> str:
        return f"{self.path}/seg={segment[0]}_{segment[1]}"

    def _commit(self, spark: SparkSession, df: DataFrame, segment: tuple[int, int]) -> None:
        df.write.mode("overwrite").parquet(self._folder(segment))
        fs, p = self._fs(spark, f"{self._folder(segment)}/{_COMMITTED}")
        out = fs.create(p, True)
        out.write(bytearray(json.dumps({"first": segment[0], "last": segment[1], "schema": df.schema.jsonValue()}), "utf-8"))
        out.close()

    def write(self, spark: SparkSession, df: DataFrame, batch_id: int) -> None:
        """The rows of a batch, in place of what an earlier try of it wrote."""
        self._commit(spark, df, (batch_id, batch_id))

    def schema(self, spark: SparkSession, segment: tuple[int, int]) -> StructType:
        fs, p = self._fs(spark, f"{self._folder(segment)}/{_COMMITTED}")
        data = fs.open(p)
        try:
            return StructType.fromJson(json.loads(bytes(data.readAllBytes()).decode())["schema"])
        finally:
            data.close()

    def read(self, spark: SparkSession, below: int | None = None,
             segments: list[tuple[int, int]] | None = None) -> DataFrame | None:
        """Rows of the table, or of the batches before ``below``; None without any."""
        segments = self.segments(spark, below) if segments is None else segments
        if not segments:
            return None
        return spark.read.schema(self.schema(spark, segments[-1])).parquet(*map(self._folder, segments))

    def compact(self, spark: SparkSession, below: int) -> None:
        """Merge runs of ``merge_at`` neighbours of one size among the batches before ``below``, oldest and largest first."""
        segments = self.segments(spark, below)
        level = lambda s: len(str(s[1] - s[0] + 1))  # noqa: E731  batches covered, by powers of ten
        at = 0
        while at + self.merge_at <= len(segments):
            run = segments[at:at + self.merge_at]
            if len({level(s) for s in run}) > 1 and max(map(level, run)) > level(run[0]):
                at += 1
                continue
            whole = (run[0][0], run[-1][1])
            self._commit(spark, self.merge(self.read(spark, segments=run)), whole)
            segments[at:at + self.merge_at] = [whole]
            at = 0
        self._remove_covered(spark, segments)

    def _remove_covered(self, spark: SparkSession, segments: list[tuple[int, int]]) -> None:
        """Folders that a committed segment of several batches covers, also what a lost run left."""
        merged = [s for s in segments if s[1] > s[0]]
        fs, p = self._fs(spark, f"{self.path}/seg=*")
        for st in fs.globStatus(p) or []:
            first, last = map(int, st.getPath().getName()[4:].split("_"))
            if any(a <= first and last <= b and (a, b) != (first, last) for a, b in merged):
                fs.delete(st.getPath(), True)


@dataclass
class ResultTableSink:
    """``foreachBatch`` callable writing ``transform(batch)`` per batch id."""

    path: str
    transform: Callable[[DataFrame], DataFrame] = lambda df: df
    schema: StructType | None = None
    merge_at: int = MERGE_AT

    @property
    def table(self) -> SegmentedTable:
        return SegmentedTable(self.path, merge_at=self.merge_at)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        with _staged(batch, f"{self.table.path}/{_STAGED}") as b:
            rows = _with_batch_col(self.transform(b), batch_id)
            self.schema = rows.schema
            if b.isEmpty():  # nothing closed in this trigger: no jobs to run
                return
            self.table.compact(b.sparkSession, batch_id)
            self.table.write(b.sparkSession, rows, batch_id)

    def read(self, spark: SparkSession) -> DataFrame:
        """Everything written so far; empty (with the written schema) when no batch had rows."""
        rows = self.table.read(spark)
        return spark.createDataFrame([], self.schema) if rows is None else rows


@dataclass
class KeyedTableSink:
    """``foreachBatch`` callable merging each batch into a keyed store (S3, K3).

    ``operation`` is a ``KeyedOperation``, or any object with ``state(deltas, key,
    order)`` and ``merge_batch(batch, state, key, order) -> (returned_rows, state_delta)``,
    where ``state`` may be applied to its own results again. Returned rows go to the table
    ``out_path``, the state to ``state_path``, both in segments: batch N merges what the
    segments before N hold, writes its delta as segment N, and merges older
    segments when there are ``compact_every`` of a size. How they are merged is
    no part of what is stored, so ``compact_every`` may change between runs.
    """

    out_path: str
    state_path: str
    operation: object = field(default_factory=FirstWrite)
    key: str = "u"
    order: str = "t"
    key_template: str | None = None
    transform: Callable[[DataFrame], DataFrame] = lambda df: df
    compact_every: int = MERGE_AT
    schema: StructType | None = None

    @property
    def results(self) -> SegmentedTable:
        return SegmentedTable(self.out_path)

    @property
    def store(self) -> SegmentedTable:
        return SegmentedTable(self.state_path, self._state, max(2, self.compact_every))

    def _state(self, deltas: DataFrame) -> DataFrame:
        return self.operation.state(deltas, self.key, self.order)

    def read(self, spark: SparkSession) -> DataFrame:
        """Every returned row written so far."""
        rows = self.results.read(spark)
        return spark.createDataFrame([], self.schema) if rows is None else rows

    def read_store(self, spark: SparkSession) -> DataFrame | None:
        """The stored values, a row per key; None before the first batch."""
        deltas = self.store.read(spark)
        return None if deltas is None else self._state(deltas)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        with _staged(batch, f"{self.results.path}/{_STAGED}") as b:
            if b.isEmpty():  # nothing closed in this trigger: no jobs to run
                if self.schema is None:
                    out, _ = self.operation.merge_batch(self.transform(b), None, self.key, self.order)
                    self.schema = _with_batch_col(self._keyed(out)).schema
                return
            with _persisted(self.transform(b)) as rows:
                self._merge(b.sparkSession, rows, batch_id)

    def _keyed(self, out: DataFrame) -> DataFrame:
        if self.key_template is None:
            return out
        return out.withColumn("store_key", profile_key(F.col(self.key), self.key_template))

    def _merge(self, spark: SparkSession, rows: DataFrame, batch_id: int) -> None:
        self.store.compact(spark, batch_id)
        self.results.compact(spark, batch_id)
        deltas = self.store.read(spark, batch_id)
        state = None
        if deltas is not None:
            state = self._state(join_back(deltas, rows.select(self.key).distinct(), self.key, "left_semi"))
        out, delta = self.operation.merge_batch(rows, state, self.key, self.order)
        out = _with_batch_col(self._keyed(out), batch_id)
        self.schema = out.schema
        self.results.write(spark, out, batch_id)
        self.store.write(spark, delta, batch_id)
