"""Small helpers shared by the training-data operators.

Rows that the operators read are ``documents`` (doc_id, text, ...). A null text
is an empty one. Operators pick the columns they need by name, so further
columns, whatever they are called, neither help nor harm.
"""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

# The white space and the word characters of the data contract.
SPACE = " \t\n\x0b\x0c\r"
WORD_BYTES = bytes(b if b >= 128 else ord(chr(b).lower()) if chr(b).isalnum() else 32
                   for b in range(256))


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per Spark context.

    Functions of the operators reach Python workers by module name, so that a
    worker's caches outlive a task; executors need not have the package installed.
    """
    context = spark.sparkContext
    if getattr(context, "_tidemark_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    folder = tempfile.mkdtemp(prefix="tidemark-")  # Spark serves the file from here
    archive = shutil.make_archive(f"{folder}/tidemark-code", "zip", package.parent, package.name)
    context.addPyFile(archive)
    context._tidemark_shipped = True


def text_of(docs: DataFrame) -> DataFrame:
    """doc_id and text, null text as an empty one."""
    ship(docs.sparkSession)
    return docs.select("doc_id", F.coalesce(docs["text"], F.lit("")).alias("text"))


def row_key(doc_id: Column | str = "doc_id", text: Column | str = "text") -> list[Column]:
    """Two never-null longs (128 bits) that name a row by its doc_id and text."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return [F.xxhash64(F.lit(1), doc_id, text).alias("key1"),
            F.xxhash64(F.lit(2), text, doc_id).alias("key2")]


def fresh_names(df: DataFrame, *names: str) -> list[str]:
    """The names, made longer until df has no such columns."""
    have, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in have:
            name += "_"
        out.append(name)
    return out


def fold_of(doc_id: Column | str, n: int) -> Column:
    """crc32 of the doc_id as text, modulo n; a null doc_id counts as empty text."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit("")) if isinstance(doc_id, str) else doc_id
    return F.crc32(text.cast("binary")) % n


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared scratch folder: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words: runs of 0-9, a-z and every byte of a non-ASCII character."""
    return text.translate(WORD_BYTES).split()


def as_bytes(batch: pa.RecordBatch, name: str) -> list[bytes]:
    return batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()


def slices(batches: Iterator[pa.RecordBatch], name: str = "text", max_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches cut so that a column holds about max_bytes, or one row: bounds what becomes Python objects."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(name))), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            done = int(ends[start - 1]) if start else 0
            end = max(start + 1, int(np.searchsorted(ends, done + max_bytes, "right")))
            yield batch.slice(start, end - start)
            start = end
    pa.default_memory_pool().release_unused()  # workers live on; other tasks share the executor's memory


def batches_of(rows: Iterator[tuple], schema: pa.Schema, max_rows: int = 4096,
               max_bytes: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Tuples as record batches of bounded size."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, (bytes, str, list)))
        if len(held) >= max_rows or size >= max_bytes:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(column), type=field.type) for column, field in zip(zip(*rows), schema)],
        schema=schema)
