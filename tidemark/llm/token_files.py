"""Token ids in a packed binary format, and back.

A file image holds the ids of consecutive documents at a fixed width, the
fewest bits that hold every id of the vocabulary:

    header      magic "TDBP", version, bits, ids per block, documents, ids
    documents   per document its doc_id (int64), flag (1: the id is null) and id count
    offsets     the byte offset of each block's first byte, uint64
    blocks      ids, ``bits`` bits each, least significant bit first

A block holds 4096 ids (a multiple of 8), so any block starts on a byte and
can be unpacked on its own: ``read_ids`` unpacks only the blocks that a range
of ids touches, with a few numpy operations.

Images are rows of a Parquet table (file, image) in the shared folder: written
and read by Spark's own connectors, they work on every store that Spark
knows, and a retried task replaces its images whole. Documents are range
partitioned by doc_id; a partition writes images of about ``image_ids`` ids,
and an image's first global position is the sum of those before it (one row
per partition, gathered on the driver).

Edge cases: a null or empty text is the end id alone. Rows with a null doc_id
come first; rows that share a doc_id follow each other, ordered by text hash. A text of any length is
one document of one image. An empty table gives no image.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches_of, row_key, shuffle_partitions, slices, text_of, written
from tidemark.llm.tokens import encoder

MAGIC, VERSION, BLOCK_IDS = b"TDBP", 1, 4096
_HEADER = struct.Struct("<4sHHIQQ")  # magic, version, bits, ids per block, documents, ids


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """ids at ``bits`` bits each, least significant first; eight ids fill ``bits`` whole bytes."""
    groups = np.zeros((-(-len(ids) // 8), 8), np.uint64)
    groups.reshape(-1)[:len(ids)] = ids
    out = np.zeros((len(groups), bits), np.uint8)
    for i in range(8):
        at, shift = divmod(i * bits, 8)
        value = groups[:, i] << np.uint64(shift)
        for k in range((shift + bits + 7) // 8):
            out[:, at + k] |= (value >> np.uint64(8 * k)).astype(np.uint8)
    return out.tobytes()


def unpack_bits(data: bytes | memoryview, bits: int, n: int) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(-1, bits)
    out = np.empty((len(raw), 8), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for i in range(8):
        at, shift = divmod(i * bits, 8)
        value = np.zeros(len(raw), np.uint64)
        for k in range((shift + bits + 7) // 8):
            value |= raw[:, at + k].astype(np.uint64) << np.uint64(8 * k)
        out[:, i] = (value >> np.uint64(shift)) & mask
    return out.reshape(-1)[:n]


def pack_image(doc_ids: list[int | None], ids: list[bytes], bits: int) -> bytes:
    """A file image of documents; ids are little-endian uint32 bytes."""
    counts = np.array([len(x) // 4 for x in ids], np.uint64)
    every = np.frombuffer(b"".join(ids), "<u4")
    blocks = -(-len(every) // BLOCK_IDS)
    head = _HEADER.pack(MAGIC, VERSION, bits, BLOCK_IDS, len(doc_ids), len(every))
    names = np.array([x or 0 for x in doc_ids], "<i8").tobytes()
    flags = np.array([x is None for x in doc_ids], np.uint8).tobytes()
    start = len(head) + len(names) + len(flags) + 8 * len(counts) + 8 * blocks
    # whole blocks end on a byte, so packing all ids at once packs them block by block
    offsets = (start + np.arange(blocks, dtype=np.uint64) * np.uint64(BLOCK_IDS // 8 * bits)).astype("<u8").tobytes()
    return b"".join([head, names, flags, counts.astype("<u8").tobytes(), offsets, pack_bits(every, bits)])


class Image:
    """Random access to a file image."""

    def __init__(self, data: bytes):
        magic, version, self.bits, self.block, n, self.n_ids = _HEADER.unpack_from(data)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not an image of token ids")
        self.data, at = memoryview(data), _HEADER.size
        names = np.frombuffer(data, "<i8", n, at)
        flags = np.frombuffer(data, np.uint8, n, at + 8 * n)
        self.doc_ids = [None if flag else int(name) for name, flag in zip(names, flags)]
        counts = np.frombuffer(data, "<u8", n, at + 9 * n).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        self.offsets = np.frombuffer(data, "<u8", -(-self.n_ids // self.block), at + 17 * n)

    def read_ids(self, start: int, end: int) -> np.ndarray:
        """ids [start, end) of the image; only their blocks, which lie one after another, are unpacked."""
        if start >= end:
            return np.empty(0, np.uint32)
        first, last = start // self.block, (end - 1) // self.block
        n = min((last + 1) * self.block, self.n_ids) - first * self.block
        at = int(self.offsets[first])
        ids = unpack_bits(self.data[at:at + -(-n // 8) * self.bits], self.bits, n)
        return ids[start - first * self.block:end - first * self.block]

    def document(self, k: int) -> np.ndarray:
        return self.read_ids(int(self.starts[k]), int(self.starts[k + 1]))


def write_token_files(docs: DataFrame, vocabulary: str, end_id: int = 1,
                      image_ids: int = 1 << 20) -> DataFrame:
    """Encode every text, append end_id, write images in ascending doc_id order.

    Returns the table read back: part, file (its number in the part), first (ids of the part before it),
    n_ids, image.
    """
    spark = docs.sparkSession
    schema = pa.schema([("part", pa.int32()), ("file", pa.int32()), ("first", pa.int64()),
                        ("n_ids", pa.int64()), ("image", pa.binary())])
    end = struct.pack("<I", end_id)

    def images(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        encode, part, file = encoder(vocabulary), TaskContext.get().partitionId(), 0
        bits = max(encode.vocabulary - 1, end_id, 1).bit_length()
        names: list[int | None] = []
        ids: list[bytes] = []
        held = first = 0
        for batch in slices(batches):
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                names.append(name)
                ids.append(encode.encode(text) + end)
                held += len(ids[-1]) // 4
                if held >= image_ids:
                    yield part, file, first, held, pack_image(names, ids, bits)
                    names, ids, held, first, file = [], [], 0, first + held, file + 1
        if names:
            yield part, file, first, held, pack_image(names, ids, bits)

    def run(batches):
        return batches_of(images(batches), schema, max_rows=8)

    ordered = (text_of(docs)
               .select("doc_id", "text", row_key()[0])
               .repartitionByRange(shuffle_partitions(spark), F.col("doc_id").asc_nulls_first(), "key1")
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "key1")
               .select("doc_id", "text"))
    return written(ordered.mapInArrow(run, "part int, file int, first long, n_ids long, image binary"), "token-files")


def read_token_files(files: DataFrame) -> DataFrame:
    """Per document, from the images: doc_id, start (ids of all documents before it), ids (uint32 bytes)."""
    totals = dict(files.groupBy("part").agg(F.sum("n_ids")).collect())  # one row per partition
    parts = sorted(totals)
    base = dict(zip(parts, accumulate((totals[p] for p in parts), initial=0)))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for part, first, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                image = Image(data)
                ids = image.read_ids(0, image.n_ids).astype("<u4")
                for name, start, end in zip(image.doc_ids, image.starts.tolist(), image.starts[1:].tolist()):
                    yield name, base[part] + first + start, ids[start:end].tobytes()

    def run(batches):
        return batches_of(documents(batches), schema)

    return files.select("part", "first", "image").mapInArrow(run, "doc_id long, start long, ids binary")
