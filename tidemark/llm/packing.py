"""Packing: first-fit decreasing over a tournament tree, in randomised groups.

Texts are encoded and cut into pieces of at most ``length`` ids. Every piece
goes to a group drawn by a hash of its row and its number, so groups are random
samples of the table of a bounded size (about ``group_bytes`` of text), whatever
the order, source or copies of the rows. In a group, pieces are placed largest
first into the first sequence with room: a tournament tree over the sequences'
free room finds it in logarithmic time. What first-fit leaves open is closed by
cutting: the emptiest sequences are taken apart and their ids fill the others'
gaps, until all but one sequence of the group are full.

Sequence ids are (group number << 32) + number in the group.

Edge cases: a null or empty text is its end id alone; repeated rows are packed
each; an empty table gives no pieces; a text of any length is many pieces, in
many groups.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches_of, slices, text_of
from tidemark.llm.tokens import encoder


class TournamentTree:
    """Free room of bins; ``first(n)`` is the leftmost bin with room for n."""

    def __init__(self, bins: int, room: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.most = [room] * (2 * self.leaves)

    def first(self, n: int) -> int:
        node = 1
        while node < self.leaves:
            node = 2 * node if self.most[2 * node] >= n else 2 * node + 1
        return node - self.leaves

    def take(self, bin_: int, n: int) -> None:
        node = bin_ + self.leaves
        self.most[node] -= n
        while node > 1:
            node //= 2
            self.most[node] = max(self.most[2 * node], self.most[2 * node + 1])


def first_fit_decreasing(sizes: list[int], room: int) -> list[list[int]]:
    """Bins of indexes into sizes."""
    tree = TournamentTree(max(1, len(sizes)), room)
    bins: list[list[int]] = []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        k = tree.first(sizes[i])
        if k == len(bins):
            bins.append([])
        bins[k].append(i)
        tree.take(k, sizes[i])
    return bins


def close_gaps(bins: list[list[int]], sizes: list[int], room: int) -> list[list[tuple[int, int, int]]]:
    """Bins of (index, start, length): the emptiest bins are cut up to fill the others."""
    out = [[(i, 0, sizes[i]) for i in b] for b in bins]
    free = [room - sum(n for _, _, n in b) for b in out]
    order = sorted(range(len(out)), key=lambda k: free[k])  # fullest first
    fill, empty = 0, len(order) - 1
    while fill < empty:
        to, source = order[fill], order[empty]
        if not free[to]:
            fill += 1
        elif not out[source]:
            empty -= 1
        else:
            i, start, n = out[source].pop()
            part = min(n, free[to])
            out[to].append((i, start, part))
            free[to] -= part
            if part < n:
                out[source].append((i, start + part, n - part))
    return [b for b in out if b]


def pack(docs: DataFrame, vocabulary: str, length: int = 2048, end_id: int = 1,
         group_bytes: int = 8 << 20) -> DataFrame:
    """Per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids (uint32 bytes)."""
    rows = text_of(docs)
    total = rows.agg(F.sum(F.octet_length("text").cast("long") + 256)).first()[0] or 0
    groups = max(1, -(-total // group_bytes))
    end = struct.pack("<I", end_id)
    cut = pa.schema([("doc_id", pa.int64()), ("seed", pa.int64()), ("number", pa.int64()),
                     ("doc_tokens", pa.int64()), ("wide", pa.bool_()), ("ids", pa.binary())])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        import numpy as np

        encode = encoder(vocabulary)
        narrow = max(encode.vocabulary - 1, end_id) < 1 << 16  # two bytes an id on the way
        for batch in slices(batches):
            for doc_id, seed, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                ids = np.frombuffer(encode.encode(text) + end, "<u4")
                sent = ids.astype("<u2") if narrow else ids
                for k in range(0, len(ids), length):
                    yield doc_id, seed, k, len(ids), not narrow, sent[k:k + length].tobytes()

    placed = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
                        ("ids", pa.binary())])

    def group_rows(key, table: pa.Table) -> Iterator[tuple]:
        import numpy as np

        # a fixed order whatever the shuffle delivers, so that a retried task packs alike
        table = table.sort_by([("seed", "ascending"), ("doc_id", "ascending"), ("number", "ascending")])
        doc_ids, numbers, totals, wide, raw = (table.column(n).to_pylist()
                                               for n in ("doc_id", "number", "doc_tokens", "wide", "ids"))
        ids = [np.frombuffer(x, "<u4" if w else "<u2").astype("<u4") for x, w in zip(raw, wide)]
        sizes = [len(x) for x in ids]
        group = key[0].as_py()
        for k, members in enumerate(close_gaps(first_fit_decreasing(sizes, length), sizes, length)):
            offset = 0
            for i, start, n in members:
                yield (doc_ids[i], numbers[i] + start, n, totals[i], (group << 32) + k, offset,
                       ids[i][start:start + n].tobytes())
                offset += n

    def in_group(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return pa.Table.from_batches(batches_of(group_rows(key, table), placed), schema=placed)

    # numbered, so that repeated rows are dealt to different groups too
    seeded = rows.select("doc_id", F.xxhash64(F.monotonically_increasing_id()).alias("seed"), "text")
    group = F.pmod(F.xxhash64("seed", "number"), F.lit(groups)).alias("group")
    return (seeded.mapInArrow(lambda b: batches_of(pieces(b), cut),
                              "doc_id long, seed long, number long, doc_tokens long, wide boolean, ids binary")
            .select(group, "*")
            .groupBy("group")
            .applyInArrow(in_group, "doc_id long, start long, length long, doc_tokens long, "
                                    "sequence_id long, offset long, ids binary"))
