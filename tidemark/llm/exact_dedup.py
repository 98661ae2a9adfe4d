"""Exact dedup: Patricia tries own the distinct texts.

A text is reduced by deleting white space; its key is (length, SHA-256) of
what is left. Each task first inserts its rows into a trie of its own, so that
copies meet before anything is shuffled: a group that holds a third of all rows
leaves a task as one row. Those rows are partitioned by (length, hash), and each
partition inserts the full byte strings into a compressed radix trie. A
terminal node keeps the owner: the most code points in the original text, then
the smallest doc_id. A trie over its byte budget spills its heaviest subtree
to a file of the task and finishes it on its own, level by level.

Rows find their owner again by joining on the hash (the trie compares whole
byte strings and stops the job if two of them ever shared a hash); a hot hash
is an ordinary skewed join whose other side has one row per hash.

Edge cases: null counts as empty, and all empty texts are equal. A null doc_id
loses to every other. Rows alike in doc_id and text are one document given
several times: each counts in group_size, and all of them are kept if it is
the owner (``keep_owners`` leaves one). An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, as_bytes, batches_of, fresh_names, row_key, shuffle_partitions, slices, text_of

TRIE_BYTES = 64 << 20  # of labels that a trie holds before it spills

Owner = tuple  # (code points, doc_id or None, rows, hash, *extra)


def better(a: Owner, b: Owner) -> Owner:
    """The owner of two equal texts, with the rows of both."""
    first = min(a, b, key=lambda x: (-x[0], x[1] is None, x[1] or 0))
    return (*first[:2], a[2] + b[2], *first[3:])


class _Node:
    __slots__ = ("label", "kids", "owner", "spilled")

    def __init__(self, label: bytes, owner: Owner | None = None):
        self.label, self.owner = label, owner
        self.kids: dict[int, _Node] = {}
        self.spilled = None


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n]) ^ int.from_bytes(b[:n])
    return n - (differ.bit_length() + 7) // 8


class PatriciaTrie:
    """Byte strings with owners; over ``budget`` label bytes the heaviest subtree moves to a file."""

    def __init__(self, budget: int = TRIE_BYTES):
        self.root, self.budget, self.size = _Node(b""), budget, 0
        self.files: list = []

    def insert(self, key: bytes, owner: Owner) -> None:
        node, at = self.root, 0
        while True:
            if node.spilled is not None:
                pickle.dump((key, owner), node.spilled)
                return
            if at == len(key):
                node.owner = better(node.owner, owner) if node.owner else owner
                return
            kid = node.kids.get(key[at])
            if kid is None:
                node.kids[key[at]] = _Node(key[at:], owner)
                self.size += len(key) - at
                break
            if key.startswith(kid.label, at):
                node, at = kid, at + len(kid.label)
                continue
            same = _common(kid.label, key[at:at + len(kid.label)])
            fork = _Node(kid.label[:same])
            kid.label = kid.label[same:]
            fork.kids[kid.label[0]] = kid
            node.kids[key[at]] = fork
            node, at = fork, at + same
        if self.size > self.budget:
            self._spill()

    def _spill(self) -> None:
        node, path = self.root, b""
        while len(node.kids) == 1 and node.spilled is None:
            node = next(iter(node.kids.values()))
            path += node.label
        weights = {first: self._weight(kid) for first, kid in node.kids.items() if kid.spilled is None}
        if not weights:  # one string, or subtrees that are all in files by now
            return
        first = max(weights, key=weights.get)
        kid, file = node.kids[first], tempfile.TemporaryFile()
        for key, owner in self._walk(kid, path):
            pickle.dump((key, owner), file)
        for below in self._spilled(kid):  # its strings would come here from now on
            self.files.remove(below)
            for entry in _entries(below):
                pickle.dump(entry, file)
        kid.kids, kid.owner, kid.spilled = {}, None, file
        self.size -= weights[first] - len(kid.label)
        # what arrives later is told apart from its siblings by the first byte alone
        kid.label, rest = kid.label[:1], len(kid.label) - 1
        self.size -= rest
        self.files.append(file)

    @staticmethod
    def _weight(node: _Node) -> int:
        total, todo = 0, [node]
        while todo:
            node = todo.pop()
            total += len(node.label)
            todo += node.kids.values()
        return total

    @staticmethod
    def _spilled(node: _Node) -> list:
        found, todo = [], [node]
        while todo:
            node = todo.pop()
            found += [node.spilled] if node.spilled is not None else []
            todo += node.kids.values()
        return found

    @staticmethod
    def _walk(node: _Node, path: bytes) -> Iterator[tuple[bytes, Owner]]:
        todo = [(node, path)]
        while todo:
            node, path = todo.pop()
            path += node.label
            if node.owner:
                yield path, node.owner
            todo += [(kid, path) for kid in node.kids.values()]

    def items(self) -> Iterator[tuple[bytes, Owner]]:
        """Every distinct string with its owner; spilled subtrees are rebuilt one at a time."""
        yield from self._walk(self.root, b"")
        for file in self.files:
            part = PatriciaTrie(self.budget)
            for key, owner in _entries(file):
                part.insert(key, owner)
            yield from part.items()


def _entries(file) -> Iterator[tuple[bytes, Owner]]:
    """What was written to a file, which is closed and gone afterwards."""
    file.seek(0)
    while True:
        try:
            yield pickle.load(file)
        except EOFError:
            break
    file.close()


def _reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, Owner]]:
    """doc_id, key1, key2, text rows -> the reduced text and the row as its owner."""
    for batch in slices(batches):
        columns = [batch.column(i).to_pylist() for i in range(3)] + [as_bytes(batch, "text")]
        for doc_id, key1, key2, text in zip(*columns):
            body = text.translate(None, SPACE.encode())
            yield body, (len(text.decode("utf-8", "replace")), doc_id, 1, hashlib.sha256(body).digest(), key1, key2)


def owners(docs: DataFrame, trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """One row per distinct reduced text: hash, doc_id (of the owner), rows, key1, key2 (of its row)."""
    rows = text_of(docs).select("doc_id", *row_key(), "text")
    local = pa.schema([("length", pa.int64()), ("hash", pa.binary()), ("body", pa.binary()), ("points", pa.int64()),
                       ("doc_id", pa.int64()), ("rows", pa.int64()), ("key1", pa.int64()), ("key2", pa.int64())])

    def emit(trie):
        for body, (points, doc_id, n, digest, key1, key2) in trie.items():
            yield len(body), digest, body, points, doc_id, n, key1, key2

    def in_task(batches):
        trie = PatriciaTrie(trie_bytes)
        for body, owner in _reduced(batches):
            trie.insert(body, owner)
            if trie.size > trie_bytes // 2:  # later copies meet again in the partitions
                yield from emit(trie)
                trie = PatriciaTrie(trie_bytes)
        yield from emit(trie)

    def in_partition(batches):
        trie = PatriciaTrie(trie_bytes)
        for batch in slices(batches, "body"):
            names = ("points", "doc_id", "rows", "hash", "key1", "key2")
            columns = [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]
            for body, owner in zip(as_bytes(batch, "body"), zip(*columns)):
                trie.insert(body, owner)
        seen = set()
        for _, (_, doc_id, n, digest, key1, key2) in trie.items():
            if digest in seen:
                raise ValueError(f"two texts share the hash {digest.hex()}")
            seen.add(digest)
            yield digest, doc_id, n, key1, key2

    merged = pa.schema([("hash", pa.binary()), ("doc_id", pa.int64()), ("rows", pa.int64()),
                        ("key1", pa.int64()), ("key2", pa.int64())])
    kinds = "length long, hash binary, body binary, points long, doc_id long, rows long, key1 long, key2 long"
    return (rows.mapInArrow(lambda b: batches_of(in_task(b), local), kinds)
            .repartition(shuffle_partitions(docs.sparkSession), "length", "hash")
            .mapInArrow(lambda b: batches_of(in_partition(b), merged),
                        "hash binary, doc_id long, rows long, key1 long, key2 long"))


def exact_dedup(docs: DataFrame, trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, hash (SHA-256 of the reduced text)."""
    schema = pa.schema([("doc_id", pa.int64()), ("key1", pa.int64()), ("key2", pa.int64()), ("hash", pa.binary())])

    def hashes(batches):
        return batches_of(((o[1], o[4], o[5], o[3]) for _, o in _reduced(batches)), schema, max_rows=16384)

    rows = (text_of(docs).select("doc_id", *row_key(), "text")
            .mapInArrow(hashes, "doc_id long, key1 long, key2 long, hash binary"))
    best = owners(docs, trie_bytes).toDF("hash", "keep_id", "group_size", "keep1", "keep2")
    return rows.join(best, "hash").select(
        "doc_id", "keep_id", "group_size",
        ((F.col("key1") == F.col("keep1")) & (F.col("key2") == F.col("keep2"))).alias("kept"), "hash")


def keep_owners(docs: DataFrame, trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """The owners' rows of docs, all columns; of rows alike in doc_id and text, one."""
    own = fresh_names(docs, "_owner1", "_owner2")
    best = owners(docs, trie_bytes).select(*[F.col(k).alias(n) for k, n in zip(("key1", "key2"), own)])
    return (docs.withColumns(dict(zip(own, row_key(docs["doc_id"], docs["text"]))))
            .join(best, own, "left_semi").dropDuplicates(own).drop(*own))
