"""Alignment of two tokenizers' tokens over the same bytes.

A is a byte-level BPE vocabulary of the ``tokenizers`` library, B a
sentencepiece model that puts a space before its text; A gets the space
explicitly, so both cover the same bytes. Where a token of each ends at the same
byte, a group ends. A token of A and one of B are linked where their bytes overlap.

Common ends come from galloping intersection: for every end of the shorter
list, doubling steps from its predecessor's place in the longer list find a
range that holds it, and a binary search the place. Equal ends cut the groups,
and the ranks' differences say which tokens overlap: an A token reaches from the rank of its
first byte to the rank of its last. The search advances in lanes: an end list is
cut into stretches whose first places are searched for, and then all
stretches step forward together, so that NumPy does one step of many at once.
Documents follow each other in one byte space, hence one search serves a cell of documents.

Counts over the corpus: a cell (documents of one task up to ``cell_bytes`` of
text, or one longer document) gives each id pair it holds once, with its
links. They are summed by pair and the largest count of each B id is taken (a table no
longer than its vocabulary). The distinct pairs are counted: up to
``broadcast_pairs`` of them go to every task; beyond, the answers go back to the cells that
asked, a frequent pair as one row for each cell. Either way what is exchanged grows
with the input at most, and no task holds more than a cell, a batch of texts or that many pairs.

Edge cases: a text that is null or empty, or whose tokens do not spell the space
and the text (a literal U+2581, say), has no tokens: all its counts are 0 and its digest
is empty. Strings of special tokens are plain text. Repeated rows and shared or null doc_ids
are documents of their own; doc_id may have any type. An empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from tidemark.llm.common import slices, text_of, written
from tidemark.llm.tokens import _BYTE_CHARACTERS

LANE = 32  # ends that a lane of the search takes one after another


# Fixed value: how byte-level vocabularies part a text, as a pattern.
BYTE_LEVEL_PARTS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_LATIN = re.compile("[\x00-\u024f\u2010-\u2026]*+")


class _Tokens:
    """Ids of a vocabulary, and the bytes of each id."""

    bytes: list[bytes]

    def _list(self, text: str) -> list[int]:
        """Ids of a space and the text."""
        raise NotImplementedError

    def encode(self, text: str) -> np.ndarray | None:
        """Ids of a space and the text; None if they do not spell it."""
        ids = self._list(text)
        return np.array(ids, "<u4") if b"".join(map(self.bytes.__getitem__, ids)) == (" " + text).encode() else None

    def sizes(self) -> np.ndarray:
        if not hasattr(self, "_sizes"):
            self._sizes = np.array([len(x) for x in self.bytes], np.int64)
        return self._sizes


class ByteTokens(_Tokens):
    """A byte-level BPE vocabulary of the ``tokenizers`` library.

    Where its merges are in the order of the ids they make, ``tiktoken`` gives
    the same ids several times faster; it gets the texts of Latin letters and signs, for
    which the two libraries' character classes are the same.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True  # their strings in a text are ordinary text
        byte_of = {chr(_BYTE_CHARACTERS.get(b, b)): b for b in range(256)}
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, parts = spec["model"], spec.get("pre_tokenizer") or {}
        vocabulary = model["vocab"]
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            if all(c in byte_of for c in token):
                self.bytes[i] = bytes(byte_of[c] for c in token)
        made = [vocabulary.get("".join(x if isinstance(x, list) else x.split(" "))) for x in model["merges"]]
        self.fast = None
        if (made == list(range(256, 256 + len(made))) and parts.get("type") == "ByteLevel" and parts.get("use_regex", True)
                and not (parts.get("add_prefix_space") or spec.get("normalizer") or model.get("dropout")
                         or model.get("ignore_merges"))):
            import tiktoken

            ranks = {self.bytes[i]: i for i in range(256 + len(made))}
            self.fast = tiktoken.Encoding("parts", pat_str=BYTE_LEVEL_PARTS, mergeable_ranks=ranks, special_tokens={})

    def _list(self, text: str) -> list[int]:
        if self.fast is not None and _LATIN.fullmatch(text):
            return self.fast.encode_ordinary(" " + text)
        return self.library.encode(" " + text, add_special_tokens=False).ids


class PieceTokens(_Tokens):
    """A sentencepiece model, which puts a space before its text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [self._bytes(i) for i in range(self.model.get_piece_size())]

    def _bytes(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()

    def _list(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)


_loaded: dict[tuple[type, str], ByteTokens | PieceTokens] = {}


def tokens_of(kind: type, path: str) -> ByteTokens | PieceTokens:
    """One in each Python worker."""
    if (kind, path) not in _loaded:
        _loaded[kind, path] = kind(path)
    return _loaded[kind, path]


def _bisect(longer: np.ndarray, wanted: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """First places in [low, high] whose value is not below the wanted one, all of them at once."""
    while True:
        wide = low < high
        if not wide.any():
            return low
        middle = (low + high) >> 1
        below = wide & (longer[np.minimum(middle, len(longer) - 1)] < wanted)
        low = np.where(below, middle + 1, low)
        high = np.where(wide & ~below, middle, high)


def gallop(shorter: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """For every value of an ascending list the first place in another whose value is not below it."""
    n, m = len(shorter), len(longer)
    out = np.empty(n, np.int64)
    if not n or not m:
        out[:] = 0
        return out
    lanes = -(-n // LANE)
    starts = np.arange(lanes) * LANE
    place = _bisect(longer, shorter[starts], np.zeros(lanes, np.int64), np.full(lanes, m, np.int64))
    out[starts] = place
    for step in range(1, LANE):
        alive = int(np.searchsorted(starts, n - step, "left"))  # the last lane may be shorter
        if not alive:
            break
        wanted, low = shorter[starts[:alive] + step], place[:alive]
        high, jump = low.copy(), 1
        while True:
            short = (high < m) & (longer[np.minimum(high, m - 1)] < wanted)
            if not short.any():
                break
            low = np.where(short, high + 1, low)
            high = np.where(short, np.minimum(high + jump, m), high)
            jump *= 2
        place = _bisect(longer, wanted, low, high)
        out[starts[:alive] + step] = place
    return out


class Aligned:
    """Tokens of A and B over the same bytes: where groups end, and which tokens overlap.

    ``first`` and ``last``: the first and the last B token that each A token overlaps.
    ``cut_a``, ``cut_b``: for each group the token of A and of B that ends it.
    """

    def __init__(self, a_sizes: np.ndarray, b_sizes: np.ndarray):
        a_ends, b_ends = np.cumsum(a_sizes), np.cumsum(b_sizes)
        if len(a_ends) <= len(b_ends):
            self.last = gallop(a_ends, b_ends)
            self.cut_a = np.flatnonzero(b_ends[self.last] == a_ends) if len(b_ends) else np.empty(0, np.int64)
            self.cut_b = self.last[self.cut_a]
        else:
            place = gallop(b_ends, a_ends)
            self.cut_b = np.flatnonzero(a_ends[place] == b_ends)
            self.cut_a = place[self.cut_b]
            # an A token ends in the first B token whose end is not before its own: B ends counted by the A token they lie in
            inside = np.bincount(place, minlength=len(a_ends))
            ended = np.zeros(len(a_ends), np.int64)
            ended[self.cut_a] = 1
            self.last = np.cumsum(inside) - ended
        self.first = np.empty_like(self.last)
        if len(self.last):
            self.first[0] = 0
            self.first[1:] = self.last[:-1]
            after = self.cut_a[self.cut_a + 1 < len(self.first)]
            self.first[after + 1] += 1  # a group ended before: its last B token is not shared

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of linked tokens: A's, ascending, and B's."""
        n = self.last - self.first + 1
        a = np.repeat(np.arange(len(n)), n)
        return a, np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.first, n)


class _Groups:
    """The text of a cell's groups: decimal ids, ``,`` inside a side, ``|`` between A and B, ``;`` between groups."""

    def __init__(self, n_a: int, n_b: int):
        words = [f"{i}{end}".encode() for n, ends in ((n_a, ",|"), (n_b, ",;")) for end in ends for i in range(n)]
        self.sizes = np.array([len(x) for x in words], np.int64)
        wide = int(self.sizes.max())
        self.table = np.frombuffer(b"".join(x.ljust(wide, b"\0") for x in words), np.uint8).reshape(-1, wide)
        self.n_a, self.n_b = n_a, n_b

    def _ordered(self, a: np.ndarray, b: np.ndarray, aligned: Aligned) -> np.ndarray:
        """Places in ``table`` of all tokens, A's before B's in each group."""
        out = np.empty(len(a) + len(b), np.int64)
        a_word, b_word = a.astype(np.int64), 2 * self.n_a + b.astype(np.int64)
        a_word[aligned.cut_a] += self.n_a
        b_word[aligned.cut_b] += self.n_b
        a_group = np.zeros(len(a), np.int64)  # groups that ended before
        b_group = np.zeros(len(b), np.int64)
        a_group[aligned.cut_a[:-1] + 1] = 1
        b_group[aligned.cut_b[:-1] + 1] = 1
        a_group, b_group = np.cumsum(a_group), np.cumsum(b_group)
        out[np.arange(len(a)) + np.concatenate([[0], aligned.cut_b + 1])[a_group]] = a_word
        out[np.arange(len(b)) + (aligned.cut_a + 1)[b_group]] = b_word
        return out

    def digests(self, a: np.ndarray, b: np.ndarray, aligned: Aligned, tokens: np.ndarray) -> list[str]:
        """sha256 of each document's groups; ``tokens``: of A and B together, by document."""
        if not len(a):
            return [""] * len(tokens)
        order = self._ordered(a, b, aligned)
        text = self.table[order].ravel()
        text = memoryview(text[text != 0])
        ends = np.concatenate([[0], np.cumsum(self.sizes[order])])[np.concatenate([[0], np.cumsum(tokens)])].tolist()
        return [hashlib.sha256(text[start:end - 1]).hexdigest() if end > start else ""
                for start, end in zip(ends, ends[1:])]


def _tokens(byte_vocabulary: str, piece_model: str) -> tuple[ByteTokens, PieceTokens]:
    return tokens_of(ByteTokens, byte_vocabulary), tokens_of(PieceTokens, piece_model)


def token_cells(docs: DataFrame, byte_vocabulary: str, piece_model: str, cell_bytes: int = 2 << 20) -> DataFrame:
    """One row per document: cell, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, a, b (ids, little-endian of
    ``_id_type``); a cell's first row in each batch also has the id pairs linked there and how often (pair, n).

    Written as a table: cells are named by task, and stay what they are.
    """
    texts = text_of(docs)
    out = StructType([StructField("cell", LongType()), texts.schema["doc_id"],
                      *[StructField(x, LongType()) for x in ("n_a", "n_b", "n_groups", "n_links")],
                      StructField("groups_sha256", StringType()),
                      StructField("a", BinaryType()), StructField("b", BinaryType()),
                      StructField("pair", ArrayType(LongType())), StructField("n", ArrayType(LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(byte_vocabulary, piece_model)
        groups = _Groups(*[len(x.bytes) for x in tokens])
        cell = TaskContext.get().partitionId() << 32
        held = 0
        for batch in slices(batches, max_bytes=cell_bytes // 2):
            size = pc.sum(pc.binary_length(batch.column(1))).as_py() or 0
            if held and held + size > cell_bytes:
                cell, held = cell + 1, 0
            held += size
            yield _cell_rows(cell, batch, *tokens, groups)

    return written(texts.mapInArrow(run, out), "alignment-cells")


def _id_type(tokens: _Tokens) -> str:
    return "<u2" if len(tokens.bytes) <= 1 << 16 else "<u4"


def _cell_rows(cell: int, batch: pa.RecordBatch, tokens_a: ByteTokens, tokens_b: PieceTokens,
               groups: _Groups) -> pa.RecordBatch:
    every: list[tuple[np.ndarray, np.ndarray]] = []
    for text in batch.column(1).to_pylist():
        a = tokens_a.encode(text) if text else None
        b = tokens_b.encode(text) if a is not None else None
        every.append((a, b) if b is not None else (_NONE, _NONE))
    n_a, n_b = (np.array([len(x[k]) for x in every], np.int64) for k in (0, 1))
    a, b = (np.concatenate([x[k] for x in every]) for k in (0, 1))
    aligned = Aligned(tokens_a.sizes()[a], tokens_b.sizes()[b])
    ends = np.concatenate([[0], np.cumsum(n_a)])
    n_groups = np.diff(np.searchsorted(aligned.cut_a, ends, "left"))
    n_links = np.diff(np.concatenate([[0], np.cumsum(aligned.last - aligned.first + 1)])[ends])
    pair, n = np.unique(_pairs(a, b, aligned)[0], return_counts=True)
    firsts = [None] * (len(every) - 1)
    ids = ((a.astype(_id_type(tokens_a)), n_a), (b.astype(_id_type(tokens_b)), n_b))
    return pa.RecordBatch.from_arrays(
        [pa.array([cell] * len(every), pa.int64()), batch.column(0), *map(pa.array, (n_a, n_b, n_groups, n_links)),
         pa.array(groups.digests(a, b, aligned, n_a + n_b), pa.string()), *[_rows_of(*x) for x in ids],
         pa.array([pair, *firsts], pa.list_(pa.int64())), pa.array([n.astype(np.int64), *firsts], pa.list_(pa.int64()))],
        names=["cell", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "a", "b", "pair", "n"])


_NONE = np.empty(0, "<u4")


def _rows_of(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A binary column of stretches of ids."""
    ends = np.concatenate([[0], np.cumsum(counts)]) * ids.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(counts),
                                 [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(ids)]).cast(pa.binary())


def _ids(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a binary column, and the number in each row."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), kind), np.array([len(x) for x in rows], np.int64) // np.dtype(kind).itemsize


def _pairs(a: np.ndarray, b: np.ndarray, aligned: Aligned) -> tuple[np.ndarray, np.ndarray]:
    """Of all links the id pair (A's in the upper half), and the A token's place."""
    places_a, places_b = aligned.links()
    return a[places_a].astype(np.int64) << 32 | b[places_b].astype(np.int64), places_a


def pair_requests(cells: DataFrame) -> DataFrame:
    """cell, pair, n: links by id pair, summed in each batch of a cell."""
    each = F.explode(F.arrays_zip("pair", "n"))
    return cells.where("pair IS NOT NULL").select("cell", each.alias("e")).select("cell", "e.pair", "e.n")


def pair_counts(requests: DataFrame) -> DataFrame:
    """pair, count, best (whether it is the B id's largest): over all cells."""
    counts = requests.groupBy("pair").agg(F.sum("n").alias("count"))
    b = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))
    most = counts.groupBy(b.alias("b")).agg(F.max("count").alias("most"))  # at most a row for each id of B
    return (counts.withColumn("b", b).join(most, "b")
            .select("pair", "count", (F.col("count") == F.col("most")).alias("best")))


class _Counts:
    """Counts of pairs, for the sums of documents."""

    def __init__(self, pair: np.ndarray, count: np.ndarray, best: np.ndarray):
        order = np.argsort(pair)
        self.pair = pair[order]
        self.values = best[order].astype(np.int64), count[order].astype(np.int64)

    def sums(self, batch: pa.RecordBatch, tokens: tuple[ByteTokens, PieceTokens]) -> list[np.ndarray]:
        """n_best and count_sum of each row of (a, b)."""
        (a, n_a), (b, _) = (_ids(batch.column(k), _id_type(x)) for k, x in enumerate(tokens))
        if not len(a):
            return [np.zeros(len(n_a), np.int64)] * 2
        pairs, at = _pairs(a, b, Aligned(tokens[0].sizes()[a], tokens[1].sizes()[b]))
        place = np.searchsorted(self.pair, pairs)
        ends = np.searchsorted(at, np.concatenate([[0], np.cumsum(n_a)]), "left")
        return [np.diff(np.concatenate([[0], np.cumsum(x[place])])[ends]) for x in self.values]


_NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def _summed(rows: pa.Table | pa.RecordBatch, sums: list[np.ndarray]) -> list[pa.Array]:
    names = rows.schema.names
    return [*[rows.column(names.index(x)) for x in ("doc_id", *_NUMBERS[:4])], *map(pa.array, sums),
            rows.column(names.index("groups_sha256"))]


def align(docs: DataFrame, byte_vocabulary: str, piece_model: str, cell_bytes: int = 2 << 20,
          broadcast_pairs: int = 4_000_000) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document.

    The counts go to all tasks if the corpus has ``broadcast_pairs`` distinct
    pairs at most (17 bytes each), else each cell is sent those that it asked for.
    """
    spark = docs.sparkSession
    cells = token_cells(docs, byte_vocabulary, piece_model, cell_bytes)
    counts = written(pair_counts(pair_requests(cells)), "alignment-counts")
    out = StructType([cells.schema["doc_id"], *[StructField(x, LongType()) for x in _NUMBERS],
                      StructField("groups_sha256", StringType())])
    rows = cells.drop("pair", "n")
    names = ["doc_id", *_NUMBERS, "groups_sha256"]
    if counts.count() <= broadcast_pairs:
        held = counts.toArrow()
        sent = spark.sparkContext.broadcast(tuple(held.column(x).to_numpy() for x in ("pair", "count", "best")))

        def by_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tokens, known = _tokens(byte_vocabulary, piece_model), _Counts(*sent.value)
            for batch in slices(batches, "a", 1 << 20):
                sums = known.sums(batch.select(["a", "b"]), tokens)
                yield pa.RecordBatch.from_arrays(_summed(batch, sums), names=names)

        return rows.mapInArrow(by_batch, out)

    answers = pair_requests(cells).select(F.col("cell").alias("asked"), "pair").join(counts, "pair")

    def by_cell(held: pa.Table, found: pa.Table) -> pa.Table:
        tokens = _tokens(byte_vocabulary, piece_model)
        known = _Counts(*[found.column(x).to_numpy() for x in ("pair", "count", "best")])
        sums = [known.sums(x, tokens) for x in slices(iter(held.select(["a", "b"]).to_batches()), "a", 1 << 20)]
        whole = [np.concatenate([x[k] for x in sums]) if sums else np.empty(0, np.int64) for k in (0, 1)]
        return pa.table(_summed(held, whole), names=names)

    return rows.groupBy("cell").cogroup(answers.groupBy("asked")).applyInArrow(by_cell, out)
