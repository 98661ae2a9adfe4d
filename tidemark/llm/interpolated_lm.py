"""A bigram language model by deleted interpolation, learned and applied at corpus size.

    P(w | v) = L(b) c(v w) / c(v) + (1 - L(b)) (c(w) + 0.1) / (N + 0.1 (V + 1))

c are counts over the training documents, b = floor(log2 c(v)) the bucket of
the context's frequency. L is learned by expectation-maximisation on held-out
counts: every training token is scored with its own occurrence deleted from
c(v w), c(v) and c(w).

How it runs. A cell is a run of rows of one input partition, ``cell_bytes`` of text or one longer text. Each cell counts its own distinct
words and bigrams (64-bit hashes) and sends, to each of the hash buckets, one
row with its sorted keys and training counts: a word that makes up a third of
all tokens leaves a cell as one key. A bucket adds the counts up and answers
each cell with one row of totals in the order it asked, so no key travels back.
There are two buckets a cell; so that the rows do not grow with the square of
the cells, a cell sends ``fan`` rows at most. Beyond that many buckets the
exchange takes several steps: the rows of about ``fan`` cells for one range of hashes are added up, that
sum is cut into finer ranges like a cell of its own, and its answers
are dealt to the cells it came from. Each step sends ``fan`` rows a cell at most, and keys that cells share go on as one.
The cell's documents meet its answers in a cogroup, and each text becomes two
arrays, c(w) and c(v w) per token, written to the shared folder. EM and scoring read only that
table; EM sees a histogram of ratios per bucket, at most BUCKETS x BINS rows
whatever the input.

Cells must read the same rows both times, so ``docs`` has to come from files
(partitions by file splits); each answer carries a checksum of its keys and a
mismatch stops the job.

Edge cases: a null or empty text is its end token alone. A null doc_id counts
as empty text for the fold. Repeated rows count and are scored each. Without
training tokens N and V are 0 and every token has the base probability, 1.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import as_bytes, batches_of, fold_of, slices, text_of, written

BUCKETS = 40         # of log2 context counts
BINS = 2048          # of the ratio of bigram to unigram probability, 32 to the doubling; bin 0: ratio 0
ADD = 0.1
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_END = b"\x00 end"   # no word holds a space
_START = b"\x00 start"

_PACKED = pa.schema([("bucket", pa.int64()), ("cell", pa.int64()), ("n_words", pa.int32()),
                     ("keys", pa.binary()), ("counts", pa.binary())])
_ANSWER = pa.schema([("cell", pa.int64()), ("bucket", pa.int64()), ("n_words", pa.int32()), ("check", pa.int64()),
                     ("tokens", pa.int64()), ("distinct", pa.int64()), ("totals", pa.binary())])
_TABLE = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                    ("train_tokens", pa.int64()), ("train_words", pa.int64()),
                    ("words", pa.binary()), ("bigrams", pa.binary())])


class _Hashes(dict):
    """word -> 64-bit hash; emptied when it holds ``limit`` words."""

    def __init__(self, limit: int = 200_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _Hashes()


def hashed(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of all tokens (an end after each text), bigram hashes, tokens per text."""
    parts, get, end = [], _hashes.__getitem__, np.array([_hashes[_END]], np.uint64)
    sizes = np.empty(len(texts), np.int64)
    for i, text in enumerate(texts):
        found = text.translate(_LOWER).split()  # bytes split at [\x20\x09-\x0D]
        parts += [np.fromiter(map(get, found), np.uint64, len(found)), end]
        sizes[i] = len(found) + 1
    w = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    v = np.empty_like(w)
    v[1:] = w[:-1]
    v[np.cumsum(sizes) - sizes] = _hashes[_START]
    return w, _mixed(v, w), sizes


def _mixed(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    """A 64-bit hash of two (fixed odd multipliers of the golden ratio and of MurmurHash3)."""
    x = v * np.uint64(0x9E3779B97F4A7C15) + w
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, byte plane by byte plane, so that the shuffle's codec shrinks them."""
    return np.diff(keys, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack_sorted(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").reshape(-1), dtype=np.uint64)


def pack_counts(counts: np.ndarray) -> bytes:
    """Counts as byte planes of the narrowest unsigned type that holds them, its width first."""
    top = int(counts.max(initial=0))
    width = next(n for n in (1, 2, 4, 8) if top < 1 << (8 * n))
    planes = counts.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T
    return bytes([width]) + planes.tobytes()


def unpack_counts(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").reshape(-1).astype(np.int64)


def _bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)  # ranges of the hash: sorted keys stay sorted


def _check(words: np.ndarray, bigrams: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        return int((words.sum(dtype=np.uint64) * np.uint64(3) + bigrams.sum(dtype=np.uint64)).view(np.int64))


def _distinct(texts: list[bytes]):
    w, vw, sizes = hashed(texts)
    words, word_at = _numbered(w)
    bigrams, bigram_at = _numbered(vw)
    return words, word_at, bigrams, bigram_at, sizes


def _numbered(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, sorted, and where each value stands among them."""
    distinct, at = np.unique(x, return_inverse=True)
    return distinct, at.astype(np.int32)


def _column(table: pa.Table | pa.RecordBatch, name: str) -> list:
    return table.column(table.schema.get_field_index(name)).to_pylist()


def _split(unit: int, first: int, words: np.ndarray, word_counts: np.ndarray, bigrams: np.ndarray,
           bigram_counts: np.ndarray, fan: int, buckets: int) -> Iterator[tuple]:
    """Sorted keys as one row for each of the ``fan`` buckets from ``first`` on, of ``buckets`` in all."""
    edge = first + np.arange(fan + 1)
    w_at = np.searchsorted(_bucket_of(words, buckets), edge)
    b_at = np.searchsorted(_bucket_of(bigrams, buckets), edge)
    for k in range(fan):
        w, b = slice(w_at[k], w_at[k + 1]), slice(b_at[k], b_at[k + 1])
        yield (first + k, unit, int(w.stop - w.start), pack_sorted(words[w]) + pack_sorted(bigrams[b]),
               pack_counts(np.concatenate([word_counts[w], bigram_counts[b]])))


def _requests(cell: int, held: list[bool], texts: list[bytes], buckets: int) -> Iterator[tuple]:
    words, word_at, bigrams, bigram_at, sizes = _distinct(texts)
    train = np.repeat(~np.array(held, bool), sizes).astype(np.float64)
    n_words = np.bincount(word_at, train, len(words)).astype(np.int64)
    n_bigrams = np.bincount(bigram_at, train, len(bigrams)).astype(np.int64)
    yield from _split(cell, 0, words, n_words, bigrams, n_bigrams, buckets, buckets)


def _added(key: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys, sorted, their totals, and where each key stands among them."""
    distinct, at = np.unique(key, return_inverse=True)
    return distinct, np.bincount(at, counts, len(distinct)).astype(np.int64), at


def _asked(table: pa.Table) -> tuple[list[int], list[np.ndarray], list[np.ndarray], np.ndarray, np.ndarray]:
    """cells, words and bigrams of each, and all word and bigram counts, of a bucket's rows."""
    words, bigrams, word_counts, bigram_counts = [], [], [], []
    for n, keys, counts in zip(*(_column(table, x) for x in ("n_words", "keys", "counts"))):
        counts = unpack_counts(counts)
        words.append(unpack_sorted(keys[:8 * n]))
        bigrams.append(unpack_sorted(keys[8 * n:]))
        word_counts.append(counts[:n])
        bigram_counts.append(counts[n:])
    return _column(table, "cell"), words, bigrams, np.concatenate(word_counts), np.concatenate(bigram_counts)


def _told(bucket: int, cells: list[int], words: list[np.ndarray], bigrams: list[np.ndarray], word_totals: np.ndarray,
          bigram_totals: np.ndarray, tokens: int, distinct: int) -> Iterator[tuple]:
    """The rows that answer a bucket's cells, from the totals of all their keys in turn."""
    w = b = 0
    for cell, ws, bs in zip(cells, words, bigrams):
        totals = np.concatenate([word_totals[w:w + len(ws)], bigram_totals[b:b + len(bs)]])
        yield cell, bucket, len(ws), _check(ws, bs), tokens, distinct, pack_counts(totals)
        w, b = w + len(ws), b + len(bs)


def _answers(bucket: int, table: pa.Table) -> Iterator[tuple]:
    cells, words, bigrams, word_counts, bigram_counts = _asked(table)
    _, word_totals, word_at = _added(np.concatenate(words), word_counts)
    _, bigram_totals, bigram_at = _added(np.concatenate(bigrams), bigram_counts)
    yield from _told(bucket, cells, words, bigrams, word_totals[word_at], bigram_totals[bigram_at],
                     int(word_totals.sum()), int((word_totals > 0).sum()))


def _summed(unit: int, bucket: int, table: pa.Table, fan: int, buckets: int) -> Iterator[tuple]:
    """Rows of several cells for one bucket, added up and cut into finer buckets."""
    _, words, bigrams, word_counts, bigram_counts = _asked(table)
    w, n_w, _ = _added(np.concatenate(words), word_counts)
    b, n_b, _ = _added(np.concatenate(bigrams), bigram_counts)
    yield from _split(unit, bucket * fan, w, n_w, b, n_b, fan, buckets)


def _joined(answers: pa.Table, words: int, bigrams: int, check: int, rows: int) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Totals of the words and bigrams of a cell, N and V, from the rows of its buckets; they must be of its keys."""
    order = np.argsort(_column(answers, "bucket"))
    n_words, checks, totals = (_column(answers, n) for n in ("n_words", "check", "totals"))
    got = [unpack_counts(totals[k]) for k in order]
    word_totals = np.concatenate([x[:n_words[k]] for x, k in zip(got, order)])
    bigram_totals = np.concatenate([x[n_words[k]:] for x, k in zip(got, order)])
    with np.errstate(over="ignore"):
        found = int(np.array(checks, np.int64).sum(dtype=np.int64))
    if (len(order), len(word_totals), len(bigram_totals), found) != (rows, words, bigrams, check):
        raise RuntimeError("a partition's rows changed between two reads; write docs to a table first")
    return word_totals, bigram_totals, sum(_column(answers, "tokens")), sum(_column(answers, "distinct"))


def _dealt(bucket: int, asked: pa.Table, answers: pa.Table, fan: int) -> Iterator[tuple]:
    """What a sum of cells was answered, dealt to those cells."""
    cells, words, bigrams, word_counts, bigram_counts = _asked(asked)
    w, _, word_at = _added(np.concatenate(words), word_counts)
    b, _, bigram_at = _added(np.concatenate(bigrams), bigram_counts)
    word_totals, bigram_totals, tokens, distinct = _joined(answers, len(w), len(b), _check(w, b), fan)
    yield from _told(bucket, cells, words, bigrams, word_totals[word_at], bigram_totals[bigram_at], tokens, distinct)


def _counted(docs: pa.Table, answers: pa.Table, buckets: int) -> Iterator[tuple]:
    """The documents of a cell with c(w) and c(v w) of each of their tokens."""
    held, ids = _column(docs, "held_out"), _column(docs, "doc_id")
    words, word_at, bigrams, bigram_at, sizes = _distinct(
        docs.column(docs.schema.get_field_index("text")).cast(pa.binary()).to_pylist())
    word_totals, bigram_totals, n, v = _joined(answers, len(words), len(bigrams), _check(words, bigrams), buckets)
    c_w, c_vw = word_totals[word_at], bigram_totals[bigram_at]
    del word_at, bigram_at, words, bigrams
    start = 0
    for doc_id, out, size in zip(ids, held, sizes.tolist()):
        own = slice(start, start + size)
        yield doc_id, out, size, n, v, pack_counts(c_w[own]), pack_counts(c_vw[own])
        start += size


_ASKED = "bucket long, cell long, n_words int, keys binary, counts binary"
_TOLD = "cell long, bucket long, n_words int, check long, tokens long, distinct long, totals binary"


def _exchange(asked: DataFrame, senders: int, fan: int, buckets: int, last: int) -> DataFrame:
    """Answers to the rows of cells: of ``senders`` cells that share each of ``buckets`` buckets, ``last`` in the end."""
    def answers(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return pa.Table.from_batches(batches_of(_answers(key[0].as_py(), table), _ANSWER), schema=_ANSWER)

    if buckets >= last:
        return asked.groupBy("bucket").applyInArrow(answers, _TOLD)

    groups = max(1, -(-senders // fan))  # of cells, each with a sum for every bucket

    def summed(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        unit, bucket = key[0].as_py(), key[1].as_py()
        return pa.Table.from_batches(batches_of(_summed(unit, bucket, table, fan, buckets * fan), _PACKED), schema=_PACKED)

    def dealt(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        return pa.Table.from_batches(batches_of(_dealt(key[1].as_py(), left, right, fan), _ANSWER), schema=_ANSWER)

    unit = F.pmod(F.xxhash64("cell"), F.lit(groups)) * buckets + F.col("bucket")
    asked = written(asked.withColumn("unit", unit), "lm-asked")
    sums = asked.groupBy("unit", "bucket").applyInArrow(summed, _ASKED)
    told = _exchange(sums, groups, fan, buckets * fan, last).withColumnRenamed("cell", "unit")
    own = F.floor(F.col("bucket") / fan).cast("long").alias("own")
    return (asked.groupBy("unit", "bucket")
            .cogroup(told.select("*", own).groupBy("unit", "own")).applyInArrow(dealt, _TOLD))


def _rows_by_cell(batches: Iterator[pa.RecordBatch], cell_bytes: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Stretches of rows with their cell: the task's number, then a number that grows when the next text does not fit."""
    cell, held = TaskContext.get().partitionId() << 32, 0
    for batch in slices(batches):
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index("text"))), 0).to_pylist()
        start = 0
        for k, size in enumerate(sizes):
            if held and held + size + 1 > cell_bytes:
                if k > start:
                    yield cell, batch.slice(start, k - start)
                cell, held, start = cell + 1, 0, k
            held += size + 1
        yield cell, batch.slice(start)


def token_counts(docs: DataFrame, held_out_mod: int = 10, cell_bytes: int = 8 << 20,
                 buckets: int | None = None, fan: int = 1024) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, train_tokens (N), train_words (V), words, bigrams (packed counts).

    c(v) of a token is c(w) of the one before it; at a start it is c(end).
    ``cell_bytes`` of text (or one longer text) make a cell and bound a task's memory;
    ``buckets`` (default: two a cell) bound that of a bucket, ``fan`` the rows that a cell sends.
    """
    rows = text_of(docs).select("doc_id", (fold_of("doc_id", held_out_mod) == 0).alias("held_out"), "text")
    size, parts = (rows.select(F.octet_length("text").cast("long").alias("n"), F.spark_partition_id().alias("part"))
                   .agg(F.sum(F.col("n") + 1), F.count_distinct("part")).first())
    cells = (size or 0) // cell_bytes + parts
    if buckets is None:
        buckets = max(16, 2 * cells)
    steps = 1
    while fan ** steps < buckets:
        steps += 1
    fan = min(fan, next(n for n in itertools.count(max(1, int(buckets ** (1 / steps)) - 1)) if n ** steps >= buckets))
    buckets = fan ** steps

    def requests(batches):
        cell, held, texts = None, [], []
        for own, batch in _rows_by_cell(batches, cell_bytes):
            if own != cell:
                if texts:
                    yield from batches_of(_requests(cell, held, texts, fan), _PACKED)
                cell, held, texts = own, [], []
            held += _column(batch, "held_out")
            texts += as_bytes(batch, "text")
        if texts:
            yield from batches_of(_requests(cell, held, texts, fan), _PACKED)

    def with_cells(batches):
        for cell, batch in _rows_by_cell(batches, cell_bytes):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([cell] * batch.num_rows, pa.int64())],
                                             names=["doc_id", "held_out", "text", "cell"])

    def counted(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        return pa.Table.from_batches(batches_of(_counted(left, right, fan), _TABLE), schema=_TABLE)

    told = _exchange(rows.mapInArrow(requests, _ASKED), cells, fan, fan, buckets)
    placed = rows.mapInArrow(with_cells, "doc_id long, held_out boolean, text string, cell long")
    return written(placed.groupBy("cell").cogroup(told.groupBy("cell")).applyInArrow(
        counted, "doc_id long, held_out boolean, n_tokens long, train_tokens long, train_words long, "
                 "words binary, bigrams binary"), "token-counts")


def _contexts(c_w: np.ndarray) -> np.ndarray:
    """c(v) of each token of a text: the word before it, and the end (as often as a start) before the first."""
    return np.concatenate([c_w[-1:], c_w[:-1]])


def _base(c_w: np.ndarray, n: int, v: int) -> np.ndarray:
    return (c_w + ADD) / (n + ADD * (v + 1))


def _bucket(c_v: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(c_v, 1)).astype(np.int64), BUCKETS - 1)


def ratio_histogram(table: DataFrame) -> np.ndarray:
    """tokens[bucket, bin] of the ratio of bigram to unigram probability, each token deleted from its counts."""
    schema = pa.schema([("cellid", pa.int32()), ("tokens", pa.int64())])

    def local(batches):
        found = np.zeros(BUCKETS * BINS, np.int64)
        for batch in slices(batches, "words"):
            names = ("train_tokens", "train_words", "words", "bigrams")
            for n, v, words, bigrams in zip(*(_column(batch, x) for x in names)):
                c_w, c_vw = unpack_counts(words), unpack_counts(bigrams)
                c_v = _contexts(c_w)
                live = c_v > 1
                ratio = np.zeros(len(c_w))
                ratio[live] = ((c_vw[live] - 1) / (c_v[live] - 1)) / _base(c_w[live] - 1, n - 1, v)
                bins = np.zeros(len(c_w), np.int64)
                some = ratio > 0
                bins[some] = np.clip(np.round(32 * np.log2(ratio[some])) + BINS // 2, 1, BINS - 1)
                found += np.bincount(_bucket(c_v) * BINS + bins, minlength=BUCKETS * BINS)
        at = np.flatnonzero(found)
        yield from batches_of(zip(at.tolist(), found[at].tolist()), schema, max_rows=1 << 17)

    rows = (table.where(~F.col("held_out")).select("train_tokens", "train_words", "words", "bigrams")
            .mapInArrow(local, "cellid int, tokens long")
            .groupBy("cellid").agg(F.sum("tokens").alias("tokens")).collect())  # BUCKETS x BINS rows at most
    out = np.zeros(BUCKETS * BINS)
    for r in rows:
        out[r["cellid"]] = r["tokens"]
    return out.reshape(BUCKETS, BINS)


def learn_weights(tokens: np.ndarray, rounds: int = 100) -> np.ndarray:
    """EM: the bigram's weight in each bucket. The mean ratio of a bin stands for its tokens (1 % wide)."""
    ratio = np.exp2((np.arange(BINS) - BINS // 2) / 32)
    ratio[0] = 0
    weight = np.full(len(tokens), 0.5)
    total = tokens.sum(1)
    for _ in range(rounds):
        share = weight[:, None] * ratio
        share = share / (share + 1 - weight[:, None] + 1e-300)
        weight = np.where(total > 0, (tokens * share).sum(1) / np.maximum(total, 1), 0)
        weight = np.clip(weight, 0, 1 - 1e-6)
    return weight


def score(docs: DataFrame, held_out_mod: int = 10) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities)."""
    table = token_counts(docs, held_out_mod)
    weights = learn_weights(ratio_histogram(table))
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                        ("n_known", pa.int64()), ("train_tokens", pa.int64()),
                        ("base_score", pa.float64()), ("score", pa.float64())])

    def scored(batches):
        for batch in slices(batches, "words"):
            for doc_id, held, size, n, v, words, bigrams in zip(*(_column(batch, f.name) for f in _TABLE)):
                c_w, c_vw = unpack_counts(words), unpack_counts(bigrams)
                base = _base(c_w, n, v)
                c_v = _contexts(c_w)
                weight = np.where(c_v > 0, weights[_bucket(c_v)], 0)
                mixed = weight * c_vw / np.maximum(c_v, 1) + (1 - weight) * base
                yield (doc_id, held, size, int((c_w > 0).sum()), n,
                       float(np.log10(base).sum()), float(np.log10(mixed).sum()))

    return table.mapInArrow(lambda b: batches_of(scored(b), schema),
                            "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                            "base_score double, score double")
