"""Benchmark decontamination: an FM-index per training shard.

Words are lower-cased runs of letters and digits; a phrase is any ``window``
consecutive words of a benchmark item (all of a shorter one). The phrases are
the stated query set: a block of them (bounded by ``block_words``) is gathered
and broadcast, and further blocks, if the benchmark is larger, are further
passes whose spans are merged.

A task cuts its documents into shards of at most ``shard_words`` words (a
longer document is a shard of its own) and indexes each shard:

* words outside the phrases' alphabet can lie in no match, so they become
  breaks, as do document ends; runs between breaks that are shorter than the
  shortest phrase are breaks too, which loses no match;
* the suffix array of what is left comes from prefix doubling, the
  Burrows-Wheeler transform goes into a wavelet tree (a matrix of bit rows with
  rank counts), and every eighth suffix position is kept, as is the start of
  every run;
* all phrases search backwards at once, two ranks a step, and each match walks
  back to a kept position to learn where it lies;
* the matches' spans are merged per document.

Nothing is shuffled: a document's result comes from the task that reads it.

Edge cases: a null or empty text, and one without words, has no hits. Benchmark
rows with a null item_id, a null text or no words are no items. Equal
windows of several items count for each. Repeated documents are answered
each; an empty benchmark hits nothing. Items that share an id are one item of
several texts.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import as_bytes, batches_of, fresh_names, row_key, ship, words_of, written

WINDOW = 10
SAMPLE = 8  # every eighth suffix position is kept
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")  # before lower-casing

RESULT = "doc_id {}, key1 long, key2 long, n_words long, spans array<struct<start:long,end:long>>, items array<string>"


class WaveletMatrix:
    """Ranks of symbols in a sequence, one bit row per bit of the symbols, highest first."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.ones, self.zeros = bits, [], []
        for bit in reversed(range(bits)):
            row = (symbols >> bit) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(row, dtype=np.int32)]).astype(np.int32))
            self.zeros.append(len(row) - int(self.ones[-1][-1]))
            symbols = np.concatenate([symbols[row == 0], symbols[row == 1]])

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its end."""
        start = np.zeros_like(end)
        for level, bit in enumerate(reversed(range(self.bits))):
            ones, one = self.ones[level], ((symbol >> bit) & 1).astype(bool)
            start = np.where(one, self.zeros[level] + ones[start], start - ones[start])
            end = np.where(one, self.zeros[level] + ones[end], end - ones[end])
        return end - start

    def symbol(self, at: np.ndarray) -> np.ndarray:
        value = np.zeros_like(at)
        for level in range(self.bits):
            ones = self.ones[level]
            one = ones[at + 1] - ones[at]
            value = value * 2 + one
            at = np.where(one == 1, self.zeros[level] + ones[at], at - ones[at])
        return value


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes, by prefix doubling. Symbol 0 is a break: each is a smallest symbol of its own."""
    n = len(text)
    breaks = text == 0
    rank = np.where(breaks, np.cumsum(breaks) - 1, text.astype(np.int64) + n)
    order = np.argsort(rank, kind="stable")
    sorted_rank = rank[order]
    new = np.concatenate([[0], np.cumsum(sorted_rank[1:] != sorted_rank[:-1])])
    rank = np.empty(n, np.int64)
    rank[order] = new
    step = 1
    while new[-1] < n - 1:
        second = np.zeros(n, np.int64)
        second[:n - step] = rank[step:] + 1
        pair = rank * (n + 1) + second
        order = np.argsort(pair, kind="stable")
        sorted_pair = pair[order]
        new = np.concatenate([[0], np.cumsum(sorted_pair[1:] != sorted_pair[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = new
        step *= 2
    return order


class FMIndex:
    """Symbols (0: a break) searchable backwards; ``text`` must end with a break."""

    def __init__(self, text: np.ndarray, symbols: int):
        order = suffix_array(text)
        before = text[order - 1]  # of position 0: the last break
        self.tree = WaveletMatrix(before.astype(np.int32), max(1, int(symbols).bit_length()))
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols + 1))])
        keep = (order % SAMPLE == 0) | (before == 0)
        self.kept = np.concatenate([[0], np.cumsum(keep)])
        self.positions = order[keep]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of the suffixes that begin with each phrase; phrases are 0-padded on the left."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.first[-1], np.int64)
        for column in phrases.T[::-1]:
            live = np.flatnonzero((column > 0) & (low < high))
            if len(live):
                symbol = column[live]
                low[live], high[live] = (self.first[symbol] + self.tree.rank(symbol, x[live]) for x in (low, high))
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows, by walking back to kept positions."""
        out, at = np.empty(len(rows), np.int64), rows.copy()
        todo, steps = np.arange(len(rows)), 0
        while len(todo):
            hit = self.kept[at + 1] > self.kept[at]
            out[todo[hit]] = self.positions[self.kept[at[hit]]] + steps
            todo, at = todo[~hit], at[~hit]
            symbol = self.tree.symbol(at)
            at = self.first[symbol] + self.tree.rank(symbol, at)
            steps += 1
        return out


class Phrases:
    """A block of phrases: their alphabet, words as symbols and the items each belongs to."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        found: dict[tuple[bytes, ...], set[str]] = {}
        for item, text in items:
            words = words_of(text)
            n = min(window, len(words))
            for i in range(len(words) - n + 1 if n else 0):
                found.setdefault(tuple(words[i:i + n]), set()).add(item)
        self.alphabet = {w: i + 1 for i, w in enumerate(sorted({w for p in found for w in p}))}
        self.items = [sorted(x) for x in found.values()]
        self.sizes = np.array([len(p) for p in found], np.int64)
        self.symbols = np.zeros((len(found), window), np.int64)
        for i, phrase in enumerate(found):
            self.symbols[i, window - len(phrase):] = [self.alphabet[w] for w in phrase]


def _runs(symbols: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """The runs of at least ``shortest`` nonzero symbols, a break after each, and their positions."""
    edge = np.diff(np.concatenate([[0], (symbols > 0).astype(np.int8), [0]]))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = ends - starts >= shortest
    starts, sizes = starts[long], (ends - starts)[long] + 1
    # positions start, start + 1, ..., end of every run; the symbol at its end is a break
    at = np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
    text = np.concatenate([symbols, [0]])[at]
    return text, at


def search_shard(texts: list[bytes], phrases: Phrases) -> list[tuple[int, list[tuple[int, int]], list[str]]]:
    """Per text of a shard: its words, the merged word spans [start, end) inside matches, the items matched."""
    found = [words_of(t) for t in texts]
    get = phrases.alphabet.get
    starts = np.concatenate([[0], np.cumsum([len(w) + 1 for w in found])]).astype(np.int64)
    symbols = np.zeros(starts[-1], np.int64)
    for words, start in zip(found, starts):
        symbols[start:start + len(words)] = [get(w, 0) for w in words]
    out: list = [(len(w), [], []) for w in found]
    if not len(phrases.sizes):
        return out
    text, at = _runs(symbols, int(phrases.sizes.min()))
    if not len(text):
        return out
    index = FMIndex(text, len(phrases.alphabet))
    low, high = index.search(phrases.symbols)
    count = high - low
    which = np.repeat(np.arange(len(count)), count)
    rows = np.repeat(low - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
    begin = at[index.locate(rows)]
    end = begin + phrases.sizes[which]
    cover = np.zeros(len(symbols) + 1, np.int32)
    np.add.at(cover, begin, 1)
    np.add.at(cover, end, -1)
    edge = np.diff(np.concatenate([[0], (np.cumsum(cover) > 0).astype(np.int8), [0]]))
    document = lambda position: np.searchsorted(starts, position, "right") - 1
    span_starts, span_ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    for k, a, b in zip(document(span_starts).tolist(), span_starts.tolist(), span_ends.tolist()):
        out[k][1].append((a - int(starts[k]), b - int(starts[k])))
    matched: dict[int, set[str]] = {}
    pairs = np.unique(np.stack([document(begin), which], 1), axis=0) if len(begin) else np.empty((0, 2), int)
    for k, p in pairs.tolist():
        matched.setdefault(k, set()).update(phrases.items[p])
    for k, items in matched.items():
        out[k][2].extend(sorted(items))
    return out


def shards(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Rows cut into shards of at most ``words`` words (two bytes of text each, at least) or one row, with their texts."""
    for batch in batches:
        texts, start, held = [t or b"" for t in as_bytes(batch, "text")], 0, 0
        for i, text in enumerate(texts):
            if i > start and held + len(text) > 2 * words:
                yield batch.slice(start, i - start), texts[start:i]
                start, held = i, 0
            held += len(text)
        if start < batch.num_rows:
            yield batch.slice(start), texts[start:]


def _one_block(docs: DataFrame, phrases: Broadcast, shard_words: int) -> DataFrame:
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", *row_key(), F.coalesce(docs["text"], F.lit("")).alias("text"))
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    schema = pa.schema([("doc_id", pa.int64()), ("key1", pa.int64()), ("key2", pa.int64()),
                        ("n_words", pa.int64()), ("spans", span), ("items", pa.list_(pa.string()))])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for shard, texts in shards(batches, shard_words):
            names = zip(*(shard.column(i).to_pylist() for i in range(3)))
            for name, (n, spans, found) in zip(names, search_shard(texts, phrases.value)):
                yield *name, n, [{"start": a, "end": b} for a, b in spans], found

    return rows.mapInArrow(lambda b: batches_of(search(b), schema), RESULT.format(kind))


def _blocks(benchmark: DataFrame, block_words: int) -> list[Callable[[], list[tuple[str, bytes]]]]:
    """The items in blocks of about ``block_words`` words (a stated query set, not a sample of the documents), each
    brought to the driver when it is asked for."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), "text").dropna()
    size = items.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    blocks = max(1, -(-size // (2 * block_words)))  # a word and its separator are two bytes at least

    def block(k: int) -> list[tuple[str, bytes]]:
        own = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k) if blocks > 1 else items
        return [(r["item"], r["text"].encode()) for r in own.collect()]

    return [partial(block, k) for k in range(blocks)]


def contaminated_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                       shard_words: int = 1 << 20, block_words: int = 500_000) -> DataFrame:
    """Per row: doc_id, key1, key2, n_words, spans (word positions, merged), items (ids as strings, sorted)."""
    blocks, context = _blocks(benchmark, block_words), docs.sparkSession.sparkContext
    if len(blocks) == 1:
        return _one_block(docs, context.broadcast(Phrases(blocks[0](), window)), shard_words)
    every = None
    for block in blocks:  # one at a time: neither the driver nor a worker holds two
        phrases = context.broadcast(Phrases(block(), window))
        # one row per document and block; equal rows have equal spans, so each keeps its own answer
        part = written(_one_block(docs, phrases, shard_words).withColumn("copy", F.row_number().over(_copies())), "spans")
        phrases.destroy()
        every = part if every is None else every.unionByName(part)
    merged = every.groupBy("doc_id", "key1", "key2", "copy").agg(
        F.max("n_words").alias("n_words"),
        F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    none = F.array().cast("array<struct<start:long,end:long>>")
    last = lambda a: F.element_at(a, -1)
    join = lambda a, s: F.when(
        (F.size(a) > 0) & (F.get(a, F.size(a) - 1)["end"] >= s["start"]),
        F.concat(F.slice(a, 1, F.size(a) - 1), F.array(F.struct(
            last(a)["start"].alias("start"), F.greatest(last(a)["end"], s["end"]).alias("end"))))
    ).otherwise(F.concat(a, F.array(s)))
    return merged.withColumn("spans", F.aggregate("spans", none, join)).drop("copy")


def _copies():
    from pyspark.sql import Window

    return Window.partitionBy("doc_id", "key1", "key2").orderBy("n_words")


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                 shard_words: int = 1 << 20, block_words: int = 500_000) -> DataFrame:
    """docs with the contaminated words cut out of text (n_chars follows, where docs has it); all columns."""
    ship(docs.sparkSession)
    blocks = _blocks(benchmark, block_words)
    if len(blocks) == 1:  # no shuffle: each task rewrites its own rows
        phrases = docs.sparkSession.sparkContext.broadcast(Phrases(blocks[0](), window))

        def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for shard, texts in shards(batches, shard_words):
                found = search_shard(texts, phrases.value)
                yield _with_texts(shard, [without(t.decode(), spans) if spans else None
                                          for t, (_, spans, _) in zip(texts, found)])

        return docs.mapInArrow(rewrite, docs.schema)
    own1, own2, cuts_of = fresh_names(docs, "_cut1", "_cut2", "_cuts")
    found = (contaminated_spans(docs, benchmark, window, shard_words, block_words)
             .where(F.size("spans") > 0)
             .select(F.col("key1").alias(own1), F.col("key2").alias(own2), F.col("spans").alias(cuts_of))
             .dropDuplicates([own1, own2]))

    def rewrite_joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, cuts = as_bytes(batch, "text"), batch.column(batch.num_columns - 1).to_pylist()
            yield _with_texts(batch.select(range(batch.num_columns - 1)), [
                without(t.decode(), [(s["start"], s["end"]) for s in c]) if c else None
                for t, c in zip(texts, cuts)])

    key1, key2 = row_key(docs["doc_id"], docs["text"])
    return (docs.withColumns({own1: key1, own2: key2})
            .join(found, [own1, own2], "left")
            .select(*docs.columns, cuts_of)
            .mapInArrow(rewrite_joined, docs.schema))


def _with_texts(batch: pa.RecordBatch, texts: list[str | None]) -> pa.RecordBatch:
    """The batch with new texts (None: as it was) and their n_chars."""
    if not any(t is not None for t in texts):
        return batch
    news: dict[str, list] = {"text": texts, "n_chars": [None if t is None else len(t) for t in texts]}
    columns = []
    for field, column in zip(batch.schema, batch.columns):
        if field.name in news:
            column = pa.array([old if t is None else new for old, new, t in
                               zip(column.to_pylist(), news[field.name], texts)], type=field.type)
        columns.append(column)
    return pa.RecordBatch.from_arrays(columns, schema=batch.schema)


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """text without the words of the spans and what lies between them."""
    words = [m.span() for m in WORDS.finditer(text)]
    out, at = [], 0
    for start, end in spans:
        out.append(text[at:words[start][0]])
        at = words[end - 1][1]
    return "".join([*out, text[at:]])
