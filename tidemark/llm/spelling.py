"""Spelling variants: words one edit apart, and the much more frequent word each is a form of.

Words are counted in the JVM (runs of Latin letters, A-Z lower-cased, a fixed
share of them with one letter deleted by a checksum of document and run).
Candidates come from blocked Gram matrices: a word is a vector of letter
counts, and one edit moves it by a squared distance of 2 (a letter replaced) or
1 (one more or less). Words of one block have the same length, and the same
number of letters of each of a few letter classes, so only blocks whose class
counts differ by one edit can hold near words: the block itself, those with one
more letter in one class, those with a letter moved from one class to another.
For each such pair of blocks one NumPy product gives all squared distances;
pairs at most two apart are verified letter by letter. What a task returns is
one row for each word that has near words in it, not a row for each pair.

Layout: a class of words larger than a block is cut into blocks by hash, and
every pair of blocks is one row of a join, so no group is held in one place:
memory is that of two blocks (``block_bytes`` each, or one longer word) and the
product of their sizes. The number of letter classes grows with the logarithm
of the vocabulary, which keeps blocks about as large as a product likes. Roots
are found by pointer jumping over the words that have a form; a form occurs
``ratio`` times as often as its word, so the chains are as short as the
logarithm of the largest count.

Edge cases: a null text has no words; a null doc_id counts as empty text in the
checksum; repeated rows count each; of equally frequent near words the first in
code-point order is the form; an empty table gives no rows. A word of any length is
compared like the others. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches_of, ship, text_of, written

# The letters of words.
LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_KNOWN = LOWER + UPPER + "".join(map(chr, range(0xC0, 0x100)))


def word_counts(docs: DataFrame, min_chars: int = 7, min_count: int = 2, noise: int = 31) -> DataFrame:
    """word, n: the distinct words with at least min_chars letters and min_count occurrences."""
    runs = (text_of(docs)
            .select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"),
                    F.explode(F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{min_chars},}}"), F.lit(0))).alias("run"))
            .select("doc", F.translate("run", UPPER, LOWER).alias("run"))
            .select("run", F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary")).alias("h")))
    cut = (F.col("h") % F.length("run")).cast("int")
    word = F.when(F.col("h") % noise == 0,
                  F.concat(F.substring("run", F.lit(1), cut), F.substring("run", cut + 2, F.length("run"))))
    return (runs.select(word.otherwise(F.col("run")).alias("word"))
            .where(F.length("word") >= min_chars)
            .groupBy("word").agg(F.count("*").alias("n"))
            .where(F.col("n") >= min_count))


def _counts(codes: np.ndarray) -> np.ndarray:
    """Letter counts by word of a block: a row each, a column for each of the 256 codes."""
    n, length = codes.shape
    flat = (np.arange(n)[:, None] * 256 + codes).ravel()
    return np.bincount(flat, minlength=n * 256).reshape(n, 256)


def _codes(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def _one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of a and b are one edit apart; b's words are as long as a's, or one letter longer."""
    length = a.shape[1]
    if b.shape[1] == length:
        return (a != b).sum(axis=1) == 1
    front = np.logical_and.accumulate(a == b[:, :length], axis=1).sum(axis=1)
    back = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return front + back >= length


def near_pairs(a: list[str], b: list[str], same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Indices of near words of two blocks; b's words are as long as a's or one letter longer.

    ``same``: b is a, and each pair is given once.
    """
    x, y = _codes(a), _codes(b)
    cx, cy = _counts(x), _counts(y)
    used = cx.any(axis=0) | cy.any(axis=0)
    exact = np.float32 if y.shape[1] < 4000 else np.float64  # squares up to length^2 stay whole numbers
    cx, cy = cx[:, used].astype(exact), cy[:, used].astype(exact)
    gram = cx @ cy.T
    gram *= -2
    gram += (cx * cx).sum(axis=1)[:, None]
    gram += (cy * cy).sum(axis=1)[None, :]
    i, j = np.divmod(np.flatnonzero(gram.ravel() <= 2), len(b))
    if same:
        once = i < j
        i, j = i[once], j[once]
    at_once = max(1, (4 << 20) // max(1, y.shape[1]))
    good = [_one_edit(x[i[k:k + at_once]], y[j[k:k + at_once]]) for k in range(0, len(i), at_once)]
    good = np.concatenate(good) if good else np.zeros(0, bool)
    return i[good], j[good]


def _blocks(words: DataFrame, classes: int, block_bytes: int) -> DataFrame:
    """key (letters by class), sub, subs (blocks of the key), names, counts."""
    letters = ["".join(c for c in _KNOWN if ord(c) % classes == k) for k in range(classes)]
    of_class = [F.length("word") - F.length(F.translate("word", x, "")) for x in letters]
    keyed = words.select("word", "n", F.array(*of_class).alias("key"))
    sizes = (keyed.groupBy("key").agg(F.sum(F.length("word") + 8).alias("size"))
             .select("key", F.ceil(F.col("size") / block_bytes).cast("int").alias("subs")))
    return (keyed.join(sizes, "key")
            .withColumn("sub", F.pmod(F.xxhash64("word"), F.col("subs")).cast("int"))
            .groupBy("key", "sub").agg(F.collect_list(F.struct("word", "n")).alias("held"))  # about block_bytes
            .select("key", "sub", F.col("held.word").alias("names"), F.col("held.n").alias("counts")))


def _steps(classes: int) -> list[list[int]]:
    """What one edit may add to a block's key, each pair of blocks once: nothing, a letter, a letter moved."""
    unit = lambda k: [int(i == k) for i in range(classes)]
    moved = [[a - b for a, b in zip(unit(i), unit(j))] for i in range(classes) for j in range(i + 1, classes)]
    return [[0] * classes] + [unit(k) for k in range(classes)] + moved


def near_words(words: DataFrame, block_bytes: int = 32 << 10) -> DataFrame:
    """word, n_near, best (struct: less, its near word's count negated, and that word): of words that have near words."""
    total = words.count()
    classes = max(2, round(math.log2(max(total, 1)) / 4))
    blocks = written(_blocks(words, classes, block_bytes), "spelling-blocks")
    key = lambda step: F.array(*[F.col("key")[k] + d for k, d in enumerate(step)])
    left = blocks.select(F.posexplode(F.array(*map(key, _steps(classes)))).alias("step", "key"),
                         F.col("sub").alias("sub1"), F.col("names").alias("names1"), F.col("counts").alias("counts1"))
    pairs = (left.join(blocks, "key").where((F.col("step") > 0) | (F.col("sub1") <= F.col("sub")))
             .select(((F.col("step") == 0) & (F.col("sub1") == F.col("sub"))).alias("same"),
                     "names1", "counts1", "names", "counts"))
    schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("less", pa.int64()), ("form", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for batch in batches:
                for r in range(batch.num_rows):
                    same, a, na, b, nb = (batch.column(k)[r].as_py() for k in range(5))
                    i, j = near_pairs(a, b, same)
                    if len(i):
                        yield from _summed(a, i, b, j, nb)
                        yield from _summed(b, j, a, i, na)
        return batches_of(found(), schema)

    found = pairs.mapInArrow(run, "word string, n_near long, less long, form string")
    return (found.groupBy("word")
            .agg(F.sum("n_near").alias("n_near"), F.min(F.struct("less", "form")).alias("best")))


def _summed(words: list[str], i: np.ndarray, others: list[str], j: np.ndarray, counts: list[int]) -> Iterator[tuple]:
    """One row for each word: its near words here, and the most frequent of them (the first of equals)."""
    best: dict[int, tuple[int, str]] = {}
    n_near = np.bincount(i, minlength=len(words))
    for word, other in zip(i.tolist(), j.tolist()):
        one = (-counts[other], others[other])
        if word not in best or one < best[word]:
            best[word] = one
    for word, (less, form) in best.items():
        yield words[word], int(n_near[word]), less, form


def _roots(forms: DataFrame, largest: int, ratio: int) -> DataFrame:
    """word, root of the words that have a form, by pointer jumping; forms: word, form."""
    steps = int(math.log(max(largest, 1), ratio)) + 1  # a form occurs ratio times as often: so long is a chain at most
    at = forms.withColumnRenamed("form", "root")
    for k in range(math.ceil(math.log2(max(steps, 1)))):
        after = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        at = written(at.join(after, "root", "left").select("word", F.coalesce("further", "root").alias("root")),
                     f"spelling-roots-{k}")
    return at


def variant_groups(docs: DataFrame, min_chars: int = 7, min_count: int = 2, noise: int = 31, ratio: int = 10,
                   block_bytes: int = 32 << 10) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word."""
    if ratio < 2:
        raise ValueError("a form must be at least twice as frequent as its word")
    ship(docs.sparkSession)
    words = written(word_counts(docs, min_chars, min_count, noise), "spelling-words")
    near = near_words(words, block_bytes)
    form_n: Column = -F.col("best.less")
    enough = form_n >= F.col("n") * ratio
    joined = written(words.join(near, "word", "left")
                     .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                             F.when(enough, F.col("best.form")).alias("form"), F.when(enough, form_n).alias("form_n")),
                     "spelling-forms")
    largest = words.agg(F.max("n")).first()[0] or 0
    roots = _roots(joined.where("form IS NOT NULL").select("word", "form"), largest, ratio)
    return (joined.join(roots, "word", "left")
            .select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")))
