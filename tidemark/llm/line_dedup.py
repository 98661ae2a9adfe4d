"""Line dedup: drop lines that too many documents share, keep one owner of each.

Lines are exploded with their position, normalised (white space stripped at
both ends, A-Z lower-cased) and hashed to 128 bits. The distinct documents of
each hash are counted; hashes over the threshold are joined back, the positions
to drop gathered per document, and the text put together again without them.

Only DataFrame functions: Spark's one-distinct aggregate shuffles by (hash,
document) first, so a line that a third of all documents share is counted by
many tasks; the join back carries hashes and positions, never text, and a hot
hash is an ordinary skewed join whose other side has one row per hash. The
text is shuffled once, by document, to meet its positions.

Edge cases: a null or empty text is one empty line. A null doc_id counts for
no line and its row keeps all lines. Rows alike in doc_id and text get the same
result, one row each. Rows that share a doc_id count as one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, row_key, text_of

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _lower_ascii(text: Column) -> Column:
    """A-Z lower-cased and nothing else; ``lower`` does that for pure ASCII."""
    return (F.when(F.octet_length(text) == F.length(text), F.lower(text))
            .otherwise(F.translate(text, _UPPER, _UPPER.lower())))


def shared_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """key1, key2 (the row), dropped: sorted positions of the lines to drop, for rows that lose any."""
    rows = text_of(docs)
    lines = (rows.select("doc_id", *row_key(), F.posexplode(F.split("text", "\n")).alias("position", "line"))
             .withColumn("line", F.btrim("line", F.lit(SPACE)))
             .where(F.length("line") >= min_chars)
             .withColumn("line", _lower_ascii(F.col("line")))
             .select("doc_id", "key1", "key2", "position",
                     F.xxhash64(F.lit(1), "line").alias("line1"), F.xxhash64(F.lit(2), "line").alias("line2")))
    hot = (lines.groupBy("line1", "line2")
           .agg(F.count_distinct("doc_id").alias("documents"), F.max("doc_id").alias("owner"))
           .where(F.col("documents") >= min_docs)
           .select("line1", "line2", "owner"))
    return (lines.join(hot, ["line1", "line2"])
            .where(F.col("doc_id") != F.col("owner"))
            .groupBy("key1", "key2")
            .agg(F.sort_array(F.collect_set("position")).alias("dropped")))


def line_dedup(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """Per row: doc_id, n_lines (before), n_dropped, kept_text (the other lines, joined by newline)."""
    drops = shared_lines(docs, min_chars, min_docs).hint("shuffle_hash")
    rows = (text_of(docs).select("doc_id", "text", *row_key())
            .join(drops, ["key1", "key2"], "left"))
    n_lines = F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1
    # the outer transform names the split lines, so that they are split once per text
    parts = F.array(F.struct(
        F.split("text", "\n").alias("lines"),
        F.array_except(F.sequence(F.lit(0), n_lines - 1), F.col("dropped")).alias("kept")))
    again = F.transform(parts, lambda p: F.array_join(
        F.transform(p["kept"], lambda i: F.get(p["lines"], i)), "\n"))[0]
    return rows.select(
        "doc_id",
        n_lines.cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("dropped").isNull(), F.col("text")).otherwise(again).alias("kept_text"))
