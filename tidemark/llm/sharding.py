"""Sharding by size: contiguous shards whose largest is as small as possible.

The atomic groups are ranges of the text's hash: 2**16 of them, in hash order,
each holding every row of the texts that hash into it, so equal texts always
share a shard. One aggregation sums the bytes of each group (at most 65,536
rows whatever the input, the proven bound of what the driver reads). The
smallest feasible capacity is found by binary search over those ordered sizes,
each candidate checked greedily, and the order is cut within it, as evenly as it allows. A row's shard is
then a comparison of its group with the cuts: no join, no shuffle.

Slots number the rows of a shard from 0 without gaps. Rows are numbered within
(shard, cell), a cell being one of 4096 hashes of the whole row, and cells are
offset by the counts before them: no task ever holds a shard, and copies of
one text spread over all cells.

Edge cases: a null text has no bytes, so size 1; null and empty texts form
one group. Repeated rows get slots of their own. An empty table gives no rows. A group larger than an
even share makes the capacity at least its size.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import written

GROUP_BITS = 16
CELLS = 4096


def fits(prefix: list[int], start: int, capacity: int, shards: int) -> bool:
    """Whether shards filled one after another hold everything from start on."""
    for _ in range(shards):
        start = bisect_right(prefix, prefix[start] + capacity) - 1
    return start == len(prefix) - 1


def cuts_within(prefix: list[int], capacity: int, shards: int) -> list[int]:
    """Ends (exclusive) of shards of at most a feasible capacity, each as near an even share of what is
    left as the shards after it allow."""
    ends, start, last = [], 0, len(prefix) - 1
    for left in reversed(range(shards)):
        most = bisect_right(prefix, prefix[start] + capacity) - 1
        share = prefix[start] + (prefix[last] - prefix[start]) / (left + 1)
        end = min(bisect_right(prefix, share), last)
        if end > start and share - prefix[end - 1] < prefix[end] - share:
            end -= 1
        end = min(end, most)
        ends.append(end if fits(prefix, end, capacity, left) else most)
        start = ends[-1]
    return ends


def smallest_cuts(sizes: list[int], shards: int) -> list[int]:
    """Ends of ``shards`` contiguous runs (some may be empty) of sizes whose largest sum is minimal."""
    prefix = list(accumulate(sizes, initial=0))
    low = max(max(sizes, default=0), -(-prefix[-1] // shards))
    high = low + max(sizes, default=0)
    while not fits(prefix, 0, high, shards):
        high *= 2
    while low < high:
        middle = (low + high) // 2
        if fits(prefix, 0, middle, shards):
            high = middle
        else:
            low = middle + 1
    return cuts_within(prefix, low, shards)


def shard_by_size(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Per row: doc_id, size, text_crc32, shard (0 to shards - 1), slot (gapless from 0 in its shard)."""
    text = F.coalesce(docs["text"], F.lit(""))
    rows = written(docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.shiftrightunsigned(F.xxhash64(text), 64 - GROUP_BITS).cast("int").alias("group"),
        F.pmod(F.xxhash64("doc_id", text), F.lit(CELLS)).cast("int").alias("cell")), "shard-rows")
    groups = sorted(rows.groupBy("group").agg(F.sum("size").alias("size")).collect())  # 2**16 rows at most
    ends = smallest_cuts([g["size"] for g in groups], shards) if groups else []
    shard = F.lit(0)
    for end in ends:
        if 0 < end < len(groups):
            shard = shard + (F.col("group") >= groups[end]["group"]).cast("int")
    placed = rows.select("doc_id", "size", "text_crc32", shard.cast("int").alias("shard"), "cell")
    before = Window.partitionBy("shard").orderBy("cell")  # shards x 4096 rows in all
    offsets = (placed.groupBy("shard", "cell").count()
               .select("shard", "cell", (F.sum("count").over(before) - F.col("count")).alias("offset")))
    inside = Window.partitionBy("shard", "cell").orderBy("doc_id", "text_crc32", "size")
    return (placed.withColumn("number", F.row_number().over(inside) - 1)
            .join(offsets, ["shard", "cell"])
            .select("doc_id", "size", "text_crc32", "shard",
                    (F.col("offset") + F.col("number")).cast("long").alias("slot")))
