"""Keyed merges of per-window results into a per-key stored value (K1, K2).

* ``first_write_merge`` (K1): the first result of a key is stored and never
  replaced; each later result is returned as stored + current but not
  written back. The stored value is ``min_by(result, t)`` per key, a partial
  aggregate, joined back on the key (AQE splits a hot key's partition).
* ``accumulate_merge`` (K2): the stored value accumulates every result, so
  each result returns the running total. Computed as a blocked prefix sum:
  per (key, time block) totals, a prefix over the (few) blocks of a key, then
  a running sum inside each (key, block) partition. No task ever holds all of
  one key's history.
* ``keyed_merge`` (K3): the same for any associative operation
  (``operations.KeyedOperation``), as a blocked scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from tidemark.config import WindowSpec
from tidemark.functions.scalars import epoch_seconds, profile_key
from tidemark.operators.joins import join_back
from tidemark.operators.operations import KeyedOperation

DEFAULT_BLOCK_SECONDS = 86400


def first_write_merge(results: DataFrame, key: str = "u", order: str = "t",
                      values: Sequence[str] = ("clicks", "shows"),
                      returned: Sequence[str] = ("rt_u_click", "rt_u_reveal"),
                      stored: Sequence[str] = ("stored_click", "stored_reveal"),
                      key_template: str | None = None) -> DataFrame:
    """``(order, key, [store_key], *returned, *stored)`` per input row."""
    # one result per (order, key): per-column min_by is exact, and its
    # fixed-width buffers keep the aggregate hash-based
    first = results.groupBy(key).agg(
        F.min(F.col(order)).alias("__t"),
        F.struct(*[F.min_by(F.col(v), F.col(order)).alias(v) for v in values]).alias("__first"))
    j = join_back(results, first, key)
    is_first = F.col(order) == F.col("__t")
    cols = [F.col(order), F.col(key)]
    if key_template is not None:
        cols.append(profile_key(F.col(key), key_template).alias("store_key"))
    cols += [F.when(is_first, F.col(v)).otherwise(F.col(f"__first.{v}") + F.col(v)).alias(r)
             for v, r in zip(values, returned)]
    cols += [F.col(f"__first.{v}").alias(s) for v, s in zip(values, stored)]
    return j.select(*cols)


def store_snapshot(results: DataFrame, key: str = "u", order: str = "t",
                   values: Sequence[str] = ("clicks", "shows"),
                   stored: Sequence[str] = ("rt_u_click", "rt_u_reveal"),
                   key_template: str | None = None) -> DataFrame:
    """Content of a first-write store after all results (S3 as a reader sees
    it): one row per key with its first result. One hash aggregate."""
    cols = [F.col(key)]
    if key_template is not None:
        cols = [profile_key(F.col(key), key_template).alias("store_key")]
    return results.groupBy(key).agg(*[F.min_by(F.col(v), F.col(order)).alias(s)
                                      for v, s in zip(values, stored)]).select(*cols, *stored)


def time_block(df: DataFrame, column: str, size: int) -> Column:
    """Block number of an order column: epoch seconds (timestamps) or the
    value itself (numbers), integer-divided by ``size``."""
    if isinstance(df.schema[column].dataType, (TimestampType, TimestampNTZType)):
        base = epoch_seconds(df, column)
    else:
        base = F.col(column)
    return F.floor(base / F.lit(size)).cast("bigint")


def running_totals(df: DataFrame, key: str, order: Sequence[str], block: Column,
                   values: dict[str, Column]) -> DataFrame:
    """Add one column per ``values`` entry: its running sum per ``key`` in
    ``order`` (current row included).

    ``block`` must not decrease along ``order`` within a key. Per (key, block)
    totals are summed over the earlier blocks of the key (a window over the
    few block rows of one key), and the running sum inside a block runs in a
    (key, block) partition, so a hot key is spread over its blocks.
    """
    rows = df.withColumn("__blk", block)
    for n, c in values.items():
        rows = rows.withColumn(f"__v_{n}", c)
    tot = rows.groupBy(key, "__blk").agg(*[F.sum(f"__v_{n}").alias(f"__bt_{n}") for n in values])
    before = Window.partitionBy(key).orderBy("__blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = tot.select(key, "__blk", *[
        F.coalesce(F.sum(f"__bt_{n}").over(before), F.lit(0)).alias(f"__off_{n}") for n in values])
    inside = Window.partitionBy(key, "__blk").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    j = join_back(rows, offsets, [key, "__blk"])
    return j.select(*[F.col(c) for c in df.columns],
                    *[(F.col(f"__off_{n}") + F.sum(f"__v_{n}").over(inside)).alias(n) for n in values])


def accumulate_merge(results: DataFrame, key: str = "u", order: str = "t",
                     values: Sequence[str] = ("clicks", "shows"),
                     returned: Sequence[str] = ("rt_u_click", "rt_u_reveal"),
                     *, spec: WindowSpec,
                     block_seconds: int = DEFAULT_BLOCK_SECONDS,
                     key_template: str | None = None) -> DataFrame:
    """``(order, key, [store_key], *returned)``: running totals per key.

    Accumulating overlapping windows would count a record several times, so
    only half-open tumbling windows are accepted: ``spec`` is the geometry
    that made ``results``.
    """
    if not spec.is_tumbling:
        raise ValueError("accumulating merge needs half-open tumbling windows; "
                         "overlapping windows would count records more than once")
    base = results.select(order, key, *values)
    run = running_totals(base, key, [order], time_block(base, order, block_seconds),
                         {r: F.col(v) for v, r in zip(values, returned)})
    cols = [F.col(order), F.col(key)]
    if key_template is not None:
        cols.append(profile_key(F.col(key), key_template).alias("store_key"))
    return run.select(*cols, *returned)


# Blocks of a key that one task scans at once, above the blocks of results.
BLOCKS_AT_ONCE = 1024


def _states(op: KeyedOperation, first: Column, values: Column) -> Column:
    """Array of the stored values before each of ``values`` and after the last, given the one before the first."""
    return F.aggregate(values, F.array(first), lambda done, x: F.concat(
        done, F.array(op.merged(F.element_at(done, -1), x))))


def _before_blocks(blocks: DataFrame, op: KeyedOperation, key: str, span: int) -> DataFrame:
    """``(key, __blk, __b)``: the value stored before each block, from ``(key, __blk, __s)``, its own.

    ``span``: about how many block numbers there may be. Blocks are scanned in groups of
    ``BLOCKS_AT_ONCE`` numbers, the groups by the same means, until one group holds them all.
    """
    last = span <= BLOCKS_AT_ONCE
    group = F.lit(0) if last else F.floor(F.col("__blk") / BLOCKS_AT_ONCE)
    groups = (blocks.withColumn("__grp", group.cast("bigint"))
              .groupBy(key, "__grp").agg(F.array_sort(F.collect_list(F.struct("__blk", "__s"))).alias("__held")))
    if not last:
        totals = groups.select(key, F.col("__grp").alias("__blk"), op.folded(F.col("__held.__s")).alias("__s"))
        before = _before_blocks(totals, op, key, -(-span // BLOCKS_AT_ONCE)).withColumnRenamed("__blk", "__grp")
        groups = join_back(groups, before, [key, "__grp"])
    else:
        groups = groups.withColumn("__b", op.absent())
    states = F.slice(_states(op, F.col("__b"), F.col("__held.__s")), F.lit(1), F.size("__held"))
    each = F.explode(F.arrays_zip(F.col("__held.__blk").alias("__blk"), states.alias("__b")))
    return groups.select(key, each.alias("__e")).select(key, "__e.__blk", "__e.__b")


def keyed_scan(results: DataFrame, op: KeyedOperation, key: str = "u", order: str = "t") -> DataFrame:
    """Every result with ``__s``, its own stored value, and ``__before``, the one stored before it.

    Results of a key are merged in ``order`` (epoch seconds or any number):
    inside blocks of ``op.block_seconds``, over the blocks' own merged values, and
    so on. No window function runs over a whole key, and no task holds more of a key than a block.
    """
    columns = results.columns
    rows = results.select(F.col(key).alias("__key"), F.struct(F.col(order).alias("__o"), F.struct(
        *[F.col(c) for c in columns]).alias("__row"), op.lifted(order).alias("__s")).alias("__r"),
        F.floor(F.col(order) / op.block_seconds).cast("bigint").alias("__blk"))
    by_order = lambda a, b: F.when(a["__o"] < b["__o"], -1).when(a["__o"] > b["__o"], 1).otherwise(0)
    blocks = rows.groupBy("__key", "__blk").agg(F.array_sort(F.collect_list("__r"), by_order).alias("__held"))
    totals = blocks.select("__key", "__blk", op.folded(F.col("__held.__s")).alias("__s"))
    before = _before_blocks(totals, op, "__key", -(-2 ** 33 // op.block_seconds))
    states = F.slice(_states(op, F.col("__b"), F.col("__held.__s")), F.lit(1), F.size("__held"))
    each = F.explode(F.arrays_zip(F.col("__held").alias("r"), states.alias("b")))
    out = join_back(blocks, before, ["__key", "__blk"]).select(each.alias("__e"))
    return out.select("__e.r.__row.*", F.col("__e.r.__s").alias("__s"), F.col("__e.b").alias("__before"))


def keyed_merge(results: DataFrame, op: KeyedOperation, key: str = "u", order: str = "t",
                key_template: str | None = None) -> DataFrame:
    """``(order, key, [store_key], *returned)`` of a keyed operation over all results (K3 in batch)."""
    out = op.project(keyed_scan(results, op, key, order), key, order)
    if key_template is None:
        return out
    return out.withColumn("store_key", profile_key(F.col(key), key_template))
