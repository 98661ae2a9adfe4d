"""Questions about an ordered sequence per key.

The order is an explicit list of columns (e.g. ``ts, event_id``); "index"
is the 0-based position in that order. All answers are aggregates with
partial (map-side) combining, so a key holding a third of all rows still
spreads over every map task:

* head / tail with index (R1), first / last non-null value with index (R2),
  length and valid length (R3, valid = from first to last non-null, inner
  nulls counted), oldest arrival (R4);
* bounded intake (R5): a key accepts rows while it holds fewer than
  ``capacity`` and rejects newcomers after that, i.e. keeps its first
  ``capacity`` rows. ``row_number() <= capacity`` is planned with a partial
  window group limit before the shuffle, so at most ``capacity`` rows per key
  and map task are shuffled.

``rolling_sequence`` asks R1-R4 of every row's live set, ``live_intake`` is R5
where what was accepted expires.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import epoch_seconds
from tidemark.operators.joins import join_back
from tidemark.operators.keyed import DEFAULT_BLOCK_SECONDS, running_totals, time_block
from tidemark.session import scratch_path, ship_package


# Fixed widths of an order number: a timestamp's microseconds (or a whole
# number of up to 17 digits) before a 64-bit number shifted to be positive.
_SECOND_WIDTH, _SECOND_SHIFT, _FIRST_NULL = 2 * 10 ** 19, 2 ** 63, -(10 ** 17)


def order_number(df: DataFrame, order: Sequence[str]) -> Column:
    """The order columns as one comparable column of fixed width, which keeps
    ``min_by`` / ``max_by`` hash-based: one column as it is, (timestamp, whole
    number) as one decimal; anything else is compared as a struct
    (sort-based). NULLs come first."""
    if len(order) == 1:
        return F.col(order[0])
    kinds = [df.schema[c].dataType.simpleString() for c in order]
    if len(order) == 2 and kinds[0] in ("timestamp", "timestamp_ntz") and kinds[1] in ("bigint", "int"):
        seconds = epoch_seconds(df, order[0])
        fraction = F.date_part(F.lit("SECOND"), F.col(order[0])) * 1_000_000 % 1_000_000
        micros = seconds.cast("decimal(17,0)") * 1_000_000 + fraction.cast("decimal(6,0)")
        first = F.coalesce(micros.cast("decimal(18,0)"), F.lit(_FIRST_NULL).cast("decimal(18,0)"))
        second = F.coalesce(F.col(order[1]).cast("decimal(20,0)") + _decimal(_SECOND_SHIFT), _decimal(0))
        return (first * _decimal(_SECOND_WIDTH)).cast("decimal(38,0)") + second.cast("decimal(38,0)")
    return F.struct(*[F.col(c) for c in order])


def _decimal(n: int) -> Column:
    return F.lit(str(n)).cast("decimal(20,0)")


def sequence_summary(df: DataFrame, key: str, value: str, order: Sequence[str],
                     ts: str | None = None) -> DataFrame:
    """Per key: ``length, head, head_idx, tail, tail_idx, valid_head,
    valid_head_idx, valid_tail, valid_tail_idx, valid_length[, oldest_sec]``."""
    ordc = order_number(df, order)
    valid_ord = F.when(F.col(value).isNotNull(), ordc)
    aggs = [F.count(F.lit(1)).alias("length"),
            F.min_by(F.col(value), ordc).alias("head"),
            F.max_by(F.col(value), ordc).alias("tail"),
            F.min_by(F.col(value), valid_ord).alias("valid_head"),
            F.max_by(F.col(value), valid_ord).alias("valid_tail"),
            F.min(valid_ord).alias("__fv"), F.max(valid_ord).alias("__lv")]
    if ts is not None:
        aggs.append(F.min(epoch_seconds(df, ts)).alias("oldest_sec"))
    first = df.groupBy(key).agg(*aggs)
    # Second pass: only NULL elements come before the first non-null one and
    # after the last, so their numbers give both positions; no other row is
    # shuffled again.
    gaps = join_back(df.filter(F.col(value).isNull()).select(key, ordc.alias("__o")),
                     first.select(key, "__fv", "__lv"), key)
    around = gaps.groupBy(key).agg(F.count_if(F.col("__o") < F.col("__fv")).alias("__before"),
                                   F.count_if(F.col("__o") > F.col("__lv")).alias("__after"))
    zero = F.lit(0).cast("bigint")
    pos = (join_back(first, around, key, "left")
           .withColumn("__vh", F.coalesce("__before", zero))
           .withColumn("__vt", F.col("length") - 1 - F.coalesce("__after", zero)))
    has_valid = F.col("__fv").isNotNull()
    vh = F.when(has_valid, F.col("__vh")).otherwise(F.lit(-1).cast("bigint"))
    vt = F.when(has_valid, F.col("__vt")).otherwise(F.lit(-1).cast("bigint"))
    cols = [key, "length", "head", F.lit(0).cast("bigint").alias("head_idx"),
            "tail", (F.col("length") - 1).alias("tail_idx"),
            "valid_head", vh.alias("valid_head_idx"), "valid_tail", vt.alias("valid_tail_idx"),
            F.when(has_valid, F.col("__vt") - F.col("__vh") + 1)
            .otherwise(F.lit(0).cast("bigint")).alias("valid_length")]
    if ts is not None:
        cols.append("oldest_sec")
    return pos.select(*cols)


def bounded_intake(df: DataFrame, key: str, order: Sequence[str], capacity: int,
                   block_size: int = DEFAULT_BLOCK_SECONDS) -> DataFrame:
    """Accepted rows of every key with ``pos`` (0-based) and per-key flags
    ``size``, ``rejected``, ``full`` and ``empty`` (false: a key that holds
    nothing has no rows, unless capacity is 0). ``capacity < 0`` means unlimited:
    every row is accepted and ``pos`` is a blocked running count (blocks of
    ``block_size`` over the first order column), so no task holds a whole key.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    if capacity < 0:
        kept = running_totals(df, key, order, time_block(df, order[0], block_size),
                              {"pos": F.lit(1)}).withColumn("pos", F.col("pos") - 1)
    else:
        w = Window.partitionBy(key).orderBy(*order)
        kept = df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= capacity) \
            .withColumn("pos", (F.col("__rn") - 1).cast("bigint")).drop("__rn")
    size = F.col("__n") if capacity < 0 else F.least(F.col("__n"), F.lit(capacity).cast("bigint"))
    rejected = F.lit(0).cast("bigint") if capacity < 0 else F.greatest(
        F.col("__n") - capacity, F.lit(0).cast("bigint"))
    full = F.lit(False) if capacity < 0 else F.col("__n") >= capacity
    return (join_back(kept, counts, key)
            .withColumn("size", size).withColumn("rejected", rejected).withColumn("full", full)
            .withColumn("empty", size == 0)
            .drop("__n"))


def rolling_sequence(df: DataFrame, key: str, value: str, order: Sequence[str], length: int, ts: str) -> DataFrame:
    """R1-R4 inside the live set: for every row the answers about its key's rows of the last ``length`` seconds,
    its own second included: ``sec, length, head, tail, valid_head, valid_tail, valid_length, lowest, oldest_sec``.

    First, last and least values have no inverse, so they cannot leave a running
    figure as sums do. Time is cut into blocks as long as a window; a window is
    then the end of one block and the beginning of the next. One pass forward
    and one backward through each block give every beginning and every end, and a
    row's answers are two of them put together. Windows run inside (key, block), so a
    hot key spreads over its blocks, and each row is copied twice whatever the length.
    """
    span = length + 1
    rows = df.select(F.col(key).alias("__k"), epoch_seconds(df, ts).alias("sec"), order_number(df, order).alias("__o"),
                     F.col(value).alias("__v")).where(F.col("sec").isNotNull())
    rows = rows.withColumn("blk", F.floor(F.col("sec") / span).cast("bigint"))
    inside = Window.partitionBy("__k", "blk")
    # places from both ends of the block, for the distance between two rows of different blocks
    rows = (rows.withColumn("__up", F.row_number().over(inside.orderBy("__o")))
            .withColumn("__down", F.count(F.lit(1)).over(inside) - F.col("__up") + 1))
    valid = F.when(F.col("__v").isNotNull(), F.col("__o"))
    one = F.struct(F.col("__v").alias("v"), F.col("__up").alias("up"), F.col("__down").alias("down"))
    answers = {"n": F.count("__o"), "head": F.min_by(one, "__o"), "tail": F.max_by(one, "__o"),
               "vh": F.min_by(one, valid), "vt": F.max_by(one, valid), "lowest": F.min("__v"), "oldest": F.min("__sec")}
    seconds = rows.select("__k", "sec", "blk").distinct()
    begin = inside.orderBy("sec").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = rows.withColumn("__sec", F.col("sec")).select(
        "__k", "sec", F.struct(*[a.over(begin).alias(n) for n, a in answers.items()]).alias("b")).dropDuplicates(["__k", "sec"])
    # the block before: its rows, and a question at the second where the window begins
    asked = seconds.select("__k", (F.col("sec") - length).alias("sec"), (F.col("blk") - 1).alias("blk"),
                           F.col("sec").alias("for"))
    both = rows.withColumn("__sec", F.col("sec")).unionByName(asked, allowMissingColumns=True)
    end = inside.orderBy(F.col("sec").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    behind = both.select("__k", "for", F.struct(*[a.over(end).alias(n) for n, a in answers.items()]).alias("a")).where(
        F.col("for").isNotNull()).withColumnRenamed("for", "sec")
    met = join_back(ahead, behind, ["__k", "sec"])
    a, b = (lambda n: F.col(f"a.{n}")), (lambda n: F.col(f"b.{n}"))
    first = F.when(a("n") > 0, a("head.v")).otherwise(b("head.v"))
    vh, vt = F.coalesce(a("vh"), b("vh")), F.coalesce(b("vt"), a("vt"))
    apart = (F.when(vh.isNull(), F.lit(0))
             .when(a("vh").isNotNull() & b("vt").isNotNull(), a("vh.down") + b("vt.up"))
             .otherwise(vt["up"] - vh["up"] + 1))
    found = met.select("__k", "sec", (a("n") + b("n")).alias("length"), first.alias("head"), b("tail.v").alias("tail"),
                       vh["v"].alias("valid_head"), vt["v"].alias("valid_tail"), apart.cast("bigint").alias("valid_length"),
                       F.least(a("lowest"), b("lowest")).alias("lowest"), F.coalesce(a("oldest"), b("oldest")).alias("oldest_sec"))
    out = df.withColumn("__k", F.col(key)).withColumn("sec", epoch_seconds(df, ts))
    return join_back(out, found, ["__k", "sec"]).drop("__k")


_INTAKE = "__k, __blk, __i bigint, sec bigint, accepted boolean, size int, held array<bigint>"


def live_intake(df: DataFrame, key: str, order: Sequence[str], capacity: int, length: int, ts: str,
                block_seconds: int = DEFAULT_BLOCK_SECONDS, block_rows: int = 100_000) -> DataFrame:
    """R5 with expiry: every row with ``accepted`` and ``size`` (held after it), where a key holds ``capacity``
    rows at most and a row leaves ``length`` seconds after its own second (it is live at both ends).

    Whether a row is accepted depends on the rows accepted before it, so a key's rows are gone through in
    order; what one block of time hands to the next is the seconds of the rows
    still held, ``capacity`` at most. All blocks start at once, as if nothing were
    held; then those whose predecessor handed over something else are run again, and so on
    until no block's beginning changes. A block forgets its beginning as soon as
    what it holds has expired or is the same either way; where a key is full all the time that may never
    be, and its blocks follow one another, a round each. So blocks are large: stretches of ``block_seconds`` are
    put together up to ``block_rows`` rows of a key, and a task holds one such block.
    """
    if capacity < 1:
        raise ValueError("capacity must be at least 1")
    ship_package(df.sparkSession)
    table = lambda d, name: _as_table(d, f"intake-{name}")
    rows = df.where(F.col(ts).isNotNull()).withColumn("sec", epoch_seconds(df, ts))
    rows = rows.withColumn("__k", F.col(key)).withColumn("__part", F.floor(F.col("sec") / block_seconds).cast("bigint"))
    earlier = Window.partitionBy("__k").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a key's stretches
    blocks = rows.groupBy("__k", "__part").agg(F.count(F.lit(1)).alias("__n")).select(
        "__k", "__part", F.floor(F.coalesce(F.sum("__n").over(earlier), F.lit(0)) / block_rows).cast("bigint").alias("__blk"))
    place = F.row_number().over(Window.partitionBy("__k", "__blk").orderBy(*order)).cast("bigint")
    rows = table(join_back(rows, blocks, ["__k", "__part"]).drop("__part").withColumn("__i", place), "rows")
    kind = rows.schema["__k"].dataType.simpleString()
    schema = _INTAKE.replace("__k,", f"__k {kind},").replace("__blk,", "__blk bigint,")

    def run(held: pd.DataFrame, start: pd.DataFrame) -> pd.DataFrame:
        """One block, from the seconds held at its beginning."""
        out = held.sort_values("__i")[["__k", "__blk", "__i", "sec"]].copy()
        live = list(start["held"].iloc[0]) if len(start) and start["held"].iloc[0] is not None else []
        accepted, size = [], []
        for s in out["sec"]:
            while live and live[0] + length < s:
                live.pop(0)
            accepted.append(len(live) < capacity)
            if accepted[-1]:
                live.append(int(s))
            size.append(len(live))
        out["accepted"], out["size"] = accepted, size
        out["held"] = [None] * (len(out) - 1) + [live]
        return out

    def run_blocks(blocks: DataFrame, starts: DataFrame) -> DataFrame:
        return blocks.select("__k", "__blk", "__i", "sec").groupBy("__k", "__blk").cogroup(
            starts.groupBy("__k", "__blk")).applyInPandas(run, schema)

    firsts = rows.groupBy("__k", "__blk").agg(F.min("sec").alias("first"))
    none = F.array().cast("array<bigint>")
    starts = firsts.select("__k", "__blk", none.alias("held"))
    results = table(run_blocks(rows, starts), "results")
    before = Window.partitionBy("__k").orderBy("__blk")  # the blocks of a key
    while True:
        ends = join_back(results.where("held IS NOT NULL").select("__k", "__blk", "held"), firsts, ["__k", "__blk"])
        handed = ends.select("__k", "__blk", "first", F.coalesce(F.lag("held").over(before), none).alias("held"))
        now = handed.select("__k", "__blk", F.filter("held", lambda s: s + length >= F.col("first")).alias("held"))
        changed = table(join_back(now.withColumnRenamed("held", "new"), starts, ["__k", "__blk"])
                        .where(F.col("new") != F.col("held")).select("__k", "__blk", F.col("new").alias("held")), "changed")
        if changed.isEmpty():
            break
        starts = table(join_back(starts, changed, ["__k", "__blk"], "left_anti").unionByName(changed), "starts")
        again = run_blocks(join_back(rows, changed, ["__k", "__blk"], "left_semi"), changed)
        results = table(join_back(results, changed, ["__k", "__blk"], "left_anti").unionByName(again), "results")
    done = results.select("__k", "__blk", "__i", "accepted", "size")
    return join_back(rows, done, ["__k", "__blk", "__i"]).drop("__k", "__blk", "__i")


def _as_table(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared scratch folder and read back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
