"""Keyed operations (K3): how a key's results merge into its stored value.

An operation says once what a result adds (``lift``), how two stored values
merge (``merge``, associative, the earlier one first) and what is returned for
a result given the value stored before it (``returned``). The same object runs

* in batch over all results at once (``keyed.keyed_merge``, a blocked scan),
* in a stream on Spark's state store (``streaming.state.merge_on_state``),
* in a stream into a keyed table (``streaming.sinks.KeyedTableSink``).

``merge`` is written against a small vocabulary (``ops``) that stands for column
expressions in plans and for plain values inside the state store's workers. A
key without a stored value has a NULL in every field, so ``ops`` skip NULLs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import WindowSpec
from tidemark.operators.joins import join_back


class ColumnOps:
    """The vocabulary of ``merge`` as column expressions."""

    add = staticmethod(lambda a, b: F.coalesce(a + b, a, b))
    greatest = staticmethod(lambda a, b: F.greatest(a, b))
    least = staticmethod(lambda a, b: F.least(a, b))
    if_absent = staticmethod(lambda a, then, other: F.when(a.isNull(), then).otherwise(other))


class ValueOps:
    """The same on plain values."""

    add = staticmethod(lambda a, b: b if a is None else a if b is None else a + b)
    greatest = staticmethod(lambda a, b: b if a is None else a if b is None else max(a, b))
    least = staticmethod(lambda a, b: b if a is None else a if b is None else min(a, b))
    if_absent = staticmethod(lambda a, then, other: then if a is None else other)


class KeyedOperation:
    """Base of keyed operations: fields of the stored value, and what follows from ``merge``."""

    #: Seconds of the order column in one block of the batch scan: some hundred results of a key at most.
    block_seconds = 64 * 300

    def fields(self) -> dict[str, str]:
        """Names and types of the stored value's fields."""
        raise NotImplementedError

    def lift(self, order: str) -> dict[str, Column]:
        """The stored value of one result alone."""
        raise NotImplementedError

    def merge(self, a: dict, b: dict, ops) -> dict:
        """The stored value after ``a`` and then ``b``."""
        raise NotImplementedError

    def returned(self, before: Callable[[str], Column]) -> dict[str, Column]:
        """What a result returns; ``before(field)`` is the value stored before it, other columns are the result's."""
        raise NotImplementedError

    # what a plan needs of it

    def struct_type(self) -> str:
        return "struct<" + ",".join(f"{n}:{t}" for n, t in self.fields().items()) + ">"

    def absent(self) -> Column:
        return F.struct(*[F.lit(None).cast(t).alias(n) for n, t in self.fields().items()])

    def lifted(self, order: str) -> Column:
        lift = self.lift(order)
        return F.struct(*[lift[n].cast(t).alias(n) for n, t in self.fields().items()])

    def merged(self, a: Column, b: Column) -> Column:
        """Two stored values, struct columns, as one."""
        parts = [{n: x.getField(n) for n in self.fields()} for x in (a, b)]
        out = self.merge(*parts, ColumnOps)
        return F.struct(*[out[n].cast(t).alias(n) for n, t in self.fields().items()])

    def folded(self, values: Column) -> Column:
        """An array of stored values, the earliest first, as one."""
        return F.aggregate(values, self.absent(), self.merged)

    # a keyed table's use of it (streaming.sinks)

    def state(self, deltas: DataFrame, key: str, order: str) -> DataFrame:
        """``(key, __o, __s)``: stored values of several batches as one per key."""
        held = F.array_sort(F.collect_list(F.struct("__o", "__s")))  # a row for each of a few segments
        return (deltas.groupBy(key).agg(held.alias("__held"))
                .select(key, F.element_at("__held", -1)["__o"].alias("__o"),
                        self.folded(F.col("__held.__s")).alias("__s")))

    def scan_batch(self, batch: DataFrame, key: str, order: str) -> tuple[DataFrame, DataFrame]:
        """A batch's results with ``__before``, the value stored before each by the batch alone, and its delta."""
        from tidemark.operators.keyed import keyed_scan

        scanned = keyed_scan(batch, self, key, order)
        delta = scanned.groupBy(key).agg(
            F.max(order).alias("__o"),
            F.max_by(self.merged(F.col("__before"), F.col("__s")), F.col(order)).alias("__s"))
        return scanned, delta

    def merge_batch(self, batch: DataFrame, state: DataFrame | None, key: str, order: str):
        """Returned rows of a batch, and ``(key, __o, __s)``: what it adds to the store."""
        scanned, delta = self.scan_batch(batch, key, order)
        if state is not None:
            stored = state.select(key, F.col("__s").alias("__stored"))
            scanned = join_back(scanned, stored, key, "left")
            at = F.when(F.col("__stored").isNull(), F.col("__before")).otherwise(
                self.merged(F.col("__stored"), F.col("__before")))
            scanned = scanned.withColumn("__before", at)
        return self.project(scanned, key, order), delta

    def project(self, scanned: DataFrame, key: str, order: str, before: str = "__before") -> DataFrame:
        """``(order, key, *returned)`` of rows that hold a struct of the value stored before them."""
        returned = self.returned(lambda n: F.col(f"{before}.{n}"))
        return scanned.select(order, key, *[c.alias(n) for n, c in returned.items()])


@dataclass
class FirstWrite(KeyedOperation):
    """K1, insert if absent: the first result stays stored; later ones return stored + current."""

    values: Sequence[str] = ("clicks", "shows")
    names: Sequence[str] = ("rt_u_click", "rt_u_reveal")
    stored: Sequence[str] = ("stored_click", "stored_reveal")
    kind: str = "bigint"

    def fields(self):
        return {"at": "bigint", **dict.fromkeys(self.values, self.kind)}

    def lift(self, order):
        return {"at": F.col(order), **{v: F.col(v) for v in self.values}}

    def merge(self, a, b, ops):
        return {n: ops.if_absent(a["at"], b[n], a[n]) for n in self.fields()}

    def scan_batch(self, batch, key, order):
        # a key's first result is what all its later ones find: no scan, a look at the first of a key's results, of
        # which a batch has one per window
        whole = Window.partitionBy(key)
        earlier = whole.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        scanned = batch.select("*", self.lifted(order).alias("__s")).withColumn("__before", F.first("__s").over(earlier))
        delta = (scanned.withColumn("__o", F.max(order).over(whole)).where(F.col("__before").isNull())
                 .select(key, "__o", "__s"))
        return scanned, delta

    def returned(self, before):
        new = before("at").isNull()
        return {**{n: F.when(new, F.col(v)).otherwise(before(v) + F.col(v)) for v, n in zip(self.values, self.names)},
                **{s: F.when(new, F.col(v)).otherwise(before(v)) for v, s in zip(self.values, self.stored)}}


@dataclass
class Accumulate(KeyedOperation):
    """K2: the stored value is the running total of every result.

    ``spec`` is the window geometry of the results; overlapping windows are
    refused, as they would count a record once per window it falls in.
    """

    spec: WindowSpec
    values: Sequence[str] = ("clicks", "shows")
    names: Sequence[str] = ("rt_u_click", "rt_u_reveal")
    kind: str = "bigint"

    def __post_init__(self):
        if not self.spec.is_tumbling:
            raise ValueError("accumulating merge needs half-open tumbling windows")
        self.block_seconds = 64 * self.spec.slide

    def fields(self):
        return dict.fromkeys(self.values, self.kind)

    def lift(self, order):
        return {v: F.col(v) for v in self.values}

    def merge(self, a, b, ops):
        return {v: ops.add(a[v], b[v]) for v in self.values}

    def returned(self, before):
        return {n: F.coalesce(before(v), F.lit(0).cast(self.kind)) + F.col(v) for v, n in zip(self.values, self.names)}


@dataclass
class KeepMost(KeyedOperation):
    """A user-defined operation: the stored value is the largest ``value`` of any result so far."""

    value: str = "clicks"
    name: str = "most_clicks"

    def fields(self):
        return {"most": "bigint"}

    def lift(self, order):
        return {"most": F.col(self.value)}

    def merge(self, a, b, ops):
        return {"most": ops.greatest(a["most"], b["most"])}

    def returned(self, before):
        return {self.name: F.greatest(before("most"), F.col(self.value))}
