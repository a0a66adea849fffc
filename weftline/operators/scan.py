"""Ordered scans over records of any size.

A window over one record is one task, however long the record is. Here a record
of more than RANGE rows is cut into ranges of its order, dealt out by Spark's
range partitioner, which samples the keys first. Each range is folded alone to
its carry (running sum, last value, first and last row), the carries of a record
are scanned, and every row takes its range's carry. Shorter records take the
plain window; where no record is long, that is all that happens.

    logs = ordered(rows, ["user_id"], ["event_id"])
    rows = logs.scan(calls=running_sum(is_call), before=previous("role")).rows

Bounds: long records are at most one in RANGE rows, and their ranges at most as
many again; only these are broadcast. Rows that tie in the whole order come in
any order, as in a window; null keys are a record, null orders come first."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from weftline.scratch import materialize

#: Rows of a record that one task may scan.
RANGE = 1_000_000

#: The column that `ordered` adds: 0 for a record that is whole, else the number of its range.
PART = "_part"


#: Steps that give every row of a record the same value.
WHOLE = {"min": F.min, "max": F.max, "total": F.sum}


@dataclass(frozen=True)
class Step:
    kind: str
    value: Column
    backward: bool = False


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def running_sum(value: Column | str, backward: bool = False) -> Step:
    """Sum up to this row, itself included; `backward` from the record's end."""
    return Step("sum", _column(value), backward)


def last_before(value: Column | str) -> Step:
    """The latest value before this row that is not null."""
    return Step("last", _column(value))


def previous(value: Column | str) -> Step:
    """The value of the row before; null in the first."""
    return Step("neighbour", _column(value))


def following(value: Column | str) -> Step:
    """The value of the row behind; null in the last."""
    return Step("neighbour", _column(value), backward=True)


def largest(value: Column | str) -> Step:
    """The greatest value of the whole record."""
    return Step("max", _column(value))


def smallest(value: Column | str) -> Step:
    """The least value of the whole record."""
    return Step("min", _column(value))


def total(value: Column | str) -> Step:
    """The sum over the whole record."""
    return Step("total", _column(value))


@dataclass(frozen=True)
class Ordered:
    """Rows of records in order, long records cut into ranges."""

    rows: DataFrame
    record: list[str]
    order: list[str]
    #: No record is long; PART is 0 everywhere.
    whole: bool

    def columns(self, **columns: Column) -> Ordered:
        return replace(self, rows=self.rows.withColumns(columns))

    def scan(self, **steps: Step) -> Ordered:
        """Adds one column a step."""
        out = self.rows.withColumns({name: self._local(s) for name, s in steps.items()})
        if not self.whole:
            carry = self._carries(steps)
            same = _same({c: f"_of_{i}" for i, c in enumerate(self.record)}) & (F.col(PART) == F.col("_of_part"))
            out = out.join(F.broadcast(carry), same, "left").withColumns({name: _merged(s, F.col(name), F.col(f"_c_{name}")) for name, s in steps.items()}).drop(*carry.columns)
        out = out.withColumns({name: F.col(f"{name}.v") for name, s in steps.items() if s.kind == "neighbour"})
        return replace(self, rows=out)

    def _local(self, s: Step) -> Column:
        """The step within a range."""
        here = W.partitionBy(*self.record, PART)
        along = here.orderBy(*[F.desc(c) if s.backward else F.asc(c) for c in self.order])
        if s.kind == "sum":
            return F.sum(s.value).over(along.rowsBetween(W.unboundedPreceding, 0))
        if s.kind == "last":
            return F.last(s.value, ignorenulls=True).over(along.rowsBetween(W.unboundedPreceding, -1))
        if s.kind == "neighbour":
            return F.lag(F.struct(s.value.alias("v"))).over(along)
        return WHOLE[s.kind](s.value).over(here)

    def _carries(self, steps: dict[str, Step]) -> DataFrame:
        """One row a range: what it gets from the ranges before it, or behind
        it where the step goes backward. At most two ranges in RANGE rows, and
        one more a long record."""
        at = F.struct(*[F.col(c) for c in self.order])

        def folded(s: Step) -> Column:
            if s.kind == "sum":
                return F.sum(s.value)
            if s.kind in WHOLE:
                return WHOLE[s.kind](s.value)
            if s.kind == "last":
                return F.max_by(F.struct(s.value.alias("v")), F.when(s.value.isNotNull(), at))
            return (F.min_by if s.backward else F.max_by)(F.struct(s.value.alias("v")), at)

        def gathered(s: Step, name: str) -> Column:
            side = W.partitionBy(*self.record).orderBy(F.desc(PART) if s.backward else F.asc(PART))
            before = side.rowsBetween(W.unboundedPreceding, -1)
            if s.kind == "sum":
                return F.sum(name).over(before)
            if s.kind == "last":
                return F.last(name, ignorenulls=True).over(before)
            if s.kind == "neighbour":
                return F.lag(name).over(side)
            return WHOLE[s.kind](name).over(W.partitionBy(*self.record))

        parts = self.rows.filter(F.col(PART) > 0).groupBy(*self.record, PART).agg(*[folded(s).alias(f"_c_{name}") for name, s in steps.items()])
        keys = [F.col(c).alias(f"_of_{i}") for i, c in enumerate(self.record)]
        return parts.select(*keys, F.col(PART).alias("_of_part"), *[gathered(s, f"_c_{name}").alias(f"_c_{name}") for name, s in steps.items()])

    def plain(self) -> DataFrame:
        return self.rows.drop(PART)


def _merged(s: Step, mine: Column, other: Column) -> Column:
    if s.kind == "sum":
        return F.coalesce(mine + other, mine, other)
    if s.kind == "last":
        return F.coalesce(mine, other["v"])
    return F.coalesce(mine, other) if s.kind == "neighbour" else F.coalesce(other, mine)


def _same(names: dict[str, str]) -> Column:
    return reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(a)) for c, a in names.items()])


def ordered(rows: DataFrame, record: list[str], order: list[str], limit: int | None = None) -> Ordered:
    """One pass over the record's columns finds the records of more than `limit`
    rows; only their rows are dealt out and written."""
    limit = limit or RANGE
    long = materialize(rows.groupBy(*record).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > limit), "long-records")
    n = long.agg(F.sum("_rows")).first()[0]
    if not n:
        return Ordered(rows.withColumn(PART, F.lit(0)), record, order, whole=True)
    names = {c: f"_of_{i}" for i, c in enumerate(record)}
    keys = F.broadcast(long.select(*[F.col(c).alias(a) for c, a in names.items()]))
    # The last key splits rows that tie in all others.
    dealt = rows.join(keys, _same(names), "left_semi").repartitionByRange(2 * n // limit + 1, *record, *order, F.rand(0))
    cut = materialize(dealt.withColumn(PART, F.spark_partition_id() + 1), "ranges")
    short = rows.join(keys, _same(names), "left_anti").withColumn(PART, F.lit(0))
    return Ordered(short.unionByName(cut), record, order, whole=False)
