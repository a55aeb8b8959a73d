"""Rules over ordered rows: what must be known is the state of a key just
before a row, and one key may hold a third of all rows.

Every rule here works on *points*, the distinct (key, order, ...) tuples it
needs, made by an aggregate (partial on the map side); the input itself is not
sorted or shuffled.  A window per key gives each point the state of the points
before it, the violating points are a helper set, and that set is attached to
the input like a set of duplicate keys (measured, broadcast under the bound,
else a shuffle join with hot keys split off).

A key with more than ``heavy_key_rows`` points would be one task's window.
Its points are therefore range-partitioned into *pieces* by (key, order),
written, and numbered in order; windows run per (key, piece), and what
earlier pieces hand on (a running maximum, the last value) is a small table,
one row per piece, attached to the points by a measured broadcast.  So one hot
key spans many tasks, and its pieces are stitched at their borders.

Types of order columns: whatever Spark orders.  Points with a NULL key part or
a NULL order value belong to no sequence; their rows pass.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsieve.functions.columns import TEXT, column_ref, column_type
from rowsieve.functions.predicates import epoch_seconds
from rowsieve.operators.outliers import numeric_value
from rowsieve.operators.referential import match_type
from rowsieve.operators.uniqueness import key_value
from rowsieve.plans.joins import DEFAULT, JoinPolicy, Sized, attach_found, hot_keys, sized_side
from rowsieve.rules import RuleError, parse_duration

PIECE = "__rs_piece"


ALL = "__rs_all"


def all_known(names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])


def _grouped(points: DataFrame, by: list[str]) -> tuple[DataFrame, list[str]]:
    """Without key columns all points are one sequence.  Its key must not be a
    literal, which Catalyst would take out of the joins on it."""
    return (points, by) if by else (points.withColumn(ALL, F.spark_partition_id() * F.lit(0)), [ALL])


@dataclass(frozen=True)
class Points:
    """Points with a piece number; ``hot`` holds the keys that have several pieces."""

    frame: DataFrame
    keys: list[str]
    order: list[str]
    hot: Sized | None
    cached: tuple[DataFrame, ...] = ()

    def window(self):
        return Window.partitionBy(*self.keys, PIECE).orderBy(*self.order)

    def carried(self, summary: Column, running: Callable[[Column, object], Column], name: str, policy: JoinPolicy) -> DataFrame:
        """``frame`` plus ``name``: ``running`` (an aggregate of a column over
        a window) of ``summary`` (an aggregate of a piece) over all earlier
        pieces of the key; NULL in a key's first piece."""
        if self.hot is None:
            kind = self.frame.groupBy(*self.keys).agg(summary.alias(name)).schema[name].dataType
            return self.frame.withColumn(name, F.lit(None).cast(kind))
        pieces = self.frame.where(F.col(PIECE) > 0).groupBy(*self.keys, PIECE).agg(summary.alias("__rs_sum"))
        before = Window.partitionBy(*self.keys).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
        carry = pieces.select(*self.keys, PIECE, running(F.col("__rs_sum"), before).alias(name))
        side = sized_side(carry, policy)
        return self.frame.join(side.side(), on=[*self.keys, PIECE], how="left")


def in_pieces(points: DataFrame, keys: list[str], order: list[str], policy: JoinPolicy = DEFAULT) -> Points:
    """Number the pieces of hot keys; all points of other keys are piece 0."""
    whole = points.withColumn(PIECE, F.lit(0))
    if not policy.probe:
        return Points(whole, keys, order, None)
    counted = points.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rs_n")).where(F.col("__rs_n") > policy.heavy_key_rows)
    measured = sized_side(counted, policy)
    hot = hot_keys(measured.frame, "__rs_n", policy) if measured.rows else None
    if hot is None:
        return Points(whole, keys, order, None)
    total = hot.frame.agg(F.sum("__rs_n")).first()[0]
    chosen = F.broadcast(hot.frame.select(*keys))
    dealt = points.join(chosen, keys, "left_semi").repartitionByRange(math.ceil(total / policy.heavy_key_rows) + 1, *keys, *order)
    # written before it is used again: a piece number is where a row once stood
    pieces = sized_side(dealt.withColumn(PIECE, F.spark_partition_id() + 1), policy)
    rest = whole.join(chosen, keys, "left_anti")
    return Points(rest.unionByName(pieces.frame), keys, order, hot, tuple(c for c in (pieces.cached, measured.cached, hot.cached) if c is not None))


def _highest(column: Column, window) -> Column:
    return F.max(column).over(window)


def _latest(column: Column, window) -> Column:
    return F.last(column, ignorenulls=True).over(window)


# -- sequence_check ------------------------------------------------------------


def step_value(df: DataFrame, column: str) -> Column:
    """A value that steps are taken between: numbers (also kept as text), or
    the seconds of dates and times; NaN is unknown."""
    kind = column_type(df, column)
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return epoch_seconds(F.col(column_ref(df, column)), kind)
    value = numeric_value(df, column)
    return F.when(~F.isnan(value), value) if isinstance(kind, (T.FloatType, T.DoubleType, *TEXT)) else value


def sequence_breaks(
    df: DataFrame, keys: Sequence[str], order: str, column: str, least: float | None, most: float | None, names: list[str], policy: JoinPolicy = DEFAULT
) -> DataFrame:
    """Distinct (key..., order, value) as ``names`` whose step from the value
    before it is under ``least`` or over ``most``."""
    values = [key_value(df, k) for k in keys] + [F.col(column_ref(df, order)), step_value(df, column)]
    points = df.select(*[v.alias(n) for v, n in zip(values, names)]).where(all_known(names)).distinct()
    *by, at, value = names
    points, by = _grouped(points, by)
    parts = in_pieces(points, by, [at, value], policy)
    # the last point of a piece hands on its value
    stitched = parts.carried(F.max(F.struct(at, value)), _latest, "__rs_carry", policy)
    before = F.lag(value).over(parts.window())
    step = F.col(value) - F.coalesce(before, F.col("__rs_carry")[value])
    bad = [step < F.lit(least)] if least is not None else []
    bad += [step > F.lit(most)] if most is not None else []
    return stitched.withColumn("__rs_bad", reduce(lambda a, b: a | b, bad)).where("__rs_bad").select(*names)


def attach_sequence_flag(work, source, keys, order, column, least, most, flag, policy=DEFAULT, sizes=None) -> DataFrame:
    """``work`` plus boolean ``flag`` (TRUE or NULL): the row's value steps out of bounds."""
    names = [f"{flag}_k{i}" for i in range(len(keys) + 2)]
    found = sequence_breaks(source, keys, order, column, least, most, names, policy).withColumn(flag, F.lit(True))
    values = [key_value(source, k) for k in keys] + [F.col(column_ref(source, order)), step_value(source, column)]
    return attach_found(work, source, dict(zip(names, values)), sized_side(found, policy, sizes=sizes), flag, flag, policy, sizes)


# -- order_dependency ----------------------------------------------------------


def dependency_bounds(df: DataFrame, keys: Sequence[str], order: str, column: str, names: list[str], bound: str, policy: JoinPolicy = DEFAULT) -> DataFrame:
    """Distinct (key..., order) as ``names`` with the greatest value of any
    strictly smaller order as ``bound``, where some value there is below it."""
    values = [key_value(df, k) for k in keys] + [F.col(column_ref(df, order))]
    rows = df.select(*[v.alias(n) for v, n in zip(values, names)], F.col(column_ref(df, column)).alias("__rs_v"))
    known = rows.where(all_known([*names, "__rs_v"]))
    points = known.groupBy(*names).agg(F.min("__rs_v").alias("__rs_low"), F.max("__rs_v").alias("__rs_high"))
    *by, at = names
    points, by = _grouped(points, by)
    parts = in_pieces(points, by, [at], policy)
    stitched = parts.carried(F.max("__rs_high"), _highest, "__rs_carry", policy)
    earlier = F.max("__rs_high").over(parts.window().rowsBetween(Window.unboundedPreceding, -1))
    return stitched.withColumn(bound, F.greatest(earlier, F.col("__rs_carry"))).where(F.col(bound) > F.col("__rs_low")).select(*names, bound)


def attach_dependency_bound(work, source, keys, order, column, flag, policy=DEFAULT, sizes=None) -> DataFrame:
    """``work`` plus ``flag``: the greatest value before the row's order, where
    a row there is below it; the row fails if its own value is."""
    names = [f"{flag}_k{i}" for i in range(len(keys) + 1)]
    found = dependency_bounds(source, keys, order, column, names, flag, policy)
    values = [key_value(source, k) for k in keys] + [F.col(column_ref(source, order))]
    return attach_found(work, source, dict(zip(names, values)), sized_side(found, policy, sizes=sizes), flag, flag, policy, sizes)


# -- functional_dependency -----------------------------------------------------


def ambiguous_keys(df: DataFrame, keys: Sequence[str], column: str, names: list[str]) -> DataFrame:
    """Distinct keys (all parts known) as ``names`` under which ``column`` has
    more than one value, with their row count ``__rs_n``."""
    rows = df.select(*[key_value(df, k).alias(n) for k, n in zip(keys, names)], key_value(df, column).alias("__rs_v"))
    grouped = rows.where(all_known(names)).groupBy(*names)
    counted = grouped.agg(F.min("__rs_v").alias("__rs_low"), F.max("__rs_v").alias("__rs_high"), F.count(F.lit(1)).alias("__rs_n"))
    return counted.where(F.col("__rs_low") != F.col("__rs_high")).select(*names, "__rs_n")


def attach_ambiguity_flag(work, source, keys, column, flag, policy=DEFAULT, sizes=None) -> DataFrame:
    """``work`` plus boolean ``flag`` (TRUE or NULL): the row's key has several values of ``column``."""
    names = [f"{flag}_k{i}" for i in range(len(keys))]
    found = ambiguous_keys(source, keys, column, names).withColumn(flag, F.lit(True))
    values = {n: key_value(source, k) for k, n in zip(keys, names)}
    return attach_found(work, source, values, sized_side(found, policy, sizes=sizes), flag, flag, policy, sizes, count="__rs_n")


# -- interval_reference --------------------------------------------------------


@dataclass(frozen=True)
class Periods:
    """Reference rows as periods: key columns, start, and end (exclusive; NULL
    is open) or a longest age of a reference row."""

    frame: DataFrame
    keys: tuple[str, ...]
    start: str
    end: str | None = None
    max_duration: str | None = None


def _keys(df: DataFrame, keys: Sequence[str], other: DataFrame, others: Sequence[str]) -> list[Column]:
    """Key columns of ``df`` as they are compared with those of ``other``."""
    out = []
    for key, theirs in zip(keys, others):
        kind = match_type(column_type(df, key), column_type(other, theirs), f"interval_reference {key} against {theirs}")
        out.append(key_value(df, key) if kind is None else F.col(column_ref(df, key)).try_cast(kind))
    return out


def _time_type(df: DataFrame, column: str, periods: Periods) -> T.DataType:
    """The type that a row's time is compared with the periods in."""
    kind = column_type(df, column)
    if isinstance(kind, T.DateType) and periods.max_duration is not None:
        return T.TimestampNTZType()
    if periods.max_duration is not None and not isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        raise RuleError(f"interval_reference: max_duration needs a date or time, {column!r} is {kind.simpleString()}")
    return kind


def uncovered_points(df: DataFrame, keys: Sequence[str], column: str, periods: Periods, names: list[str], policy: JoinPolicy = DEFAULT) -> DataFrame:
    """Distinct (key..., time) as ``names`` that no reference row covers.

    Points and periods are sorted together by (key, time); a point is covered
    if the greatest end among the periods that started by then is beyond it.
    So overlapping, nested and open periods need no merging, and no period is
    spread over bins: the work is that of one sort.
    """
    ref, kind = periods.frame, _time_type(df, column, periods)
    *by, at = names
    own = _keys(df, keys, ref, periods.keys) + [F.col(column_ref(df, column)).cast(kind)]
    points = df.select(*[v.alias(n) for v, n in zip(own, names)]).where(all_known(names)).distinct()
    start = F.col(column_ref(ref, periods.start))
    begin, sound = start.try_cast(kind), start.isNull() | start.try_cast(kind).isNotNull()  # text of no such value is no period
    if periods.max_duration is not None:
        # up to and including that age, in steps of a microsecond
        span = F.make_dt_interval(secs=F.lit(str(parse_duration(periods.max_duration))).cast("decimal(18,6)") + F.expr("0.000001BD"))
        to, open_, sound = begin + span, F.lit(False), sound & start.isNotNull()
    elif periods.end is None:
        to, open_ = F.lit(None).cast(kind), F.lit(True)
    else:
        end = F.col(column_ref(ref, periods.end))
        to, open_, sound = end.try_cast(kind), end.isNull(), sound & (end.isNull() | end.try_cast(kind).isNotNull())
    theirs = [v.alias(n) for v, n in zip(_keys(ref, periods.keys, df, keys), by)]
    known = ref.where(sound).select(*theirs, begin.alias(at), to.alias("__rs_to"), open_.alias("__rs_open"))
    known = (known.where(all_known(by)) if by else known).groupBy(*names).agg(F.max("__rs_to").alias("__rs_to"), F.bool_or("__rs_open").alias("__rs_open"))
    # at one time a period comes before the point, since its start is part of it; open starts (NULL) come first of all
    both = known.select(*names, F.lit(False).alias("__rs_point"), "__rs_open", "__rs_to").unionByName(
        points.select(*names, F.lit(True).alias("__rs_point"), F.lit(False).alias("__rs_open"), F.lit(None).cast(kind).alias("__rs_to"))
    )
    both, by = _grouped(both, by)
    parts = in_pieces(both, by, [at, "__rs_point"], policy)
    reach = F.struct("__rs_open", "__rs_to")  # an open end is beyond every other
    stitched = parts.carried(F.max(reach), _highest, "__rs_carry", policy)
    far = stitched.withColumn("__rs_far", F.max(reach).over(parts.window().rowsBetween(Window.unboundedPreceding, Window.currentRow)))

    def covers(end: str) -> Column:
        return F.coalesce(F.col(end)["__rs_open"] | (F.col(end)["__rs_to"] > F.col(at)), F.lit(False))

    return far.where(F.col("__rs_point") & ~covers("__rs_far") & ~covers("__rs_carry")).select(*names)


def attach_uncovered_flag(work, source, keys, column, periods, flag, policy=DEFAULT, sizes=None) -> DataFrame:
    """``work`` plus boolean ``flag`` (TRUE or NULL): no reference row covers the row's time."""
    names = [f"{flag}_k{i}" for i in range(len(keys) + 1)]
    found = uncovered_points(source, keys, column, periods, names, policy).withColumn(flag, F.lit(True))
    values = _keys(source, keys, periods.frame, periods.keys) + [F.col(column_ref(source, column)).cast(_time_type(source, column, periods))]
    return attach_found(work, source, dict(zip(names, values)), sized_side(found, policy, sizes=sizes), flag, flag, policy, sizes)
