"""G2 referential_integrity: a row fails when its value is NOT IN the
reference column, with SQL ``NOT IN`` semantics kept exactly:

* empty reference        → every row fails (NULL input included)
* NULL input             → passes (the IN test is unknown)
* value found            → passes
* reference holds a NULL → no row can fail (unknown instead of FALSE)
* otherwise              → fails

Plan: the distinct reference keys, NULL among them (an aggregate, partial on
the map side), left-joined to the input.  Whether the reference has any row
or any NULL follows from that set, so the reference is scanned once.  Nothing
is collected to the driver and no literal list grows with the reference.  The
key set is broadcast only when measured under a bound
(``rowsieve.plans.joins``); otherwise the join is a shuffle join with hot and
NULL input values split off.

Keys of different simple types are matched by value: numbers with numeric
text as decimals (or doubles), dates and timestamps with their text.  Text
that is no such value equals nothing.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsieve.functions.columns import TEXT, column_ref, column_type
from rowsieve.plans.joins import DEFAULT, JoinPolicy, Sized, attach_found, sized_side
from rowsieve.rules import RuleError

_EXACT = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType)
_TIMED = (T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def match_type(left: T.DataType, right: T.DataType, what: str) -> str | None:
    """The type to compare two key types in, None to compare them as they
    are; ``RuleError`` if they cannot be compared."""
    if left == right or isinstance(left, TEXT) and isinstance(right, TEXT):
        return None
    if isinstance(left, T.NumericType) and isinstance(right, T.NumericType):
        return None
    for a, b in ((left, right), (right, left)):
        if isinstance(a, TEXT) and isinstance(b, _EXACT):
            return "decimal(38,10)"
        if isinstance(a, TEXT) and isinstance(b, T.NumericType):
            return "double"
        if isinstance(a, TEXT) and isinstance(b, _TIMED):
            return b.simpleString()
    raise RuleError(
        f"{what}: column type {left.simpleString()} cannot be matched against "
        f"reference type {right.simpleString()}; cast one side first"
    )


def _value(df: DataFrame, column: str, kind: str | None) -> Column:
    c = F.col(column_ref(df, column))
    return c if kind is None else c.try_cast(kind)


def reference_keys(ref: DataFrame, ref_column: str, alias: str, kind: str | None = None) -> DataFrame:
    """Distinct reference values as ``alias``; a NULL in the reference is a
    row of NULL, text of no such value is left out."""
    c, value = F.col(column_ref(ref, ref_column)), _value(ref, ref_column, kind)
    keys = ref.select(value.alias(alias), c.isNull().alias("__rs_null"))
    return keys.where(F.col(alias).isNotNull() | F.col("__rs_null")).select(alias).distinct()


def attach_reference_hit(
    work: DataFrame,
    column: str,
    ref: DataFrame,
    ref_column: str,
    flag: str,
    policy: JoinPolicy = DEFAULT,
    sizes: dict | None = None,
    source: DataFrame | None = None,
) -> tuple[DataFrame, Column, Column]:
    """``work`` plus boolean ``flag``: TRUE when the value is in the
    reference; and whether the reference has any row, and any NULL.

    ``source`` (default ``work``) is the input the values come from; it is
    scanned for hot values only when the reference is too large to
    broadcast."""
    probe, src = f"{flag}_p", work if source is None else source
    kind = match_type(column_type(src, column), column_type(ref, ref_column), f"referential check {column} -> {ref_column}")
    everything = reference_keys(ref, ref_column, probe, kind)
    if not policy.probe:
        present = ref.select(F.count(F.lit(1)) > 0).scalar()
        has_null = everything.select(F.coalesce(F.bool_or(F.col(probe).isNull()), F.lit(False))).scalar()
        sized = Sized(everything, False)
    else:
        sized = sized_side(everything, policy, sizes=sizes)
        nulls = bool(sized.rows) and not sized.frame.where(F.col(probe).isNull()).isEmpty()
        # text of no value is left out of the set, so an empty set may have had rows
        present, has_null = F.lit(bool(sized.rows) or (kind is not None and not ref.isEmpty())), F.lit(nulls)
        if sized.rows == int(nulls):  # no non-NULL reference value: nothing to join
            if sizes is not None:
                sizes[flag] = Sized(sized.frame, False, 0, 0, sized.cached, "empty")
            return work.withColumn(flag, F.lit(None).cast("boolean")), present, has_null
    keys = sized.frame.where(F.col(probe).isNotNull()).withColumn(flag, F.lit(True))
    joined = attach_found(work, src, {probe: _value(src, column, kind)}, replace(sized, frame=keys), flag, flag, policy, sizes)
    return joined, present, has_null


def orphan_predicate(value: Column, hit: Column, present: Column, has_null: Column) -> Column:
    """Violation predicate from the join flag and the reference's contents."""
    return (
        F.when(~present, F.lit(True))
        .when(value.isNull(), F.lit(False))
        .when(hit.isNotNull(), F.lit(False))
        .when(has_null, F.lit(False))
        .otherwise(F.lit(True))
    )


def orphans(
    df: DataFrame, column: str, ref: DataFrame, ref_column: str, policy: JoinPolicy = DEFAULT, sizes: dict | None = None
) -> DataFrame:
    """Rows of ``df`` failing the check (stand-alone form of G2).  ``sizes``
    receives the measured helper set, as in ``duplicates``."""
    flag = "__rs_hit"
    joined, present, has_null = attach_reference_hit(df, column, ref, ref_column, flag, policy, sizes)
    value = F.col(column_ref(df, column))
    return joined.where(orphan_predicate(value, F.col(flag), present, has_null)).drop(flag)
