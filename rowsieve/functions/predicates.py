"""Row-local rules → violation predicates (TRUE means "this row fails").

Every predicate is a plain Catalyst expression, so it runs inside
whole-stage codegen, works on streaming frames, and lets Catalyst prune
columns and fold constants.  A predicate that evaluates to NULL passes the
row: the verdict collector keeps a rule name only when its predicate is TRUE.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsieve.functions.columns import TEXT, column_ref, column_type
from rowsieve.rules import Rule, RuleError, parse_date_bound, parse_duration, parse_time_bound

Source = DataFrame | T.StructType

_FLOATING = (T.FloatType, T.DoubleType)


def _any(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conds)


# --- R1 ---------------------------------------------------------------------
def null_check(rule: Rule, schema: Source) -> Column:
    return F.col(column_ref(schema, rule.require("column"))).isNull()


# --- R2 ---------------------------------------------------------------------
def regex_match(rule: Rule, schema: Source) -> Column:
    # unanchored Java regex (find anywhere); users anchor with ^...$
    return ~F.col(column_ref(schema, rule.require("column"))).rlike(rule.require("pattern"))


# --- R3 ---------------------------------------------------------------------
def _exact(c: Column) -> Column:
    """Numeric text as a decimal; NULL where it is no number or too long."""
    return c.try_cast("decimal(38,10)")


def _decimal(value: float) -> Column:
    return F.lit(Decimal(str(value))).cast("decimal(38,10)")


def value_range(rule: Rule, schema: Source) -> Column:
    name = rule.require("column")
    c = F.col(column_ref(schema, name))
    dtype = column_type(schema, name)
    low, high = rule.get("min"), rule.get("max")
    conds: list[Column] = []
    if isinstance(dtype, TEXT):
        # numbers kept as text (an all-string CSV read): compare the parsed
        # value; text that is no number gives NULL and passes instead of an
        # ANSI cast error aborting the run.  Parsing to DOUBLE rounds, and
        # rounding keeps order, so only values that meet a bound can be
        # judged wrongly: those compare as decimals.
        d, dtype = c.try_cast(T.DoubleType()), T.DoubleType()
        if low is not None:
            conds.append((d < F.lit(float(low))) | ((d == F.lit(float(low))) & (_exact(c) < _decimal(low))))
        if high is not None:
            conds.append((d > F.lit(float(high))) | ((d == F.lit(float(high))) & (_exact(c) > _decimal(high))))
        c = d
    else:
        if low is not None:
            conds.append(c < F.lit(low))
        if high is not None:
            conds.append(c > F.lit(high))
    # An absent bound means -inf / +inf: NaN compares greater than +inf in
    # Spark, so NaN always fails.  Emit that directly instead of casting the
    # column to double against infinite bounds.
    if isinstance(dtype, _FLOATING):
        conds.append(F.isnan(c))
    return _any(conds) if conds else F.lit(False)


# --- R4 ---------------------------------------------------------------------
def allowed_values(rule: Rule, schema: Source) -> Column:
    # SQL NOT IN: a NULL in the list makes the rule never fire, NULL input passes
    name = rule.require("column")
    values = list(rule.require("allowed_values"))
    c = F.col(column_ref(schema, name))
    numbers = [v for v in values if v is not None]
    if (
        isinstance(column_type(schema, name), TEXT)
        and numbers
        and all(isinstance(v, (int, float)) and not isinstance(v, bool) for v in numbers)
    ):
        # numeric list against text: compare parsed numbers (no ANSI error),
        # those beyond the whole numbers a DOUBLE holds as decimals too
        d = c.try_cast(T.DoubleType())
        missing = ~d.isin([None if v is None else float(v) for v in values])
        large = [v for v in numbers if abs(v) >= 2**53]
        if large and len(numbers) == len(values):
            other = ~reduce(lambda a, b: a | b, [_exact(c) == _decimal(v) for v in large])
            missing = missing | (d.isin([float(v) for v in large]) & other)
        return missing
    return ~c.isin(values)


# --- R5 ---------------------------------------------------------------------
def date_format(rule: Rule, schema: Source) -> Column:
    # try_to_date: malformed text is a violation, never an ANSI exception
    return F.try_to_date(F.col(column_ref(schema, rule.require("column"))), rule.require("format")).isNull()


# --- R6 ---------------------------------------------------------------------
def length_check(rule: Rule, schema: Source) -> Column:
    c = F.col(column_ref(schema, rule.require("column")))
    conds = [c.isNull()]
    if rule.get("min_length") is not None:
        conds.append(F.length(c) < F.lit(rule.get("min_length")))
    if rule.get("max_length") is not None:
        conds.append(F.length(c) > F.lit(rule.get("max_length")))
    if len(conds) == 1:
        raise RuleError(f"Rule {rule.name!r}: give min_length, max_length or both")
    return _any(conds)


# --- R7 ---------------------------------------------------------------------
def cross_column(rule: Rule, schema: Source) -> Column:
    # 'condition' is the violation itself (TRUE fails); 'expect' is the
    # expectation (FALSE fails).  NULL passes either way.
    if rule.get("condition") is not None:
        return F.expr(rule.get("condition"))
    return ~F.expr(rule.require("expect"))


# --- R8 ---------------------------------------------------------------------
def completeness_check(rule: Rule, schema: Source) -> Column:
    return _any([F.col(column_ref(schema, c)).isNull() for c in rule.require("columns")])


# --- R9 ---------------------------------------------------------------------
def epoch_seconds(c: Column, dtype: T.DataType | None, fmt: str | None = None) -> Column:
    """Whole seconds since the epoch for a temporal column.

    TIMESTAMP and ISO strings with a zone or offset are instants.
    TIMESTAMP_NTZ, DATE and other ISO strings are wall-clock values read as
    UTC, so differences do not depend on the session time zone.  Strings with an explicit ``fmt`` are parsed in the session zone.
    Unparsable strings give NULL (the difference is unknown → the row passes).
    """
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_timestamp(c)
    if isinstance(dtype, T.DateType):
        return F.unix_timestamp(c.cast(T.TimestampNTZType()))
    if isinstance(dtype, T.StringType):
        if fmt:
            return F.unix_timestamp(F.try_to_timestamp(c, F.lit(fmt)))
        # text that names a zone or offset is an instant; text without is wall-clock time
        zoned = c.rlike(r"[0-9]:[0-9]{2}.*(?:[zZ]|[+-][0-9:]+|[A-Za-z][A-Za-z_/]+)\s*$")
        instant = F.unix_timestamp(c.try_cast(T.TimestampType()))
        return F.when(zoned, instant).otherwise(F.unix_timestamp(c.try_cast(T.TimestampNTZType())))
    if isinstance(dtype, T.NumericType):
        return F.floor(c)  # already epoch seconds
    raise RuleError(f"time_difference needs timestamp, date, string or numeric columns, got {dtype}")


def time_difference(rule: Rule, schema: Source) -> Column:
    start, end = rule.require("columns")
    limit = parse_duration(rule.require("max_duration"))
    fmt = rule.get("format")
    first, last = F.col(column_ref(schema, start)), F.col(column_ref(schema, end))
    s = epoch_seconds(first, column_type(schema, start), fmt)
    e = epoch_seconds(last, column_type(schema, end), fmt)
    # signed: a negative gap passes
    return first.isNull() | last.isNull() | ((e - s) > F.lit(limit))


# --- R10 (extension) ----------------------------------------------------------
def data_type(rule: Rule, schema: Source) -> Column:
    """Non-NULL values whose text does not parse as ``expected_type``.

    Text columns are cast directly; other columns through their string
    form, so a cast Spark forbids between the types (int → date) is a
    per-row verdict instead of an analysis error."""
    name = rule.require("column")
    c = F.col(column_ref(schema, name))
    dtype = column_type(schema, name)
    textual = dtype is None or isinstance(dtype, (T.StringType, T.VarcharType, T.CharType))
    source = c if textual else c.cast(T.StringType())
    return c.isNotNull() & source.try_cast(rule.require("expected_type")).isNull()


# --- R11 (extension) ----------------------------------------------------------
def _as_date(c: Column, dtype: T.DataType | None) -> Column:
    if isinstance(dtype, T.DateType):
        return c
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(c)
    return F.try_to_date(c.cast(T.StringType()))


def date_range(rule: Rule, schema: Source) -> Column:
    name = rule.require("column")
    d = _as_date(F.col(column_ref(schema, name)), column_type(schema, name))
    conds: list[Column] = []
    if rule.get("min_date") is not None:
        conds.append(d < F.lit(parse_date_bound(rule.get("min_date"), rule.name)))
    if rule.get("max_date") is not None:
        conds.append(d > F.lit(parse_date_bound(rule.get("max_date"), rule.name)))
    return _any(conds)


# --- R12 (extension) ----------------------------------------------------------
def time_of_day(c: Column, dtype: T.DataType | None) -> Column:
    """Whole seconds since midnight."""
    if isinstance(dtype, T.StringType):
        c = F.coalesce(F.try_to_timestamp(c, F.lit("H:mm:ss")), c.try_cast(T.TimestampNTZType()))
    return F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)


def _seconds(bound: str, rule: Rule) -> Column:
    hour, minute, second = map(int, parse_time_bound(bound, rule.name).split(":"))
    return F.lit(hour * 3600 + minute * 60 + second)


def time_range(rule: Rule, schema: Source) -> Column:
    name = rule.require("column")
    tod = time_of_day(F.col(column_ref(schema, name)), column_type(schema, name))
    conds: list[Column] = []
    if rule.get("min_time") is not None:
        conds.append(tod < _seconds(rule.get("min_time"), rule))
    if rule.get("max_time") is not None:
        conds.append(tod > _seconds(rule.get("max_time"), rule))
    return _any(conds)


# --- ours ---------------------------------------------------------------------
def well_formed(rule: Rule, schema: Source) -> Column:
    """The column that holds raw lines of malformed records (``read_csv``) is empty."""
    return F.col(column_ref(schema, rule.require("column"))).isNotNull()


ROW_LOCAL = {
    "null_check": null_check,
    "regex_match": regex_match,
    "value_range": value_range,
    "allowed_values": allowed_values,
    "date_format": date_format,
    "length_check": length_check,
    "cross_column": cross_column,
    "completeness_check": completeness_check,
    "time_difference": time_difference,
    "data_type": data_type,
    "date_range": date_range,
    "time_range": time_range,
    "well_formed": well_formed,
}


def violation(rule: Rule, schema: Source) -> Column:
    """Violation predicate of a row-local rule."""
    try:
        builder = ROW_LOCAL[rule.type]
    except KeyError:
        raise RuleError(f"{rule.type} is not a row-local rule") from None
    return builder(rule, schema)
