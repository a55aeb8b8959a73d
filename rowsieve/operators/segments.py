"""A6 and A7 per segment: counts of every rule by columns, with subtotals.

One aggregate over the flags: the grouping sets become one ``Expand`` over the
segment columns and the booleans, aggregated partially before the shuffle, so
any number of rules and levels costs one job over the input, and what is
shuffled is one row per segment and task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsieve.operators.validate import HELPER_PREFIX, ValidationResult, any_flag, qcol

#: What a grouping row counts; segment columns may not have these names.
COUNTS = ("level", "total_records", "passed_records", "rejected_records", "quality_pct")


def _grouped(result: ValidationResult, by: Mapping[str, Column | str] | Sequence[str], sets: str | Sequence[Sequence[str]]) -> tuple[DataFrame, list[str]]:
    """One row per segment: its columns, ``level``, ``total``, ``rejected``, ``c<i>`` per rule."""
    named = dict(by) if isinstance(by, Mapping) else {c: c for c in by}
    clash = [n for n in named if n in COUNTS or n.startswith(HELPER_PREFIX)]
    if not named or clash:
        raise ValueError(f"segments need columns of other names than {COUNTS}; got {list(named)}")
    values = [(qcol(c) if isinstance(c, str) else c).alias(n) for n, c in named.items()]
    rows = result.flags.select(*values, *[qcol(f) for f in result.flag_names])
    columns = [qcol(n) for n in named]
    if sets == "rollup":
        grouped = rows.rollup(*columns)
    elif sets == "cube":
        grouped = rows.cube(*columns)
    elif isinstance(sets, str):
        raise ValueError(f"grouping sets are 'rollup', 'cube' or lists of names, not {sets!r}")
    else:
        unknown = [n for s in sets for n in s if n not in named]
        if unknown:
            raise ValueError(f"grouping sets name unknown segments {unknown}")
        grouped = rows.groupingSets([[qcol(n) for n in s] for s in sets], *columns)
    counted = grouped.agg(
        F.grouping_id().cast("long").alias("level"),
        F.count(F.lit(1)).alias("total"),
        F.count_if(any_flag(result.flag_names)).alias("rejected"),
        *[F.count_if(F.col(f)).alias(f"c{i}") for i, f in enumerate(result.flag_names)],
    )
    return counted, list(named)


def segment_summary(result: ValidationResult, by: Mapping[str, Column | str] | Sequence[str], sets: str | Sequence[Sequence[str]] = "rollup") -> DataFrame:
    """A7 per segment: the segment columns (NULL where summed over), ``level``
    (bit i from the right: the i-th segment column from the right is summed
    over; 0 is the finest), total, passed and rejected records, quality_pct.

    ``by`` names columns of the input or maps names to expressions; ``sets``
    is ``rollup`` (each prefix of the columns), ``cube`` (each subset) or the
    wanted lists of names.  NULL is a segment value like any other; ``level``
    tells it from a subtotal.  An empty input has no segments, no grand total either."""
    counted, names = _grouped(result, by, sets)
    total, rejected = F.col("total"), F.col("rejected")
    pct = (total - rejected) / total * F.lit(100.0)  # a segment has a row at least
    return counted.select(
        *[qcol(n) for n in names],
        "level",
        total.alias("total_records"),
        (total - rejected).alias("passed_records"),
        rejected.alias("rejected_records"),
        pct.alias("quality_pct"),
    )


def segment_violations(result: ValidationResult, by: Mapping[str, Column | str] | Sequence[str], sets: str | Sequence[Sequence[str]] = "rollup") -> DataFrame:
    """A6 per segment: a row per segment and rule, zeros included: segment
    columns, ``level``, ``rule``, ``rule_type``, ``priority``, ``entity``,
    ``failed_count``, ``total_records``."""
    counted, names = _grouped(result, by, sets)
    if not len(result.rules):
        return counted.limit(0).select(
            *[qcol(n) for n in names], "level", *[F.lit(None).cast(t).alias(c) for c, t in (("rule", "string"), ("rule_type", "string"), ("priority", "int"), ("entity", "string"), ("failed_count", "long"))], F.col("total").alias("total_records")
        )
    rows = [
        F.struct(
            F.lit(r.name).alias("rule"),
            F.lit(r.type).alias("rule_type"),
            F.lit(r.priority).alias("priority"),
            F.lit(r.entity).cast(T.StringType()).alias("entity"),
            F.col(f"c{i}").alias("failed_count"),
        )
        for i, r in enumerate(result.rules)
    ]
    long = counted.select(*[qcol(n) for n in names], "level", F.col("total").alias("total_records"), F.inline(F.array(*rows)))
    return long.select(*[qcol(n) for n in names], "level", "rule", "rule_type", "priority", "entity", "failed_count", "total_records")
