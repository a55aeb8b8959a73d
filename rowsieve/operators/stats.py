"""Per-rule violation counts, quality summary, failed-row facts.

``violations`` and ``summary`` both read the single aggregate
``ValidationResult.counts`` (one partial + final aggregate over the flags),
so every rule's count costs the same one job.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsieve.operators.validate import ValidationResult, qcol


def violations(result: ValidationResult) -> DataFrame:
    """One row per rule (priority order), zeros included:
    ``rule, rule_type, priority, entity, description, failed_count``."""
    counts = result.counts
    if not len(result.rules):
        schema = "rule string, rule_type string, priority int, entity string, description string, failed_count bigint"
        return counts.sparkSession.createDataFrame([], schema)
    rows = [
        F.struct(
            F.lit(r.name).alias("rule"),
            F.lit(r.type).alias("rule_type"),
            F.lit(r.priority).alias("priority"),
            F.lit(r.entity).cast(T.StringType()).alias("entity"),
            F.lit(r.description).cast(T.StringType()).alias("description"),
            F.col(f"c{i}").alias("failed_count"),
        )
        for i, r in enumerate(result.rules)
    ]
    return counts.select(F.inline(F.array(*rows)))


def summary(result: ValidationResult) -> DataFrame:
    """One row ``total_records, passed_records, rejected_records,
    quality_pct`` (0 when the input is empty)."""
    total, rejected = F.col("total"), F.col("rejected")
    return result.counts.select(
        total.alias("total_records"),
        (total - rejected).alias("passed_records"),
        rejected.alias("rejected_records"),
        F.when(total > 0, (total - rejected) / total * F.lit(100.0))
        .otherwise(F.lit(0.0))
        .alias("quality_pct"),
    )


def quality_stats(result: ValidationResult) -> dict[str, Any]:
    """A7 as a dict, from one job over the one-row aggregate."""
    row = result.counts.first()
    total, rejected = int(row["total"]), int(row["rejected"])
    return {
        "total_records": total,
        "passed_records": total - rejected,
        "rejected_records": rejected,
        "quality_percentage": ((total - rejected) / total * 100) if total > 0 else 0,
        "rule_violations": {
            r.name: {"failed_count": int(row[f"c{i}"])} for i, r in enumerate(result.rules)
        },
    }


def failed_rules_summary(result: ValidationResult, keys: Sequence[str]) -> DataFrame:
    """Key columns and ``failed_rules`` of the rejected rows."""
    return result.bad.select(*[qcol(k) for k in keys], F.col(result.verdict_col))


def exploded(result: ValidationResult, keys: Sequence[str]) -> DataFrame:
    """One row per (key, violated rule) — the long form of A8.  Arrays of
    rejected rows are never empty; ``explode`` would make Catalyst add a
    ``size > 0`` filter that evaluates the whole verdict again."""
    return result.bad.select(
        *[qcol(k) for k in keys], F.explode_outer(F.col(result.verdict_col)).alias("rule")
    )


def rule_counts_from_verdicts(flagged: DataFrame, verdict_col: str = "failed_rules") -> DataFrame:
    """Per-rule counts recomputed from the verdict arrays (an invariant check:
    must equal ``violations``; zero-count rules are absent here)."""
    return (
        flagged.select(F.explode(F.col(verdict_col)).alias("rule"))
        .groupBy("rule")
        .agg(F.count(F.lit(1)).alias("failed_count"))
    )
