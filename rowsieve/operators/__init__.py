"""Spark operators: rule application, dataset-level checks, stats, report data."""

from rowsieve.operators.outliers import outliers, zscore_predicate
from rowsieve.operators.referential import orphans
from rowsieve.operators.report import (
    metric_cards,
    record_distribution,
    rejected_sample,
    violations_ranking,
    worst_rules,
)
from rowsieve.operators.segments import segment_summary, segment_violations
from rowsieve.operators.stats import (
    exploded,
    failed_rules_summary,
    quality_stats,
    summary,
    violations,
)
from rowsieve.operators.uniqueness import duplicates
from rowsieve.operators.validate import ValidationResult, flag_rows, validate

__all__ = [
    "ValidationResult",
    "duplicates",
    "exploded",
    "failed_rules_summary",
    "flag_rows",
    "metric_cards",
    "orphans",
    "outliers",
    "quality_stats",
    "record_distribution",
    "rejected_sample",
    "segment_summary",
    "segment_violations",
    "summary",
    "validate",
    "violations",
    "violations_ranking",
    "worst_rules",
    "zscore_predicate",
]
