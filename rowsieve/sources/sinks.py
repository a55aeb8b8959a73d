"""K1 / K2: write rejected (and good) rows.  Tasks write their own part
files; nothing passes through the driver."""

from __future__ import annotations

import datetime as _dt
from typing import TYPE_CHECKING

from typing import Any

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

if TYPE_CHECKING:
    from rowsieve.operators.validate import ValidationResult


def timestamped_path(base_path: str, prefix: str = "rejected") -> str:
    stamp = _dt.datetime.now().strftime("%Y%m%d_%H%M%S_%f")
    return f"{base_path.rstrip('/')}/{prefix}_{stamp}"


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists", partition_by=None) -> str:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def save_rejected(result: ValidationResult, base_path: str, mode: str = "errorifexists") -> str:
    """K1: rejected rows with ``failed_rules`` to
    ``{base}/rejected_{yyyyMMdd_HHmmss_micro}``; returns the path."""
    return write_parquet(result.bad, timestamped_path(base_path, "rejected"), mode)


def save_good(result: ValidationResult, path: str, mode: str = "errorifexists") -> str:
    """K2: the good rows (input columns only)."""
    return write_parquet(result.good, path, mode)


def _observed(result: ValidationResult, name: str) -> tuple[DataFrame, Observation]:
    """The flags frame with every count of ``counts`` observed in flight."""
    from rowsieve.operators.validate import any_flag

    obs = Observation(name)
    observed = result.flags.observe(
        obs,
        F.count(F.lit(1)).alias("total"),
        F.count_if(any_flag(result.flag_names)).alias("rejected"),
        *[F.count_if(F.col(f)).alias(f"c{i}") for i, f in enumerate(result.flag_names)],
    )
    return observed, obs


def _stats(result: ValidationResult, metrics: dict[str, Any]) -> dict[str, Any]:
    total, rejected = int(metrics["total"]), int(metrics["rejected"])
    return {
        "total_records": total,
        "passed_records": total - rejected,
        "rejected_records": rejected,
        "quality_percentage": ((total - rejected) / total * 100) if total > 0 else 0,
        "rule_violations": {
            r.name: {"failed_count": int(metrics[f"c{i}"])} for i, r in enumerate(result.rules)
        },
    }


def save_rejected_with_stats(
    result: ValidationResult, base_path: str, mode: str = "errorifexists"
) -> tuple[str, dict[str, Any]]:
    """K1 plus A6/A7 in ONE pass: the counts are observed while the rejected
    rows are written (``DataFrame.observe``), instead of a second scan."""
    from rowsieve.operators.validate import any_flag, qcol, verdict_expr

    observed, obs = _observed(result, "rowsieve_rejected")
    bad = observed.where(any_flag(result.flag_names)).select(
        *[qcol(c) for c in result.columns],
        verdict_expr(result.rules.names, result.flag_names).alias(result.verdict_col),
    )
    path = write_parquet(bad, timestamped_path(base_path, "rejected"), mode)
    return path, _stats(result, obs.get)


def write_split(
    result: ValidationResult, path: str, mode: str = "errorifexists", status_col: str = "dq_status"
) -> tuple[str, dict[str, Any]]:
    """Good AND rejected rows in one partitioned write
    (``<path>/dq_status=passed|rejected``), with all counts observed in the
    same job: one scan of the input for the whole split and its stats."""
    from rowsieve.operators.validate import any_flag, qcol, verdict_expr

    observed, obs = _observed(result, "rowsieve_split")
    out = observed.select(
        *[qcol(c) for c in result.columns],
        verdict_expr(result.rules.names, result.flag_names).alias(result.verdict_col),
        F.when(any_flag(result.flag_names), F.lit("rejected")).otherwise(F.lit("passed")).alias(status_col),
    )
    write_parquet(out, path, mode, partition_by=[status_col])
    return path, _stats(result, obs.get)
