"""Read a DataFrame's plans: used by tests and the benchmark to check that
the plans this library builds stay the intended shape."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def optimized(df: DataFrame) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def physical(df: DataFrame) -> str:
    """Physical plan text, including subqueries (before AQE re-planning)."""
    return df._jdf.queryExecution().executedPlan().toString()


def final_physical(df: DataFrame) -> str:
    """Physical plan after running the query (AQE's final plan).  Runs the
    DataFrame's own query execution; rows stay on the executors."""
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    return qe.executedPlan().toString()


def case_nodes(df: DataFrame) -> int:
    """CASE expressions in the optimized plan (grows with rule count)."""
    return optimized(df).count("CASE WHEN")


def single_partition_exchanges(plan_text: str) -> list[str]:
    """Child operator under every ``Exchange SinglePartition``."""
    lines = plan_text.splitlines()
    out = []
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line and i + 1 < len(lines):
            out.append(lines[i + 1].strip(" :+-*()0123456789"))
    return out


def gathers_raw_rows(plan_text: str) -> bool:
    """True when some SinglePartition exchange moves rows rather than one
    partial-aggregate row per task (the reference's global window did)."""
    return any(not re.match(r"HashAggregate\(keys=\[\], functions=\[partial_", child)
               for child in single_partition_exchanges(plan_text))


def joins(plan_text: str) -> list[str]:
    return re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)", plan_text)
