"""X1 (extension): data-quality rules on Structured Streaming.

* ``flag_stream`` — row-local rules are plain expressions, so a streaming
  DataFrame gets its ``failed_rules`` column with no state at all.
* ``route_stream`` — every micro-batch is validated with the full rule set
  and its rows are written in one pass, good and rejected ones to
  ``<path>/batch_id=<n>/dq_status=passed|rejected``.  A replayed batch
  overwrites its own folder, so with the query checkpoint the sink is
  exactly-once per batch.  Duplicates and z-scores are judged within the
  batch or, with ``state_path``, together with all batches before it: keys and
  moments are kept per batch id (``rowsieve.operators.state``), so a batch
  that is replayed after a restart finds what it found the first time.  Keys
  by which rows of earlier batches have come to fail are written to
  ``<path>/repeated/rule=<name>/batch_id=<n>``; with them, what the stream
  rejects is what a batch run over all rows rejects.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from rowsieve.operators.state import KeptState
from rowsieve.operators.validate import flag_rows, validate
from rowsieve.plans.joins import DEFAULT, JoinPolicy
from rowsieve.rules import RuleError, RuleSet, load_rules


def flag_stream(stream: DataFrame, rules: Any, verdict_col: str = "failed_rules") -> DataFrame:
    """Streaming ``df`` plus ``failed_rules`` (row-local rules only)."""
    return flag_rows(stream, rules, verdict_col)


def route_stream(
    stream: DataFrame,
    rules: Any,
    *,
    path: str,
    checkpoint_location: str,
    refs: Mapping[str, DataFrame] | None = None,
    policy: JoinPolicy = DEFAULT,
    trigger: Mapping[str, Any] | None = None,
    state_path: str | None = None,
    time_column: str | None = None,
    retention: str | None = None,
) -> StreamingQuery:
    """Start a query that validates each micro-batch and writes its rows, with
    ``failed_rules``, as Parquet: one partitioned write per batch.  State is
    kept below ``state_path``, keys for ``retention`` on ``time_column``."""
    rule_set: RuleSet = rules if isinstance(rules, RuleSet) else load_rules(rules)
    out = path.rstrip("/")
    if state_path is None and (time_column or retention):
        raise RuleError("a retention needs a state_path")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        if state_path is None:
            result = validate(batch, rule_set, refs=refs, policy=policy)
            result.write_split(f"{out}/batch_id={batch_id}", mode="overwrite")
        else:
            state = KeptState(batch.sparkSession, state_path, rule_set, time_column=time_column, retention=retention)
            result = state.validate(batch, batch_id, refs=refs, policy=policy)
            result.write_split(f"{out}/batch_id={batch_id}", mode="overwrite")
            for rule in rule_set.of_type("unique_check"):
                repeated = state.repeated_since(rule.key_columns, batch_id)
                repeated.write.mode("overwrite").parquet(f"{out}/repeated/rule={rule.name}/batch_id={batch_id}")
            state.record(result, batch_id)
        result.unpersist()

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    return writer.start()
