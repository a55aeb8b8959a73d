"""Validation of a new partition against what earlier ones left.

A table that grows by batches need not be read whole for every batch: what
its rules need to know of the rows before is kept as small tables in a shared
folder, one partition per batch, so they merge by plain sums:

* ``keys/<rule>``  — per ``unique_check`` the batch's distinct keys (long text
  as digests) with row counts and, with a time column, the latest time;
* ``moments``      — per z-score column count, mean and squared deviations;
* ``counts``       — per rule the failed rows, and the batch's totals.

A batch id owns its partition: validating it again overwrites what it wrote
and compares with all *other* batches, so a replay changes nothing, whatever
came in between.  After any number of batches, in any order, the merged state
equals that of one run over all rows.

A row of a new batch fails ``unique_check`` if its key occurs twice in the
batch, or once and in a kept batch.  Rows of kept batches are not rewritten;
``repeated_since`` names the keys by which they have come to fail.  z-scores
are taken over kept batches and the new one together.  ``retention`` with
``time_column`` is a watermark: keys last seen longer than that before the
latest time of any batch no longer count, and ``compact`` drops them.

Only rules' own columns are read, only sums reach the driver, and the keys of
a batch are compared with kept keys by an aggregate, not by a lookup per row.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsieve.functions.columns import column_ref
from rowsieve.operators.outliers import numeric_value
from rowsieve.operators.uniqueness import key_value
from rowsieve.operators.validate import ValidationResult, build_flags
from rowsieve.plans.joins import DEFAULT, Helpers, JoinPolicy
from rowsieve.rules import Rule, RuleError, RuleSet, load_rules, parse_duration

_BATCH = re.compile(r"[A-Za-z0-9_.-]+")


class KeptState:
    """State tables below ``path`` for one rule set.  ``retention`` is a
    duration such as ``"30 DAYS"`` on ``time_column``."""

    def __init__(self, spark: SparkSession, path: str, rules: Any, *, time_column: str | None = None, retention: str | None = None) -> None:
        if (time_column is None) != (retention is None):
            raise RuleError("a retention needs a time column, and a time column a retention")
        self.spark, self.path = spark, path.rstrip("/")
        self.rules: RuleSet = rules if isinstance(rules, RuleSet) else load_rules(rules)
        self.time_column = time_column
        self.retention = None if retention is None else parse_duration(retention)
        ordered = [r.name for r in self.rules if r.type in ("sequence_check", "order_dependency", "functional_dependency") or r.get("statistic") == "mad"]
        if ordered:
            raise RuleError(f"rules {ordered} need all rows at once; no state is kept for them")

    # -- kept tables -------------------------------------------------------
    def _read(self, table: str) -> DataFrame | None:
        try:
            return self.spark.read.option("basePath", f"{self.path}/{table}").parquet(f"{self.path}/{table}/batch=*")
        except AnalysisException:  # nothing kept yet
            return None

    def _write(self, df: DataFrame, table: str, batch: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.path}/{table}/batch={batch}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{table}/batch={batch}")

    def _others(self, table: str, batch: str) -> DataFrame | None:
        kept = self._read(table)
        return None if kept is None else kept.where(F.col("batch").cast("string") != batch).drop("batch")

    @staticmethod
    def _table(keys: Sequence[str]) -> str:
        return "keys/" + hashlib.sha256("\0".join(keys).encode()).hexdigest()[:16]

    @staticmethod
    def _names(keys: Sequence[str]) -> list[str]:
        return [f"k{i}" for i in range(len(keys))]

    # -- what a batch leaves ------------------------------------------------
    def _keys_of(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        names = self._names(keys)
        seen = F.lit(None).cast("timestamp") if self.time_column is None else F.col(column_ref(df, self.time_column)).cast("timestamp")
        rows = df.select(*[key_value(df, k).alias(n) for k, n in zip(keys, names)], seen.alias("seen"))
        known = reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])
        return rows.where(known).groupBy(*names).agg(F.count(F.lit(1)).alias("n"), F.max("seen").alias("seen"))

    @staticmethod
    def _moments_of(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
        columns = sorted({r.require("column") for r in rules})
        values = {c: numeric_value(df, c).cast("double") for c in columns}
        one = df.agg(*[f(values[c]).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("n", F.count), ("mean", F.avg), ("var", F.var_pop))])
        rows = [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("n"), F.col(f"mean{i}").alias("mean"), (F.col(f"var{i}") * F.col(f"n{i}")).alias("m2")) for i, c in enumerate(columns)]
        return one.select(F.inline(F.array(*rows)))

    # -- merged state --------------------------------------------------------
    def _alive(self, keys: DataFrame) -> DataFrame:
        """Keys inside the retention, measured from the latest time kept."""
        if self.retention is None:
            return keys
        latest = keys.select(F.max("seen")).first()[0]
        if latest is None:
            return keys
        oldest = F.lit(latest) - F.make_dt_interval(secs=F.lit(str(self.retention)).cast("decimal(18,6)"))
        return keys.where(F.col("seen").isNull() | (F.col("seen") >= oldest))

    def key_counts(self, keys: Sequence[str]) -> DataFrame:
        """Kept keys of a ``unique_check`` (``k0``, ...; long text as digests) with their rows."""
        kept = self._read(self._table(keys))
        if kept is None:
            raise RuleError(f"no batch with keys {list(keys)} has been validated")
        return self._alive(kept).groupBy(*self._names(keys)).agg(F.sum("n").alias("n"))

    def moments(self) -> dict[str, dict[str, float]]:
        """Count, mean and sample deviation per z-score column over all kept batches."""
        kept = self._read("moments")
        return {} if kept is None else {c: {"n": n, "mean": mean, "sd": sd} for c, (n, mean, sd) in self._merged(kept).items()}

    @staticmethod
    def _merged(parts: DataFrame) -> dict[str, tuple[int, float | None, float | None]]:
        """Merged moments: squared deviations about the common mean."""
        total = parts.groupBy("column").agg(F.sum("n").alias("total"), F.try_divide(F.sum(F.col("n") * F.col("mean")), F.sum("n")).alias("m"))
        about = F.col("m2") + F.col("n") * (F.col("mean") - F.col("m")) ** 2
        rows = parts.join(F.broadcast(total), "column").groupBy("column", "total", "m").agg(F.sum(about).alias("d")).collect()
        return {r["column"]: (r["total"], r["m"], (r["d"] / (r["total"] - 1)) ** 0.5 if r["total"] > 1 and r["d"] is not None else None) for r in rows}

    def counts(self) -> DataFrame:
        """A6 over all kept batches: ``rule, failed_count, total_records``."""
        kept = self._read("counts")
        if kept is None:
            raise RuleError("no batch has been recorded")
        return kept.groupBy("rule").agg(F.sum("failed").alias("failed_count"), F.sum("total").alias("total_records"))

    def batches(self) -> list[str]:
        kept = self._read("counts")
        return [] if kept is None else sorted(str(r["batch"]) for r in kept.select("batch").distinct().collect())

    # -- validation ------------------------------------------------------------
    def validate(
        self, df: DataFrame, batch: str | int, *, refs: Mapping[str, DataFrame] | None = None, policy: JoinPolicy = DEFAULT, verdict_col: str = "failed_rules"
    ) -> ValidationResult:
        """The batch's verdicts, judged with all other kept batches; its keys
        and moments are kept, replacing those of an earlier try."""
        batch = str(batch)
        if not _BATCH.fullmatch(batch):
            raise RuleError(f"a batch id has letters, digits, '_', '.' and '-', not {batch!r}")
        if not policy.probe:
            raise RuleError("kept state needs a policy that measures its helper sets")
        helpers = Helpers()
        flags, names = build_flags(df, self.rules, refs, policy, helpers, _Batch(self, df, batch))
        return ValidationResult(df, self.rules, flags, names, verdict_col, helpers)

    def record(self, result: ValidationResult, batch: str | int) -> None:
        """Keep the batch's counts: from a one-pass write if one ran, else one job."""
        stats = result.quality_stats()
        rows = [(name, v["failed_count"], stats["total_records"]) for name, v in stats["rule_violations"].items()]
        rows.append((None, stats["rejected_records"], stats["total_records"]))
        self._write(self.spark.createDataFrame(rows, "rule string, failed long, total long").coalesce(1), "counts", str(batch))

    def repeated_since(self, keys: Sequence[str], batch: str | int) -> DataFrame:
        """Keys of this batch that other kept batches hold as well: the rows
        there fail too, though they were written before."""
        names, table = self._names(keys), self._table(keys)
        kept = self._read(table)
        if kept is None:
            raise RuleError(f"no batch with keys {list(keys)} has been validated")
        own = F.col("batch").cast("string") == str(batch)
        both = self._alive(kept).groupBy(*names).agg(F.bool_or(own).alias("own"), F.bool_or(~own).alias("other"))
        return both.where("own AND other").select(*names)

    def compact(self, into: str, batches: Sequence[str | int]) -> None:
        """Merge the kept partitions of ``batches`` into one named ``into``:
        fewer files, and keys past the retention are gone.  These batches can
        no longer be replayed, and count twice until their partitions are
        dropped: ``drop`` does that, and is safe to run again."""
        old = [str(b) for b in batches]
        for table in [*{self._table(r.key_columns): 0 for r in self.rules if r.type == "unique_check"}, "moments", "counts"]:
            kept = self._read(table)
            if kept is None:
                continue
            alive = self._alive(kept) if table.startswith("keys/") else kept
            some = alive.where(F.col("batch").cast("string").isin(old)).drop("batch")
            if table.startswith("keys/"):
                names = [c for c in some.columns if c not in ("n", "seen")]
                some = some.groupBy(*names).agg(F.sum("n").alias("n"), F.max("seen").alias("seen"))
            elif table == "counts":
                some = some.groupBy("rule").agg(F.sum("failed").alias("failed"), F.sum("total").alias("total"))
            self._write(some, table, into)


    def drop(self, batches: Sequence[str | int]) -> None:
        """Forget batches: their partitions become empty."""
        for table in [*{self._table(r.key_columns): 0 for r in self.rules if r.type == "unique_check"}, "moments", "counts"]:
            kept = self._read(table)
            for batch in batches if kept is not None else ():
                if not kept.where(F.col("batch").cast("string") == str(batch)).isEmpty():
                    self._write(kept.drop("batch").limit(0), table, str(batch))


class _Batch:
    """What ``build_flags`` asks of kept state for one batch."""

    def __init__(self, state: KeptState, df: DataFrame, batch: str) -> None:
        self.state, self.batch = state, batch
        scored = state.rules.of_type("statistical")
        self.merged: dict = {}
        if scored:
            own = state._write(state._moments_of(df, scored).coalesce(1), "moments", batch)
            others = state._others("moments", batch)
            self.merged = state._merged(own if others is None else own.unionByName(others))

    def duplicate_keys(self, df: DataFrame, keys: Sequence[str], aliases: Sequence[str]) -> DataFrame:
        """The batch's keys that occur twice over all kept batches, with their rows in the batch."""
        state, names = self.state, self.state._names(keys)
        own = state._write(state._keys_of(df, keys), state._table(keys), self.batch)
        every = own.select(*names, "n", "seen", F.col("n").alias("own"))
        others = state._others(state._table(keys), self.batch)
        if others is not None:
            every = every.unionByName(others.select(*names, "n", "seen", F.lit(0).cast("long").alias("own")))
        # the watermark is that of all batches, this one included
        found = state._alive(every).groupBy(*names).agg(F.sum("n").alias("n"), F.sum("own").alias("__rs_n"))
        return found.where("n > 1 AND __rs_n > 0").select(*[F.col(n).alias(a) for n, a in zip(names, aliases)], "__rs_n")

    def zscore(self, df: DataFrame, column: str, threshold: float) -> Column:
        _, mean, sd = self.merged.get(column, (0, None, None))
        away = numeric_value(df, column).cast("double") - F.lit(mean).cast("double")
        return F.abs(F.try_divide(away, F.lit(sd).cast("double"))) > F.lit(float(threshold))
