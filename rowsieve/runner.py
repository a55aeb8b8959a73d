"""An engine-style wrapper with the familiar workflow: construct over a
DataFrame, ``apply_rules`` → ``(good, bad)``, then stats, summary, sinks and
a report.  Everything delegates to ``validate`` and stays lazy and
distributed; only the bounded report aggregates reach the driver."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame

from rowsieve.operators.validate import ValidationResult, validate
from rowsieve.plans.joins import DEFAULT, JoinPolicy
from rowsieve.rules import RuleError, load_rules, parse_duration


class RuleRunner:
    def __init__(
        self,
        df: DataFrame,
        *,
        refs: Mapping[str, DataFrame] | None = None,
        keys: Sequence[str] = ("order_id",),
        policy: JoinPolicy = DEFAULT,
    ) -> None:
        self.df = df
        self.spark = df.sparkSession
        self.refs = refs
        self.keys = list(keys)
        self.policy = policy
        self.result: ValidationResult | None = None

    parse_duration = staticmethod(parse_duration)

    @staticmethod
    def load_rules(rules_path: Any) -> list[dict[str, Any]]:
        """Validated rules as dicts, ordered by priority."""
        return [r.to_dict() for r in load_rules(rules_path)]

    def apply_rules(self, rules: Any) -> tuple[DataFrame, DataFrame]:
        if self.result is not None:
            self.result.unpersist()
        self.result = validate(self.df, rules, refs=self.refs, policy=self.policy)
        return self.result.good, self.result.bad

    def _validated(self) -> ValidationResult:
        if self.result is None:
            raise ValueError("no rules applied yet: call apply_rules() first")
        return self.result

    @property
    def good_df(self) -> DataFrame:
        return self._validated().good

    @property
    def bad_df(self) -> DataFrame:
        return self._validated().bad

    def save_rejected(self, base_path: str, mode: str = "errorifexists") -> str:
        return self._validated().save_rejected(base_path, mode=mode)

    def get_quality_stats(self) -> dict[str, Any]:
        return self._validated().quality_stats()

    def _keys(self, keys: Sequence[str] | None, required: bool) -> list[str]:
        chosen = list(keys) if keys else self.keys
        missing = [k for k in chosen if k not in self.df.columns]
        if missing and required:
            raise RuleError(f"key column(s) {missing} not in the input {self.df.columns}")
        return [] if missing else chosen

    def get_failed_rules_summary(self, keys: Sequence[str] | None = None) -> DataFrame:
        return self._validated().failed_rules_summary(self._keys(keys, required=True))

    def generate_report(self, output_path: str, title: str = "Data Quality Report", keys: Sequence[str] | None = None) -> str:
        """HTML report; the rejected-row sample needs key columns and is left
        out when the input lacks them."""
        from rowsieve.operators.report import write_html_report

        return write_html_report(self._validated(), output_path, keys=self._keys(keys, required=False), title=title)

    def generate_report_data(self) -> dict[str, Any]:
        from rowsieve.operators.report import report_data

        return report_data(self._validated(), self._keys(None, required=False))
