"""Rule model: JSON / dict rules → validated, priority-ordered ``RuleSet``.

A rule is a flat mapping with ``name``, ``type`` and ``priority`` plus the
fields its type needs.  Everything here runs on the driver and touches no
data; it only decides which Spark expressions and joins ``validate`` builds.
"""

from __future__ import annotations

import datetime as _dt
import json
import math
import os
import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from typing import Any

# ---------------------------------------------------------------------------
# The rule vocabulary, the fields a rule may carry, and the
# duration units.  These must stay equal to the accepted rule format.
# ---------------------------------------------------------------------------
RULE_TYPES = (
    "null_check",
    "regex_match",
    "value_range",
    "allowed_values",
    "data_type",
    "unique_check",
    "date_format",
    "date_range",
    "cross_column",
    "referential_integrity",
    "length_check",
    "statistical",
    "time_difference",
    "completeness_check",
    "time_range",
    # ours
    "well_formed",
    "sequence_check",
    "order_dependency",
    "functional_dependency",
    "interval_reference",
)

DURATION_UNITS = {"SECONDS": 1, "MINUTES": 60, "HOURS": 3600, "DAYS": 86400}

# field name -> accepted python types (bool is refused separately for numbers)
_NUM = (int, float)
FIELD_TYPES: dict[str, tuple[type, ...]] = {
    "name": (str,),
    "type": (str,),
    "priority": (int,),
    "column": (str, type(None)),
    "columns": (list, tuple),
    "pattern": (str,),
    "min": _NUM,
    "max": _NUM,
    "allowed_values": (list, tuple),
    "expected_type": (str,),
    "reference_table": (str,),
    "reference_column": (str,),
    "condition": (str,),
    "statistic": (str,),
    "threshold": _NUM,
    "min_length": (int,),
    "max_length": (int,),
    "format": (str,),
    "min_date": (str,),
    "max_date": (str,),
    "max_duration": (str,),
    "entity": (str,),
    "description": (str,),
    # extensions of ours
    "expect": (str,),  # cross_column: the expectation; violation = NOT expect
    "min_time": (str,),  # time_range bounds, HH:mm:ss
    "max_time": (str,),
    "key_columns": (list, tuple),  # keys of sequence_check, the two dependencies, interval_reference
    "order_column": (str,),
    "min_step": _NUM,
    "max_step": _NUM,
    "reference_key_columns": (list, tuple),
    "from_column": (str,),
    "to_column": (str,),
}

# Rule types evaluated as plain row-local Column expressions.
ROW_LOCAL_TYPES = frozenset(
    {
        "null_check",
        "regex_match",
        "value_range",
        "allowed_values",
        "date_format",
        "length_check",
        "cross_column",
        "completeness_check",
        "time_difference",
        "data_type",
        "date_range",
        "time_range",
        "well_formed",
    }
)
# Rule types that need a dataset-wide aggregate or a join.
DATASET_TYPES = frozenset(
    {
        "unique_check",
        "referential_integrity",
        "statistical",
        "sequence_check",
        "order_dependency",
        "functional_dependency",
        "interval_reference",
    }
)


class RuleError(ValueError):
    """A rule set that cannot be compiled into a plan."""


class MissingParameterError(RuleError, KeyError):
    """A rule lacks a field its type needs."""

    def __str__(self) -> str:  # KeyError would quote the message
        return str(self.args[0])


_TIME_OF_DAY = re.compile(r"^(\d{1,2}):(\d{2})(?::(\d{2}))?$")


def parse_date_bound(text: str, rule_name: str = "") -> _dt.date:
    """``yyyy-MM-dd`` bound of a date_range rule."""
    try:
        return _dt.date.fromisoformat(text)
    except (TypeError, ValueError) as exc:
        raise RuleError(f"Rule {rule_name!r}: date bound {text!r} is not yyyy-MM-dd") from exc


def parse_time_bound(text: str, rule_name: str = "") -> str:
    """``H:mm[:ss]`` bound of a time_range rule → zero-padded ``HH:mm:ss``."""
    m = _TIME_OF_DAY.match(text if isinstance(text, str) else "")
    if not m:
        raise RuleError(f"Rule {rule_name!r}: time bound {text!r} is not HH:mm:ss")
    h, mi, s = int(m.group(1)), int(m.group(2)), int(m.group(3) or 0)
    if h > 23 or mi > 59 or s > 59:
        raise RuleError(f"Rule {rule_name!r}: time bound {text!r} is out of range")
    return f"{h:02d}:{mi:02d}:{s:02d}"


_DURATION = re.compile(r"\s*(?P<amount>(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d{1,3})?)\s+(?P<unit>[A-Za-z]+)\s*")


def parse_duration(text: str) -> float:
    """Seconds of a duration such as ``"72 HOURS"``: a plain non-negative
    amount, white space, and one of the units in any case."""
    match = _DURATION.fullmatch(text) if isinstance(text, str) else None
    scale = DURATION_UNITS.get(match["unit"].upper()) if match else None
    seconds = float(match["amount"]) * scale if scale else math.inf
    if math.isinf(seconds):
        raise RuleError(f"{text!r} is no duration; write an amount and one of {', '.join(DURATION_UNITS)}, like '30 DAYS'")
    return seconds


@dataclass(frozen=True)
class Rule:
    """One validated rule.  ``params`` holds the type-specific fields."""

    name: str
    type: str
    priority: int
    params: Mapping[str, Any] = field(default_factory=dict)
    entity: str | None = None
    description: str | None = None

    def get(self, key: str, default: Any = None) -> Any:
        return self.params.get(key, default)

    def require(self, key: str) -> Any:
        if self.params.get(key) is None:
            raise MissingParameterError(
                f"Rule {self.name!r} ({self.type}) needs the field '{key}'"
            )
        return self.params[key]

    @property
    def is_row_local(self) -> bool:
        return self.type in ROW_LOCAL_TYPES

    @property
    def key_columns(self) -> tuple[str, ...]:
        """Columns a unique_check groups by (single or composite key)."""
        if "columns" in self.params:
            return tuple(self.params["columns"])
        return (self.require("column"),)

    def to_dict(self) -> dict[str, Any]:
        out: dict[str, Any] = {"name": self.name, "type": self.type, "priority": self.priority}
        out.update(self.params)
        if self.entity is not None:
            out["entity"] = self.entity
        if self.description is not None:
            out["description"] = self.description
        return out


def _check_field(rule_name: str, key: str, value: Any) -> None:
    if key not in FIELD_TYPES:
        raise RuleError(f"Rule {rule_name!r}: unknown field {key!r}")
    accepted = FIELD_TYPES[key]
    if isinstance(value, bool) and bool not in accepted:
        raise RuleError(f"Rule {rule_name!r}: field {key!r} must not be a boolean")
    if not isinstance(value, accepted):
        names = "/".join(t.__name__ for t in accepted)
        raise RuleError(f"Rule {rule_name!r}: field {key!r} must be {names}, got {value!r}")
    if key in ("columns", "key_columns", "reference_key_columns"):
        if len(value) == 0 or not all(isinstance(c, str) and c for c in value):
            raise RuleError(f"Rule {rule_name!r}: {key!r} must be a non-empty list of names")
    if key in ("min", "max", "threshold", "min_step", "max_step") and isinstance(value, float) and math.isnan(value):
        raise RuleError(f"Rule {rule_name!r}: field {key!r} must not be NaN")


def _check_type_fields(rule: Rule) -> None:
    """Per-type required fields and value checks (raised at load, not at run)."""
    t = rule.type
    p = rule.params
    has_col, has_cols = "column" in p, "columns" in p
    if has_col and has_cols:
        raise RuleError(f"Rule {rule.name!r}: give either 'column' or 'columns', not both")

    def need_column() -> None:
        if has_cols:
            raise RuleError(f"Rule {rule.name!r}: {t} checks one 'column', not 'columns'")
        rule.require("column")

    def need_columns() -> None:
        if has_col:
            raise RuleError(f"Rule {rule.name!r}: {t} takes 'columns', not 'column'")
        rule.require("columns")

    if t in ("null_check", "well_formed"):
        need_column()
    elif t == "regex_match":
        need_column()
        rule.require("pattern")
    elif t == "value_range":
        need_column()
        lo, hi = p.get("min"), p.get("max")
        if lo is not None and hi is not None and lo > hi:
            raise RuleError(f"Rule {rule.name!r}: min {lo} > max {hi}")
    elif t == "allowed_values":
        need_column()
        rule.require("allowed_values")
    elif t == "date_format":
        need_column()
        rule.require("format")
    elif t == "length_check":
        need_column()
        if "min_length" not in p and "max_length" not in p:
            raise RuleError(f"Rule {rule.name!r}: give min_length, max_length or both")
        for k in ("min_length", "max_length"):
            if k in p and p[k] < 0:
                raise RuleError(f"Rule {rule.name!r}: {k} must be >= 0")
    elif t == "cross_column":
        need_columns()
        if ("condition" in p) == ("expect" in p):
            raise RuleError(
                f"Rule {rule.name!r}: cross_column needs exactly one of 'condition' "
                "(violation when TRUE) or 'expect' (violation when FALSE)"
            )
    elif t == "completeness_check":
        need_columns()
    elif t == "time_difference":
        need_columns()
        if len(p["columns"]) != 2:
            raise RuleError(f"Rule {rule.name!r}: time_difference compares a start and an end column, got {len(p['columns'])}")
        parse_duration(rule.require("max_duration"))
    elif t == "unique_check":
        if not has_cols:
            rule.require("column")
    elif t == "referential_integrity":
        need_column()
        rule.require("reference_table")
        rule.require("reference_column")
    elif t == "statistical":
        need_column()
        stat = rule.require("statistic")
        if stat not in ("z_score", "mad"):
            raise RuleError(f"Rule {rule.name!r}: unsupported statistic {stat!r} (only 'z_score' and 'mad')")
        if stat == "z_score" and "key_columns" in p:
            raise RuleError(f"Rule {rule.name!r}: z_score is taken over the whole input; 'key_columns' go with 'mad'")
        rule.require("threshold")
    elif t == "sequence_check":
        need_column()
        rule.require("order_column")
        low, high = p.get("min_step"), p.get("max_step")
        if low is None and high is None:
            raise RuleError(f"Rule {rule.name!r}: give min_step, max_step or both")
        if low is not None and high is not None and low > high:
            raise RuleError(f"Rule {rule.name!r}: min_step {low} > max_step {high}")
    elif t == "order_dependency":
        need_column()
        rule.require("order_column")
    elif t == "functional_dependency":
        need_column()
        rule.require("key_columns")
    elif t == "interval_reference":
        need_column()
        rule.require("reference_table")
        rule.require("from_column")
        if len(p.get("key_columns") or ()) != len(p.get("reference_key_columns") or ()):
            raise RuleError(f"Rule {rule.name!r}: as many 'key_columns' as 'reference_key_columns' are needed")
        if "to_column" in p and "max_duration" in p:
            raise RuleError(f"Rule {rule.name!r}: give 'to_column' or 'max_duration', not both")
        if "max_duration" in p:
            parse_duration(p["max_duration"])
    elif t == "data_type":
        need_column()
        rule.require("expected_type")
    elif t == "date_range":
        need_column()
        if "min_date" not in p and "max_date" not in p:
            raise RuleError(f"Rule {rule.name!r}: date_range needs 'min_date' and/or 'max_date'")
        lo = parse_date_bound(p["min_date"], rule.name) if "min_date" in p else None
        hi = parse_date_bound(p["max_date"], rule.name) if "max_date" in p else None
        if lo and hi and lo > hi:
            raise RuleError(f"Rule {rule.name!r}: min_date after max_date")
    elif t == "time_range":
        need_column()
        if "min_time" not in p and "max_time" not in p:
            raise RuleError(f"Rule {rule.name!r}: time_range needs 'min_time' and/or 'max_time'")
        for k in ("min_time", "max_time"):
            if k in p:
                parse_time_bound(p[k], rule.name)


def rule_from_dict(raw: Mapping[str, Any]) -> Rule:
    if not isinstance(raw, Mapping):
        raise RuleError(f"A rule must be a JSON object, got {raw!r}")
    name = raw.get("name")
    if not isinstance(name, str) or not name:
        raise RuleError(f"Rule name must be a non-empty string, got {name!r}")
    for key, value in raw.items():
        _check_field(name, key, value)
    for key in ("type", "priority"):
        if key not in raw:
            raise MissingParameterError(f"Rule {name!r}: missing required field {key!r}")
    rtype = raw["type"]
    if rtype not in RULE_TYPES:
        raise RuleError(f"Rule {name!r}: unsupported rule type {rtype!r}")
    priority = raw["priority"]
    if not 1 <= priority <= 5:
        raise RuleError(f"Rule {name!r}: priority must be in 1..5, got {priority}")
    params = {
        k: (list(v) if isinstance(v, tuple) else v)
        for k, v in raw.items()
        if k not in ("name", "type", "priority", "entity", "description")
    }
    rule = Rule(
        name=name,
        type=rtype,
        priority=priority,
        params=params,
        entity=raw.get("entity"),
        description=raw.get("description"),
    )
    _check_type_fields(rule)
    return rule


@dataclass(frozen=True)
class RuleSet:
    """Rules in evaluation order: ascending priority, stable for ties."""

    rules: tuple[Rule, ...]

    def __iter__(self):
        return iter(self.rules)

    def __len__(self) -> int:
        return len(self.rules)

    @property
    def names(self) -> list[str]:
        return [r.name for r in self.rules]

    def of_type(self, *types: str) -> list[Rule]:
        return [r for r in self.rules if r.type in types]

    @property
    def row_local_only(self) -> bool:
        return all(r.is_row_local for r in self.rules)


def read_text(path: str) -> str:
    """A small text file: local, or by Spark from any store it reads when the
    path names a scheme (``hdfs://``, ``s3a://``, ...)."""
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]+://", path):
        from pyspark.sql import SparkSession

        spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
        return spark.read.text(path, wholetext=True).first()["value"]
    with open(path, encoding="utf-8") as fh:
        return fh.read()


def _read_source(source: Any) -> list[Any]:
    if isinstance(source, RuleSet):
        return list(source.rules)
    if isinstance(source, (str, os.PathLike)):
        text = os.fspath(source)
        if text.lstrip().startswith("["):
            return json.loads(text)
        return json.loads(read_text(text))
    if isinstance(source, Mapping):
        return [source]
    if isinstance(source, Iterable):
        return list(source)
    raise RuleError(f"Cannot read rules from {type(source).__name__}")


def load_rules(source: Any) -> RuleSet:
    """Load rules from a JSON file path, a JSON text, a list of dicts/Rules or
    a RuleSet; validate every field and sort by priority (stable)."""
    items = _read_source(source)
    if not isinstance(items, list):
        raise RuleError("A rule file must hold a JSON list of rules")
    rules = [r if isinstance(r, Rule) else rule_from_dict(r) for r in items]
    seen: set[str] = set()
    for r in rules:
        if r.name in seen:
            raise RuleError(f"Duplicate rule name {r.name!r}")
        seen.add(r.name)
    return RuleSet(tuple(sorted(rules, key=lambda r: r.priority)))


def validate_rules(items: Iterable[Mapping[str, Any]]) -> None:
    """Check a list of rule dicts; raise ``RuleError`` on the first problem."""
    load_rules(list(items))
