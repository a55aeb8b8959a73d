"""rowsieve — a data-quality rule engine that runs as Spark plans.

Rules (JSON or dicts) compile into one DataFrame plan that marks every row
with the names of the rules it violates, splits good from rejected rows,
counts violations per rule in one aggregate and writes rejected rows out.
"""

from rowsieve.operators.validate import ValidationResult, flag_rows, validate
from rowsieve.rules import Rule, RuleError, RuleSet, load_rules, parse_duration, validate_rules
from rowsieve.runner import RuleRunner

__all__ = [
    "Rule",
    "RuleError",
    "RuleRunner",
    "RuleSet",
    "ValidationResult",
    "flag_rows",
    "load_rules",
    "parse_duration",
    "validate",
    "validate_rules",
]
