"""Rule loading, field checks, ordering, durations (no Spark)."""

import json

import pytest

from rowsieve.rules import (
    MissingParameterError,
    RuleError,
    load_rules,
    parse_duration,
    validate_rules,
)


def r(**kw):
    base = {"name": "r", "type": "null_check", "column": "c", "priority": 1}
    base.update(kw)
    return base


def test_sorted_by_priority_stable():
    rules = load_rules(
        [
            r(name="a", priority=3),
            r(name="b", priority=1),
            r(name="c", priority=3),
            r(name="d", priority=1),
        ]
    )
    assert rules.names == ["b", "d", "a", "c"]


def test_load_from_file_and_json_text(tmp_path):
    data = [r(name="x"), r(name="y", priority=2)]
    p = tmp_path / "rules.json"
    p.write_text(json.dumps(data))
    assert load_rules(str(p)).names == ["x", "y"]
    assert load_rules(json.dumps(data)).names == ["x", "y"]


@pytest.mark.parametrize(
    "bad",
    [
        r(name=""),
        r(type="nope"),
        r(priority=0),
        r(priority=6),
        r(priority=True),  # booleans are not priorities
        r(priority=1.5),
        r(unknown_field=1),
        r(columns=["a"]),  # column and columns together
        r(type="regex_match"),  # pattern missing
        r(type="value_range", min=5, max=1),
        r(type="value_range", min=float("nan")),
        r(type="length_check"),  # neither bound
        r(type="statistical", statistic="median", threshold=1),
        r(type="time_difference", column=None, columns=["a"], max_duration="1 DAYS"),
        {"name": "t", "type": "time_difference", "columns": ["a", "b", "c"], "max_duration": "1 DAYS", "priority": 1},
        {"name": "t", "type": "time_difference", "columns": ["a", "b"], "max_duration": "1 WEEKS", "priority": 1},
        {"name": "t", "type": "cross_column", "columns": ["a"], "priority": 1},
        {"name": "t", "type": "cross_column", "columns": ["a"], "condition": "a", "expect": "a", "priority": 1},
        {"name": "t", "type": "completeness_check", "column": "a", "priority": 1},
        {"name": "t", "type": "referential_integrity", "column": "a", "reference_table": "x", "priority": 1},
        {"name": "t", "type": "date_range", "column": "a", "priority": 1},
        {"name": "t", "type": "date_range", "column": "a", "min_date": "2020-13-01", "priority": 1},
        {"name": "t", "type": "time_range", "column": "a", "max_time": "25:00:00", "priority": 1},
        {"name": "t", "type": "unique_check", "priority": 1},
        {"name": "t", "type": "null_check", "column": "a"},  # priority missing
        {"name": "t", "type": "allowed_values", "column": "a", "allowed_values": "abc", "priority": 1},
    ],
)
def test_invalid_rules_refused(bad):
    with pytest.raises(RuleError):
        load_rules([bad])


def test_duplicate_names_refused():
    with pytest.raises(RuleError, match="Duplicate"):
        load_rules([r(name="a"), r(name="a", column="d")])


def test_missing_parameter_is_key_error_too():
    with pytest.raises(KeyError):
        load_rules([r(type="date_format")])
    with pytest.raises(MissingParameterError, match="needs the field 'format'"):
        load_rules([r(type="date_format")])


def test_validate_rules_shim():
    validate_rules([r()])
    with pytest.raises(RuleError):
        validate_rules([r(priority=9)])


@pytest.mark.parametrize(
    "text,seconds",
    [
        ("72 HOURS", 259200.0),
        ("72 hours", 259200.0),
        ("1.5 MINUTES", 90.0),
        ("30 DAYS", 2592000.0),
        ("0 SECONDS", 0.0),
    ],
)
def test_parse_duration(text, seconds):
    assert parse_duration(text) == seconds


@pytest.mark.parametrize("text", ["72", "72 HOURS extra", "x HOURS", "72 WEEKS", "nan HOURS", "inf DAYS", "-1 DAYS", "72 HOUR"])
def test_parse_duration_rejects(text):
    with pytest.raises(RuleError):
        parse_duration(text)


def test_metadata_carried():
    rs = load_rules([r(entity="customers", description="must be set")])
    rule = rs.rules[0]
    assert rule.entity == "customers" and rule.description == "must be set"
    assert "entity" not in rule.params


def test_all_fifteen_types_accepted():
    from rowsieve.catalog.queries import FULL_RULES

    rs = load_rules(FULL_RULES)
    assert len({x.type for x in rs}) == 15
