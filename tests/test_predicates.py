"""R1–R12 on literal unit frames: NULL, boundaries, NaN, malformed text."""

import datetime as dt
import math

import pytest

from rowsieve import validate


def verdicts(spark, rows, schema, rule):
    """{k: True when the row fails ``rule``}."""
    rule = {"name": "r", "priority": 1, **rule}
    df = spark.createDataFrame(rows, schema)
    out = validate(df, [rule]).flagged.select("k", "failed_rules").collect()
    return {row["k"]: row["failed_rules"] == ["r"] for row in out}


SCALARS = "k int, s string, x double, d string, t timestamp"
NAN, INF = float("nan"), float("inf")


def scalars(spark, rule):
    rows = [
        (1, None, None, None, None),
        (2, "", 0.0, "2023-01-05", dt.datetime(2024, 1, 1, 8, 59, 59)),
        (3, "abc", 5.0, "2023-13-32", dt.datetime(2024, 1, 1, 9, 0, 0)),
        (4, "abcdef", NAN, "2023-01-05x", dt.datetime(2024, 1, 1, 21, 0, 0)),
        (5, "ab", INF, "2023-1-5", dt.datetime(2024, 1, 1, 20, 59, 59)),
        (6, "x@y.io", -INF, "2023-02-29", dt.datetime(2024, 1, 1, 12, 0, 0)),
        (7, "abc", 4.999, "2024-02-29", None),
        (8, "abc", 10.0, "2023-01-05", None),
        (9, "abc", 10.001, "2023-01-05", None),
    ]
    return verdicts(spark, rows, SCALARS, rule)


def test_null_check(spark):
    v = scalars(spark, {"type": "null_check", "column": "s"})
    assert v[1] is True  # NULL fails
    assert v[2] is False  # empty string is not NULL
    assert sum(v.values()) == 1


def test_regex_match_unanchored_and_null_passes(spark):
    v = scalars(spark, {"type": "regex_match", "column": "s", "pattern": "b"})
    assert v[1] is False  # NULL passes
    assert v[2] is True  # '' has no 'b'
    assert v[3] is False and v[4] is False  # found anywhere
    v = scalars(spark, {"type": "regex_match", "column": "s", "pattern": "^[a-z]+@[a-z]+\\.[a-z]{2,}$"})
    assert [k for k, f in v.items() if not f] == [1, 6]


def test_value_range_bounds_inclusive_nan_fails(spark):
    v = scalars(spark, {"type": "value_range", "column": "x", "min": 5, "max": 10})
    assert v == {1: False, 2: True, 3: False, 4: True, 5: True, 6: True, 7: True, 8: False, 9: True}


def test_value_range_single_bound(spark):
    v = scalars(spark, {"type": "value_range", "column": "x", "min": 5})
    # no max = +inf: inf passes, NaN fails (NaN sorts above +inf)
    assert v == {1: False, 2: True, 3: False, 4: True, 5: False, 6: True, 7: True, 8: False, 9: False}
    v = scalars(spark, {"type": "value_range", "column": "x", "max": 5})
    assert v == {1: False, 2: False, 3: False, 4: True, 5: True, 6: False, 7: False, 8: True, 9: True}


def test_value_range_no_bounds_only_nan(spark):
    v = scalars(spark, {"type": "value_range", "column": "x"})
    assert [k for k, f in v.items() if f] == [4]


def test_value_range_integer_column(spark):
    rows = [(1, 4), (2, 5), (3, 10), (4, 11), (5, None)]
    v = verdicts(spark, rows, "k int, n int", {"type": "value_range", "column": "n", "min": 5, "max": 10})
    assert v == {1: True, 2: False, 3: False, 4: True, 5: False}


def test_allowed_values(spark):
    v = scalars(spark, {"type": "allowed_values", "column": "s", "allowed_values": ["abc", ""]})
    assert v[1] is False  # NULL passes
    assert v[2] is False and v[3] is False
    assert v[4] is True and v[5] is True


def test_allowed_values_null_in_list_never_fires(spark):
    v = scalars(spark, {"type": "allowed_values", "column": "s", "allowed_values": ["abc", None]})
    assert not any(v.values())


def test_allowed_values_empty_list_fails_all(spark):
    v = scalars(spark, {"type": "allowed_values", "column": "s", "allowed_values": []})
    assert all(v.values())


def test_date_format_strict_no_rollover(spark):
    v = scalars(spark, {"type": "date_format", "column": "d", "format": "yyyy-MM-dd"})
    assert v == {1: True, 2: False, 3: True, 4: True, 5: True, 6: True, 7: False, 8: False, 9: False}


def test_length_check(spark):
    v = scalars(spark, {"type": "length_check", "column": "s", "min_length": 2, "max_length": 3})
    assert v == {1: True, 2: True, 3: False, 4: True, 5: False, 6: True, 7: False, 8: False, 9: False}
    v = scalars(spark, {"type": "length_check", "column": "s", "max_length": 3})
    assert v[1] is True and v[2] is False and v[4] is True


def test_length_counts_characters_not_bytes(spark):
    rows = [(1, "héllo"), (2, "日本語"), (3, "abcdef")]
    v = verdicts(spark, rows, "k int, s string", {"type": "length_check", "column": "s", "max_length": 5})
    assert v == {1: False, 2: False, 3: True}


PAIR = "k int, original double, discounted double"
PAIR_ROWS = [(1, 10.0, 5.0), (2, 10.0, 11.0), (3, 10.0, 10.0), (4, None, 5.0), (5, 10.0, None)]


def test_cross_column_condition_is_the_violation(spark):
    v = verdicts(
        spark,
        PAIR_ROWS,
        PAIR,
        {"type": "cross_column", "columns": ["original", "discounted"], "condition": "discounted <= original"},
    )
    assert v == {1: True, 2: False, 3: True, 4: False, 5: False}  # NULL passes


def test_cross_column_expect(spark):
    v = verdicts(
        spark,
        PAIR_ROWS,
        PAIR,
        {"type": "cross_column", "columns": ["original", "discounted"], "expect": "discounted <= original"},
    )
    assert v == {1: False, 2: True, 3: False, 4: False, 5: False}  # NULL passes


def test_cross_column_full_sql_surface(spark):
    v = verdicts(
        spark,
        PAIR_ROWS,
        PAIR,
        {"type": "cross_column", "columns": ["original"], "condition": "coalesce(original, 0) < 1 OR abs(discounted - 11) < 1e-9"},
    )
    assert v == {1: False, 2: True, 3: False, 4: True, 5: False}


def test_completeness(spark):
    rows = [(1, "a", 1), (2, None, 1), (3, "a", None), (4, None, None)]
    v = verdicts(spark, rows, "k int, a string, b int", {"type": "completeness_check", "columns": ["a", "b"]})
    assert v == {1: False, 2: True, 3: True, 4: True}


SPANS = "k int, a timestamp, b timestamp"
T0 = dt.datetime(2024, 3, 1, 12, 0, 0)


def test_time_difference(spark):
    H72 = dt.timedelta(hours=72)
    rows = [
        (1, None, T0),
        (2, T0, None),
        (3, T0, T0 + H72),  # exactly the limit passes
        (4, T0, T0 + H72 + dt.timedelta(seconds=1)),
        (5, T0 + H72 * 2, T0),  # negative gap passes
        (6, T0, T0 + H72 + dt.timedelta(microseconds=500000)),  # whole seconds
    ]
    rule = {"type": "time_difference", "columns": ["a", "b"], "max_duration": "72 HOURS"}
    v = verdicts(spark, rows, SPANS, rule)
    assert v == {1: True, 2: True, 3: False, 4: True, 5: False, 6: False}


def test_time_difference_dates_and_strings(spark):
    rows = [
        (1, dt.date(2024, 3, 1), dt.date(2024, 3, 4), "2024-03-01", "2024-03-04"),
        (2, dt.date(2024, 3, 1), dt.date(2024, 3, 5), "2024-03-01", "2024-03-05 00:00:01"),
        (3, dt.date(2024, 3, 1), dt.date(2024, 3, 2), "2023-13-32", "2024-03-05"),  # unparsable: passes
    ]
    schema = "k int, a date, b date, sa string, sb string"
    dates = verdicts(spark, rows, schema, {"type": "time_difference", "columns": ["a", "b"], "max_duration": "3 DAYS"})
    texts = verdicts(spark, rows, schema, {"type": "time_difference", "columns": ["sa", "sb"], "max_duration": "3 DAYS"})
    assert dates == {1: False, 2: True, 3: False}
    assert texts == {1: False, 2: True, 3: False}


def test_time_difference_ntz_independent_of_session_zone(spark):
    rows = [(1, dt.datetime(2024, 3, 9, 12), dt.datetime(2024, 3, 10, 12))]  # spans a US DST switch
    df = spark.createDataFrame(rows, "k int, a timestamp_ntz, b timestamp_ntz")
    rule = [{"name": "r", "type": "time_difference", "columns": ["a", "b"], "max_duration": "86399 SECONDS", "priority": 1}]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        results = []
        for tz in ("UTC", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            results.append(validate(df, rule).flagged.collect()[0]["failed_rules"])
        assert results == [["r"], ["r"]]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_data_type(spark):
    rows = [(1, "12"), (2, " 7 "), (3, "x1"), (4, None), (5, "3.5"), (6, "99999999999")]
    v = verdicts(spark, rows, "k int, s string", {"type": "data_type", "column": "s", "expected_type": "int"})
    assert v == {1: False, 2: False, 3: True, 4: False, 5: True, 6: True}


def test_date_range(spark):
    rows = [
        (1, dt.date(2019, 12, 31), "2019-12-31"),
        (2, dt.date(2020, 1, 1), "2020-01-01"),
        (3, dt.date(2020, 12, 31), "2020-12-31"),
        (4, dt.date(2021, 1, 1), "2021-01-01"),
        (5, None, "garbage"),
    ]
    schema = "k int, d date, s string"
    rule = {"type": "date_range", "min_date": "2020-01-01", "max_date": "2020-12-31"}
    assert verdicts(spark, rows, schema, {**rule, "column": "d"}) == {1: True, 2: False, 3: False, 4: True, 5: False}
    assert verdicts(spark, rows, schema, {**rule, "column": "s"}) == {1: True, 2: False, 3: False, 4: True, 5: False}


def test_time_range(spark):
    v = scalars(spark, {"type": "time_range", "column": "t", "min_time": "9:00", "max_time": "20:59:59"})
    assert v == {1: False, 2: True, 3: False, 4: True, 5: False, 6: False, 7: False, 8: False, 9: False}


def test_time_range_strings(spark):
    rows = [(1, "08:30:00"), (2, "9:05:00"), (3, "20:59:00"), (4, "21:00:00"), (5, "junk"), (6, None)]
    v = verdicts(spark, rows, "k int, s string", {"type": "time_range", "column": "s", "min_time": "09:00:00", "max_time": "20:59:59"})
    assert v == {1: True, 2: False, 3: False, 4: True, 5: False, 6: False}


def test_struct_field_by_dotted_name(spark):
    rows = [(1, ("a",)), (2, (None,))]
    v = verdicts(spark, rows, "k int, p struct<name:string>", {"type": "null_check", "column": "p.name"})
    assert v == {1: False, 2: True}


def test_ansi_never_raises_on_bad_data(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    v = scalars(spark, {"type": "date_format", "column": "d", "format": "yyyy-MM-dd"})
    assert len(v) == 9


@pytest.mark.parametrize("nan", [True, False])
def test_nan_float_column(spark, nan):
    x = NAN if nan else 1.0
    v = verdicts(spark, [(1, x)], "k int, x float", {"type": "value_range", "column": "x", "min": 0, "max": 2})
    assert v[1] is nan
    assert math.isnan(x) is nan


def test_data_type_on_typed_columns(spark):
    rows = [(1, 12345, 3.0, dt.date(2024, 1, 5)), (2, None, 3.5, None)]
    schema = "k int, zip int, x double, d date"
    # int -> boolean is not a cast Spark allows on the types; judged on the text instead
    assert verdicts(spark, rows, schema, {"type": "data_type", "column": "zip", "expected_type": "boolean"}) == {1: True, 2: False}
    # (Spark's text-to-date cast reads a bare year, so '12345' is a date)
    assert verdicts(spark, rows, schema, {"type": "data_type", "column": "zip", "expected_type": "date"}) == {1: False, 2: False}
    assert verdicts(spark, rows, schema, {"type": "data_type", "column": "x", "expected_type": "int"}) == {1: True, 2: True}
    assert verdicts(spark, rows, schema, {"type": "data_type", "column": "x", "expected_type": "double"}) == {1: False, 2: False}
    assert verdicts(spark, rows, schema, {"type": "data_type", "column": "d", "expected_type": "timestamp"}) == {1: False, 2: False}


def test_rules_on_inferred_csv_types(spark):
    """Columns a CSV reader infers as int / date / timestamp still validate."""
    rows = [(1, 12345, dt.date(2024, 1, 5), dt.datetime(2024, 1, 5, 8, 30)), (2, None, None, None)]
    schema = "k int, zip int, d date, t timestamp"
    assert verdicts(spark, rows, schema, {"type": "regex_match", "column": "zip", "pattern": "^\\d{5}$"}) == {1: False, 2: False}
    assert verdicts(spark, rows, schema, {"type": "length_check", "column": "zip", "min_length": 5, "max_length": 5}) == {1: False, 2: True}
    assert verdicts(spark, rows, schema, {"type": "date_format", "column": "d", "format": "yyyy-MM-dd"}) == {1: False, 2: True}
    assert verdicts(spark, rows, schema, {"type": "time_difference", "columns": ["d", "t"], "max_duration": "8 HOURS"}) == {1: True, 2: True}
    assert verdicts(spark, rows, schema, {"type": "time_range", "column": "t", "min_time": "09:00:00"}) == {1: True, 2: False}


def test_numeric_rules_on_text_columns_never_abort(spark):
    """All-string inputs (CSV without inference): bad text passes, no ANSI error."""
    rows = [(1, "5"), (2, "12.5"), (3, "abc"), (4, None), (5, " 7 ")]
    schema = "k int, s string"
    assert verdicts(spark, rows, schema, {"type": "value_range", "column": "s", "min": 6, "max": 10}) == {
        1: True, 2: True, 3: False, 4: False, 5: False}
    assert verdicts(spark, rows, schema, {"type": "allowed_values", "column": "s", "allowed_values": [5, 7]}) == {
        1: False, 2: True, 3: False, 4: False, 5: False}
    assert verdicts(spark, rows, schema, {"type": "allowed_values", "column": "s", "allowed_values": ["5", "abc"]}) == {
        1: False, 2: True, 3: False, 4: False, 5: True}
