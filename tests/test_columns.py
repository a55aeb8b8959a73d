"""Columns resolve as Spark resolves them; text values keep their meaning."""

import datetime as dt

import pytest
from pyspark.sql import types as T

from rowsieve import RuleError, parse_duration, validate
from rowsieve.operators import outliers


def failed(df, **rule):
    result = validate(df, [{"name": "r", "priority": 1, **rule}])
    return [row.i for row in result.bad.orderBy("i").collect()]


def frame(spark):
    schema = T.StructType(
        [
            T.StructField("i", T.IntegerType()),
            T.StructField("Name", T.StringType()),
            T.StructField("s", T.StructType([T.StructField("A", T.IntegerType())])),
            T.StructField("items", T.ArrayType(T.StructType([T.StructField("sku", T.StringType())]))),
            T.StructField("m", T.MapType(T.StringType(), T.IntegerType())),
            T.StructField("dotted.name", T.IntegerType()),
        ]
    )
    return spark.createDataFrame([(1, None, (None,), None, {"k": 1}, None), (2, "b", (2,), [("x",)], {}, 2)], schema)


@pytest.mark.parametrize(
    ("column", "rows"),
    [("name", [1]), ("NAME", [1]), ("`Name`", [1]), ("s.a", [1]), ("s.A", [1]), ("items.sku", [1]), ("m.k", [2]), ("dotted.name", [1])],
)
def test_column_forms(spark, column, rows):
    assert failed(frame(spark), type="null_check", column=column) == rows


def test_unknown_column_is_refused(spark):
    with pytest.raises(RuleError, match="not in the input"):
        failed(frame(spark), type="null_check", column="nobody")


def test_dataset_rules_resolve_names_too(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "i int, `k.x` string")
    assert failed(df, type="unique_check", column="k.x") == [1, 2]
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "i int, Key string")
    assert failed(df, type="unique_check", column="KEY") == [1, 2]


def test_offsets_in_text(spark):
    rows = [
        (1, "2024-01-01T00:00:00Z", "2024-01-01T00:00:00-10:00"),
        (2, "2024-01-01T00:00:00Z", "2024-01-01T04:00:00Z"),
        (3, "2024-01-01 00:00:00", "2024-01-01 06:00:00"),
        (4, "2024-01-01T00:00:00+02:00", "2024-01-01T00:00:00+01:00"),
        (5, "2024-01-01", "2024-01-01 04:59:59"),
    ]
    df = spark.createDataFrame(rows, "i int, a string, b string")
    assert failed(df, type="time_difference", columns=["a", "b"], max_duration="5 HOURS") == [1, 3]


def test_long_numbers_in_text(spark):
    df = spark.createDataFrame([(1, "9007199254740992"), (2, "9007199254740993"), (3, "abc"), (4, None)], "i int, n string")
    assert failed(df, type="value_range", column="n", max=2**53) == [2]
    assert failed(df, type="value_range", column="n", min=2**53 + 1) == [1]
    assert failed(df, type="allowed_values", column="n", allowed_values=[2**53]) == [2]


def test_zscore_on_bad_text(spark):
    df = spark.createDataFrame([(i, "10") for i in range(30)] + [(30, "1000"), (31, "abc")], "i int, n string")
    assert [r.i for r in outliers(df, "n", 3).collect()] == [30]


def test_time_of_day_in_seconds(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 8, 59, 59)), (2, dt.datetime(2024, 1, 1, 9, 0, 0))], "i int, t timestamp_ntz")
    assert failed(df, type="time_range", column="t", min_time="09:00:00") == [1]


@pytest.mark.parametrize(("left", "right", "rows"), [("int", "string", [3]), ("string", "int", [3]), ("double", "string", [3])])
def test_reference_of_another_type(spark, left, right, rows):
    df = spark.createDataFrame([(1, 1), (2, 2), (3, 3), (4, None)], "i int, k int").selectExpr("i", f"cast(k as {left}) AS k")
    ref = spark.createDataFrame([(1,), (2,), (7,)], "k int").selectExpr(f"cast(k as {right}) AS k")
    rule = [{"name": "r", "priority": 1, "type": "referential_integrity", "column": "k", "reference_table": "t", "reference_column": "k"}]
    assert [r.i for r in validate(df, rule, refs={"t": ref}).bad.collect()] == rows


def test_reference_types_that_cannot_be_compared(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1))], "i int, k date")
    ref = spark.createDataFrame([(1,)], "k int")
    rule = [{"name": "r", "priority": 1, "type": "referential_integrity", "column": "k", "reference_table": "t", "reference_column": "k"}]
    with pytest.raises(RuleError, match="cannot be matched"):
        validate(df, rule, refs={"t": ref})


def test_durations():
    assert parse_duration(" 1.5 hours ") == 5400
    assert parse_duration("1e2 SECONDS") == 100
    for text in ("", "5", "5hours", "-1 DAYS", "nan DAYS", "inf DAYS", "1 2 DAYS", "5 WEEKS", None):
        with pytest.raises(RuleError):
            parse_duration(text)
