"""Counts per segment against counts of every segment's own rows."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from rowsieve import validate
from rowsieve.catalog.queries import table
from rowsieve.plans import inspect as pi

RULES = [
    {"name": "q", "type": "value_range", "column": "q", "min": 2, "priority": 1, "entity": "e"},
    {"name": "u", "type": "unique_check", "column": "u", "priority": 2},
]
ROWS = [("a", 1, 1, 1), ("a", 1, 5, 2), ("a", 2, None, 2), (None, 1, 0, 3), (None, None, 9, 4), ("b", 2, 1, None)]
SCHEMA = "s string, t int, q int, u int"


def test_levels_nulls_and_zeros(spark):
    r = validate(spark.createDataFrame(ROWS, SCHEMA), RULES)
    got = {(x.s, x.t, x.level): (x.total_records, x.passed_records, x.rejected_records) for x in r.segment_summary(["s", "t"]).collect()}
    assert got == {
        ("a", 1, 0): (2, 0, 2), ("a", 2, 0): (1, 0, 1), (None, 1, 0): (1, 0, 1), (None, None, 0): (1, 1, 0), ("b", 2, 0): (1, 0, 1),
        ("a", None, 1): (3, 0, 3), (None, None, 1): (2, 1, 1), ("b", None, 1): (1, 0, 1), (None, None, 3): (6, 1, 5),
    }
    long = {(x.s, x.t, x.level, x.rule): (x.failed_count, x.total_records, x.entity) for x in r.segment_violations(["s", "t"]).collect()}
    assert len(long) == 18
    assert long["a", None, 1, "u"] == (2, 3, None) and long["b", 2, 0, "u"] == (0, 1, None) and long[None, None, 3, "q"] == (3, 6, "e")


@pytest.mark.parametrize("sets", ["rollup", "cube", [["s"], ["t"], []], [["t", "s"]]])
def test_sets_agree_with_the_whole(spark, sets):
    r = validate(spark.createDataFrame(ROWS, SCHEMA), RULES)
    whole = r.quality_stats()
    for level, rows in r.segment_violations({"s": "s", "t": F.col("t") % 2}, sets).groupBy("level", "rule").agg(F.sum("failed_count").alias("n")).groupBy("level").agg(F.map_from_entries(F.collect_list(F.struct("rule", "n")))).collect():
        assert rows == {k: v["failed_count"] for k, v in whole["rule_violations"].items()}, level


def test_empty_input_and_no_rules(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    empty = validate(df.limit(0), RULES)
    assert empty.segment_summary(["s"]).collect() == [] == empty.segment_violations(["s"]).collect()
    none = validate(df, [])
    assert none.segment_violations(["s"]).collect() == []
    assert {x.rejected_records for x in none.segment_summary(["s"]).collect()} == {0}


def test_odd_names_and_refusals(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).withColumnRenamed("s", "a.b")
    r = validate(df, RULES)
    assert r.segment_summary(["a.b"]).columns[0] == "a.b"
    for by, sets in (([], "rollup"), (["q", "level"], "rollup"), ({"__rs_x": "q"}, "rollup"), (["t"], "some"), (["t"], [["q"]])):
        with pytest.raises(ValueError):
            r.segment_summary(by, sets)


def test_one_expand_and_one_exchange(spark):
    r = validate(table(spark, SF001, "lineitem"), [{"name": f"r{i}", "type": "value_range", "column": "l_quantity", "min": i, "priority": 1} for i in range(9)])
    plan = pi.physical(r.segment_violations(["l_returnflag", "l_linestatus"], "cube"))
    assert plan.count("Expand [") == 1 and plan.count("Exchange hashpartitioning") == 1 and "partial_count" in plan
    assert "ReadSchema: struct<l_quantity:double,l_returnflag:string,l_linestatus:string>" in plan
