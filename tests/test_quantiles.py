"""Exact quantiles and robust outliers against sorted lists."""

import math
import random
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF001
from rowsieve import RuleError, load_rules, validate
from rowsieve.catalog.queries import table
from rowsieve.operators import quantiles as Q
from rowsieve.plans import LAZY, JoinPolicy
from rowsieve.plans import inspect as pi

P = [0.0, 0.1, 0.5, 0.77, 1.0]
POLICIES = {"default": JoinPolicy(), "tiny": JoinPolicy(broadcast_max_rows=2, heavy_key_rows=20), "lazy": LAZY}


@pytest.fixture(params=[(4096, 10_000), (4, 3)], ids=["one pass", "many passes"])
def sizes(request, monkeypatch):
    monkeypatch.setattr(Q, "BUCKETS", request.param[0])
    monkeypatch.setattr(Q, "SETTLE", request.param[1])


def disc(values, p):
    return sorted(values)[max(math.ceil(p * len(values)), 1) - 1]


@pytest.mark.parametrize("policy", POLICIES)
def test_groups_against_sorted_lists(spark, sizes, policy):
    rng = random.Random(1)
    rows = [(7 if i % 3 == 0 else rng.choice([1, 2, 3, 4, None]), rng.choice([None, float("nan"), rng.gauss(0, 1e3), float(rng.randrange(5)), 1e-300])) for i in range(600)]
    df = spark.createDataFrame(rows, "g int, x double").repartition(4)
    groups = {}
    for g, x in rows:
        if g is not None and x is not None and x == x:
            groups.setdefault(g, []).append(x)
    got = {(r.g, r.probability): (r.n, r.value) for r in Q.quantiles(df, "x", P, ["g"], POLICIES[policy]).collect()}
    assert got == {(g, p): (len(v), disc(v, p)) for g, v in groups.items() for p in P}
    every = [x for _, x in rows if x is not None and x == x]
    got = {r.probability: r.value for r in Q.quantiles(df, "x", P, policy=POLICIES[policy]).collect()}
    assert got == {p: disc(every, p) for p in P}


@pytest.mark.parametrize(
    "kind, values",
    [
        ("double", [float("inf"), float("-inf"), 1.7e308, -1.7e308, 5e-324, 0.0, 1e-323, 1.0, 2.0, 2.0000000000000004]),
        ("long", [2**63 - 1, -(2**63), 2**53, 2**53 + 1, 2**53 + 2, 0, -1, 1, 1, 1]),
        ("decimal(30,4)", [Decimal("1.0001"), Decimal("1.0002"), Decimal("9" * 26), Decimal("-" + "9" * 26), Decimal(0)]),
        ("float", [0.5, 0.25, 2.0**127, -(2.0**127), 1.5, 1.5]),
        ("string", ["10", "9", "x", "1e3", None, "-2"]),
    ],
)
def test_extreme_values_of_every_type(spark, sizes, kind, values):
    df = spark.createDataFrame([(v,) for v in values * 3], f"x {kind}")
    known = [float(v) for v in values if v not in ("x", None)] if kind == "string" else values
    got = {r.probability: r.value for r in Q.quantiles(df, "x", P).collect()}
    assert got == {p: disc(known * 3, p) for p in P}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.floats(allow_nan=False), min_size=1, max_size=60), p=st.floats(0, 1))
def test_any_doubles(spark, values, p):
    old = Q.BUCKETS, Q.SETTLE
    Q.BUCKETS, Q.SETTLE = 8, 2
    try:
        (row,) = Q.quantiles(spark.createDataFrame([(v,) for v in values], "x double"), "x", [p]).collect()
    finally:
        Q.BUCKETS, Q.SETTLE = old
    assert row.n == len(values) and row.value == disc(values, p)


def test_no_values_and_bad_probabilities(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "x double")
    assert Q.quantiles(df, "x", [0.5]).collect() == []
    for bad in ([], [1.5], [-0.1]):
        with pytest.raises(ValueError):
            Q.quantiles(df, "x", bad)


def robust(values, threshold):
    median = disc(values, 0.5)
    mad = disc([abs(v - median) for v in values], 0.5)
    return [bool(mad) and abs(v - median) / (1.4826 * mad) > threshold for v in values]


@pytest.mark.parametrize("policy", POLICIES)
def test_mad_rule(spark, policy):
    rng = random.Random(3)
    rows = [(i, rng.choice(["a", "b"]) if i % 3 else "hot", rng.gauss(0, 1) * (50 if i % 17 == 0 else 1)) for i in range(200)]
    df = spark.createDataFrame([*rows, (900, "a", None), (901, None, 1e9), (902, "one", 5.0), (903, "hot", float("nan"))], "id int, g string, x double")
    rule = {"name": "m", "type": "statistical", "statistic": "mad", "column": "x", "threshold": 4, "key_columns": ["g"], "priority": 1}
    want = []
    for g in ("a", "b", "hot"):
        own = [r for r in rows if r[1] == g]
        want += [r[0] for r, bad in zip(own, robust([r[2] for r in own], 4)) if bad]
    got = validate(df, [rule], policy=POLICIES[policy]).bad.collect()
    assert sorted(r.id for r in got) == sorted(want) and want
    known = [(i, x) for i, _, x in rows] + [(901, 1e9), (902, 5.0)]
    want = [i for (i, _), bad in zip(known, robust([x for _, x in known], 4)) if bad]
    del rule["key_columns"]
    assert sorted(r.id for r in validate(df, [rule], policy=POLICIES[policy]).bad.collect()) == sorted(want)


def test_equal_values_have_no_outlier(spark):
    df = spark.createDataFrame([(5.0,)] * 9 + [(50.0,)], "x double")
    rule = {"name": "m", "type": "statistical", "statistic": "mad", "column": "x", "threshold": 1, "priority": 1}
    assert validate(df, [rule]).bad.count() == 0 and validate(df.limit(0), [rule]).bad.count() == 0


def test_rule_refusals():
    base = {"name": "m", "type": "statistical", "column": "x", "threshold": 1, "priority": 1}
    for extra in ({"statistic": "iqr"}, {"statistic": "z_score", "key_columns": ["g"]}):
        with pytest.raises(RuleError):
            load_rules([{**base, **extra}])


def test_no_task_sorts_the_column(spark, monkeypatch):
    """What a pass shuffles is a row per bucket and task, and it reads two columns."""
    monkeypatch.setattr(Q, "SETTLE", 10)
    rows = table(spark, SF001, "lineitem").select(F.col("l_returnflag").alias("g"), F.col("l_extendedprice").alias("x"))
    plan = pi.physical(Q.exact_quantiles(rows, ["g"], "x", [0.5]))
    assert not pi.gathers_raw_rows(plan) and "NestedLoop" not in plan
    assert "partial_count" in plan
