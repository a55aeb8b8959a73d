"""Multiset differences against Counter."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from rowsieve.catalog.queries import table
from rowsieve.operators import reconcile as R
from rowsieve.plans import JoinPolicy
from rowsieve.plans import inspect as pi

SCHEMA = "k int, s string, x double, a array<int>"


def versions(seed=1, n=400):
    rng = random.Random(seed)
    left = [(rng.choice([None, *range(50)]), rng.choice([None, "", "a", "b"]), rng.choice([None, 0.0, -0.0, float("nan"), 1.5]), rng.choice([None, [], [1, None]])) for _ in range(n)]
    left += [(7, "hot", 1.0, None)] * 200
    right = [r for r in left if rng.random() > 0.05] + [rng.choice(left) for _ in range(9)] + [(999, "new", None, None)] * 3
    rng.shuffle(right)
    return left, right


def content(row):
    return tuple("nan" if isinstance(v, float) and v != v else (0.0 if v == 0 and isinstance(v, float) else (tuple(v) if isinstance(v, list) else v)) for v in row)


def difference(left, right):
    a, b = Counter(map(content, left)), Counter(map(content, right))
    return Counter({(*r, "left"): n for r, n in (a - b).items()} | {(*r, "right"): n for r, n in (b - a).items()})


def found(df):
    return Counter({(*content(r[:-2]), r.side): r.copies for r in df.collect()})


@pytest.mark.parametrize("keys", [[], ["k"], ["k", "s"]])
@pytest.mark.parametrize("drill", [1_000_000, 0])
def test_against_counter(spark, monkeypatch, keys, drill):
    monkeypatch.setattr(R, "FANOUT", 8)
    monkeypatch.setattr(R, "DRILL_ROWS", drill)
    left, right = versions()
    a, b = spark.createDataFrame(left, SCHEMA).repartition(3), spark.createDataFrame(right, SCHEMA)
    assert found(R.reconcile(a, b, keys)) == difference(left, right)
    assert found(R.reconcile(a, b, keys, policy=JoinPolicy(broadcast_max_rows=1))) == difference(left, right)
    assert not R.same(a, b) and R.same(a, spark.createDataFrame(random.Random(2).sample(left, len(left)), SCHEMA))


def test_nothing_and_everything_differs(spark):
    left, _ = versions()
    a, none = spark.createDataFrame(left, SCHEMA), spark.createDataFrame([], SCHEMA)
    assert R.reconcile(a, a.repartition(5), ["k"]).collect() == [] and R.reconcile(none, none).collect() == []
    assert found(R.reconcile(a, none)) == difference(left, [])
    assert found(R.reconcile(none, a, ["k"])) == difference([], left)
    assert R.same(none, none) and not R.same(a, none)


def test_chosen_columns_types_and_maps(spark):
    a = spark.createDataFrame([(1, {"x": 1, "y": 2}, "p"), (2, None, "q")], "k int, m map<string,int>, other string")
    b = spark.createDataFrame([("1", {"y": 2, "x": 1}, "z"), ("2", {}, "z")], "k string, m map<string,int>, other string")
    rows = R.reconcile(a, b, ["k"], ["k", "m"]).collect()
    assert sorted((r.k, r.m is None, r.side, r.copies) for r in rows) == [(2, False, "right", 1), (2, True, "left", 1)]
    for bad in ({"keys": ["other"], "columns": ["k"]}, {"columns": ["k", "side"]}):
        with pytest.raises(ValueError):
            R.reconcile(a.withColumn("side", F.lit(1)), b, **bad)


def test_swapped_values_and_null_places_differ(spark):
    a = spark.createDataFrame([(1, None, "x"), (2, "u", "v")], "k int, p string, q string")
    b = spark.createDataFrame([(1, "x", None), (2, "v", "u")], "k int, p string, q string")
    assert R.reconcile(a, b, ["k"]).count() == 4
    changes = {r.k: (r.change, r.left_copies, r.right_copies) for r in R.changed_keys(R.reconcile(a, b.where("k = 1"), ["k"]), ["k"]).collect()}
    assert changes == {1: ("changed", 1, 1), 2: ("removed", 1, 0)}


def test_equal_ranges_are_not_shuffled(spark):
    """One row of a table changed: only its range's rows go through the last aggregate."""
    a = table(spark, SF001, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    b = a.withColumn("l_quantity", F.when((F.col("l_orderkey") == 5) & (F.col("l_linenumber") == 1), -1.0).otherwise(F.col("l_quantity")))
    diff = R.reconcile(a, b, ["l_orderkey", "l_linenumber"])
    assert {r.side for r in diff.collect()} <= {"left", "right"} and diff.count() == 2 * a.where("l_orderkey = 5 AND l_linenumber = 1").count()
    plan = pi.physical(diff)
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan and "partial_sum" in plan and "NestedLoop" not in plan


def many(n, seed=3):
    """Keys that mostly differ, one content with very many copies, and a key with very many contents."""
    rng = random.Random(seed)
    left = [(i, rng.choice([None, "a", "b"]), rng.choice([0.0, -0.0, float("nan"), None]), None) for i in range(n)]
    left += [(-1, "hot", 1.0, [1])] * n + [(-2, str(i), 1.0, None) for i in range(n)]
    right = [(k, "z" if k >= 0 and k % 3 == 0 else s, x, a) for k, s, x, a in left if k % 7 != 1] + left[n : n + 5]
    rng.shuffle(right)
    return left, right


@pytest.mark.parametrize("keys", [[], ["k"]])
@pytest.mark.parametrize("ranges", [8, 64])
def test_many_rows_left_and_hot_ranges(spark, monkeypatch, keys, ranges):
    """Rows dealt by content before they are counted, those of hot ranges folded first."""
    monkeypatch.setattr(R, "FANOUT", ranges)
    monkeypatch.setattr(R, "DRILL_ROWS", 100)
    monkeypatch.setattr(R, "TRIAL", 2)
    left, right = many(300)
    a, b = spark.createDataFrame(left, SCHEMA).repartition(3), spark.createDataFrame(right, SCHEMA)
    for tasks in (2_000_000, 20):
        monkeypatch.setattr(R, "TASK_ROWS", tasks)
        assert found(R.reconcile(a, b, keys)) == difference(left, right)
        assert found(R.reconcile(a, b, keys, policy=JoinPolicy(broadcast_max_rows=1))) == difference(left, right)


def levels(monkeypatch):
    seen, sized = [], R.sized_side
    monkeypatch.setattr(R, "sized_side", lambda side, policy: seen.append(side.columns) or sized(side, policy))
    return seen


def test_narrow_rows_that_differ_everywhere_are_moved_once(spark, monkeypatch):
    """A third of the keys changed: one level of sums, no join, one shuffle of the rows."""
    monkeypatch.setattr(R, "FANOUT", 64)
    monkeypatch.setattr(R, "DRILL_ROWS", 100)
    seen = levels(monkeypatch)
    a = spark.range(20_000).selectExpr("id AS k", "id % 7 AS v", "id + 0.5D AS x")
    b = a.withColumn("v", F.expr("IF(k % 3 = 0, v + 1, v)"))
    diff = R.reconcile(a, b, ["k"])
    plan = pi.physical(diff)
    assert len(seen) == 1 and plan.count("Exchange") == 1 and "Join" not in plan
    assert diff.count() == 2 * a.where("k % 3 = 0").count()


def test_wide_rows_with_few_differences_are_cut_again(spark, monkeypatch):
    """Moving sums is cheaper than wide rows: ranges are cut until few rows are left."""
    monkeypatch.setattr(R, "FANOUT", 16)
    monkeypatch.setattr(R, "DRILL_ROWS", 100)
    monkeypatch.setattr(R, "TRIAL", 2)
    seen = levels(monkeypatch)
    a = spark.range(5_000).selectExpr("id AS k", "repeat(CAST(id AS STRING), 200) AS `te``xt`", "map(id, 1) AS m")
    b = a.where("k <> 3").withColumn("te`xt", F.expr("IF(k % 200 = 1, 'new', `te``xt`)"))
    rows = R.reconcile(a, b, ["k"]).collect()
    assert len(seen) > 1 and "LeftSemi" in pi.physical(R.reconcile(a, b, ["k"]))
    assert sorted((r.k, r.side) for r in rows) == sorted([(3, "left"), *[(k, s) for k in range(1, 5_000, 200) for s in ("left", "right")]])


def test_changed_keys_of_many_rows(spark, monkeypatch):
    """What became of each key, hot ones too; besides the rows, only differences are shuffled."""
    monkeypatch.setattr(R, "FANOUT", 64)
    monkeypatch.setattr(R, "DRILL_ROWS", 100)
    seen = levels(monkeypatch)
    left, right = many(300)
    a, b = spark.createDataFrame(left, SCHEMA).repartition(3), spark.createDataFrame(right, SCHEMA)
    changes = R.changed_keys(R.reconcile(a, b, ["k"]), ["k"])
    expected = {}
    for row, n in difference(left, right).items():
        copies = expected.setdefault(row[0], {"left": 0, "right": 0})
        copies[row[-1]] += n
    said = {k: ("removed" if not c["right"] else "added" if not c["left"] else "changed", c["left"], c["right"]) for k, c in expected.items()}
    assert {r.k: (r.change, r.left_copies, r.right_copies) for r in changes.collect()} == said
    assert len(seen) == 1 and "SortMergeJoin" not in pi.physical(changes)
