"""Duplicates, referential integrity (NOT IN semantics), z-score."""

import pytest

from rowsieve import RuleError, validate
from rowsieve.operators import duplicates, orphans, outliers


def fails(result, key="k"):
    return {r[key]: bool(r["failed_rules"]) for r in result.flagged.select(key, "failed_rules").collect()}


# ---------------------------------------------------------------- G1 unique
KEYS = [(1, None), (2, None), (3, "a"), (4, "a"), (5, "a"), (6, "b")]


def test_unique_every_copy_fails_null_keys_pass(spark):
    df = spark.createDataFrame(KEYS, "k int, v string")
    r = validate(df, [{"name": "u", "type": "unique_check", "column": "v", "priority": 1}])
    assert fails(r) == {1: False, 2: False, 3: True, 4: True, 5: True, 6: False}


def test_unique_keeps_column_order_and_rows(spark):
    df = spark.createDataFrame([(1, "x", 2.0), (2, "x", 3.0)], "k int, v string, z double")
    r = validate(df, [{"name": "u", "type": "unique_check", "column": "v", "priority": 1}])
    assert r.flagged.columns == ["k", "v", "z", "failed_rules"]
    assert r.good.columns == ["k", "v", "z"]
    assert r.flagged.count() == 2


def test_unique_composite_key(spark):
    rows = [(1, 1, "a"), (2, 1, "a"), (3, 1, "b"), (4, None, "a"), (5, None, "a")]
    df = spark.createDataFrame(rows, "k int, x int, y string")
    r = validate(df, [{"name": "u", "type": "unique_check", "columns": ["x", "y"], "priority": 1}])
    assert fails(r) == {1: True, 2: True, 3: False, 4: False, 5: False}


def test_unique_hot_key(spark):
    # one key holds most rows: every one of its rows fails, the rest pass
    rows = [(i, "hot" if i % 3 else f"k{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, v string").repartition(8)
    r = validate(df, [{"name": "u", "type": "unique_check", "column": "v", "priority": 1}])
    stats = r.quality_stats()
    assert stats["rejected_records"] == 2000 and stats["total_records"] == 3000


def test_duplicates_standalone(spark):
    df = spark.createDataFrame(KEYS, "k int, v string")
    assert sorted(r.k for r in duplicates(df, ["v"]).collect()) == [3, 4, 5]


# ----------------------------------------------------------- G2 referential
VALS = [(1, "a"), (2, "b"), (3, None)]


def ref_verdict(spark, ref_rows):
    df = spark.createDataFrame(VALS, "k int, v string")
    ref = spark.createDataFrame([(x,) for x in ref_rows], "r string")
    rule = {
        "name": "fk",
        "type": "referential_integrity",
        "column": "v",
        "reference_table": "ref",
        "reference_column": "r",
        "priority": 1,
    }
    return fails(validate(df, [rule], refs={"ref": ref}))


def test_referential_plain(spark):
    assert ref_verdict(spark, ["a", "c"]) == {1: False, 2: True, 3: False}


def test_referential_duplicates_in_reference(spark):
    assert ref_verdict(spark, ["a", "a", "c", "c"]) == {1: False, 2: True, 3: False}


def test_referential_null_in_reference_disables(spark):
    assert ref_verdict(spark, ["a", None]) == {1: False, 2: False, 3: False}


def test_referential_empty_reference_fails_all(spark):
    assert ref_verdict(spark, []) == {1: True, 2: True, 3: True}


def test_referential_matches_sql_not_in(spark):
    """Same verdicts as Spark's own NOT IN over a literal list."""
    for ref_rows in (["a", "c"], ["a", None], ["a", "a"], ["z"]):
        df = spark.createDataFrame(VALS, "k int, v string")
        lit = df.where(~df.v.isin(ref_rows)).select("k").collect()
        expected = {r.k for r in lit}
        got = {k for k, f in ref_verdict(spark, ref_rows).items() if f}
        assert got == expected, ref_rows


def test_referential_by_catalog_name(spark):
    spark.createDataFrame([("a",)], "r string").createOrReplaceTempView("ref_view_t")
    df = spark.createDataFrame(VALS, "k int, v string")
    rule = {
        "name": "fk",
        "type": "referential_integrity",
        "column": "v",
        "reference_table": "ref_view_t",
        "reference_column": "r",
        "priority": 1,
    }
    assert fails(validate(df, [rule])) == {1: False, 2: True, 3: False}


def test_referential_type_mismatch_refused(spark):
    df = spark.createDataFrame(VALS, "k int, v string")
    ref = spark.sql("SELECT DATE'2024-01-01' AS r")
    rule = {
        "name": "fk",
        "type": "referential_integrity",
        "column": "k",
        "reference_table": "ref",
        "reference_column": "r",
        "priority": 1,
    }
    with pytest.raises(RuleError):
        validate(df, [rule], refs={"ref": ref})


def test_referential_widening_integers(spark):
    df = spark.createDataFrame([(1, 1), (2, 5)], "k int, v int")
    ref = spark.createDataFrame([(1,)], "r bigint")
    rule = {
        "name": "fk",
        "type": "referential_integrity",
        "column": "v",
        "reference_table": "ref",
        "reference_column": "r",
        "priority": 1,
    }
    assert fails(validate(df, [rule], refs={"ref": ref})) == {1: False, 2: True}


def test_orphans_standalone(spark):
    df = spark.createDataFrame(VALS, "k int, v string")
    ref = spark.createDataFrame([("a",)], "r string")
    assert [r.k for r in orphans(df, "v", ref, "r").collect()] == [2]


def test_two_rules_same_reference_share_one_join(spark):
    df = spark.createDataFrame(VALS, "k int, v string")
    ref = spark.createDataFrame([("a",)], "r string")
    base = {"type": "referential_integrity", "column": "v", "reference_table": "ref", "reference_column": "r"}
    r = validate(df, [{**base, "name": "a", "priority": 1}, {**base, "name": "b", "priority": 2}], refs={"ref": ref})
    plan = r.flags._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 1
    assert fails(r) == {1: False, 2: True, 3: False}


# --------------------------------------------------------------- G3 z-score
def z_fails(spark, values, threshold=1.5):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "k int, x double")
    rule = {"name": "z", "type": "statistical", "column": "x", "statistic": "z_score", "threshold": threshold, "priority": 1}
    return fails(validate(df, [rule]))


def test_zscore_basic(spark):
    v = z_fails(spark, [1.0, 2.0, 3.0, 4.0, 100.0])
    assert v == {0: False, 1: False, 2: False, 3: False, 4: True}


def test_zscore_strict_threshold(spark):
    # values -1, 1: mean 0, stddev_samp sqrt(2) → |z| = 1/sqrt(2)
    v = z_fails(spark, [-1.0, 1.0], threshold=2 ** -0.5)
    assert v == {0: False, 1: False}


def test_zscore_constant_column_passes(spark):
    assert not any(z_fails(spark, [5.0, 5.0]).values())


def test_zscore_single_row_passes(spark):
    assert z_fails(spark, [5.0]) == {0: False}


def test_zscore_nulls_pass(spark):
    v = z_fails(spark, [1.0, None, 2.0, 3.0, 4.0, 100.0])
    assert v[1] is False and v[5] is True


def test_zscore_nan_poisons_mean(spark):
    v = z_fails(spark, [1.0, 2.0, float("nan"), None])
    assert v == {0: True, 1: True, 2: True, 3: False}


def test_zscore_rows_failed_by_other_rules_still_count(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([1, 2, 3, 4, 100])], "k int, x double")
    rules = [
        {"name": "range", "type": "value_range", "column": "x", "max": 50, "priority": 1},
        {"name": "z", "type": "statistical", "column": "x", "statistic": "z_score", "threshold": 1.5, "priority": 2},
    ]
    row = validate(df, rules).flagged.where("k = 4").collect()[0]
    assert row.failed_rules == ["range", "z"]


def test_outliers_standalone(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([1, 2, 3, 4, 100])], "k int, x double")
    assert [r.k for r in outliers(df, "x", 1.5).collect()] == [4]


def test_unique_long_key_is_grouped_by_digest(spark):
    from conftest import SF01
    from rowsieve.catalog.queries import table
    from rowsieve.plans import LAZY
    from rowsieve.plans import inspect as pi

    docs = table(spark, SF01, "documents")
    rule = [{"name": "u", "type": "unique_check", "column": "text", "priority": 1}]
    r = validate(docs, rule)
    lazy = validate(docs, rule, policy=LAZY)
    assert "sha2" in pi.optimized(lazy.flagged)  # whatever the policy and the size
    got = sorted((x.doc_id, tuple(x.failed_rules)) for x in r.flagged.collect())
    assert got == sorted((x.doc_id, tuple(x.failed_rules)) for x in lazy.flagged.collect())
    assert sum(1 for _, f in got if f) == 135


def test_unique_wide_key_composite_with_nulls(spark):
    rows = [(1, "a", "x"), (2, "a", "x"), (3, "a", None), (4, "a", None), (5, "b", "x")]
    df = spark.createDataFrame(rows, "k int, s string, t string")
    r = validate(df, [{"name": "u", "type": "unique_check", "columns": ["s", "t"], "priority": 1}])
    assert fails(r) == {1: True, 2: True, 3: False, 4: False, 5: False}


def test_same_catalog_reference_shares_one_join(spark):
    spark.createDataFrame([("a",)], "r string").createOrReplaceTempView("shared_ref_t")
    df = spark.createDataFrame(VALS, "k int, v string")
    base = {"type": "referential_integrity", "column": "v", "reference_table": "shared_ref_t", "reference_column": "r"}
    r = validate(df, [{**base, "name": "a", "priority": 1}, {**base, "name": "b", "priority": 2}])
    assert r.flags._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter") == 1
    assert len(r.helpers) == 1
