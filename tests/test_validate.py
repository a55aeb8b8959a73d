"""Verdicts, split, counts, summary, report data sets,
plus invariants on the driver's tables and on random frames."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF001
from rowsieve import RuleError, flag_rows, validate
from rowsieve.catalog.queries import DOCUMENT_RULES, EVENT_RULES, FULL_KEYS, FULL_RULES, full_input, table
from rowsieve.operators import report
from rowsieve.operators.stats import rule_counts_from_verdicts


@pytest.fixture(scope="module")
def full(spark):
    small_parts = table(spark, SF001, "part").where(F.col("p_size") <= 40)
    return validate(full_input(spark, SF001), FULL_RULES, refs={"small_parts": small_parts})


def test_good_plus_bad_is_input(spark, full):
    total = full_input(spark, SF001).count()
    good, bad = full.good.count(), full.bad.count()
    assert good + bad == total
    assert full.flagged.count() == total


def test_good_and_bad_partition_the_rows(spark):
    r = validate(table(spark, SF001, "events"), EVENT_RULES)
    good = {x.event_id for x in r.good.select("event_id").collect()}
    bad = {x.event_id for x in r.bad.select("event_id").collect()}
    assert not good & bad
    assert len(good | bad) == table(spark, SF001, "events").count()


def test_counts_equal_exploded_verdicts(full):
    v = {r.rule: r.failed_count for r in full.violations.collect()}
    exploded = {r.rule: r.failed_count for r in rule_counts_from_verdicts(full.flagged).collect()}
    assert {k: c for k, c in v.items() if c} == exploded
    assert list(v) == full.rules.names  # priority order, zeros included


def test_summary_matches_split(full):
    s = full.summary.collect()[0]
    assert s.total_records == s.passed_records + s.rejected_records
    assert s.rejected_records == full.bad.count()
    assert s.quality_pct == pytest.approx(100.0 * s.passed_records / s.total_records)


def test_quality_stats_dict(full):
    stats = full.quality_stats()
    assert set(stats) == {"total_records", "passed_records", "rejected_records", "quality_percentage", "rule_violations"}
    assert list(stats["rule_violations"]) == full.rules.names
    assert all(set(v) == {"failed_count"} for v in stats["rule_violations"].values())


def test_empty_input(spark):
    df = table(spark, SF001, "events").where("false")
    r = validate(df, EVENT_RULES)
    stats = r.quality_stats()
    assert stats["total_records"] == 0 and stats["quality_percentage"] == 0
    assert r.summary.collect()[0].quality_pct == 0.0
    assert [x.failed_count for x in r.violations.collect()] == [0, 0]


def test_verdict_order_follows_priority(spark):
    df = table(spark, SF001, "events")
    rules = [dict(EVENT_RULES[0], priority=5), dict(EVENT_RULES[1], priority=1)]
    row = validate(df, rules).bad.where(F.size("failed_rules") == 2).first()
    assert row.failed_rules == ["known_event_type", "value_in_range"]


def test_rule_order_does_not_change_verdict(spark):
    df = table(spark, SF001, "documents")
    refs = {"labels": table(spark, SF001, "labels")}
    a = validate(df, DOCUMENT_RULES, refs=refs).flagged.select("doc_id", F.array_sort("failed_rules").alias("f"))
    shuffled = list(DOCUMENT_RULES)
    random.Random(7).shuffle(shuffled)
    shuffled = [dict(r, priority=1) for r in shuffled]
    b = validate(df, shuffled, refs=refs).flagged.select("doc_id", F.array_sort("failed_rules").alias("f"))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_single_pass_equals_rule_by_rule(spark):
    df = table(spark, SF001, "documents")
    refs = {"labels": table(spark, SF001, "labels")}
    together = {r.doc_id: r.failed_rules for r in validate(df, DOCUMENT_RULES, refs=refs).flagged.collect()}
    separate = {k: [] for k in together}
    for rule in DOCUMENT_RULES:  # already in priority order
        for r in validate(df, [rule], refs=refs).bad.select("doc_id").collect():
            separate[r.doc_id].append(rule["name"])
    assert together == separate


def test_columns_kept(spark, full):
    cols = full_input(spark, SF001).columns
    assert full.flagged.columns == cols + ["failed_rules"]
    assert full.good.columns == cols
    assert full.bad.columns == cols + ["failed_rules"]


def test_verdict_column_clash(spark):
    df = table(spark, SF001, "events").withColumn("failed_rules", F.lit("x"))
    with pytest.raises(RuleError):
        validate(df, EVENT_RULES)
    r = validate(df, EVENT_RULES, verdict_col="dq_failures")
    assert "dq_failures" in r.flagged.columns


def test_helper_prefix_clash(spark):
    df = table(spark, SF001, "events").withColumn("__rs_x", F.lit(1))
    with pytest.raises(RuleError):
        validate(df, EVENT_RULES)


def test_flag_rows_is_row_local_only(spark):
    df = table(spark, SF001, "documents")
    with pytest.raises(RuleError):
        flag_rows(df, DOCUMENT_RULES)
    out = flag_rows(df, DOCUMENT_RULES[:1])
    assert out.columns[-1] == "failed_rules"


def test_no_rules(spark):
    df = table(spark, SF001, "events")
    r = validate(df, [])
    assert r.bad.count() == 0 and r.good.count() == df.count()
    assert r.violations.count() == 0


def test_failed_rules_summary_and_exploded(full):
    s = full.failed_rules_summary(FULL_KEYS)
    assert s.columns == FULL_KEYS + ["failed_rules"]
    e = full.exploded(FULL_KEYS)
    assert e.columns == FULL_KEYS + ["rule"]
    assert e.count() == sum(r.failed_count for r in full.violations.collect())


def test_report_data_sets(full):
    dist = {r.status: r.records for r in report.record_distribution(full).collect()}
    s = full.summary.collect()[0]
    assert dist == {"passed": s.passed_records, "rejected": s.rejected_records}
    ranking = report.violations_ranking(full).collect()
    counts = [r.failed_count for r in ranking]
    assert counts == sorted(counts, reverse=True) and len(ranking) == len(FULL_RULES)
    top = report.worst_rules(full, 5).collect()
    assert [tuple(r) for r in top] == [tuple(r) for r in ranking[:5]]
    cards = report.metric_cards(full).collect()[0]
    assert cards.quality_pct == round(s.quality_pct, 2)
    sample = report.rejected_sample(full, FULL_KEYS, 10).collect()
    assert len(sample) == 10
    keys = [(r.l_orderkey, r.l_linenumber) for r in sample]
    assert keys == sorted(keys)
    assert all(isinstance(r.failed_rules, str) and r.failed_rules for r in sample)


def test_checkpointed_result(spark):
    r = validate(table(spark, SF001, "events"), EVENT_RULES).checkpoint()
    assert "LogicalRDD" in r.bad._jdf.queryExecution().optimizedPlan().toString()
    assert r.bad.count() + r.good.count() == table(spark, SF001, "events").count()


# ---- random frames: single pass == one rule at a time, good + bad = input
ROW = st.tuples(
    st.one_of(st.none(), st.integers(-5, 25)),
    st.one_of(st.none(), st.sampled_from(["a", "b", "ab", "", "zzz"])),
    st.one_of(st.none(), st.floats(allow_nan=True, allow_infinity=True, width=32)),
)
RANDOM_RULES = [
    {"name": "n_range", "type": "value_range", "column": "n", "min": 0, "max": 20, "priority": 2},
    {"name": "s_null", "type": "null_check", "column": "s", "priority": 1},
    {"name": "s_allowed", "type": "allowed_values", "column": "s", "allowed_values": ["a", "b"], "priority": 3},
    {"name": "s_len", "type": "length_check", "column": "s", "max_length": 2, "priority": 1},
    {"name": "x_range", "type": "value_range", "column": "x", "min": -1.0, "priority": 4},
    {"name": "n_lt_x", "type": "cross_column", "columns": ["n", "x"], "condition": "n < x", "priority": 2},
    {"name": "s_unique", "type": "unique_check", "column": "s", "priority": 5},
    {"name": "n_z", "type": "statistical", "column": "n", "statistic": "z_score", "threshold": 1.2, "priority": 5},
]


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(ROW, min_size=0, max_size=25))
def test_random_frames_single_pass_equals_rule_by_rule(spark, rows):
    data = [(i, *r) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, "k int, n int, s string, x float")
    together = {r.k: r.failed_rules for r in validate(df, RANDOM_RULES).flagged.collect()}
    assert len(together) == len(rows)
    separate = {k: [] for k in together}
    ordered = sorted(RANDOM_RULES, key=lambda r: r["priority"])
    for rule in ordered:
        for r in validate(df, [rule]).bad.select("k").collect():
            separate[r.k].append(rule["name"])
    assert together == separate


def test_materialize_input_cuts_lineage(spark):
    small_parts = table(spark, SF001, "part").where(F.col("p_size") <= 40)
    refs = {"small_parts": small_parts}
    cut = validate(full_input(spark, SF001), FULL_RULES, refs=refs, materialize_input=True)
    plan = cut.flags._jdf.queryExecution().optimizedPlan().toString()
    assert "lineitem.parquet" not in plan and "LogicalRDD" in plan  # the join is not recomputed
    plain = validate(full_input(spark, SF001), FULL_RULES, refs=refs)
    assert cut.quality_stats() == plain.quality_stats()


def test_missing_columns_named_in_error(spark):
    ev = table(spark, SF001, "events")
    with pytest.raises(RuleError, match="nope"):
        validate(ev, [{"name": "x", "type": "null_check", "column": "nope", "priority": 1}])
    with pytest.raises(RuleError, match="'k'"):
        validate(ev, [{"name": "x", "type": "completeness_check", "columns": ["value", "k"], "priority": 1}])
    with pytest.raises(RuleError, match="no_such"):
        validate(ev, [{"name": "x", "type": "referential_integrity", "column": "user_id",
                       "reference_table": "c", "reference_column": "no_such", "priority": 1}],
                 refs={"c": table(spark, SF001, "customer")})
