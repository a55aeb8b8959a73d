"""G1 / G2 on random frames against a brute-force Python oracle, under every
join path: measured broadcast, shuffle with hot keys split off, and lazy."""

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rowsieve import validate
from rowsieve.plans import DEFAULT, LAZY, JoinPolicy

POLICIES = {
    "broadcast": DEFAULT,
    "split": JoinPolicy(broadcast_max_rows=2, heavy_key_rows=3),
    "lazy": LAZY,
}
VALUE = st.one_of(st.none(), st.integers(0, 6), st.just(7))  # 7 is made hot below
SETTINGS = settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))


def frame(spark, values, hot):
    rows = [(i, v) for i, v in enumerate(values)] + [(len(values) + j, 7) for j in range(hot)]
    return spark.createDataFrame(rows, "k int, v int"), [v for _, v in rows]


def verdict(result):
    return {r.k: bool(r.failed_rules) for r in result.flagged.select("k", "failed_rules").collect()}


@pytest.mark.parametrize("policy", sorted(POLICIES))
@SETTINGS
@given(values=st.lists(VALUE, max_size=30), hot=st.integers(0, 12))
def test_unique_matches_brute_force(spark, policy, values, hot):
    df, vals = frame(spark, values, hot)
    counts = Counter(v for v in vals if v is not None)
    expected = {i: v is not None and counts[v] > 1 for i, v in enumerate(vals)}
    rule = [{"name": "u", "type": "unique_check", "column": "v", "priority": 1}]
    r = validate(df, rule, policy=POLICIES[policy])
    assert verdict(r) == expected
    r.unpersist()


@pytest.mark.parametrize("policy", sorted(POLICIES))
@SETTINGS
@given(
    values=st.lists(VALUE, max_size=30),
    hot=st.integers(0, 12),
    ref=st.lists(st.one_of(st.none(), st.integers(0, 7)), max_size=8),
)
def test_referential_matches_sql_not_in(spark, policy, values, hot, ref):
    df, vals = frame(spark, values, hot)
    ref_df = spark.createDataFrame([(x,) for x in ref], "r int")
    present = {x for x in ref if x is not None}

    def not_in(v):  # SQL: NOT (v IN ref), TRUE only
        if not ref:
            return True
        if v is None:
            return False
        if v in present:
            return False
        return None not in ref

    expected = {i: not_in(v) for i, v in enumerate(vals)}
    rule = [{"name": "fk", "type": "referential_integrity", "column": "v",
             "reference_table": "ref", "reference_column": "r", "priority": 1}]
    r = validate(df, rule, refs={"ref": ref_df}, policy=POLICIES[policy])
    assert verdict(r) == expected
    r.unpersist()
