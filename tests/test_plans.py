"""Plan-shape checks: linear plan size, no gather of raw rows, pruning and
push-down reach the scan, broadcast only under a measured bound, AQE
splits a skewed join, codegen covers the verdict."""

import re
import time

import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF01
from rowsieve import validate
from rowsieve.catalog.queries import DOCUMENT_RULES, FULL_RULES, full_input, table
from rowsieve.plans import LAZY, JoinPolicy
from rowsieve.plans import inspect as pi


def n_rules(n):
    return [
        {"name": f"q{i}", "type": "value_range", "column": "l_quantity", "min": i % 20, "max": 50 - i % 7, "priority": 1 + i % 5}
        for i in range(n)
    ]


def test_plan_grows_linearly_with_rules(spark):
    li = table(spark, SF001, "lineitem")
    sizes = {n: pi.case_nodes(validate(li, n_rules(n)).bad) for n in (4, 8, 16, 32)}
    # one CASE per rule in the verdict array; no doubling per rule
    assert sizes[32] <= 2 * 32
    assert sizes[32] / sizes[4] <= 8.5


def test_many_rules_plan_quickly(spark):
    li = table(spark, SF001, "lineitem")
    t = time.time()
    validate(li, n_rules(60)).bad.count()
    assert time.time() - t < 30


def test_no_single_partition_gather_of_rows(spark):
    small_parts = table(spark, SF001, "part").where(F.col("p_size") <= 40)
    r = validate(full_input(spark, SF001), FULL_RULES, refs={"small_parts": small_parts})
    for df in (r.bad, r.counts, r.flagged):
        text = pi.physical(df)
        assert pi.single_partition_exchanges(text), "z-score aggregate expected"
        assert not pi.gathers_raw_rows(text)
        assert "Window" not in text
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_column_pruning_and_pushdown(spark):
    li = table(spark, SF01, "lineitem").where(F.col("l_returnflag") == "R")
    r = validate(li, [{"name": "q", "type": "value_range", "column": "l_quantity", "min": 5, "priority": 1}])
    text = pi.physical(r.counts)
    assert "ReadSchema: struct<l_quantity:double,l_returnflag:string>" in text
    assert "EqualTo(l_returnflag,R)" in text


def test_verdict_inside_whole_stage_codegen(spark):
    ev = table(spark, SF001, "events")
    r = validate(ev, [{"name": "v", "type": "value_range", "column": "value", "min": 1, "priority": 1}])
    text = pi.physical(r.flagged)
    project = [line for line in text.splitlines() if "failed_rules" in line and "Project" in line]
    assert project and project[0].lstrip(" +-:").startswith("*(")


def _jobs_for(spark, group, action):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(group, group)
    try:
        action()
    finally:
        spark.sparkContext.setJobGroup("", "")
    return len(tracker.getJobIdsForGroup(group))


def test_counts_cost_the_same_jobs_for_any_rule_count(spark):
    """All per-rule counts and the summary come from one aggregate query (AQE
    runs it as a map-stage job plus a result job): not one job per rule."""
    ev = table(spark, SF001, "events")

    def rules(n):
        return [{"name": f"v{i}", "type": "value_range", "column": "value", "min": i, "priority": 1} for i in range(n)]

    one = _jobs_for(spark, "counts-1", lambda: validate(ev, rules(1)).quality_stats())
    ten = _jobs_for(spark, "counts-10", lambda: validate(ev, rules(10)).quality_stats())
    assert ten == one <= 2


def test_lazy_policy_builds_without_jobs(spark):
    docs = table(spark, SF001, "documents")
    refs = {"labels": table(spark, SF001, "labels")}
    assert _jobs_for(spark, "build-lazy", lambda: validate(docs, DOCUMENT_RULES, refs=refs, policy=LAZY)) == 0


def test_broadcast_only_under_measured_bound(spark):
    docs = table(spark, SF001, "documents")
    refs = {"labels": table(spark, SF001, "labels")}
    rules = DOCUMENT_RULES[:3]
    small = validate(docs, rules, refs=refs)
    assert all(v["broadcast"] for v in small.join_plan().values())
    assert pi.optimized(small.bad).count("strategy=broadcast") == 2
    assert pi.joins(pi.physical(small.bad)).count("BroadcastHashJoin") == 2
    tight = validate(docs, rules, refs=refs, policy=JoinPolicy(broadcast_max_rows=1))
    assert not any(v["broadcast"] for v in tight.join_plan().values())
    assert "strategy=broadcast" not in pi.optimized(tight.bad)  # no forced broadcast
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in pi.physical(tight.bad)
        assert sorted(map(tuple, small.bad.collect())) == sorted(map(tuple, tight.bad.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_byte_bound_applies(spark):
    docs = table(spark, SF001, "documents")
    rule = [{"name": "u", "type": "unique_check", "column": "text", "priority": 1}]
    r = validate(docs, rule, policy=JoinPolicy(broadcast_max_bytes=10))
    plan = r.join_plan()
    assert plan["__rs_dup0"]["bytes"] > 10 and not plan["__rs_dup0"]["broadcast"]
    assert r.bad.count() == validate(docs, rule).bad.count()


@pytest.fixture
def skew_conf(spark):
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_aqe_alone_does_not_split_this_join(spark, skew_conf):
    """Why the split is explicit: with skew handling fully enabled and tiny
    thresholds, AQE still leaves the hot key on one task, because the
    helper side of the join is an aggregate, not a plain shuffle stage."""
    ev = table(spark, SF01, "events").withColumn(
        "hot_user", F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("event_id"))
    )
    rule = [{"name": "u", "type": "unique_check", "column": "hot_user", "priority": 1}]
    r = validate(ev, rule, policy=LAZY)
    plan = pi.final_physical(r.bad)
    assert "SortMergeJoin" in plan
    assert "isSkewJoin=true" not in plan
    assert r.bad.count() == ev.where("event_id % 3 = 0").count()


# ---- explicit hot-key split on the shuffle path
def hot_events(spark):
    # a third of the rows share one key; the rest form ~2000 small duplicate groups
    return table(spark, SF01, "events").withColumn(
        "hot_user", F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("event_id") % 2000)
    )


SPLIT = JoinPolicy(broadcast_max_rows=100, heavy_key_rows=100)


def test_duplicate_join_splits_hot_key(spark):
    ev = hot_events(spark)
    rule = [{"name": "u", "type": "unique_check", "column": "hot_user", "priority": 1}]
    split = validate(ev, rule, policy=SPLIT)
    (info,) = split.join_plan().values()
    assert info["path"] == "shuffle+split" and not info["broadcast"]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = pi.physical(split.flagged)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # hot keys answered by a broadcast join; the rest by a shuffle join on (key, salt)
    assert "BroadcastHashJoin" in plan
    smj = [line for line in plan.splitlines() if "SortMergeJoin" in line]
    assert smj and "__rs_dup0_s" in smj[0].split("LeftOuter")[0]  # an equi-join key
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning(__rs_dup0_k0" in line]
    assert len(shuffles) == 2 and all("__rs_dup0_s" in line for line in shuffles)  # salt spreads rows
    ref = validate(ev, rule)  # broadcast path
    assert ref.join_plan()["__rs_dup0"]["path"] == "broadcast"
    assert sorted(map(tuple, split.flagged.collect())) == sorted(map(tuple, ref.flagged.collect()))


def test_referential_join_splits_hot_value(spark):
    ev = hot_events(spark).withColumn("hot_user", F.when(F.col("hot_user") == 7, F.lit(None)).otherwise(F.col("hot_user")))
    ref = table(spark, SF01, "customer")
    rule = [
        {
            "name": "fk",
            "type": "referential_integrity",
            "column": "hot_user",
            "reference_table": "c",
            "reference_column": "c_custkey",
            "priority": 1,
        }
    ]
    split = validate(ev, rule, refs={"c": ref}, policy=SPLIT)
    (info,) = split.join_plan().values()
    assert info["path"] == "shuffle+split"
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(1 << 10))
    try:
        plan = pi.physical(split.flagged)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning(__rs_ref0_p" in line]
    assert len(shuffles) == 2 and all("__rs_ref0_s" in line for line in shuffles)
    expected = validate(ev, rule, refs={"c": ref})
    assert expected.join_plan()["__rs_ref0"]["path"] == "broadcast"
    assert sorted(map(tuple, split.flagged.collect())) == sorted(map(tuple, expected.flagged.collect()))
    # same answer as SQL NOT IN
    ev.createOrReplaceTempView("hot_ev")
    ref.createOrReplaceTempView("hot_c")
    sql = spark.sql("SELECT event_id FROM hot_ev WHERE hot_user NOT IN (SELECT c_custkey FROM hot_c)")
    assert sorted(r.event_id for r in split.bad.collect()) == sorted(r.event_id for r in sql.collect())


def test_salt_spreads_hot_and_null_keys(spark):
    from rowsieve.plans.joins import content_hash, salt_expr

    ev = hot_events(spark).withColumn(
        "k", F.when(F.col("event_id") % 5 == 1, F.lit(None)).otherwise(F.col("hot_user"))
    )
    parts = 16
    content = content_hash(ev, ev.columns)
    salted = ev.withColumn("s", salt_expr(F.col("hot_user") == -1, ["k"], content))
    # where the shuffle join would send each row: hash of (key, salt)
    sizes = [r["n"] for r in salted.repartition(parts, "k", "s").groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    unsalted = [r["n"] for r in ev.repartition(parts, "k").groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    total = ev.count()
    assert max(unsalted) > 4 * total / parts  # without the salt one task gets several shares
    assert max(sizes) < 2.5 * total / parts  # with it, every task gets about its share


def test_session_without_broadcast_joins_is_honoured(spark):
    docs = table(spark, SF001, "documents")
    refs = {"labels": table(spark, SF001, "labels")}
    expected = validate(docs, DOCUMENT_RULES, refs=refs)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        r = validate(docs, DOCUMENT_RULES, refs=refs)
        assert not any(v["broadcast"] for v in r.join_plan().values())
        assert "strategy=broadcast" not in pi.optimized(r.bad)
        assert sorted(map(tuple, r.flagged.collect())) == sorted(map(tuple, expected.flagged.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_salt_does_not_depend_on_row_order(spark):
    from rowsieve.plans.joins import content_hash, salt_expr

    ev = hot_events(spark)

    def reducers(df):
        salted = df.withColumn("s", salt_expr(F.col("hot_user") == -1, ["hot_user"], content_hash(ev, ev.columns)))
        placed = salted.repartition(16, "hot_user", "s").select("event_id", F.spark_partition_id().alias("p"))
        return {r.event_id: r.p for r in placed.collect()}

    plain = reducers(ev)
    assert plain == reducers(ev.repartition(5, "value").sortWithinPartitions(F.desc("event_id")))
    assert len(set(plain.values())) == 16


def test_hottest_keys_are_split_off_even_if_hot_keys_are_many(spark):
    # 51 keys over heavy_key_rows, bound 10: the one that holds a third is still split off
    ev = table(spark, SF01, "events").withColumn(
        "k", F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("event_id") % 50)
    )
    rule = [{"name": "u", "type": "unique_check", "column": "k", "priority": 1}]
    split = validate(ev, rule, policy=JoinPolicy(broadcast_max_rows=10, heavy_key_rows=20))
    (info,) = split.join_plan().values()
    assert info["path"] == "shuffle+split" and info["rows"] == 51
    (helper,) = split.helpers.values()
    assert helper.hot.rows <= 10
    assert sorted(map(tuple, split.flagged.collect())) == sorted(map(tuple, validate(ev, rule).flagged.collect()))


def test_long_keys_are_shuffled_as_digests(spark):
    from rowsieve.operators.uniqueness import duplicate_keys

    plan = pi.physical(duplicate_keys(table(spark, SF01, "documents"), ["text"], ["k"]))
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and "text" not in " ".join(exchanges)
    assert "sha2" in plan


def test_exploded_does_not_filter_on_the_verdict_again(spark):
    plan = pi.physical(validate(table(spark, SF001, "lineitem"), n_rules(4)).exploded(["l_orderkey"]))
    assert "size(" not in plan.lower()


def test_reference_is_scanned_once_while_building(spark):
    ev, ref = table(spark, SF001, "events"), table(spark, SF001, "customer")
    rule = [{"name": "fk", "type": "referential_integrity", "column": "user_id", "reference_table": "c", "reference_column": "c_custkey", "priority": 1}]
    plan = pi.physical(validate(ev, rule, refs={"c": ref}).flagged)
    assert "customer.parquet" not in plan  # known from the written key set


def test_helper_sets_share_one_broadcast_budget(spark):
    docs = table(spark, SF001, "documents")
    rules = [{"name": f"u{c}", "type": "unique_check", "column": c, "priority": 1} for c in ("lang", "source")]
    whole = validate(docs, rules)
    assert [v["path"] for v in whole.join_plan().values()] == ["broadcast", "broadcast"]
    first = whole.join_plan()["__rs_dup0"]["bytes"]
    tight = validate(docs, rules, policy=JoinPolicy(broadcast_max_bytes=first))
    assert tight.join_plan()["__rs_dup0"]["path"] == "broadcast" and not tight.join_plan()["__rs_dup1"]["broadcast"]
    assert sorted(map(str, tight.flagged.collect())) == sorted(map(str, whole.flagged.collect()))


def test_hot_keys_are_split_when_the_shared_budget_is_spent(spark):
    """A first rule's set fills the budget; the second rule's hot key is split off all the same."""
    ev = hot_events(spark)
    rules = [{"name": n, "type": "unique_check", "column": c, "priority": 1} for n, c in (("t", "event_type"), ("u", "hot_user"))]
    first = validate(ev, rules).join_plan()["__rs_dup0"]["bytes"]
    tight = validate(ev, rules, policy=JoinPolicy(broadcast_max_bytes=first, heavy_key_rows=1_000))
    assert [v["path"] for v in tight.join_plan().values()] == ["broadcast", "shuffle+split"]
    assert tight.helpers["__rs_dup1"].hot.rows == 1
    assert sorted(map(tuple, tight.flagged.collect())) == sorted(map(tuple, validate(ev, rules).flagged.collect()))


def test_twenty_equally_hot_keys_over_the_bound_are_split(spark):
    """More hot keys of one size than may be broadcast: as many as fit are split off."""
    ev = table(spark, SF01, "events").withColumn("k", F.col("event_id") % 20)
    rule = [{"name": "u", "type": "unique_check", "column": "k", "priority": 1}]
    split = validate(ev, rule, policy=JoinPolicy(broadcast_max_rows=10, heavy_key_rows=100))
    (helper,) = split.helpers.values()
    assert helper.path == "shuffle+split" and helper.hot.rows == 10
    assert sorted(map(tuple, split.flagged.collect())) == sorted(map(tuple, validate(ev, rule).flagged.collect()))


@pytest.fixture
def no_small_broadcasts(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_equal_rows_scatter_by_their_place(spark, tmp_out, no_small_broadcasts):
    """20,000 equal rows of 60,000 in one column: no reducer gets more than twice the median."""
    from rowsieve.plans.joins import row_place, salt_expr

    path = f"{tmp_out}/equal"
    spark.range(60_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 25_000).alias("k")).repartition(4).write.parquet(path)
    df = spark.read.parquet(path)
    salted = df.withColumn("s", salt_expr(F.col("k") == -1, ["k"], row_place(df)))
    sizes = sorted(r["n"] for r in salted.repartition(16, "k", "s").groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect())
    assert len(sizes) == 16 and sizes[-1] < 2 * sizes[8]
    rule = [{"name": "u", "type": "unique_check", "column": "k", "priority": 1}]
    split = validate(df, rule, policy=SPLIT)
    assert next(iter(split.join_plan().values()))["path"] == "shuffle+split"
    assert split.quality_stats()["rule_violations"] == validate(df, rule).quality_stats()["rule_violations"]


def test_shuffle_path_reads_only_the_rule_s_column(spark, no_small_broadcasts):
    docs = table(spark, SF01, "documents")
    for rule, refs in (
        ({"name": "u", "type": "unique_check", "column": "lang", "priority": 1}, None),
        ({"name": "r", "type": "referential_integrity", "column": "lang", "reference_table": "t", "reference_column": "source", "priority": 1}, {"t": docs.select("source")}),
    ):
        wide = validate(docs, [rule], refs=refs, policy=JoinPolicy(broadcast_max_rows=1, heavy_key_rows=10))
        assert next(iter(wide.join_plan().values()))["path"] == "shuffle+split"
        plan = pi.physical(wide.counts)
        assert "SortMergeJoin" in plan
        read = set(re.findall(r"ReadSchema: struct<(.*?)>", plan))
        assert read == {"lang:string,_tmp_metadata_row_index:bigint"}  # the row's number is counted, not read
        assert wide.counts.collect() == validate(docs, [rule], refs=refs).counts.collect()


def test_rows_of_no_file_are_salted_by_content(spark):
    from rowsieve.plans.joins import row_place

    ev = table(spark, SF01, "events")
    assert row_place(ev.where("value > 1").select("user_id")) is not None
    assert row_place(spark.range(5).toDF("k")) is None and row_place(ev.groupBy("user_id").count()) is None
    assert row_place(ev.select(F.lit(1).alias("_metadata"))) is None


def test_rules_of_one_key_share_one_wide_shuffle(spark, no_small_broadcasts):
    """Four rules on one key whose sets are too large to broadcast: the input is exchanged once."""
    ev = hot_events(spark).withColumn("who", F.when(F.col("event_id") % 7 > 0, F.col("hot_user"))).drop("hot_user")
    on = {"key_columns": ["who"], "priority": 1}
    rules = [
        {"name": "u", "type": "unique_check", "column": "who", "priority": 1},
        {"name": "f", "type": "functional_dependency", "column": "event_type", **on},
        {"name": "r", "type": "referential_integrity", "column": "who", "reference_table": "c", "reference_column": "c_custkey", "priority": 2},
        {"name": "m", "type": "statistical", "statistic": "mad", "column": "value", "threshold": 3, **on},
        {"name": "other", "type": "unique_check", "column": "user_id", "priority": 3},
    ]
    refs = {"c": table(spark, SF01, "customer").where("c_custkey % 2 = 0")}
    wide = validate(ev, rules, refs=refs, policy=SPLIT)
    paths = [v["path"] for v in wide.join_plan().values()]
    assert sorted(paths) == ["shuffle"] + ["shuffle+split"] * 4  # no user_id is hot
    plan = pi.physical(wide.flagged)
    assert plan.count("SortMergeJoin") == 2  # one for ``who``, one for ``user_id``
    assert len(re.findall(r"FileScan parquet .*events.parquet", plan)) == 1 and "props" not in pi.physical(wide.counts)
    want = validate(ev, rules, refs=refs, policy=LAZY)  # a join per rule
    assert sorted(map(str, wide.flagged.collect())) == sorted(map(str, want.flagged.collect()))
    assert all(v["failed_count"] for v in want.quality_stats()["rule_violations"].values())
