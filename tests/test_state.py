"""Batches against kept state: equal to one run, in any order, replayed, and on streams."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from rowsieve import RuleError, validate
from rowsieve.catalog.queries import table
from rowsieve.operators.state import KeptState
from rowsieve.plans import LAZY, JoinPolicy
from rowsieve.streaming import route_stream

RULES = [
    {"name": "once", "type": "unique_check", "columns": ["k", "s"], "priority": 1},
    {"name": "far", "type": "statistical", "column": "v", "statistic": "z_score", "threshold": 1.5, "priority": 2},
    {"name": "small", "type": "value_range", "column": "v", "max": 90, "priority": 3},
]
SCHEMA = "id int, k int, s string, v double, t timestamp"
ROWS = [(i, None if i % 11 == 0 else i * i % 23, None if i % 13 == 0 else "ab"[i % 2] * 300, None if i % 7 == 0 else float(i * 37 % 101)) for i in range(120)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, None) for r in rows], SCHEMA)


def parts(n=3):
    return [ROWS[i::n] for i in range(n)]


def stored(spark, path, table):
    return sorted(map(tuple, spark.read.parquet(f"{path}/{table}").collect()), key=str)


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1), (0, 0, 1, 2, 0, 1)])
def test_state_after_batches_equals_one_run(spark, tmp_out, order):
    state = KeptState(spark, f"{tmp_out}/s", RULES)
    for b in order:
        state.record(state.validate(frame(spark, parts()[b]), b), b)
    whole = validate(frame(spark, ROWS), RULES)
    counts = state.key_counts(["k", "s"])
    failed = {r: v["failed_count"] for r, v in whole.quality_stats()["rule_violations"].items()}
    assert counts.where("n > 1").agg(F.sum("n")).first()[0] == failed["once"]
    m = state.moments()["v"]
    known = [r[3] for r in ROWS if r[3] is not None]
    mean = sum(known) / len(known)
    assert m["n"] == len(known) and m["mean"] == pytest.approx(mean)
    assert m["sd"] == pytest.approx((sum((x - mean) ** 2 for x in known) / (len(known) - 1)) ** 0.5)
    kept = {r.rule: (r.failed_count, r.total_records) for r in state.counts().collect()}
    assert kept["small"] == (failed["small"], 120) and state.batches() == ["0", "1", "2"]


def test_last_batch_is_judged_as_in_one_run(spark, tmp_out):
    state = KeptState(spark, tmp_out + "/s", RULES)
    whole = {r.id: r.failed_rules for r in validate(frame(spark, ROWS), RULES).flagged.collect()}
    for b, rows in enumerate(parts()):
        flagged = state.validate(frame(spark, rows), b, policy=JoinPolicy(broadcast_max_rows=2, heavy_key_rows=2) if b == 2 else JoinPolicy()).flagged
    assert {r.id: r.failed_rules for r in flagged.collect()} == {i: whole[i] for i in whole if i % 3 == 2}


def test_replay_changes_nothing(spark, tmp_out):
    state = KeptState(spark, f"{tmp_out}/s", RULES)
    first = [sorted((r.id, tuple(r.failed_rules)) for r in state.validate(frame(spark, p), b).flagged.collect()) for b, p in enumerate(parts())]
    keys = state._table(["k", "s"])
    before = stored(spark, f"{tmp_out}/s", keys), stored(spark, f"{tmp_out}/s", "moments")
    again = sorted((r.id, tuple(r.failed_rules)) for r in state.validate(frame(spark, parts()[2]), 2).flagged.collect())
    assert again == first[2]
    assert (stored(spark, f"{tmp_out}/s", keys), stored(spark, f"{tmp_out}/s", "moments")) == before


def test_repeated_since_names_the_rows_written_before(spark, tmp_out):
    state = KeptState(spark, f"{tmp_out}/s", [{"name": "u", "type": "unique_check", "column": "k", "priority": 1}])
    df = spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "id int, k int")
    assert state.validate(df, "a").bad.count() == 0
    assert [r.id for r in state.validate(df.where("id = 2"), "b").bad.collect()] == [2]
    assert [r.k0 for r in state.repeated_since(["k"], "b").collect()] == [2]


def test_retention_forgets_old_keys(spark, tmp_out):
    rows = spark.createDataFrame([(1, 5, "2024-01-01 00:00:00"), (2, 6, "2024-01-09 00:00:00")], "id int, k int, at string").withColumn("t", F.col("at").cast("timestamp"))
    rule = [{"name": "u", "type": "unique_check", "column": "k", "priority": 1}]
    state = KeptState(spark, f"{tmp_out}/s", rule, time_column="t", retention="7 DAYS")
    late = spark.createDataFrame([(3, 5, "2024-01-09 12:00:00"), (4, 6, "2024-01-09 12:00:00")], "id int, k int, at string").withColumn("t", F.col("at").cast("timestamp"))
    state.validate(rows, 0)
    assert [r.id for r in state.validate(late, 1).bad.collect()] == [4]
    state.compact("old", [0])
    state.drop([0])
    assert {r.k0: r.n for r in state.key_counts(["k"]).collect()} == {6: 2, 5: 1}


def test_compact_keeps_the_sums(spark, tmp_out):
    state = KeptState(spark, f"{tmp_out}/s", RULES)
    for b, rows in enumerate(parts()):
        state.record(state.validate(frame(spark, rows), b), b)
    before = sorted(map(tuple, state.key_counts(["k", "s"]).collect())), state.moments(), sorted(map(str, state.counts().collect()))
    state.compact("0-1", [0, 1])
    state.drop([0, 1])
    state.drop([0, 1])
    after = sorted(map(tuple, state.key_counts(["k", "s"]).collect())), state.moments(), sorted(map(str, state.counts().collect()))
    assert after[0] == before[0] and after[2] == before[2]
    assert after[1]["v"] == pytest.approx(before[1]["v"])


def test_empty_batches_and_refusals(spark, tmp_out):
    state = KeptState(spark, f"{tmp_out}/s", RULES)
    assert state.moments() == {} and state.batches() == []
    with pytest.raises(RuleError):
        state.key_counts(["k", "s"])
    state.record(state.validate(frame(spark, []), "e"), "e")
    flagged = state.validate(frame(spark, ROWS), "x").flagged
    assert sorted((r.id, r.failed_rules) for r in flagged.collect()) == sorted((r.id, r.failed_rules) for r in validate(frame(spark, ROWS), RULES).flagged.collect())
    for bad in ({"batch": "a/b"}, {"batch": 1, "policy": LAZY}):
        with pytest.raises(RuleError):
            state.validate(frame(spark, ROWS), **bad)
    with pytest.raises(RuleError):
        KeptState(spark, tmp_out, RULES, retention="1 DAYS")
    with pytest.raises(RuleError):
        KeptState(spark, tmp_out, [{"name": "f", "type": "functional_dependency", "key_columns": ["k"], "column": "v", "priority": 1}])


def test_stream_with_state_restarts_and_equals_the_batch_answer(spark):
    """Four batches, the query stopped after two and started again; the third
    batch is lost after its state was written and runs a second time."""
    base = tempfile.mkdtemp(prefix="rowsieve-state-", dir="/tmp")
    events = table(spark, SF01, "events").selectExpr("event_id", "user_id", "event_type", "value", "ts")
    files = f"{base}/in"
    rules = [
        {"name": "u", "type": "unique_check", "columns": ["user_id", "event_type"], "priority": 1},
        {"name": "v", "type": "value_range", "column": "value", "min": 5, "priority": 2},
    ]
    options = {"path": f"{base}/out", "checkpoint_location": f"{base}/ckpt", "state_path": f"{base}/state"}

    def run():
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(files)
        route_stream(stream, rules, **options).awaitTermination(300)

    events.where("event_id % 4 < 2").repartition(2, "event_id").write.parquet(files)
    run()
    events.where("event_id % 4 = 2").coalesce(1).write.mode("append").parquet(files)
    lost = events.where("event_id % 4 = 2")
    KeptState(spark, options["state_path"], rules).validate(lost, 2).counts.collect()  # ... and the task died here
    run()
    events.where("event_id % 4 = 3").coalesce(1).write.mode("append").parquet(files)
    run()
    out = spark.read.option("basePath", options["path"]).parquet(f"{options['path']}/batch_id=*")
    assert out.count() == events.count() and out.select("batch_id").distinct().count() == 4
    later = spark.read.option("basePath", f"{options['path']}/repeated").parquet(f"{options['path']}/repeated/rule=u")
    from rowsieve.operators.uniqueness import key_value

    keyed = out.withColumns({"k0": key_value(out, "user_id"), "k1": key_value(out, "event_type")})
    since = keyed.join(later.select("k0", "k1").distinct(), ["k0", "k1"], "left_semi").select("event_id")
    got = out.where(F.array_contains("failed_rules", "u")).select("event_id").union(since).distinct()
    want = validate(events, rules[:1]).bad.select("event_id")
    assert want.count() > 100 and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    ranges = out.where(F.array_contains("failed_rules", "v")).select("event_id")
    assert ranges.exceptAll(validate(events, rules[1:]).bad.select("event_id")).isEmpty()
    assert sorted(os.listdir(f"{options['path']}/repeated/rule=u"))[:1]
