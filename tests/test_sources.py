"""S1–S6 sources and K1–K2 sinks, on files derived from the given tables."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from rowsieve import validate
from rowsieve.catalog.queries import table
from rowsieve.sources import (
    read_csv,
    read_parquet,
    read_table,
    register_view,
    save_good,
    save_rejected,
    schema_from_json,
    timestamped_path,
)

CUSTOMER_RULES = [
    {"name": "segment_known", "type": "allowed_values", "column": "c_mktsegment",
     "allowed_values": ["AUTOMOBILE", "FURNITURE", "MACHINERY", "HOUSEHOLD"], "priority": 1},
    {"name": "balance_positive", "type": "value_range", "column": "c_acctbal", "min": 0, "priority": 2},
]


@pytest.fixture(scope="module")
def customer_csv(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("csv") / "customer")
    table(spark, SF001, "customer").write.option("header", True).csv(path)
    return path


def test_csv_inferred(spark, customer_csv):
    df = read_csv(spark, customer_csv, infer_schema=True)
    assert dict(df.dtypes)["c_acctbal"] == "double"
    expected = validate(table(spark, SF001, "customer"), CUSTOMER_RULES).bad.count()
    assert validate(df, CUSTOMER_RULES).bad.count() == expected


def test_csv_all_strings(spark, customer_csv):
    df = read_csv(spark, customer_csv)
    assert set(dict(df.dtypes).values()) == {"string"}
    r = validate(df, CUSTOMER_RULES[:1])
    assert r.bad.count() == table(spark, SF001, "customer").where("c_mktsegment = 'BUILDING'").count()


def test_csv_explicit_json_schema(spark, customer_csv, tmp_path):
    schema = table(spark, SF001, "customer").schema
    p = tmp_path / "schema.json"
    p.write_text(schema.json())
    assert schema_from_json(str(p)) == schema
    assert schema_from_json(json.loads(schema.json())) == schema
    df = read_csv(spark, customer_csv, schema=str(p))
    assert df.schema == schema
    assert read_csv(spark, customer_csv, schema="c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").count() == df.count()


def test_parquet_and_views(spark):
    df = read_parquet(spark, f"{SF001}/customer.parquet")
    register_view(df.where("c_mktsegment = 'BUILDING'"), "building_customers_t")
    assert read_table(spark, "building_customers_t").count() == df.where("c_mktsegment = 'BUILDING'").count()
    rule = [{"name": "fk", "type": "referential_integrity", "column": "user_id",
             "reference_table": "building_customers_t", "reference_column": "c_custkey", "priority": 1}]
    ev = table(spark, SF001, "events")
    r = validate(ev, rule)
    expected = ev.join(df.where("c_mktsegment = 'BUILDING'"), ev.user_id == df.c_custkey, "left_anti").count()
    assert r.bad.count() == expected


def test_save_rejected_and_good(spark, tmp_out):
    r = validate(table(spark, SF001, "customer"), CUSTOMER_RULES)
    path = save_rejected(r, tmp_out)
    assert os.path.basename(path).startswith("rejected_")
    back = spark.read.parquet(path)
    assert back.columns == r.bad.columns
    assert back.count() == r.bad.count()
    assert sorted(map(tuple, back.select("c_custkey", F.array_join("failed_rules", ",")).collect())) == sorted(
        map(tuple, r.bad.select("c_custkey", F.array_join("failed_rules", ",")).collect())
    )
    with pytest.raises(Exception):
        r.bad.write.parquet(path)  # never overwritten by default
    assert r.save_rejected(tmp_out) != path  # a new folder each time
    good_path = save_good(r, os.path.join(tmp_out, "good"))
    assert spark.read.parquet(good_path).count() == r.good.count()


def test_timestamped_path_format():
    p = timestamped_path("/base/", "rejected")
    assert p.startswith("/base/rejected_") and len(os.path.basename(p)) == len("rejected_20250101_000000_000000")


def _jobs(spark, group, fn):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = fn()
    finally:
        spark.sparkContext.setJobGroup("", "")
    return out, len(tracker.getJobIdsForGroup(group))


def test_save_rejected_with_stats_one_pass(spark, tmp_out):
    from rowsieve.sources import save_rejected_with_stats

    r = validate(table(spark, SF001, "customer"), CUSTOMER_RULES)
    (path, stats), jobs = _jobs(spark, "rejected-with-stats", lambda: save_rejected_with_stats(r, tmp_out))
    assert jobs == 1  # the write job; the counts came with it
    assert stats == r.quality_stats()
    assert spark.read.parquet(path).count() == stats["rejected_records"]


def test_write_split_one_pass(spark, tmp_out):
    from rowsieve.sources import write_split

    r = validate(table(spark, SF001, "events"), [
        {"name": "v", "type": "value_range", "column": "value", "min": 1, "max": 20, "priority": 1},
        {"name": "u", "type": "unique_check", "column": "user_id", "priority": 2},
    ])
    out = os.path.join(tmp_out, "split")
    (path, stats), jobs = _jobs(spark, "split", lambda: write_split(r, out))
    # the same jobs as writing the verdicts alone (the write + the broadcast
    # of the measured duplicate set): the counts add no pass
    _, plain = _jobs(spark, "plain", lambda: r.flagged.write.format("noop").mode("overwrite").save())
    assert jobs == plain
    assert stats == r.quality_stats()
    back = spark.read.parquet(path)
    counts = {row.dq_status: row["count"] for row in back.groupBy("dq_status").count().collect()}
    assert counts.get("rejected", 0) == stats["rejected_records"]
    assert counts.get("passed", 0) == stats["passed_records"]
    assert back.where("dq_status = 'passed'").where(F.size("failed_rules") > 0).count() == 0


MALFORMED = 'id,name,amount\n1,ann,2.5\n2,bob\n3,cid,x\n4,"d, e",7\n5,eve,1,extra\n6,,\n"7"",fay,3\n'
WELL_FORMED = {"name": "well_formed", "type": "well_formed", "column": "raw", "priority": 1}


def _malformed(spark, tmp_out, **options):
    path = f"{tmp_out}/in.csv"
    with open(path, "w") as fh:
        fh.write(MALFORMED)
    return read_csv(spark, path, malformed="raw", source_file="file", **options)


def test_malformed_lines_are_captured_and_rejected(spark, tmp_out):
    df = _malformed(spark, tmp_out, schema="id int, name string, amount double")
    assert df.columns == ["id", "name", "amount", "raw", "file"]
    result = validate(df, [WELL_FORMED, {"name": "amount", "type": "null_check", "column": "amount", "priority": 2}])
    bad = {r.raw: r for r in result.bad.collect()}
    assert {"2,bob", "3,cid,x", "5,eve,1,extra"} <= set(bad)
    assert bad["3,cid,x"].failed_rules == ["well_formed", "amount"] and bad["3,cid,x"].file.endswith("in.csv")
    assert {r.id for r in result.good.collect()} == {1, 4}
    path = result.save_rejected(f"{tmp_out}/out")
    assert spark.read.parquet(path).where("raw IS NOT NULL").count() == result.observed_stats["rule_violations"]["well_formed"]["failed_count"]


def test_pruning_does_not_change_the_verdict(spark, tmp_out):
    """Counting the one rule reads no other column by name; a value of the wrong type is found all the same."""
    df = _malformed(spark, tmp_out, schema="id int, name string, amount double")
    whole = sorted(r.raw for r in df.collect() if r.raw is not None)
    assert validate(df, [WELL_FORMED]).quality_stats()["rule_violations"]["well_formed"]["failed_count"] == len(whole)
    assert sorted(r.raw for r in df.where("raw IS NOT NULL").select("raw").collect()) == whole
    assert sorted(r.raw for r in df.select("id", "raw").collect() if r.raw is not None) == whole


def test_malformed_lines_without_a_schema(spark, tmp_out):
    for options in ({}, {"infer_schema": True}):
        df = _malformed(spark, tmp_out, **options)
        assert {"2,bob", "5,eve,1,extra"} <= {r.raw for r in df.collect()}
    import pytest

    for options in ({"malformed": "ID"}, {"source_file": "name"}):
        with pytest.raises(ValueError):
            read_csv(spark, f"{tmp_out}/in.csv", **options)
    assert read_csv(spark, f"{tmp_out}/in.csv").columns == ["id", "name", "amount"]
