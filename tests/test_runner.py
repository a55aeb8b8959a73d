"""Engine-style workflow: apply_rules → (good, bad), stats, summary, sink, report."""

import json
import os

import pytest

from conftest import SF001
from rowsieve import RuleRunner
from rowsieve.catalog.queries import DOCUMENT_RULES, table


@pytest.fixture(scope="module")
def rules_file(tmp_path_factory):
    p = tmp_path_factory.mktemp("rules") / "rules.json"
    p.write_text(json.dumps(DOCUMENT_RULES))
    return str(p)


def test_workflow(spark, rules_file, tmp_out):
    docs = table(spark, SF001, "documents")
    runner = RuleRunner(docs, refs={"labels": table(spark, SF001, "labels")}, keys=["doc_id"])
    with pytest.raises(ValueError):
        runner.get_quality_stats()
    good, bad = runner.apply_rules(rules_file)
    assert good.count() + bad.count() == docs.count()
    stats = runner.get_quality_stats()
    assert stats["rejected_records"] == bad.count()
    assert list(stats["rule_violations"]) == [r["name"] for r in RuleRunner.load_rules(rules_file)]
    summary = runner.get_failed_rules_summary()
    assert summary.columns == ["doc_id", "failed_rules"] and summary.count() == bad.count()
    path = runner.save_rejected(tmp_out)
    assert spark.read.parquet(path).count() == bad.count()
    assert RuleRunner.parse_duration("2 DAYS") == 172800.0


def test_html_report(spark, rules_file, tmp_out):
    docs = table(spark, SF001, "documents")
    runner = RuleRunner(docs, refs={"labels": table(spark, SF001, "labels")}, keys=["doc_id"])
    runner.apply_rules(rules_file)
    out = runner.generate_report(os.path.join(tmp_out, "report.html"), title="Documents <check>")
    text = open(out, encoding="utf-8").read()
    stats = runner.get_quality_stats()
    assert "Documents &lt;check&gt;" in text
    assert f"{stats['total_records']:,}" in text
    for name in stats["rule_violations"]:
        assert name in text
    assert text.count("<tr>") >= 1 + 5  # header + top-5 rows (4 rules here) + sample
    assert "http" not in text  # self-contained


def test_stats_free_after_save(spark, rules_file, tmp_out):
    docs = table(spark, SF001, "documents")
    runner = RuleRunner(docs, refs={"labels": table(spark, SF001, "labels")}, keys=["doc_id"])
    runner.apply_rules(rules_file)
    runner.save_rejected(tmp_out)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("stats-after-save", "x")
    stats = runner.get_quality_stats()
    spark.sparkContext.setJobGroup("", "")
    assert tracker.getJobIdsForGroup("stats-after-save") == []
    from rowsieve.operators.stats import quality_stats

    assert stats == quality_stats(runner.result)


def test_command_line(spark, tmp_out, capsys):
    from rowsieve.__main__ import main

    csv = os.path.join(tmp_out, "events_csv")
    table(spark, SF001, "events").write.option("header", True).csv(csv)
    rules = os.path.join(tmp_out, "rules.json")
    with open(rules, "w") as fh:
        json.dump(
            [
                {"name": "value_in_range", "type": "value_range", "column": "value", "min": 1, "max": 20, "priority": 1},
                {"name": "user_known", "type": "referential_integrity", "column": "user_id",
                 "reference_table": "customers", "reference_column": "c_custkey", "priority": 2},
            ],
            fh,
        )
    report = os.path.join(tmp_out, "r.html")
    code = main([
        "--input", csv, "--format", "csv", "--infer-schema", "--rules", rules,
        "--ref", f"customers={SF001}/customer.parquet", "--rejected", tmp_out,
        "--split", os.path.join(tmp_out, "split"), "--report", report, "--keys", "event_id",
    ])
    assert code == 0
    stats = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert stats["total_records"] == table(spark, SF001, "events").count()
    assert os.path.exists(report)
    back = spark.read.parquet(os.path.join(tmp_out, "split"))
    assert back.where("dq_status = 'rejected'").count() == stats["rejected_records"]


def test_default_keys_missing(spark, rules_file, tmp_out):
    from rowsieve import RuleError

    docs = table(spark, SF001, "documents")
    runner = RuleRunner(docs, refs={"labels": table(spark, SF001, "labels")})  # default key order_id
    runner.apply_rules(rules_file)
    with pytest.raises(RuleError, match="order_id"):
        runner.get_failed_rules_summary()
    out = runner.generate_report(os.path.join(tmp_out, "nokeys.html"))
    text = open(out, encoding="utf-8").read()
    assert "Top 5 rule violations" in text and "Sample rejected records" not in text
    assert runner.get_failed_rules_summary(["doc_id"]).count() == runner.bad_df.count()
