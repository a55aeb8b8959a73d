"""The pipeline: every stage against brute force on its own input."""

import os

import corpus_pipeline
import pytest
from conftest import SF01
from llm.test_near_dedup import brute
from llm.test_packing_sharding import check_pieces, reference_ids
from llm.test_pii import base


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of every stage on the whole sf0.01 tables."""
    docs, out = spark.read.parquet(f"{SF01}/documents.parquet"), []
    from rowsieve.llm.tables import save

    for name, stage in corpus_pipeline.STAGES:
        result = save(stage(spark, docs, SF01))
        out.append((name, docs, result))
        docs = result
    return {name: (before, after) for name, before, after in out}


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_names_and_columns(spark, stages):
    columns = spark.read.parquet(f"{SF01}/documents.parquet").columns
    assert list(stages) == ["quality_filter", "near_duplicates", "decontamination", "personal_data", "packed"]
    assert all(after.columns == columns for name, (_, after) in stages.items() if name != "packed")


def test_quality_filter_keeps_clean_documents(spark, stages):
    before, after = stages["quality_filter"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    kept = set(ids(after))
    good = [i for i in ids(before) if labels.get(i) == 1]
    junk = [i for i in ids(before) if labels.get(i) == 0]
    assert sum(i in kept for i in good) >= 0.97 * len(good) and sum(i in kept for i in junk) <= 0.05 * len(junk)


def test_one_of_each_class_stays(stages):
    before, after = stages["near_duplicates"]
    classes = brute([(r.doc_id, r.text) for r in before.collect()])
    assert ids(after) == sorted(i for i, (_, c) in classes.items() if c == i)


def test_personal_data_goes_and_clean_texts_stay(stages):
    before, after = stages["personal_data"]
    texts = {r.doc_id: r.text for r in before.collect()}
    changed = 0
    for r in after.collect():
        assert base(r.text) == [] and r.n_chars == len(r.text)
        if base(texts[r.doc_id]):
            changed += 1
        else:
            assert r.text == texts[r.doc_id]
    assert ids(before) == ids(after) and changed


def test_packed_pieces(stages):
    before, after = stages["packed"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    expected = {i: [x + [1]] for (i, _), x in zip(rows, reference_ids([t for _, t in rows]))}
    assert check_pieces(after.collect(), expected) == 0


def test_run_and_registration(spark, stages):
    import __spark_entry__ as entry

    run = entry.queries()["pipeline"](spark, SF01)
    assert run.select("doc_id", "start").exceptAll(stages["packed"][1].select("doc_id", "start")).count() == 0
    assert {f"op{n}" for n in range(1, 11)} <= {name.split("_")[0] for name in entry.queries()}


def test_llm_is_not_imported_elsewhere():
    root = os.path.dirname(corpus_pipeline.__file__)
    for folder, _, files in os.walk(os.path.join(root, "rowsieve")):
        for name in files:
            if name.endswith(".py") and os.sep + "llm" not in folder:
                assert "rowsieve.llm" not in open(os.path.join(folder, name), encoding="utf-8").read()
