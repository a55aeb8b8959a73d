"""Quality and toxicity: held-out accuracy, and defined cases."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF01
from llm.conftest import clashing, documents

from rowsieve.llm import quality, toxicity
from rowsieve.llm.training import labelled_sample


def auc(scores, labels):
    order = np.argsort(scores, kind="stable")
    rank = np.empty(len(scores))
    rank[order] = np.arange(len(scores))
    pos = labels == 1
    return (rank[pos].mean() - (pos.sum() - 1) / 2) / (~pos).sum()


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize(
    ("classify", "label", "parts", "held", "threshold"),
    [(quality.classify, "quality", 4, 2, quality.THRESHOLD), (toxicity.classify, "toxic", 5, 0, toxicity.THRESHOLD)],
)
def test_whole_table_held_out(spark, classify, label, parts, held, threshold):
    folder = SF01.replace("sf0.01", "sf0.1")
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    rows = classify(docs, labels).toPandas().set_index("doc_id")
    assert len(rows) == docs.count() and rows.score.between(0, 1).all()
    assert (rows.held_out == [zlib.crc32(str(i).encode()) % parts == held for i in rows.index]).all()
    assert (rows.predicted == (rows.score >= threshold).astype(int)).all()
    known = labels.toPandas().set_index("doc_id")[label]
    known = known[[i for i in known.index if rows.held_out[i]]]
    found, truth = rows.score[known.index].to_numpy(), known.to_numpy()
    assert auc(found, truth) > 0.95
    if label == "quality":  # a filter keeps clean documents
        assert (found[truth == 1] >= threshold).mean() > 0.97 and (found[truth == 0] >= threshold).mean() < 0.05


def test_held_out_labels_and_other_columns_are_no_inputs(spark, prose):
    texts = [prose(60, i) + (" ### %%% ***" * 10 if i % 2 else "") for i in range(80)]
    docs = documents(spark, texts)
    rows = [(i, int(i % 2 == 1), int(i % 2)) for i in range(1, 81)]
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q, t) for i, q, t in rows]
    other = docs.selectExpr("doc_id", "text", "'zz' AS lang", "'zz' AS source", "0L AS n_chars")
    plain = {r.doc_id: r.score for r in quality.classify(docs, labelled(spark, rows)).collect()}
    assert plain == {r.doc_id: r.score for r in quality.classify(other, labelled(spark, flipped)).collect()}


def test_factorisation_identity():
    rng = np.random.default_rng(0)
    texts = pa.array(["a few words here", "", "other words, other words!"])
    machine = quality.Machine(np.zeros(quality.N_STATS), np.ones(quality.N_STATS))
    machine.w, machine.v, machine.w0 = rng.normal(size=machine.w.shape), rng.normal(size=machine.v.shape), 0.3
    c, x, text, ptr = machine.rows(*quality.features(texts))
    found, _ = machine.raw(c, x, ptr)
    for i in range(3):
        own = range(ptr[i], ptr[i + 1])
        pairs = sum(machine.v[c[a]] @ machine.v[c[b]] * x[a] * x[b] for a in own for b in own if a < b)
        assert np.isclose(found[i], machine.w0 + sum(machine.w[c[a]] * x[a] for a in own) + pairs)


def test_interactions_are_learned():
    # neither word tells, the pair does
    rng = random.Random(4)
    rows = [(a, b) for a in ("red", "blue") for b in ("dog", "cat")] * 60
    texts = [" ".join(rng.sample([f"w{rng.randrange(50)}" for _ in range(3)] + [a, b], 5)) for a, b in rows]
    labels = [int((a == "red") == (b == "dog")) for a, b in rows]
    old = quality.EPOCHS, quality.RATE
    quality.EPOCHS, quality.RATE = 60, 0.3
    try:
        machine = quality.fit(texts, labels)
    finally:
        quality.EPOCHS, quality.RATE = old
    assert ((machine.predict(pa.array(texts)) > 0.5) == np.array(labels)).mean() > 0.9


def test_toxic_windows_and_calibration(prose):
    rng = random.Random(2)
    bad = ["zorgon", "blikter", "mufrath", "quellok"]
    texts, labels = [], []
    for i in range(900):
        words = prose(rng.randint(40, 200), i).split(" ")
        if i % 3 == 0:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        texts.append(" ".join(words))
        labels.append(int(i % 3 == 0))
    model = toxicity.fit(texts[:600], labels[:600])
    assert b"zorgon" in model["toxic"] and b"zorgon" not in model["plain"]
    found = toxicity.scores(model, pa.array(texts[600:]))
    truth = np.array(labels[600:])
    assert auc(found, truth) > 0.97 and ((found >= 0.5) == truth).mean() > 0.9


@pytest.mark.parametrize("text", ["", "short", "x" * 5000, "a b " * 999, "é" * 700, "word " * 40 + "y" * 300 + " end"])
def test_windows_cover_a_text_once(text):
    raw = text.encode()
    data = np.frombuffer(raw, np.uint8)
    starts, ends = toxicity.cut_windows(data, np.array([0, len(raw)]))
    assert b"".join(raw[a:b] for a, b in zip(starts, ends)) == raw
    assert (ends - starts <= 2 * toxicity.WINDOW).all()


@pytest.mark.parametrize("classify", [quality.classify, toxicity.classify])
def test_defined_cases(spark, prose, classify):
    texts = [None, "", prose(30, 1), prose(30, 1), "w " * 60000] + [prose(50, i) for i in range(5, 40)]
    docs = clashing(documents(spark, texts, [1, 2, None, 4, 4] + list(range(5, 40))))
    labels = labelled(spark, [(i, i % 2, i % 2) for i in range(5, 40)] + [(6, 0, 0), (None, 1, 1), (4, None, None), (999, 1, 0)])
    rows = classify(docs, labels).collect()
    assert len(rows) == len(texts) and all(0 <= r.score <= 1 for r in rows)
    assert not [r for r in rows if r.doc_id is None][0].held_out
    none = classify(docs, labels.limit(0)).collect()
    assert len({r.score for r in none}) == 1
    one = classify(docs, labelled(spark, [(i, 1, 1) for i in range(5, 40)])).collect()
    assert {r.score for r in one} == {1.0}
    assert classify(documents(spark, []), labels).count() == 0


def test_accepted_keeps_columns(spark, prose):
    docs = clashing(documents(spark, [prose(50, i) for i in range(30)] + [None]))
    labels = labelled(spark, [(i, 1, 0) for i in range(1, 30)])
    out = quality.accepted(docs, labels)
    assert out.columns == docs.columns and out.count() == 31


def test_sample_is_bounded(spark, prose, monkeypatch):
    docs = documents(spark, [prose(20, i) for i in range(60)])
    labels = labelled(spark, [(i, i % 2, 0) for i in range(1, 61)])
    from pyspark.sql import functions as F

    texts, known = labelled_sample(docs, labels, "quality", F.lit(True), 10)
    assert len(texts) == 20 and sorted(known) == [0] * 10 + [1] * 10
    monkeypatch.setattr("rowsieve.llm.training.SAMPLE_BYTES", 500)
    texts, _ = labelled_sample(docs, labels, "quality", F.lit(True), 10)
    assert 0 < sum(len(t.encode()) for t in texts) <= 500
