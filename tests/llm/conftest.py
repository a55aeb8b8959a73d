import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that the operators use themselves, or return.
CLASHING = ["id", "label", "score", "component_id", "digest", "spans", "base", "part", "key", "h", "k", "found", "shard", "slot"]


def documents(spark, texts, ids=None):
    """A documents table; ids count from 1 unless given."""
    ids = range(1, len(texts) + 1) if ids is None else ids
    rows = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, DOCS)


def clashing(df):
    """``df`` with extra columns of names that are used inside."""
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("x") for c in CLASHING if c not in df.columns})


@pytest.fixture
def prose():
    """Sentences of invented words, different for every seed."""
    import random

    syllables = ["ka", "lo", "mi", "ren", "tas", "vu", "el", "dor", "shi", "pan", "qua", "ber"]

    def make(n, seed):
        rng = random.Random(seed)
        words = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(n)]
        return " ".join(w.capitalize() if i % 11 == 0 else w + ("." if i % 11 == 10 else "") for i, w in enumerate(words))

    return make
