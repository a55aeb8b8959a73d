"""The corpus pipeline: ``documents`` to packed training sequences.

Each stage works on all that the one before kept; all but the last return
the columns of ``documents``.  Every stage is written as Parquet and read
again, so a stage that fails starts over from written tables.
"""

from __future__ import annotations

from rowsieve.llm import decontaminate, near_dedup, packing, pii, quality
from rowsieve.llm.catalog import tokenizer_path
from rowsieve.llm.tables import read, save, shared_folder


def quality_filter(spark, docs, sf_dir):
    """Documents that the quality classifier rejects go."""
    return quality.accepted(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark, docs, sf_dir):
    """One document of each class of near copies stays."""
    return near_dedup.keep_one(docs)


def decontamination(spark, docs, sf_dir):
    """Documents that hold a benchmark passage go."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def personal_data(spark, docs, sf_dir):
    """Personal data and the terms that disclose it are replaced."""
    return pii.sanitise(docs)


def packed(spark, docs, sf_dir):
    """Token pieces of packed sequences, with their ids."""
    return packing.with_digests(packing.pack(docs, tokenizer_path()))


STAGES = [
    ("quality_filter", quality_filter),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packed", packed),
]

#: SQL cannot express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The stages in order over the whole ``documents`` table."""
    folder = shared_folder(spark)
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), folder)
    return STAGES[-1][1](spark, docs, sf_dir)
