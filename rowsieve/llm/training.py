"""The bounded, labelled sample that classifiers are fitted on."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Text of the sample in all; rows whose texts would exceed it are left out of the sample.
SAMPLE_BYTES = 48 << 20


def id_remainder(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(parts))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, per_label: int, id_col: str = "doc_id", text_col: str = "text") -> tuple[list[str], list[int]]:
    """Whole texts and labels (0 or 1) of at most ``per_label`` rows of each
    label with the smallest hashes of their ids, ``SAMPLE_BYTES`` of text in
    all.  Only ids that ``learn`` holds for are taken; an id with several
    labels takes the largest; an id with several texts, one of them."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label).isin(0, 1) & learn)
    known = known.groupBy(F.col(id_col).cast("long").alias("__id")).agg(F.max(label).cast("int").alias("__y"))
    there = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("__t")).where("__t IS NOT NULL")
    key = F.xxhash64("__id", F.lit(17))
    chosen = None
    for y in (0, 1):
        some = known.where(F.col("__y") == y).orderBy(key, "__id").limit(per_label)
        chosen = some if chosen is None else chosen.union(some)
    sized = there.join(F.broadcast(chosen), "__id").groupBy("__id", "__y").agg(F.min(F.octet_length("__t")).alias("__n"))
    rows = sorted(sized.toPandas().itertuples(index=False), key=lambda r: (r[0] * 0x9E3779B97F4A7C15) % 2**64)
    total, taken = 0, []
    for i, _, n in rows:
        if total + n <= SAMPLE_BYTES:
            total += n
            taken.append((int(i), int(n)))
    if not taken:
        return [], []
    ids = docs.sparkSession.createDataFrame(pa.table({"__id": pa.array([t[0] for t in taken], pa.int64()), "__n": pa.array([t[1] for t in taken], pa.int32())}))
    texts = there.join(F.broadcast(ids), "__id").where(F.octet_length("__t") == F.col("__n"))
    texts = texts.join(F.broadcast(chosen), "__id").dropDuplicates(["__id"]).select("__id", "__t", "__y").toPandas()
    texts = texts.sort_values("__id", key=lambda s: s.map(lambda i: (i * 0x9E3779B97F4A7C15) % 2**64))
    return texts["__t"].tolist(), texts["__y"].tolist()
