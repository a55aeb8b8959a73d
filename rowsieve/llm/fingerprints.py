"""Document fingerprints by I-Match.

A text's terms are its words (letters and digits, A-Z lower-cased).  The
lexicon keeps the terms whose inverse document frequency over all rows lies
in a band, ``LOW <= n(t) / N <= HIGH``; frequencies are counted per hashed
term in a table of fixed size (``BUCKETS``), so counting and shipping the
lexicon are bounded whatever the vocabulary.  The distinct terms of a text
that the lexicon keeps are sorted and hashed whole, and once more for each of
several randomised subsets of the lexicon: ``SUBSETS`` subsets at each of the
``RATES``.  A small change leaves the hashes of most sparse subsets alone.

The likeness of two fingerprints is the share of equal subset hashes among
the subsets with a term of either text, from the sparsest rate on until
``ENOUGH`` such subsets are seen.

Defined cases: null text is empty; a text without a term in the band is
fingerprinted by all its terms, and by the text itself if it has none, and
its likeness is 1 to an equal fingerprint, else 0; extra columns are
ignored; an empty table gives an empty result.  For neighbours, rows are
ordered by descending id, equal ids by text hash, null ids last; rows that
repeat are neighbours of each other.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsieve.llm.text import LETTERS, blocks, buffers, column, mix, split_words, stream

BUCKETS = 1 << 20
CHUNKS = 64
LOW, HIGH = 2e-4, 0.2
RATES = (1 / 512, 1 / 128, 1 / 32, 1 / 8, 1 / 2)
SUBSETS = 16
ENOUGH = 16

_SEEDS = stream(41, len(RATES) * SUBSETS)
_LIMITS = np.repeat((np.array(RATES) * 2.0**64).astype(np.uint64), SUBSETS)


def _terms(texts: pa.Array):
    """(sorted distinct term hashes, ptr) per text."""
    words = split_words(texts, LETTERS)
    h = words.hashes()
    parts = [np.unique(h[a:b]) for a, b in zip(words.ptr[:-1], words.ptr[1:])]
    ptr = np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)]).astype(np.int64)
    return (np.concatenate(parts) if parts else np.empty(0, np.uint64)), ptr


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(44)).astype(np.int64)


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Document frequencies of a task's texts, chunk by chunk, compressed."""
    counts, n = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        texts = column(batch, "text")
        for lo, hi in blocks(texts):
            h, ptr = _terms(texts.slice(lo, hi - lo))
            text = np.repeat(np.arange(hi - lo), np.diff(ptr))
            seen = np.unique(text * BUCKETS + _bucket(h)) % BUCKETS
            counts += np.bincount(seen, minlength=BUCKETS)
            n += hi - lo
    if n:
        packed = [zlib.compress(part.tobytes(), 1) for part in counts.reshape(CHUNKS, -1)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(CHUNKS), pa.int32()), pa.array([n] * CHUNKS, pa.int64()), pa.array(packed, pa.binary())], names=["chunk", "n", "counts"]
        )


def _sum_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of counts per chunk, and from them the lexicon's bits."""
    sums: dict[int, list] = {}
    for batch in batches:
        for row in batch.to_pylist():
            kept = sums.setdefault(row["chunk"], [0, np.zeros(BUCKETS // CHUNKS, np.int64)])
            kept[0] += row["n"]
            kept[1] += np.frombuffer(zlib.decompress(row["counts"]), np.int64)
    for chunk, (n, counts) in sums.items():
        bits = np.packbits((counts >= max(2, LOW * n)) & (counts <= HIGH * n)).tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([bits], pa.binary())], names=["chunk", "bits"])


def lexicon(docs: DataFrame) -> np.ndarray:
    """Which hashed terms the band keeps, as booleans by bucket (128 kB reach
    the driver).  ``docs`` has a column ``text``."""
    counts = docs.select("text").mapInArrow(_count_batches, "chunk int, n long, counts binary")
    bits = counts.repartition("chunk").mapInArrow(_sum_batches, "chunk int, bits binary").collect()
    out = np.zeros(BUCKETS, bool)
    for row in bits:
        size = BUCKETS // CHUNKS
        out[row["chunk"] * size : (row["chunk"] + 1) * size] = np.unpackbits(np.frombuffer(row["bits"], np.uint8)).astype(bool)
    return out


def fingerprints(texts: pa.Array, kept: np.ndarray) -> tuple[list[str], np.ndarray]:
    """(fingerprints, texts x subsets hashes; 0 for a subset without a term)."""
    h, ptr = _terms(texts)
    text = np.repeat(np.arange(len(texts)), np.diff(ptr))
    inside = kept[_bucket(h)]
    h_in, text_in = h[inside], text[inside]
    with np.errstate(over="ignore"):
        order = np.concatenate([[0], np.cumsum(np.bincount(text_in, minlength=len(texts)))])[text_in]
        place = (np.arange(len(h_in)) - order + 1).astype(np.uint64)
        worth = mix(h_in + place)  # terms in their sorted order
        hashes = np.zeros((len(texts), len(_SEEDS)), np.uint16)
        for k, (seed, limit) in enumerate(zip(_SEEDS, _LIMITS)):
            some = np.flatnonzero(mix(h_in ^ seed) < limit)
            total = np.zeros(len(texts), np.uint64)
            np.add.at(total, text_in[some], mix(h_in[some] + seed))
            used = np.zeros(len(texts), bool)
            used[text_in[some]] = True
            hashes[:, k] = np.where(used, mix(total) % np.uint64(65535) + np.uint64(1), 0)
        whole, alone = np.zeros(len(texts), np.uint64), np.zeros(len(texts), np.uint64)
        np.add.at(whole, text_in, worth)
        np.add.at(alone, text, mix(h))
    data, offsets = buffers(texts)
    names = []
    n_in, n_all = np.bincount(text_in, minlength=len(texts)), np.diff(ptr)
    for i in range(len(texts)):
        if n_in[i]:
            head = f"t{int(whole[i]):016x}"
        elif n_all[i]:
            head = f"a{int(alone[i]):016x}"
        else:
            head = "x" + hashlib.sha1(data[offsets[i] : offsets[i + 1]].tobytes()).hexdigest()[:16]
        names.append(head + "".join(f"{v:04x}" for v in hashes[i].tolist()) if n_in[i] else head)
    return names, hashes


def likeness(a_names: list[str], a: np.ndarray, b_names: list[str], b: np.ndarray) -> np.ndarray:
    """Likeness, 0 to 1, of fingerprints in pairs."""
    shape = (len(a), len(RATES), SUBSETS)
    either = ((a > 0) | (b > 0)).reshape(shape).sum(axis=2)
    equal = ((a == b) & (a > 0)).reshape(shape).sum(axis=2)
    seen, hit = np.cumsum(either, axis=1), np.cumsum(equal, axis=1)
    level = np.where((seen >= ENOUGH).any(axis=1), (seen >= ENOUGH).argmax(axis=1), len(RATES) - 1)
    rows = np.arange(len(a))
    share = hit[rows, level] / np.maximum(seen[rows, level], 1)
    same = np.array([x == y for x, y in zip(a_names, b_names)], bool)
    return np.where(same, 1.0, np.where(seen[:, -1] > 0, share, 0.0))


_OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compare_batches(kept_bits: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = np.unpackbits(np.frombuffer(kept_bits, np.uint8)).astype(bool)
        rest: pa.Table | None = None
        for batch in batches:
            for lo, hi in blocks(column(batch, "text")):
                table = pa.Table.from_batches([batch.slice(lo, hi - lo)])
                if rest is not None:  # the row before waits for its neighbour
                    table = pa.concat_tables([rest, table]).combine_chunks()
                rest = table.slice(len(table) - 1)
                texts = ["" if t is None else t for t in table.column("text").to_pylist()]
                own = table.column("part").to_pylist()
                lent = table.column("lent").to_pylist()
                pairs = [i for i in range(len(texts) - 1) if own[i] == own[i + 1] and not lent[i]]
                if not pairs:
                    continue
                edited = [t[: len(t) - len(t) // 3] + u[: len(t) // 3] for t, u in ((texts[i], texts[i + 1]) for i in pairs)]
                names, hashes = fingerprints(pa.array(texts, pa.string()), kept)
                e_names, e_hashes = fingerprints(pa.array(edited, pa.string()), kept)
                after = [i + 1 for i in pairs]
                mine, my_names = hashes[pairs], [names[i] for i in pairs]
                ids = table.column("id").to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([ids[i] for i in pairs], pa.int64()),
                        pa.array([len(texts[i]) for i in pairs], pa.int64()),
                        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
                        pa.array(my_names),
                        pa.array(e_names),
                        pa.array(likeness(my_names, mine, e_names, e_hashes)),
                        pa.array(likeness(my_names, mine, [names[i] for i in after], hashes[after])),
                    ],
                    names=[f.split()[0] for f in _OUT.split(", ")],
                )

    return run


def _part_of(borders: list[int]):
    """Number of the range, in descending order, that an id lies in."""
    edges = np.array(sorted(borders), np.int64)

    def part(ids: np.ndarray) -> np.ndarray:
        return len(edges) - np.searchsorted(edges, ids, "left")

    return part


_LEAST = -(2**63)


def _deal_batches(part, heads: dict[int, tuple[int, int]], before: dict[int, int]):
    """Rows with their range, and each range's first row once more as the end
    of the range before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lent: set[int] = set()
        for batch in batches:
            key, h = column(batch, "k").to_numpy(), column(batch, "h").to_numpy()
            own = part(key)
            extra, to = [], []
            for p, first in heads.items():
                if p in lent:
                    continue
                at = np.flatnonzero((key == first[0]) & (h == first[1]))
                if len(at):
                    lent.add(p)
                    extra.append(int(at[0]))
                    to.append(before[p])
            rows = pa.array(np.concatenate([np.arange(len(key)), np.array(extra, np.int64)]))
            out = batch.take(rows)
            yield pa.RecordBatch.from_arrays(
                [*out.columns, pa.array(np.concatenate([own, np.array(to, np.int64)]), pa.int64()), pa.array([False] * len(key) + [True] * len(extra))],
                names=["id", "k", "h", "text", "part", "lent"],
            )

    return run


def compare_neighbours(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its fingerprint, that of its edited text (the last third of
    its code points replaced by the first ones of the next row's text, by
    descending id, the first row's after the last), and how alike they are."""
    spark = df.sparkSession
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    docs = docs.select("id", F.coalesce("id", F.lit(_LEAST)).alias("k"), F.xxhash64("text").alias("h"), "text")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    borders = docs.select(F.percentile_approx("k", [i / n for i in range(1, n)] or [0.5], 10_000)).first()[0] or []
    part = _part_of(sorted(set(borders)))

    @F.arrow_udf("long")
    def number(k: pa.Array) -> pa.Array:
        return pa.array(part(k.to_numpy(zero_copy_only=False)), pa.int64())

    first = F.max(F.struct("k", F.negative(F.col("h").cast("decimal(20,0)")).alias("minus")))
    tops = docs.select("k", "h", number("k").alias("part")).groupBy("part").agg(first.alias("top")).orderBy("part").collect()
    heads = {r["part"]: (r["top"]["k"], int(-r["top"]["minus"])) for r in tops}
    order = sorted(heads)
    before = {p: order[i - 1] for i, p in enumerate(order)}  # of the first, the last
    bits = np.packbits(lexicon(docs)).tobytes()
    dealt = docs.mapInArrow(_deal_batches(part, heads, before), "id long, k long, h long, text string, part long, lent boolean")
    ranged = dealt.repartition(n, "part").sortWithinPartitions("part", "lent", F.desc("k"), "h")
    return ranged.mapInArrow(_compare_batches(bits), _OUT)
