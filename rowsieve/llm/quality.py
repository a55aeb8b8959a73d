"""Text quality by a factorisation machine.

Features of a text: its words hashed to ``DIM`` columns (counts, scaled to
length one), and statistics of its structure and size (shares of character
kinds, word lengths, repetition, lines, length), standardised by the
training sample.  The score is the logistic of

    w0 + sum_i w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2]

so all pairwise interactions cost time linear in the text's features.
``FACTORS`` weights per feature are fitted by AdaGrad on a bounded sample of
labelled rows (``SAMPLE`` per label, within ``training.SAMPLE_BYTES`` of
whole texts); labels, language, source and id are no features.

Defined cases: null or empty text has no words and all statistics zero
before scaling, and gets a score like any other; a null id counts as not
held out; null labels are not learned from; with labels of one kind alone
(or none) every score is that kind's share (or 1); rows that repeat are
scored each; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsieve.llm.text import SPACE, blocks, column, split_words
from rowsieve.llm.training import id_remainder, labelled_sample

DIM = 1 << 14
FACTORS = 8
SAMPLE = 3_000
EPOCHS, BATCH, RATE, RIDGE = 12, 128, 0.05, 1e-5
THRESHOLD = 0.7

_B = np.arange(256)
_KINDS = [
    (_B >= 65) & (_B <= 90),
    (_B >= 97) & (_B <= 122),
    (_B >= 48) & (_B <= 57),
    _B >= 128,
    (_B == 32) | (_B == 9),
    _B == 10,
    np.isin(_B, [44, 46]),
    np.isin(_B, [33, 63]),
    np.isin(_B, [124, 60, 62, 123, 125, 91, 93, 61, 92, 95]),
    np.isin(_B, [35, 36, 37, 38, 42, 43, 47, 64, 94, 126]),
]
N_STATS = len(_KINDS) + 9


def _per_text(values: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return total[ptr[1:]] - total[ptr[:-1]]


def features(texts: pa.Array):
    """(column, value, ptr) of the hashed words, and (texts x N_STATS)."""
    words = split_words(texts, SPACE)
    h = words.hashes()
    n_texts = len(texts)
    n_bytes = np.diff(words.offsets).astype(float)
    n_words = np.diff(words.ptr).astype(float)
    own = np.repeat(np.arange(n_texts), np.diff(words.ptr))
    keys, counts = np.unique(own * DIM + (h >> np.uint64(50)).astype(np.int64), return_counts=True)
    doc, col = keys // DIM, keys % DIM
    ptr = np.searchsorted(doc, np.arange(n_texts + 1))
    norm = np.sqrt(np.maximum(_per_text(counts.astype(float) ** 2, ptr), 1))
    value = counts / norm[doc]

    per_byte, per_word = np.maximum(n_bytes, 1), np.maximum(n_words, 1)
    length = (words.ends - words.starts).astype(float)
    again = np.zeros(len(h))
    again[1:] = (h[1:] == h[:-1]) & (own[1:] == own[:-1])
    last = words.data[words.ends - 1] if len(h) else np.empty(0, np.uint8)
    ends_odd = ~(_KINDS[0] | _KINDS[1] | _KINDS[2] | _KINDS[3] | _KINDS[6])[last]
    mean = _per_text(length, words.ptr) / per_word
    top = np.zeros(n_texts)
    np.maximum.at(top, doc, counts)
    stats = [_per_text(k[words.data], words.offsets) / per_byte for k in _KINDS]
    stats += [
        np.log1p(n_bytes),
        mean,
        np.sqrt(np.maximum(_per_text(length**2, words.ptr) / per_word - mean**2, 0)),
        _per_text(again, words.ptr) / per_word,
        _per_text(ends_odd, words.ptr) / per_word,
        np.diff(ptr) / per_word,
        top / per_word,
        _per_text((length <= 1).astype(float), words.ptr) / per_word,
        np.log1p(n_words / np.maximum(_per_text(_KINDS[5][words.data], words.offsets), 1)),
    ]
    return col, value, ptr, np.column_stack(stats)


class Machine:
    """The model: weights of the hashed words, then of the statistics."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray):
        self.mean, self.spread = mean, spread
        rng = np.random.default_rng(7)
        self.w0, self.w = 0.0, np.zeros(DIM + N_STATS)
        self.v = rng.normal(0, 0.02, (DIM + N_STATS, FACTORS))

    def rows(self, col, value, ptr, stats):
        """Words and statistics of texts as one sparse matrix (col, value, text, ptr)."""
        z = np.clip((stats - self.mean) / self.spread, -5, 5) / 3
        n, k = stats.shape
        sizes = np.diff(ptr) + k
        out_ptr = np.concatenate([[0], np.cumsum(sizes)])
        text = np.repeat(np.arange(n), sizes)
        place = np.arange(out_ptr[-1]) - out_ptr[text]
        dense = place < k
        c, x = np.empty(len(text), np.int64), np.empty(len(text))
        c[dense], x[dense] = DIM + place[dense], z.reshape(-1)
        c[~dense], x[~dense] = col, value
        return c, x, text, out_ptr

    def raw(self, c, x, ptr):
        vx = self.v[c] * x[:, None]
        s = np.add.reduceat(vx, ptr[:-1], axis=0)
        pairs = 0.5 * (s**2 - np.add.reduceat(vx**2, ptr[:-1], axis=0)).sum(axis=1)
        return self.w0 + np.add.reduceat(self.w[c] * x, ptr[:-1]) + pairs, s

    def predict(self, texts: pa.Array) -> np.ndarray:
        if not len(texts):
            return np.empty(0)
        c, x, _, ptr = self.rows(*features(texts))
        return 1 / (1 + np.exp(-np.clip(self.raw(c, x, ptr)[0], -30, 30)))


def fit(texts: list[str], labels: list[int]) -> Machine | float:
    """The machine of labelled texts, or the constant score of one kind."""
    y = np.array(labels, float)
    if len(set(labels)) < 2:
        return float(y.mean()) if len(y) else 1.0
    array = pa.array(texts, pa.string())
    parts = [features(array.slice(lo, hi - lo)) for lo, hi in blocks(array)]
    stats = np.concatenate([p[3] for p in parts])
    machine = Machine(stats.mean(axis=0), stats.std(axis=0) + 1e-9)
    sizes = np.concatenate([np.diff(p[2]) for p in parts])
    c, x, _, ptr = machine.rows(
        np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), np.concatenate([[0], np.cumsum(sizes)]), stats
    )
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    sum_w, sum_v, sum_0 = np.full(len(machine.w), 1e-8), np.full(machine.v.shape, 1e-8), 1e-8
    rng = np.random.default_rng(8)
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for i in range(0, len(y), BATCH):
            some = order[i : i + BATCH]
            at = np.concatenate([np.arange(ptr[k], ptr[k + 1]) for k in some])
            own_ptr = np.concatenate([[0], np.cumsum(ptr[some + 1] - ptr[some])])
            cc, xx = c[at], x[at]
            out, s = machine.raw(cc, xx, own_ptr)
            error = weight[some] * (1 / (1 + np.exp(-np.clip(out, -30, 30))) - y[some]) / len(some)
            each = np.repeat(error, np.diff(own_ptr))
            used, back = np.unique(cc, return_inverse=True)
            grad_w = np.bincount(back, each * xx, len(used)) + RIDGE * machine.w[used]
            row = (each * xx)[:, None] * (np.repeat(s, np.diff(own_ptr), axis=0) - machine.v[cc] * xx[:, None])
            grad_v = np.column_stack([np.bincount(back, row[:, f], len(used)) for f in range(FACTORS)]) + RIDGE * machine.v[used]
            sum_w[used] += grad_w**2
            sum_v[used] += grad_v**2
            sum_0 += error.sum() ** 2
            machine.w[used] -= RATE * grad_w / np.sqrt(sum_w[used])
            machine.v[used] -= RATE * 0.2 * grad_v / np.sqrt(sum_v[used])
            machine.w0 -= RATE * error.sum() / np.sqrt(sum_0)
    return machine


def _score_columns(df: DataFrame, labels: DataFrame, id_col: str, text_col: str, label: str, held_out: int, parts: int):
    part = id_remainder(id_col, parts)
    texts, known = labelled_sample(df, labels, label, part != held_out, SAMPLE, id_col, text_col)
    model = fit(texts, known)

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        if isinstance(model, float):
            return pa.array(np.full(len(text), model))
        found = [model.predict(text.slice(lo, hi - lo)) for lo, hi in blocks(text)]
        return pa.array(np.concatenate(found) if found else np.empty(0))

    return F.coalesce(part == held_out, F.lit(False)), score(F.col(text_col).cast("string"))


def classify(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "quality", held_out: int = 2, parts: int = 4) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``df``.  Labels
    are learned only from ids whose crc32 modulo ``parts`` is not ``held_out``."""
    held, score = _score_columns(df, labels, id_col, text_col, label, held_out, parts)
    scored = df.select(F.col(id_col).cast("long").alias("doc_id"), held.alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def accepted(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` whose score reaches ``THRESHOLD``, columns as they are."""
    _, score = _score_columns(df, labels, id_col, text_col, "quality", 2, 4)
    return df.where(score >= THRESHOLD)
