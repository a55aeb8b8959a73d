"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on toxic and one on ordinary
text.  A text is cut into windows at word ends; a window that the toxic
dictionary compresses to fewer bytes than the ordinary one is evidence, and
the calibrated threshold turns a text's strongest evidence into a score.

Fitting takes a bounded sample of labelled rows (``SAMPLE`` per label, those
with the smallest hashes of their ids, within ``training.SAMPLE_BYTES`` of
whole texts).  Two thirds train the dictionaries.  The ordinary one comes
from the library's trainer.  The toxic one holds the same content, since a
toxic text is mostly ordinary, after the words that toxic texts use in many
different places and ordinary ones hardly; so ordinary windows compress
alike with both.  The last third, seen by no dictionary, calibrates the
score from the texts' strongest windows.

Defined cases: null or empty text has no window and the score of no
evidence; a null id is scored like any other row and counts as not held
out; null labels are not learned from; rows that repeat are scored each;
with labels of one kind alone every score is that kind's share; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsieve.llm.text import blocks, buffers, column
from rowsieve.llm.training import id_remainder, labelled_sample

WINDOW = 96  # bytes
DICT_BYTES = 32 << 10
SAMPLE = 4_000
TRAIN_BYTES = 6 << 20
#: A word is toxic content if it is used in this many places (a share
#: of the toxic texts, a number at least), and so many times the share that
#: it has in ordinary texts.
MIN_SHARE, MIN_PLACES, CONTRAST = 0.01, 4, 8
THRESHOLD = 0.5


def cut_windows(data: np.ndarray, offsets: np.ndarray, width: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of windows of about ``width`` bytes that end after
    white space (or with their text); a run without any is cut anyway."""
    n = offsets[1:] - offsets[:-1]
    counts = -(-n // width)
    first = np.cumsum(counts) - counts
    k = np.arange(int(counts.sum())) - np.repeat(first, counts)
    lo, hi = np.repeat(offsets[:-1], counts), np.repeat(offsets[1:], counts)
    blank = np.flatnonzero((data == 32) | (data == 10)) + 1
    at = lo + k * width
    where = np.searchsorted(blank, at)
    snapped = np.append(blank, np.iinfo(np.int64).max)[where]
    starts = np.where(k == 0, lo, np.where(snapped < np.minimum(at + width, hi), snapped, at))
    ends = np.append(starts[1:], 0)
    last = np.append(k[1:] == 0, True) if len(k) else np.empty(0, bool)
    return starts, np.where(last, hi, ends)


class Coder:
    """Compressed sizes of windows with one dictionary."""

    def __init__(self, content: bytes):
        import zstandard as z

        form = z.ZstdCompressionParameters(
            window_log=17, hash_log=16, chain_log=16, search_log=6, min_match=4, target_length=32, strategy=z.STRATEGY_LAZY2,
            write_content_size=False, write_checksum=False, write_dict_id=False,
        )
        own = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
        self.coder = z.ZstdCompressor(dict_data=own, compression_params=form)

    def sizes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw, compress = data.tobytes(), self.coder.compress
        return np.fromiter((len(compress(raw[a:b])) for a, b in zip(starts.tolist(), ends.tolist())), np.int64, len(starts))


def train_ordinary(pieces: list[bytes]) -> bytes:
    """A dictionary of ordinary text by the library's trainer, from evenly
    spaced windows of ``TRAIN_BYTES`` in all."""
    import zstandard as z

    step = max(1, -(-sum(map(len, pieces)) // TRAIN_BYTES))
    try:
        return z.train_dictionary(DICT_BYTES, pieces[::step], k=48, d=6, f=18, steps=1, level=3).as_bytes()
    except z.ZstdError:  # too little text for the trainer: the text is the dictionary
        return b"".join(pieces)[-DICT_BYTES:] or b" " * 8


def _places(texts: list[bytes]) -> dict[bytes, int]:
    """Of every word, in how many places it is used: different texts, or
    different words before it if these are fewer.  So copies of a text and
    repetition inside one add nothing."""
    before_it: dict[bytes, set[bytes]] = {}
    inside: dict[bytes, int] = {}
    for text in set(texts):
        before, words = b"", text.split()
        for word in words:
            before_it.setdefault(word, set()).add(before)
            before = word
        for word in set(words):
            inside[word] = inside.get(word, 0) + 1
    return {w: min(n, len(before_it[w])) for w, n in inside.items()}


def train_toxic(toxic: list[bytes], ordinary: list[bytes], base: bytes) -> bytes:
    """The dictionary of toxic text: the ordinary content, as toxic text is
    mostly ordinary, after the words that toxic texts use in many places and
    ordinary ones hardly, rarest first."""
    used, usual = _places(toxic), _places(ordinary)
    n, m = max(len(set(toxic)), 1), max(len(set(ordinary)), 1)
    least = max(MIN_PLACES, MIN_SHARE * n)
    words = [w for w, k in used.items() if k >= least and k / n >= CONTRAST * (usual.get(w, 0) + 1) / m]
    words.sort(key=lambda w: (used[w], w))
    return b"".join(b" " + w + b" " for w in words)[-DICT_BYTES:] + base


def _lower(data: np.ndarray) -> np.ndarray:
    return data | ((data >= 65) & (data <= 90)).astype(np.uint8) << 5


def gains(texts: pa.Array, toxic: Coder, plain: Coder):
    """(gain, text number, start, end, bytes) of every window."""
    data, offsets = buffers(texts)
    data = _lower(data)
    starts, ends = cut_windows(data, offsets)
    gain = plain.sizes(data, starts, ends) - toxic.sizes(data, starts, ends)
    return gain, np.searchsorted(offsets, starts, "right") - 1, starts, ends, data


def evidence(texts: pa.Array, toxic: Coder, plain: Coder) -> np.ndarray:
    """(texts x 4): the largest and second gain of a window, log of the sum of
    squared gains, log of the number of windows."""
    gain, own, *_ = gains(texts, toxic, plain)
    order = np.lexsort((-gain, own))
    gain, own = gain[order], own[order]
    first = np.searchsorted(own, np.arange(len(texts)))
    n = np.bincount(own, minlength=len(texts))
    out = np.zeros((len(texts), 4))
    padded = np.append(gain, [0, 0]).astype(float)
    out[:, 0] = np.where(n > 0, padded[np.minimum(first, len(gain))], 0)
    out[:, 1] = np.where(n > 1, padded[np.minimum(first + 1, len(gain) + 1)], np.minimum(out[:, 0], 0))
    out[:, 2] = np.log1p(np.bincount(own, np.maximum(gain, 0) ** 2, len(texts)))
    out[:, 3] = np.log1p(n)
    return out


def calibrate(x: np.ndarray, y: np.ndarray, steps: int = 50) -> np.ndarray:
    """Logistic regression (ridge, Newton) of labels on evidence, both kinds
    weighing the same."""
    z = np.column_stack([np.ones(len(x)), x])
    weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    beta = np.zeros(z.shape[1])
    ridge = np.diag([1e-6] + [1e-2] * x.shape[1]) * len(x) * 0.05
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        grad = z.T @ (weight * (y - p)) - ridge @ beta
        beta = beta + np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + ridge + 1e-6 * np.eye(len(beta)), grad)
    return beta


def fit(texts: list[str], labels: list[int]) -> dict:
    """The model of labelled texts: two dictionaries and a calibration."""
    labels = np.array(labels, int)
    if len(set(labels.tolist())) < 2:
        return {"constant": float(labels.mean()) if len(labels) else 0.0}
    lowered = [t.encode().lower() for t in texts]
    third = np.arange(len(texts)) % 3 == 2
    toxic = [t for t, y, c in zip(lowered, labels, third) if y and not c]
    ordinary = [t for t, y, c in zip(lowered, labels, third) if not y and not c]
    joined = np.frombuffer(b"".join(ordinary), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in ordinary], dtype=np.int64)]).astype(np.int64)
    raw = joined.tobytes()
    plain = train_ordinary([raw[a:b] for a, b in zip(*cut_windows(joined, offsets))])
    model = {"toxic": train_toxic(toxic, ordinary, plain), "plain": plain}
    rest = third if len(set(labels[third].tolist())) == 2 else ~third
    x = evidence(pa.array([t for t, c in zip(texts, rest) if c], pa.string()), Coder(model["toxic"]), Coder(plain))
    return model | {"beta": calibrate(x, labels[rest].astype(float))}


def scores(model: dict, texts: pa.Array) -> np.ndarray:
    if "constant" in model:
        return np.full(len(texts), model["constant"])
    x = evidence(texts, Coder(model["toxic"]), Coder(model["plain"]))
    return 1 / (1 + np.exp(-np.clip(model["beta"][0] + x @ model["beta"][1:], -30, 30)))


def classify(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic", held_out: int = 0, parts: int = 5) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``df``.  Labels
    are learned only from ids whose crc32 modulo ``parts`` is not ``held_out``."""
    part = id_remainder(id_col, parts)
    texts, known = labelled_sample(df, labels, label, part != held_out, SAMPLE, id_col, text_col)
    model = fit(texts, known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            array = column(batch, "text")
            for lo, hi in blocks(array, 1 << 20):
                score = scores(model, array.slice(lo, hi - lo))
                own = [column(batch, n).slice(lo, hi - lo) for n in ("doc_id", "held_out")]
                yield pa.RecordBatch.from_arrays([*own, pa.array(score)], names=["doc_id", "held_out", "score"])

    rows = df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(part == held_out, F.lit(False)).alias("held_out"),
        F.col(text_col).cast("string").alias("text"),
    )
    scored = rows.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
