"""Words and word hashes of Arrow text columns, vectorised over bytes.

A text column arrives in a task as one byte buffer with offsets.  Word
borders, lower-casing of A-Z and 64-bit word hashes are computed over that
buffer, never per word in Python.  Work is cut into blocks of about
a megabyte, so memory stays bounded whatever the batch holds; one very long
text is a block of its own and its words are hashed piecewise.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
HASH_BYTES = 1 << 19

GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64): every input bit reaches every output bit."""
    x = np.asarray(x, np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit values."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 20)) * GOLDEN)


def solid_bytes(kind: str) -> np.ndarray:
    """Which bytes belong to words.  ``space``: all but 0x20 and 0x09-0x0D.
    ``letters``: ASCII letters, digits and every non-ASCII byte."""
    b = np.arange(256)
    if kind == "space":
        return ~((b == 0x20) | ((b >= 0x09) & (b <= 0x0D)))
    return ((b >= 48) & (b <= 57)) | ((b >= 65) & (b <= 90)) | ((b >= 97) & (b <= 122)) | (b >= 128)


SPACE = solid_bytes("space")
LETTERS = solid_bytes("letters")


def _byte_values() -> np.ndarray:
    values = stream(11, 256) | np.uint64(1)
    values[65:91] = values[97:123]
    return values


_VALUES = _byte_values()
_BASE = stream(12, 1)[0] | np.uint64(1)


def _powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _BASE, np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


@dataclass
class Words:
    """Words of a block of texts: byte borders in ``data``, hashes, and for
    text ``i`` the word range ``ptr[i]:ptr[i+1]``."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    ptr: np.ndarray

    def hashes(self) -> np.ndarray:
        return hash_spans(self.data, self.starts, self.ends)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every (ascending, disjoint) byte span, A-Z as a-z."""
    out = np.empty(len(starts), np.uint64)
    if not len(starts):
        return out
    lengths = ends - starts
    powers = _powers(int(lengths.max()))
    i = 0
    with np.errstate(over="ignore"):
        while i < len(starts):
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + HASH_BYTES, "right")))
            n = lengths[i:j]
            first = np.cumsum(n) - n
            pos = np.arange(int(n.sum())) - np.repeat(first, n)
            at = pos + np.repeat(starts[i:j], n)
            out[i:j] = np.add.reduceat(_VALUES[data[at]] * powers[pos], first)
            i = j
    return mix(out)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets from 0) of a string array; null is empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    if raw is None or not len(texts):
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def split_words(texts: pa.Array, solid: np.ndarray = SPACE) -> Words:
    data, offsets = buffers(texts)
    inside = solid[data]
    n = len(data)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    border = offsets[(offsets > 0) & (offsets < n)]  # words end with their text
    begins[border] = inside[border]
    stops[border - 1] = inside[border - 1]
    starts = np.flatnonzero(begins)
    return Words(data, offsets, starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets))


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``limit`` bytes of text, one row at least."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total = np.concatenate([[0], np.cumsum(size)])
    lo = 0
    while lo < len(size):
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] + limit, "right")) - 1)
        yield lo, hi
        lo = hi


def column(batch: pa.RecordBatch | pa.Table, name: str) -> pa.Array:
    col = batch.column(name)
    return col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of ``width``-word shingles per text:
    (values, ptr).  Fewer words make one shingle of them all; no word, none."""
    words = split_words(texts, SPACE)
    h = words.hashes()
    weights = stream(13, width) | np.uint64(1)
    out, ptr = [], [0]
    with np.errstate(over="ignore"):
        rolled = np.zeros(max(len(h) - width + 1, 0), np.uint64)
        for k in range(width):
            rolled += h[k : k + len(rolled)] * weights[k]
        rolled = mix(rolled)
        for a, b in zip(words.ptr[:-1], words.ptr[1:]):
            n = b - a
            if n >= width:
                own = np.unique(rolled[a : b - width + 1])
            elif n:
                own = mix(np.array([(h[a:b] * weights[:n]).sum() + np.uint64(n)], np.uint64))
            else:
                own = np.empty(0, np.uint64)
            out.append(own)
            ptr.append(ptr[-1] + len(own))
    return (np.concatenate(out) if out else np.empty(0, np.uint64)), np.array(ptr, np.int64)
