"""Packing documents into windows by the sum-of-squares rule.

A document's tokens are its ids by a public tokenizer plus one end id.  Full
windows are cut off its front; what remains (under a window) is placed
whole, online: of all fill levels it fits, it goes to the one that minimises
the sum over levels of the squared number of windows partially filled to
that level.  A level array holds those numbers, so a placement is one
vectorised scan of ``window`` levels.

Each task packs the rows it reads, so nothing is shuffled and a task's
result depends on its rows alone.  At the end of a task (and whenever
``MAX_OPEN`` windows are partially filled, so memory is bounded) the
partially filled windows are joined end to end and cut into full windows;
the last tokens of a task are cut into sequences of a power of two, which
need no padding.

Defined cases: null text is empty (a document of the end id alone); rows
that repeat a document are packed each; a null id is carried; extra columns
are ignored; an empty table packs into nothing.
"""

from __future__ import annotations

import json
from array import array
from codecs import charmap_decode
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsieve.llm.text import blocks, column

WINDOW = 2048
END_ID = 1
MAX_OPEN = 4096
#: Distinct words whose ids a worker remembers; forgetting changes no result.
MAX_WORDS = 300_000

PIECES = "doc_id long, start long, ids binary, doc_tokens long, sequence_id long, offset long"


class WordEncoder:
    """Ids of texts by a ``tokenizers`` file that splits at white space and
    keeps none: a text's ids are its words' ids in order, so each distinct
    word is encoded once and texts are put together from array slices.

    A word of plain lower-case letters (a core) is one piece for the model, so
    cores go to the model alone, each once, many in a call; a core's last id
    ends a word, which parts them again.  A word that ends in one full stop or
    comma after a core is that core and that mark; all others take the whole
    tokenizer.  A file whose ids do not come out so on ``SAMPLE`` is used as
    it is: whole texts go through its tokenizer.
    """

    #: Compared with the whole tokenizer before cores or words are taken alone.
    SAMPLE = "Ab cde, fgh. straße élan. Ülk x, naïvely zzqxj., don't a--b 12 3.5 É ønsket ÿ, the the. Q"

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # how the model spells a byte of UTF-8; a blank stays
        spelt = {level.pre_tokenize_str(chr(c))[0][0][i]: b for c in range(0xC0, 0x100) for i, b in enumerate(chr(c).encode())}
        back = {b: s for s, b in spelt.items()}
        self.bytewise = "".join(back.get(b, chr(b)) for b in range(256))
        self.plain = "^[A-Za-z\u00df-\u00f6\u00f8-\u00ff]+[.,]?$"
        rules = json.loads(self.tokenizer.to_str())
        self.inner = Tokenizer.from_str(json.dumps(rules | {"normalizer": None, "post_processor": None, "pre_tokenizer": {"type": "WhitespaceSplit"}}))
        suffix, vocabulary = rules["model"].get("end_of_word_suffix") or "", self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ends[[i for w, i in vocabulary.items() if suffix and w.endswith(suffix)]] = True
        self.by_core = self.by_word = True
        words = self.SAMPLE.split(" ")
        each = [self._whole([w])[0] for w in words]
        self.by_word = self._whole([self.SAMPLE.replace(" ", "\n")])[0] == [i for ids in each for i in ids]
        self.forget()
        if self.by_word:
            self.by_core = [ids.tolist() for ids in self.encode(words)] == each
            self.forget()

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def forget(self):
        """Entries (slices of ``flat``) of cores and of all other words; 0 is empty, 1 and 2 are the marks."""
        self.known: dict[str, int] = {"": 0}
        self.cores: dict[str, int] = {}
        self.flat, self.starts, self.sizes = array("I"), array("q"), array("q")
        for ids in ([], *self._whole([".", ","])):
            self._add(ids)

    def _add(self, ids: list[int]) -> int:
        self.starts.append(len(self.flat))
        self.sizes.append(len(ids))
        self.flat.extend(ids)
        return len(self.starts) - 1

    def _learn_words(self, words: list[str]) -> None:
        for word, ids in zip(words, self._whole(words)):
            self.known[word] = self._add(ids)

    def _learn_cores(self, cores: list[str]) -> None:
        lines = [charmap_decode(" ".join(cores[i : i + 50]).encode(), "strict", self.bytewise)[0] for i in range(0, len(cores), 50)]
        ids = np.array([i for e in self.inner.encode_batch_fast(lines, add_special_tokens=False) for i in e.ids], np.uint32)
        after = np.flatnonzero(self.ends[ids]) + 1
        if len(after) != len(cores) or after[-1] != len(ids):  # some core does not end in an id that ends words
            for core, own in zip(cores, self._whole(cores)):
                self.cores[core] = self._add(own)
            return
        first = np.concatenate([[0], after[:-1]])
        at, start = len(self.starts), len(self.flat)
        self.flat.frombytes(ids.tobytes())
        self.starts.frombytes((first + start).tobytes())
        self.sizes.frombytes((after - first).tobytes())
        self.cores.update(zip(cores, range(at, at + len(cores))))

    @staticmethod
    def _look_up(words: pa.Array, known: dict[str, int], learn) -> np.ndarray:
        """Entries of distinct words; those not yet known are learnt."""
        each = words.to_pylist()
        at = np.fromiter(map(known.get, each, repeat(-1)), np.int64, len(each))
        unknown = np.flatnonzero(at < 0).tolist()
        if unknown:
            learn([each[i] for i in unknown])
            at[unknown] = [known[each[i]] for i in unknown]
        return at

    def _entries(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(entry, entry of a mark after it or 0) of distinct words."""
        if not self.by_core:
            return self._look_up(words, self.known, self._learn_words), np.zeros(len(words), np.int64)
        plain = pc.match_substring_regex(words, self.plain)
        some, at = words.filter(plain), np.zeros(len(words), np.int64)
        mask = plain.to_numpy(zero_copy_only=False)
        cores = pc.ascii_lower(pc.utf8_rtrim(some, ".,")).dictionary_encode()  # of these letters, only A to Z have capitals
        at[mask] = self._look_up(cores.dictionary, self.cores, self._learn_cores)[cores.indices.to_numpy()]
        at[~mask] = self._look_up(words.filter(pc.invert(plain)), self.known, self._learn_words)
        mark = np.zeros(len(words), np.int64)
        mark[mask] = pc.ends_with(some, ".").to_numpy(zero_copy_only=False) + 2 * pc.ends_with(some, ",").to_numpy(zero_copy_only=False)
        return at, mark

    def encode(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        texts = pa.array(texts, pa.string())
        if not self.by_word:
            return [np.array(ids, np.uint32) for ids in self._whole(texts.to_pylist())]
        if len(self.known) + len(self.cores) > MAX_WORDS:
            self.forget()
        parts = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        words = parts.flatten().dictionary_encode()
        at, mark = self._entries(words.dictionary)
        which = words.indices.to_numpy()
        entries = np.stack([at[which], mark[which]], 1).reshape(-1)  # a word, then its mark; entry 0 adds nothing
        sizes = np.frombuffer(self.sizes, np.int64)[entries]
        first = np.cumsum(sizes) - sizes
        where = np.arange(int(sizes.sum())) + np.repeat(np.frombuffer(self.starts, np.int64)[entries] - first, sizes)
        ids = np.frombuffer(self.flat, np.uint32)[where] if len(where) else np.empty(0, np.uint32)
        borders = np.append(first, len(where))[2 * (parts.offsets.to_numpy()[1:] - parts.offsets[0].as_py())]
        return np.split(ids, borders[:-1])


class SumOfSquares:
    """Online packing of token pieces into windows.  ``place`` and ``flush``
    return the finished sequences, each a list of pieces (doc, start, ids, total)."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.counts = np.zeros(window + 1, np.int64)  # counts[h]: windows filled to h
        self.open: dict[int, list[list]] = {}
        self.n_open = 0

    def level(self, size: int) -> int:
        """The level (0: a new window) to put ``size`` on."""
        n, window = self.counts, self.window
        # the sum of squares changes by 2 (n[h + size] - n[h]) + 2 between two levels
        gain = 2 * (n[size : window + 1] - n[: window + 1 - size]) + 2
        gain[0] = 2 * n[size] + 1  # from nothing to level ``size``
        gain[window - size] = 1 - 2 * n[window - size] if size < window else 0  # a window is finished
        gain[1:][n[1 : window + 1 - size] == 0] = np.iinfo(np.int64).max
        return int(gain.argmin())

    def place(self, piece: tuple) -> list[list]:
        size = len(piece[2])
        if size == self.window:
            return [[piece]]
        h = self.level(size)
        pieces = []
        if h:
            pieces = self.open[h].pop()
            self.counts[h] -= 1
            self.n_open -= 1
        pieces.append(piece)
        if h + size == self.window:
            return [pieces]
        self.open.setdefault(h + size, []).append(pieces)
        self.counts[h + size] += 1
        self.n_open += 1
        return self.flush(last=False) if self.n_open > MAX_OPEN else []

    def flush(self, last: bool = True) -> list[list]:
        """Join what is open and cut it into full windows; the last tokens
        stay open, or (``last``) become sequences of a power of two."""
        pieces = [p for h in sorted(self.open, reverse=True) for own in self.open[h] for p in own]
        total = sum(len(p[2]) for p in pieces)
        sizes = [self.window] * (total // self.window)
        rest = total % self.window
        if last:
            sizes += [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
        elif rest:
            sizes.append(rest)
        done, own, room = [], [], iter(sizes)
        left = next(room, 0)
        for doc, start, ids, n in pieces:
            while len(ids):
                own.append((doc, start, ids[:left], n))
                start, ids, left = start + min(left, len(ids)), ids[left:], left - min(left, len(ids))
                if not left:
                    done.append(own)
                    own, left = [], next(room, 0)
        self.open, self.n_open = {}, 0
        self.counts[:] = 0
        if not last and rest:
            self.open[rest], self.n_open = [done.pop()], 1
            self.counts[rest] = 1
        return done


def _encoder(path: str) -> WordEncoder:
    """One per worker process, whatever the number of tasks it runs."""
    import sys
    import types

    kept = sys.modules.setdefault("_rowsieve_kept", types.ModuleType("_rowsieve_kept")).__dict__
    if ("encoder", path) not in kept:
        kept["encoder", path] = WordEncoder(path)
    return kept["encoder", path]


def _pack_batches(path: str, window: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, packer = _encoder(path), SumOfSquares(window)
        sequence = TaskContext.get().partitionId() << 33
        end = np.array([end_id], np.uint32)

        def rows(sequences):
            nonlocal sequence
            out = []
            for pieces in sequences:
                offset = 0
                for doc, start, ids, n in pieces:
                    out.append((doc, start, ids.tobytes(), n, sequence, offset))
                    offset += len(ids)
                sequence += 1
            names = ["doc_id", "start", "ids", "doc_tokens", "sequence_id", "offset"]
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=names)

        for batch in batches:
            texts, docs = column(batch, "text"), column(batch, "doc_id")
            for lo, hi in blocks(texts, 2 << 20):
                done = []
                encoded = encoder.encode(texts.slice(lo, hi - lo).fill_null(""))
                for doc, ids in zip(docs.slice(lo, hi - lo).to_pylist(), encoded):
                    ids = np.concatenate([ids, end])
                    for start in range(0, len(ids), window):
                        done += packer.place((doc, start, ids[start : start + window], len(ids)))
                yield rows(done)
        yield rows(packer.flush())
        # the worker lives on, maybe for other operators: it keeps no words, and gives its memory back
        encoder.forget()
        pa.default_memory_pool().release_unused()

    return run


def pack(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Pieces (doc_id, start, ids, doc_tokens, sequence_id, offset): ``ids``
    are little-endian unsigned 32-bit token ids, at ``offset`` of their
    sequence and from ``start`` of their document's ``doc_tokens`` ids.
    ``tokenizer`` is the path of a tokenizer file that drops white space."""
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return docs.mapInArrow(_pack_batches(tokenizer, window, end_id), PIECES)


def with_digests(pieces: DataFrame) -> DataFrame:
    """The pieces with the length and checksum of their ids."""
    length = (F.octet_length("ids") / 4).cast("long").alias("length")
    return pieces.select("doc_id", "start", length, F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "ids")
