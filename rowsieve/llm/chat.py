"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole, turn after turn:

    <|turn|>role<|text|>text<|end|>

and encoded once, with offsets, by a public byte-level tokenizer to which the three
markers are added as special tokens.  The spans of the texts to learn from
(``LEARN`` roles) and the tokens' spans are both sorted, so binary search
finds the tokens that a span covers, and the code points of a token inside
it; these are the loss mask.

Control strings inside roles and texts (the markers' ``<|``, and ``<s>``,
``</s>``, ``[INST]``, ``[/INST]``, ``<<SYS>>``, ``<</SYS>>`` of other
templates) get a backslash after their first character, one more than they
have there already; ``unescape`` takes it away again.

A conversation of more than ``PART_CHARS`` code points is rendered and
encoded in parts cut between turns, which follow each other in order, so a
task holds one part and one turn whatever a conversation's length; equal
``turn`` values keep a fixed order by role and text.

Defined cases: null text and null role are empty; a null conversation id is
a conversation like any other, rows with a null turn come first; rows that
repeat are turns each; extra columns are ignored; an empty table gives no
rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PART_CHARS = 1 << 20
LEARN = ("assistant",)
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"

_CONTROL = r"(\||s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>)"
_ESCAPE = re.compile(r"([<\[])(\\*)" + _CONTROL)
_UNESCAPE = re.compile(r"([<\[])\\(\\*)" + _CONTROL)


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2\3", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text and, per turn, the span of its (escaped) text."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{TURN}{escape(role)}{TEXT}", escape(text)
        spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at = spans[-1][1] + len(END)
    return "".join(parts), spans


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts read back from a formatted text."""
    out = []
    for part in formatted.split(TURN)[1:]:
        role, _, rest = part.partition(TEXT)
        if not rest.endswith(END):
            raise ValueError("a turn does not end with its marker")
        out.append((unescape(role), unescape(rest.removesuffix(END))))
    return out


def mask(offsets: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Rows (token, from, to): the code points of tokens (``offsets``: sorted
    start, end) that lie in the sorted disjoint ``spans``."""
    if not len(offsets) or not len(spans):
        return np.empty((0, 3), np.int64)
    first = np.searchsorted(offsets[:, 1], spans[:, 0], "right")
    last = np.searchsorted(offsets[:, 0], spans[:, 1], "left")
    n = np.maximum(last - first, 0)
    token = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    span = np.repeat(np.arange(len(spans)), n)
    start = np.maximum(offsets[token, 0], spans[span, 0])
    return np.column_stack([token, start, np.minimum(offsets[token, 1], spans[span, 1])])


def masked_texts(formatted: str, rows: np.ndarray) -> list[str]:
    """The texts under a mask, unescaped, in order: runs of code points that
    follow each other (two learned texts always have markers between)."""
    runs: list[list[int]] = []
    for _, a, b in rows.tolist():
        if runs and a <= runs[-1][1]:  # tokens may share a code point
            runs[-1][1] = max(b, runs[-1][1])
        else:
            runs.append([a, b])
    return [unescape(formatted[a:b]) for a, b in runs]


class Encoder:
    def __init__(self, path: str):
        from tokenizers import AddedToken, Tokenizer, processors

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)  # spaces belong to their tokens
        self.tokenizer.add_special_tokens([AddedToken(m, normalized=False, special=True) for m in (TURN, TEXT, END)])

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets in code points)."""
        found = self.tokenizer.encode(text, add_special_tokens=False)
        return np.array(found.ids, np.int32), np.array(found.offsets, np.int64).reshape(-1, 2)


FORMATTED = "conv_id long, part long, n_turns long, formatted string, ids array<int>, mask array<struct<token:int,start:int,end:int>>"


def _format_batches(path: str, learn: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        kind = pa.list_(pa.struct([("token", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
        conv, part, turns, size, begun = None, 0, [], 0, False

        def out():
            formatted, spans = render(turns)
            ids, offsets = encoder.encode(formatted)
            rows = mask(offsets, np.array([s for s, (role, _) in zip(spans, turns) if role in learn and s[1] > s[0]], np.int64).reshape(-1, 2))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([conv], pa.int64()), pa.array([part], pa.int64()), pa.array([len(turns)], pa.int64()),
                    pa.array([formatted], pa.string()), pa.array([ids.tolist()], pa.list_(pa.int32())),
                    pa.array([[{"token": t, "start": a, "end": b} for t, a, b in rows.tolist()]], kind),
                ],
                names=[f.split()[0] for f in re.split(", (?=[a-z_]+ )", FORMATTED)],
            )

        for batch in batches:
            for own, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "role", "text"))):
                if begun and own != conv:
                    yield out()
                    part, turns, size = 0, [], 0
                elif turns and size + len(text) > PART_CHARS:
                    yield out()
                    part, turns, size = part + 1, [], 0
                conv, begun = own, True
                turns.append((role, text))
                size += len(text)
        if begun:
            yield out()

    return run


def format_chats(df: DataFrame, tokenizer: str, learn: tuple[str, ...] = LEARN) -> DataFrame:
    """Per conversation (and part, for very long ones, in order): the
    formatted text, its token ids, and the loss mask: tokens and the code
    points of the formatted text that they cover inside learned texts."""
    rows = df.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(_format_batches(tokenizer, learn), FORMATTED)


_DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of a conversation follow each other; hashes run over them."""
    state = None

    def out():
        conv, n, turns, chars, loss, size = state
        return pa.RecordBatch.from_arrays(
            [pa.array([v], k) for v, k in zip((conv, n, turns.hexdigest(), chars, loss.hexdigest(), size), (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()))],
            names=[f.split()[0] for f in _DIGEST.split(", ")],
        )

    for batch in batches:
        for row in batch.to_pylist():
            if row["part"] == 0:
                if state is not None:
                    yield out()
                state = [row["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            turns = read_turns(row["formatted"])
            spans = np.array([(m["token"], m["start"], m["end"]) for m in row["mask"]], np.int64).reshape(-1, 3)
            loss = "".join(masked_texts(row["formatted"], spans))
            for role, text in turns:
                state[2].update(f"{role}\n{text}\n".encode())
            state[1] += len(turns)
            state[3] += len(loss)
            state[4].update(loss.encode())
            state[5] += len(row["formatted"])
    if state is not None:
        yield out()


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back from ``format_chats``'s rows as they come:
    turns, loss text and their hashes."""
    return formatted.mapInArrow(_digest_batches, _DIGEST)
