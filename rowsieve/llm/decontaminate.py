"""Benchmark decontamination by template windows.

Texts are brought to templates: words (A-Z and U+00C0-U+00DE lower-cased,
punctuation at word ends dropped) with numbers, names (a capital and small
letters, inside a sentence) and units
(after a number) replaced by typed placeholders.  Case and place of a word
can mislead about names, so a window is hashed in up to three forms: with
names only where a capital stands inside a sentence, with every capitalised
word as a name (one that opens a sentence may be a name as well), and with
none, as a passage in other case or wrapped at other line ends is met.  Any
form may meet; what is a value of the item is bound the same in all of them.
Windows of ``WIDTH``
template words of every benchmark item are hashed; whole documents are
hashed the same way and joined on the hash, so a question whose numbers or
names were changed still meets its item.  All hits of an item in a document
count together, however far apart: a run of numbers or words put in between
leave holes, and the parts on both sides are added up.  Slots must agree: one
value of the item stands for one value of the document and the other way
round.  Hits of one alignment (the same distance between the places in
document and item) are bound together, by majority, so a window that also
meets another place of its item does not disturb them; windows with slots
that disagree are dropped.  A document is contaminated when at least
``SHARE`` of an item's windows are left.

The documents are read once and never shuffled.  Benchmark items reach the
tasks in blocks of ``BLOCK_BYTES`` of text, measured before, one after the
other on the same row, so a large benchmark costs more passes over a row's
words, not more memory, and drops nothing.

Defined cases: null or empty text (of either side) has no window and matches
nothing; texts shorter than a window are one window of all their words, where a word
that opens the text is no name;
windows that are mostly placeholders count only for items that have no
other; items that repeat are reported each; null ids are carried; extra
columns are ignored or kept as they are; empty tables give no hits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsieve.llm.text import LETTERS, blocks, buffers, column, hash_spans, mix, stream

WIDTH = 5
SHARE = 0.8
BLOCK_BYTES = 8 << 20

# Unit words (after a number) and number words.
UNITS = (
    "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers "
    "g kg mg lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces ton tons s sec min h hr second seconds "
    "minute minutes hour hours day days week weeks month months year years ml l liter liters litre litres gallon gallons "
    "mph kph dollar dollars euro euros cent cents percent degrees celsius fahrenheit watt watts volt volts"
).split()
NUMBER_WORDS = "two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty hundred thousand million".split()

_NUMBER, _NAME, _UNIT = stream(31, 3)
_WEIGHTS = stream(32, WIDTH) | np.uint64(1)


def _known(words: list[str]) -> np.ndarray:
    raw = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    return np.sort(hash_spans(raw, ends - [len(w) for w in words], ends))


_UNIT_HASHES, _NUMBER_HASHES = _known(UNITS), _known(NUMBER_WORDS)


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def shapes(texts: pa.Array):
    """(values, plain, template, wide, ptr): hashes of the words as they are;
    with placeholders for numbers and units; for names inside sentences as
    well; for every capitalised word.  Words of text ``i`` are
    ``ptr[i]:ptr[i+1]``."""
    data, offsets = buffers(texts)
    n = len(data)
    inside = LETTERS[data]
    digit = (data >= 48) & (data <= 57)
    point = (data == 46) | (data == 44)
    if n > 2:  # 1,000 and 3.5 are one word
        inside[1:-1] |= point[1:-1] & digit[:-2] & digit[2:]
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    border = offsets[(offsets > 0) & (offsets < n)]
    before[border], after[border - 1] = False, False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    ptr = np.searchsorted(starts, offsets)
    folded = data.copy()  # capitals beyond A-Z: U+00C0-U+00DE
    folded[1:][(data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)] += 0x20
    values = hash_spans(folded, starts, ends)
    plain, template, wide = values.copy(), values.copy(), values.copy()
    if len(starts):
        marks = np.concatenate([[0], np.cumsum(digit | point)])
        number = (marks[ends] - marks[starts] == ends - starts) | _among(values, _NUMBER_HASHES)
        byte = lambda at: np.where(at < ends, data[np.minimum(at, n - 1)], 0)
        ascii_first = (data[starts] >= 65) & (data[starts] <= 90)
        other_first = (data[starts] == 0xC3) & (byte(starts + 1) >= 0x80) & (byte(starts + 1) <= 0x9E)
        then = np.where(other_first, starts + 2, starts + 1)
        small = (byte(then) >= 97) & (byte(then) <= 122) | (byte(then) == 0xC3) & (byte(then + 1) >= 0xA0)
        capital = (ascii_first | other_first) & small  # a word all in capitals is no name
        stops = np.concatenate([[0], np.cumsum(np.isin(data, list(b'.!?:;"')))])
        lines = np.concatenate([[0], np.cumsum(data == 10)])  # a blank line ends a sentence, a wrapped line does not
        first = np.zeros(len(starts), bool)
        first[ptr[:-1][ptr[:-1] < len(starts)]] = True
        first[1:] |= (stops[starts[1:]] > stops[ends[:-1]]) | (lines[starts[1:]] > lines[ends[:-1]] + 1)
        unit = np.zeros(len(starts), bool)
        unit[1:] = number[:-1] & _among(values[1:], _UNIT_HASHES) & ~first[1:]
        for own in (plain, template, wide):
            own[number], own[unit] = _NUMBER, _UNIT
        template[capital & ~first & ~number], wide[capital & ~number & ~unit] = _NAME, _NAME
    return values, plain, template, wide, ptr


def templates(texts: pa.Array):
    """(values, template, ptr) of ``shapes``."""
    values, _, template, _, ptr = shapes(texts)
    return values, template, ptr


def _slots(template: np.ndarray) -> np.ndarray:
    return (template == _NUMBER) | (template == _NAME) | (template == _UNIT)


def _hashes(template: np.ndarray, ptr: np.ndarray, text: np.ndarray, place: np.ndarray) -> np.ndarray:
    at, n = ptr[text] + place, np.diff(ptr)[text]
    padded = np.concatenate([template, np.zeros(WIDTH, np.uint64)])
    total = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(WIDTH):
            total += np.where(place + k < n, padded[at + k], np.uint64(0)) * _WEIGHTS[k]
    return mix(total)


def windows(ptr: np.ndarray):
    """(text, place) of every window; a shorter text is one window."""
    n = np.diff(ptr)
    count = np.where(n >= WIDTH, n - WIDTH + 1, np.minimum(n, 1))
    text = np.repeat(np.arange(len(n)), count)
    return text, np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)


def _inside(marked: np.ndarray, ptr: np.ndarray, text: np.ndarray, place: np.ndarray) -> np.ndarray:
    """How many marked words each window has."""
    total = np.concatenate([[0], np.cumsum(marked)])
    at = ptr[text] + place
    return total[np.minimum(at + WIDTH, ptr[text + 1])] - total[at]


def forms(plain: np.ndarray, template: np.ndarray, wide: np.ndarray, ptr: np.ndarray, text: np.ndarray, place: np.ndarray):
    """(hash, text, place) of windows in every form that is another one."""
    h = [_hashes(template, ptr, text, place)]
    own = [np.arange(len(text))]
    for other, long in ((plain, 0), (wide, WIDTH)):
        some = np.flatnonzero((_inside(other != template, ptr, text, place) > 0) & (np.diff(ptr)[text] >= long))
        h.append(_hashes(other, ptr, text[some], place[some]))
        own.append(some)
    own = np.concatenate(own)
    return np.concatenate(h), text[own], place[own]


class Items:
    """The windows of a block of benchmark items, ready to be met."""

    def __init__(self, ids: list, texts: pa.Array):
        self.ids = ids
        self.values, plain, template, self.template, self.ptr = shapes(texts)
        text, place = windows(self.ptr)
        few = 2 * _inside(_slots(template), self.ptr, text, place) <= WIDTH
        any_few = np.bincount(text, few, len(ids)) > 0
        used = few | ~any_few[text]
        text, place = text[used], place[used]
        self.total = np.bincount(text, minlength=len(ids))
        h, text, place = forms(plain, template, self.template, self.ptr, text, place)
        order = np.argsort(h, kind="stable")
        self.h, self.text, self.place = h[order], text[order], place[order]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.h >> np.uint64(44)).astype(np.int64)] = True

    def hits(self, h: np.ndarray):
        """(window of the documents, window of the items) of equal hash."""
        some = np.flatnonzero(self.maybe[(h >> np.uint64(44)).astype(np.int64)])
        lo, hi = np.searchsorted(self.h, h[some]), np.searchsorted(self.h, h[some], "right")
        n = hi - lo
        own = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(some, n), np.repeat(lo, n) + own

    def agreeing(self, values: np.ndarray, spots: np.ndarray, item: int, places: np.ndarray) -> int:
        """Of a document's hits (word ``spots``, item ``places``), how
        many windows of the item have slots that agree.  Hits of one
        diagonal (``spot - place``) are one alignment.  Each alignment is
        tried first: its values are bound by majority, then the alignments
        that add most windows bind what is still free."""
        k = np.arange(WIDTH)
        own = self.ptr[item] + places[:, None] + k
        inside = own < self.ptr[item + 1]
        own = np.where(inside, own, self.ptr[item])
        kind = self.template[own]
        slot = inside & _slots(kind)
        with np.errstate(over="ignore"):
            theirs = kind + self.values[own]
            mine = kind + values[np.where(inside, spots[:, None] + k, spots[:, None])]
        a_keys, a = np.unique(theirs, return_inverse=True)
        b_keys, b = np.unique(mine, return_inverse=True)
        a, b = a.reshape(slot.shape), b.reshape(slot.shape)
        _, diagonal = np.unique(spots - places, return_inverse=True)

        def bind(rows: np.ndarray, there: np.ndarray, back: np.ndarray):
            """Values of ``rows`` that are free, most frequent pairs first."""
            pairs = (a[rows] * len(b_keys) + b[rows])[slot[rows]]
            pairs, first, votes = np.unique(pairs, return_index=True, return_counts=True)
            x, y = pairs // len(b_keys), pairs % len(b_keys)
            for i in np.lexsort((first, a_keys[x] != b_keys[y], -votes)):
                if there[x[i]] < 0 and back[y[i]] < 0:
                    there[x[i]], back[y[i]] = y[i], x[i]

        best, tried, need = 0, set(), SHARE * self.total[item]
        size = np.bincount(diagonal)
        by_diagonal = np.split(np.argsort(diagonal, kind="stable"), np.cumsum(size)[:-1])
        for d in np.argsort(-size, kind="stable"):
            there, back = np.full(len(a_keys), -1), np.full(len(b_keys), -1)
            bind(by_diagonal[d], there, back)
            if there.tobytes() in tried:
                continue
            tried.add(there.tobytes())
            while True:
                bound = there[a] == b
                free = (there[a] < 0) & (back[b] < 0)
                may = np.flatnonzero((~slot | bound | free).all(1))
                if len(np.unique(places[may])) < max(need, best + 1):
                    break
                fine = np.unique(places[(~slot | bound).all(1)])
                left = may[~np.isin(places[may], fine)]
                if not len(left):
                    best = len(fine)
                    break
                most = np.argmax(np.bincount(diagonal[left]))
                bind(left[diagonal[left] == most], there, back)
            if best == self.total[item]:
                break
        return best

    def find(self, texts: pa.Array) -> list[list[tuple]]:
        """Per text the (item id, share of its windows) of items found."""
        out: list[list[tuple]] = [[] for _ in range(len(texts))]
        values, plain, template, wide, ptr = shapes(texts)
        h, text, place = forms(plain, template, wide, ptr, *windows(ptr))
        mine, theirs = self.hits(h)
        if not len(mine):
            return out
        doc, spot = text[mine], place[mine]
        item, q = self.text[theirs], self.place[theirs]
        order = np.lexsort((q, spot, item, doc))
        doc, spot, item, q = doc[order], spot[order], item[order], q[order]
        once = np.ones(len(doc), bool)  # a pair may meet in several forms
        once[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (spot[1:] != spot[:-1]) | (q[1:] != q[:-1])
        doc, spot, item, q = doc[once], spot[once], item[once], q[once]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])
        begins = np.flatnonzero(new)
        for a, b in zip(begins, np.append(begins[1:], len(doc))):
            if len(np.unique(q[a:b])) < SHARE * self.total[item[a]]:
                continue
            share = self.agreeing(values, ptr[doc[a]] + spot[a:b], int(item[a]), q[a:b]) / self.total[item[a]]
            if share >= SHARE:
                out[doc[a]].append((self.ids[item[a]], float(share)))
        return out


def _blocks_of_items(benchmark: DataFrame, id_col: str, text_col: str):
    """The benchmark's rows in blocks whose text is bounded."""
    items = benchmark.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    items = items.where(F.length("text") > 0)
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // BLOCK_BYTES)
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("text"), F.lit(n)) == k).toArrow()
        yield rows.column("id").to_pylist(), column(rows, "text")


_FOUND = "array<struct<item_id:bigint,share:double>>"


def _finder(ids: list, texts: pa.Array):
    kept: list[Items] = []  # the items' windows, made once per task

    @F.arrow_udf(_FOUND)
    def find(documents: pa.Array) -> pa.Array:
        if not kept:
            kept.append(Items(ids, texts))
        out = [own for lo, hi in blocks(documents) for own in kept[0].find(documents.slice(lo, hi - lo))]
        rows = [[{"item_id": i, "share": s} for i, s in own] for own in out]
        return pa.array(rows, pa.list_(pa.struct([("item_id", pa.int64()), ("share", pa.float64())])))

    return find


def found(benchmark: DataFrame, text: Column, id_col: str = "item_id", text_col: str = "text") -> Column:
    """Column of the (item_id, share) of benchmark passages in ``text``."""
    parts = [_finder(ids, texts)(text.cast("string")) for ids, texts in _blocks_of_items(benchmark, id_col, text_col)]
    return F.concat(*parts) if parts else F.array().cast(_FOUND)


def contamination(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, contaminated, item_ids, share) of every row of ``df``."""
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), found(benchmark, F.col(text_col)).alias("found"))
    return rows.select(
        "doc_id",
        (F.size("found") > 0).alias("contaminated"),
        F.array_sort(F.array_distinct("found.item_id")).alias("item_ids"),
        F.coalesce(F.array_max("found.share"), F.lit(0.0)).alias("share"),
    )


def clean(df: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` without a benchmark passage."""
    return df.where(F.size(found(benchmark, F.col(text_col))) == 0)
