"""Near-duplicate classes with SetSketch registers.

A text's set is its distinct five-word shingles (``[^\\x20\\x09-\\x0D]+``
words, A-Z lower-cased; fewer words are one shingle, no word an empty set
that is linked with nothing).  Two texts are linked when
``100 * |A & B| >= 85 * |A | B|``; a class is a connected component.

1. *Sketch.*  Every set becomes ``M`` registers: register ``i`` holds the
   exponentially spaced, truncated minimum ``floor(1 - log_b min h_i)`` over
   the set, ``h_i`` exponential.  Registers of a union are the maxima of the
   parts' registers (mergeable), and equal registers of two sets become
   likelier with their similarity (locality-sensitive).  Sets with the same
   content are one node from here on.
2. *Band.*  ``BANDS`` groups of ``ROWS`` registers are hashed; sets that share
   a band meet in a bucket.  At a similarity of 0.85 two sets miss every band
   with a chance of 2e-9.
3. *Pivots.*  Each node is tested against the smallest node of its buckets,
   and what is linked is contracted, so a large group of near copies becomes
   one class by a number of tests in proportion to its size.
4. *The rest, whole.*  Buckets that still hold several classes are tested
   throughout, between members of different classes only, in blocks of
   bounded size.  Inside a block, links that join classes already joined add
   nothing and are not sought; nothing is capped or sampled.

Every test first estimates the similarity jointly from the two sketches by
maximum likelihood (given the exact set sizes, the counts of registers that
are larger, smaller and equal), drops pairs far below the threshold, and
then confirms the link on the full sets.

Defined cases: null text is empty; a null id is no document that others can
name: its ``component_id`` is null, it links to nothing and is kept; rows that repeat an id are one
node with all their sets; extra columns are ignored; empty input gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsieve.llm.components import components
from rowsieve.llm.grouped import among, by_group, without
from rowsieve.llm.tables import save, shared_folder
from rowsieve.llm.text import GOLDEN, blocks, column, mix, shingle_sets, stream

M, ROWS, BANDS = 256, 6, 42
BASE, RATE, TOP = 1.001, 20.0, 2**16 - 2
SHINGLE = 5
THRESHOLD = (85, 100)
#: Estimates below are no links: six standard errors of the estimate under 0.85.
ESTIMATE_FLOOR = 0.715
BLOCK_ROWS, BLOCK_SHINGLES = 256, 1_000_000

_ORDERS = np.argsort(stream(21, 4096 * M).reshape(4096, M), axis=1).astype(np.uint8)
_BAND_WEIGHTS = stream(22, ROWS) | np.uint64(1)
_BAND_SEEDS = stream(23, BANDS)


def registers(values: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """SetSketch registers (texts x M, uint16) of the sets ``values[ptr]``.

    An element's ``M`` exponential values are drawn in ascending order and
    dealt to the registers in a random order of its own; an element is done
    once its next value can no longer raise the lowest register of its set.
    """
    out = np.zeros((len(ptr) - 1, M), np.uint16)
    flat = out.reshape(-1)
    doc = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))
    h = values
    order = (h >> np.uint64(52)).astype(np.int64)
    x = np.zeros(len(h))
    scale = 1 / np.log(BASE)
    for j in range(M):
        with np.errstate(over="ignore"):
            u = ((mix(h + GOLDEN * np.uint64(j + 1)) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        x = x - np.log(u) / (RATE * (M - j))
        k = np.clip(np.floor(1 - np.log(x) * scale), 0, TOP + 1).astype(np.uint16)
        np.maximum.at(flat, doc * M + _ORDERS[order, j], k)
        alive = k > out.min(axis=1)[doc]
        if not alive.all():
            doc, h, x, order = doc[alive], h[alive], x[alive], order[alive]
        if not len(h):
            break
    return out


def band_hashes(sketches: np.ndarray) -> np.ndarray:
    """(texts x BANDS) int64 hashes of the banded register values."""
    with np.errstate(over="ignore"):
        parts = sketches[:, : ROWS * BANDS].astype(np.uint64).reshape(-1, BANDS, ROWS) + np.uint64(1)
        return mix((parts * _BAND_WEIGHTS).sum(axis=2, dtype=np.uint64) + _BAND_SEEDS).view(np.int64)


def _collide(x: np.ndarray) -> np.ndarray:
    """-log_b(1 - x (b - 1) / b): the chance that one register is larger."""
    return -np.log1p(-np.clip(x, 1e-12, 1.0) * (BASE - 1) / BASE) / np.log(BASE)


def _slope(j, n_u, n_v, larger, smaller) -> np.ndarray:
    """Slope at similarity ``j`` of the log-likelihood of the counts of
    registers in which U's value is larger, smaller or equal."""
    u, v = n_u / (n_u + n_v), n_v / (n_u + n_v)
    equal = M - larger - smaller

    def like(t):
        p, q = _collide(u - v * t), _collide(v - u * t)
        return larger * np.log(p) + smaller * np.log(q) + equal * np.log(np.clip(1 - p - q, 1e-12, 1))

    return like(j + 1e-6) - like(j - 1e-6)


def joint_estimate(n_u, n_v, larger, smaller) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of sets of known sizes."""
    n_u, n_v, larger, smaller = (np.asarray(x, float) for x in (n_u, n_v, larger, smaller))
    lo, hi = np.zeros_like(n_u), np.minimum(n_u / n_v, n_v / n_u)
    for _ in range(24):
        mid = (lo + hi) / 2
        up = _slope(mid, n_u, n_v, larger, smaller) > 0
        lo, hi = np.where(up, mid, lo), np.where(up, hi, mid)
    return (lo + hi) / 2


def estimate_reaches(floor: float, n_u, n_v, larger, smaller) -> np.ndarray:
    """Whether the joint estimate is ``floor`` or more: the likelihood has one
    peak, so its slope there tells."""
    return _slope(floor, n_u, n_v, larger, smaller) >= 0


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib

    for batch in batches:
        texts = column(batch, "text")
        for lo, hi in blocks(texts, 1 << 20):
            values, ptr = shingle_sets(texts.slice(lo, hi - lo), SHINGLE)
            sketches = registers(values, ptr)
            raw = values.tobytes()
            digests = [hashlib.md5(raw[8 * a : 8 * b]).digest() for a, b in zip(ptr[:-1], ptr[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    column(batch, "id").slice(lo, hi - lo),
                    pa.array(np.diff(ptr), pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array([s.tobytes() for s in sketches], pa.binary()),
                ],
                names=["id", "n", "digest", "sketch"],
            )


def sketch(docs: DataFrame) -> DataFrame:
    """``docs(id, text)``: (id, n, digest, sketch)."""
    return docs.select("id", "text").mapInArrow(_sketch_batches, "id long, n long, digest binary, sketch binary")


def _stack(col: pa.Array) -> np.ndarray:
    if not len(col):
        return np.empty((0, M), np.uint16)
    return np.frombuffer(b"".join(col.to_pylist()), np.uint16).reshape(-1, M)


def _band_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes = band_hashes(_stack(column(batch, "sketch")))
        ids = column(batch, "id").take(pa.array(np.repeat(np.arange(len(hashes)), BANDS)))
        yield pa.RecordBatch.from_arrays([pa.array(hashes.reshape(-1)), ids], names=["h", "id"])


def _possible(n, sketches, part, labels, cross, first, g):
    """Pairs (i, j) of a block worth confirming: of different classes, sizes
    within the threshold, estimate not far below it, and (``first``) not met
    in an earlier band's bucket already."""
    num, den = THRESHOLD
    left = np.flatnonzero(part == 0)
    right = np.flatnonzero(part == 1) if cross else left
    bands = band_hashes(sketches) if first else None
    found = []
    for i in left:
        js = right if cross else right[right > i]
        js = js[(labels[js] != labels[i]) & (den * np.minimum(n[js], n[i]) >= num * np.maximum(n[js], n[i]))]
        if bands is not None and len(js):
            same = bands[i] == bands[js]
            js = js[same.any(axis=1) & (bands[i][same.argmax(axis=1)] == g)]
        if len(js):
            larger, smaller = (sketches[i] > sketches[js]).sum(axis=1), (sketches[i] < sketches[js]).sum(axis=1)
            found.append((np.full(len(js), i), js, larger, smaller))
    if not found:
        return []
    i, j, larger, smaller = map(np.concatenate, zip(*found))
    close = estimate_reaches(ESTIMATE_FLOOR, n[i].astype(float), n[j].astype(float), larger, smaller)
    return list(zip(i[close].tolist(), j[close].tolist()))


_GROUP = "g long, x int, y int, cross boolean, first boolean, part int, id long, label long, n long, digest binary, sketch binary"
_NAMES = [f.split()[0] for f in _GROUP.split(", ")]
_KEYS = ["g", "x", "y", "cross"]


def _block_columns(table: pa.Table):
    take = lambda name: table.column(name).to_numpy()
    one = lambda name: table.column(name)[0].as_py()
    return take("n"), _stack(column(table, "sketch")), take("part"), take("label"), one("cross"), one("first"), one("g")


def _shortlist(table: pa.Table) -> pa.Table:
    """The rows of a block that have a pair worth confirming."""
    found = {k for pair in _possible(*_block_columns(table)) for k in pair} if len(table) > 1 else ()
    return table.take(pa.array(sorted(found), pa.int64()))


def _confirm(table: pa.Table) -> pa.Table:
    """Links of a block on full sets: a spanning set of links between
    classes (a link that joins what is joined already adds nothing)."""
    import hashlib

    num, den = THRESHOLD
    values, ptr = shingle_sets(column(table, "text"), SHINGLE)
    sets = [values[a:b] for a, b in zip(ptr[:-1], ptr[1:])]
    # an id may have several texts: each row keeps the text that its sketch is of
    own = [hashlib.md5(s.tobytes()).digest() == d for s, d in zip(sets, table.column("digest").to_pylist())]
    table, sets = table.filter(pa.array(own, pa.bool_())), [s for s, ok in zip(sets, own) if ok]
    links = []
    if len(table):
        ids, labels = table.column("id").to_pylist(), table.column("label").to_pylist()
        roots = {x: x for x in labels}

        def root(x):
            while roots[x] != x:
                roots[x] = x = roots[roots[x]]
            return x

        for i, j in _possible(*_block_columns(table)):
            a, b = root(labels[i]), root(labels[j])
            if a == b:
                continue
            common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if den * common >= num * (len(sets[i]) + len(sets[j]) - common):
                roots[a] = b
                links.append((ids[i], ids[j]))
    a, b = zip(*links) if links else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _links(groups: DataFrame, sets: DataFrame, docs: DataFrame, folder: str) -> DataFrame:
    """``groups(g, x, y, cross, first, part, id, label)``: confirmed links (a, b)."""
    groups = save(groups, folder)
    rows = groups.join(among(sets, groups), "id").select(_NAMES)
    short = save(by_group(rows, _KEYS, _shortlist, _GROUP), folder)
    return save(by_group(short.join(among(docs, short), "id"), _KEYS, _confirm, "a long, b long"), folder)


def _n_blocks(rows, shingles):
    return F.greatest(F.ceil(rows / BLOCK_ROWS), F.ceil(shingles / BLOCK_SHINGLES)).cast("int")


def _own_block(n: str):
    return F.pmod(F.xxhash64("id"), F.col(n)).cast("int")


def _each_block(n: str):
    return F.explode(F.sequence(F.lit(0), F.col(n) - 1))


def _star_groups(members: DataFrame, buckets: DataFrame, sets: DataFrame, folder: str) -> DataFrame:
    """Every node against one pivot, the smallest node it shares a bucket with."""
    star = members.join(buckets, "h").groupBy("id").agg(F.min("pivot").alias("pivot")).where("pivot < id")
    star = save(star.join(sets.select("id", "n"), "id"), folder)
    pivots = save(star.groupBy("pivot").agg(_n_blocks(F.count("*"), F.sum("n")).alias("blocks")), folder)
    plain = [F.lit(0).alias("y"), F.lit(True).alias("cross"), F.lit(False).alias("first")]
    spokes = star.join(pivots, "pivot")
    spokes = spokes.select(
        F.col("pivot").alias("g"), _own_block("blocks").alias("x"), *plain, F.lit(0).alias("part"), "id", F.col("id").alias("label")
    )
    hubs = pivots.withColumnRenamed("pivot", "id").select(
        F.col("id").alias("g"), _each_block("blocks").alias("x"), *plain, F.lit(1).alias("part"), "id", F.col("id").alias("label")
    )
    return spokes.union(hubs)


def _mixed_groups(members: DataFrame, labels: DataFrame, sets: DataFrame, folder: str) -> DataFrame:
    """Buckets with several classes, whole: the members outside the largest
    class against that class and against each other, in pairs of blocks."""
    labelled = members.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    mixed = labelled.groupBy("h").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("h")
    rest = save(labelled.join(save(mixed, folder), "h").join(sets.select("id", "n"), "id"), folder)
    classes = rest.groupBy("h", "label").agg(F.count("*").alias("k"), F.sum("n").alias("s"))
    sizes = classes.groupBy("h").agg(
        F.max(F.struct("k", F.negative("label").alias("minus"), "s")).alias("big"), F.sum("k").alias("k"), F.sum("s").alias("s")
    )
    sizes = save(
        sizes.select(
            "h",
            F.negative("big.minus").alias("major"),
            _n_blocks(F.col("big.k"), F.col("big.s")).alias("nb"),
            _n_blocks(F.col("k") - F.col("big.k"), F.col("s") - F.col("big.s")).alias("na"),
        ),
        folder,
    )
    rest = rest.join(sizes, "h").withColumnRenamed("h", "g").withColumn("first", F.lit(True))
    minor, major = rest.where("label <> major"), rest.where("label = major")
    cross = F.lit(True).alias("cross")
    left = minor.select("g", _own_block("na").alias("x"), _each_block("nb").alias("y"), cross, "first", F.lit(0).alias("part"), "id", "label")
    right = major.select("g", _each_block("na").alias("x"), _own_block("nb").alias("y"), cross, "first", F.lit(1).alias("part"), "id", "label")
    among = minor.select("g", "first", "id", "label", _own_block("na").alias("own"), _each_block("na").alias("met"))
    among = among.select(
        "g",
        F.least("own", "met").alias("x"),
        (F.lit(-1) - F.greatest("own", "met")).alias("y"),  # negative: no clash with blocks of the largest class
        (F.col("own") != F.col("met")).alias("cross"),
        "first",
        (F.col("own") > F.col("met")).cast("int").alias("part"),
        "id",
        "label",
    )
    return left.union(right).union(among)


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), a row per row of ``df``."""
    folder = shared_folder(df.sparkSession)
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = save(sketch(docs), folder)

    # sets with the same content are one node, named by the smallest id
    filled = rows.where("n > 0 AND id IS NOT NULL")
    sets = filled.groupBy("digest").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    sets = save(sets, folder)
    repeated = filled.groupBy("id").agg(F.count("*").alias("k"), F.min("digest").alias("lo"), F.max("digest").alias("hi"))
    repeated = save(repeated.where("k > 1").select("id", (F.col("lo") != F.col("hi")).alias("several")), folder)
    if not repeated.isEmpty():  # one row per text of an id is enough
        docs = docs.join(repeated, "id", "left_anti").union(docs.join(repeated, "id", "left_semi").distinct())

    members = save(sets.select("id", "sketch").mapInArrow(_band_batches, "h long, id long"), folder)
    buckets = members.groupBy("h").agg(F.min("id").alias("pivot"), F.max("id").alias("top")).where("pivot < top")
    buckets = save(buckets.drop("top"), folder)
    members = save(among(members, buckets, "h"), folder)

    links = _links(_star_groups(members, buckets, sets, folder), sets, docs, folder)
    versions = filled.join(repeated.where("several"), "id").select("id", "digest")
    versions = versions.join(sets.select("digest", F.col("id").alias("b")), "digest").select(F.col("id").alias("a"), "b")
    links = links.union(versions)
    more = _links(_mixed_groups(members, components(links, folder), sets, folder), sets, docs, folder)
    labels = components(links.union(more), folder)

    classes = sets.select("digest", "id").join(labels, "id", "left").select("digest", F.coalesce("label", "id").alias("label"))
    found = rows.join(classes, "digest", "left").select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("label", "id")).alias("component_id"),
    )
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` less all but one of each class: the row whose id
    names the class.  Rows that repeat a kept id stay once; rows without an
    id stay."""
    folder = shared_folder(df.sparkSession)
    found = save(near_duplicates(df, id_col, text_col).where("doc_id IS NOT NULL").select(F.col("doc_id").alias("__id"), "kept"), folder)
    out = df.withColumn("__id", F.col(id_col).cast("long"))
    out = without(out, save(found.where("NOT kept"), folder), "__id")
    repeated = save(found.where("kept").groupBy("__id").agg(F.count("*").alias("k")).where("k > 1"), folder)
    if not repeated.isEmpty():
        out = without(out, repeated, "__id").union(among(out, repeated, "__id").dropDuplicates(["__id"]))
    return out.select(*[F.col(f"`{c}`") for c in df.columns])
