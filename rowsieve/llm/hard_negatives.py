"""Hard negatives mined by best-first search in an STR-packed R-tree.

Scores are inner products of whole-number vectors, floor(256 c) per entry, so
they are exact.  The tree is packed by sort-tile-recursive: rows are dealt to
parts by ranges of (label, widest coordinate, id), every part is cut into
slabs along its widest coordinates in turn, the last cut gives leaves of
``LEAF`` rows, and nodes of ``FAN`` children stand above them.  A node keeps
its minimum bounding box (least and greatest value of every coordinate) and
the range of its labels.

For an anchor q a box gives an interval of inner products: coordinate i adds
min and max of q_i * low_i and q_i * high_i.  A search keeps a queue of boxes,
the most promising first, and leaves a box aside only if its interval misses
every score window, its labels cannot match, or its upper end is strictly
below the kth score already found in each window (an equal score may still
win by its smaller id).  So the results are exact.

On Spark: parts are written once, a row per leaf.  Anchors visit the parts
whose own box can matter; the work is dealt out as (part, block of anchors),
and a task streams it: it holds one part's tree (``PART_ROWS`` rows) and one
batch of anchors.  A block holds ``BLOCK`` anchors, so a part that all anchors
visit is many tasks' work.  The best of every part are merged by a top-k per
anchor.  Boxes of parts up to ``BOX_BYTES`` reach the tasks that route
anchors; if they are larger, every anchor visits every part.

In many dimensions without clusters boxes overlap and little is pruned: the
search then scores most rows, leaf by leaf, which is what the contract asks
of every anchor; it is never less than exact.

Defined cases: rows with a null label, a null vector, or a null or non-finite
entry take no part; of vectors of several lengths, those of the most frequent
length (the longest among equals) do.  A row never is positive or negative of
an anchor with its own id; rows that repeat an id each take part, and each
one that is an anchor gets its own results.  Rows with a null id are no
anchors and come last among equal scores; the id 2**63 - 1 is read as null.
An anchor without positives, and a positive without a row in its window, give
no rows; so does an empty table.  Extra columns are ignored, whatever their
names.  A score that no long holds ends the run with an error.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowsieve.llm.tables import bound_batches, save, shared_folder
from rowsieve.llm.vectors import EXACT, exact_products, finite_rows

SCALE = 256.0
LEAF, FAN = 512, 16
#: Rows of a part at most, about; small tables get smaller parts, so that all cores have work.
PART_ROWS, LEAST_ROWS = 131_072, 8_192
#: Anchors of a block of work.
BLOCK = 16_384
BOX_BYTES = 64 << 20
NO_ID = 2**63 - 1

_ROW = "id long, label long, v binary"
_LEAF = "part int, ids array<bigint>, labels array<bigint>, low binary, high binary, v binary"


def _numbers(raw: Sequence[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)


# -- the tree of one part ----------------------------------------------------


def str_tiles(keys: np.ndarray, size: int) -> list[np.ndarray]:
    """Row numbers in tiles of at most ``size`` rows: slabs along the first
    column of ``keys``, each cut along the next ones."""

    def cut(rows: np.ndarray, column: int) -> Iterator[np.ndarray]:
        tiles = math.ceil(len(rows) / size)
        if tiles <= 1:
            yield rows
            return
        left = keys.shape[1] - column
        slabs = tiles if left <= 1 else math.ceil(tiles ** (1 / left))
        rows = rows[np.argsort(keys[rows, column], kind="stable")]
        per = math.ceil(tiles / slabs) * size if left > 1 else size
        for start in range(0, len(rows), per):
            yield from cut(rows[start : start + per], column + 1) if left > 1 else [rows[start : start + per]]

    return list(cut(np.arange(len(keys)), 0))


def widest(vectors: np.ndarray, most: int = 4) -> np.ndarray:
    """The coordinates with the greatest spread, at most ``most``."""
    if not len(vectors):
        return np.zeros(0, np.int64)
    return np.argsort(-vectors.std(0), kind="stable")[:most]


class Tree:
    """Leaves of one part, with boxes above them up to a root."""

    def __init__(self, ids, labels, lows, highs, vectors):
        self.ids, self.labels, self.vectors = ids, labels, vectors  # per leaf
        self.low, self.high = list(lows), list(highs)
        self.least, self.most = [int(x.min()) for x in labels], [int(x.max()) for x in labels]
        self.below: list[list[int]] = [[] for _ in ids]
        level = list(range(len(ids)))
        while len(level) > 1:
            above = []
            for start in range(0, len(level), FAN):
                some = level[start : start + FAN]
                self.below.append(some)
                self.low.append(np.min([self.low[i] for i in some], 0))
                self.high.append(np.max([self.high[i] for i in some], 0))
                self.least.append(min(self.least[i] for i in some))
                self.most.append(max(self.most[i] for i in some))
                above.append(len(self.below) - 1)
            level = above
        self.root = level[0]
        self.lows, self.highs = np.array(self.low), np.array(self.high)
        self.least, self.most = np.array(self.least), np.array(self.most)
        self.reach = float(max(np.abs(self.lows).max(initial=0), np.abs(self.highs).max(initial=0)))

    def intervals(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner product that each box allows; widened where doubles are not exact."""
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        low, high = self.lows @ up + self.highs @ down, self.highs @ up + self.lows @ down
        size = self.reach * float(np.abs(q).sum())
        slack = 0.0 if size < EXACT else size * 1e-12
        return low - slack, high + slack

    def search(self, anchor: int, label: int, q: np.ndarray, windows: list[tuple[float, float]], k: int, same: bool) -> list[list[tuple[int, int]]]:
        """Per window (least, greatest score) the ``k`` best (score, id), best
        first, among rows of the same or of another label."""
        low, high = self.intervals(q)
        fits = (self.least <= label) & (label <= self.most) if same else (self.least != label) | (self.most != label)
        found: list[list[tuple[int, int]]] = [[] for _ in windows]
        kth = [a for a, _ in windows]

        def promise(node: int) -> float:
            """The greatest score that the node may add, or -inf."""
            if not fits[node]:
                return -math.inf
            best = -math.inf
            for (a, b), least in zip(windows, kth):
                if high[node] >= least and high[node] >= a and low[node] <= b:
                    best = max(best, min(high[node], b))
            return best

        queue = [(-promise(self.root), self.root)]
        while queue:
            worth, node = heapq.heappop(queue)
            if worth == math.inf or promise(node) == -math.inf:
                continue
            if self.below[node]:
                for child in self.below[node]:
                    if (p := promise(child)) > -math.inf:
                        heapq.heappush(queue, (-p, child))
                continue
            scores = exact_products(self.vectors[node], q)
            other = (self.labels[node] == label) == same
            other &= self.ids[node] != anchor
            for w, (a, b) in enumerate(windows):
                rows = np.flatnonzero(other & (scores >= kth[w]) & (scores <= b))
                if len(rows):
                    if len(rows) > 4 * k:  # the kth largest score bounds what can stay
                        edge = np.partition(scores[rows], len(rows) - k)[len(rows) - k]
                        rows = rows[scores[rows] >= edge]
                    found[w] = sorted([*found[w], *((int(scores[r]), int(self.ids[node][r])) for r in rows)], key=lambda x: (-x[0], x[1]))[:k]
                    if len(found[w]) == k:
                        kth[w] = max(kth[w], found[w][-1][0])
        return found


# -- on Spark ----------------------------------------------------------------


def prepared(df: DataFrame, id_col: str, label_col: str, vector: str, relabel: Column | None) -> DataFrame:
    """(id, label, v) of the rows that take part; v is the whole-number vector."""
    label = F.col(label_col).cast("long") if relabel is None else relabel
    rows = df.select(F.col(id_col).cast("long"), label, F.col(vector)).toDF("id", "label", "x")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length in np.unique([len(v) for v in batch.column(2).drop_null()] or [0]):
                at, values = finite_rows(batch.column(2), int(length))
                if len(at):
                    v = np.floor(SCALE * values)
                    raw = pa.array([row.tobytes() for row in v], pa.binary())
                    yield pa.RecordBatch.from_arrays([batch.column(i).take(pa.array(at)) for i in (0, 1)] + [raw], ["id", "label", "v"])

    return rows.where("label IS NOT NULL").mapInArrow(run, _ROW)


def spread(rows: DataFrame) -> tuple[int, int, int]:
    """(rows, dimensions, widest coordinate) of the vectors of the most frequent length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for batch in batches:
            raw = batch.column(0).to_pylist()
            for size in {len(r) for r in raw}:
                v = _numbers([r for r in raw if len(r) == size])
                t = total.setdefault(size // 8, [0, 0.0, 0.0])
                t[0], t[1], t[2] = t[0] + len(v), t[1] + v.sum(0), t[2] + (v * v).sum(0)
        out = [(d, i, t[0], float(t[1][i]) if i >= 0 else 0.0, float(t[2][i]) if i >= 0 else 0.0) for d, t in total.items() for i in range(-1, d)]
        names, types = ["d", "i", "n", "s", "ss"], [pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, types)], names)

    sums = rows.select("v").mapInArrow(run, "d int, i int, n long, s double, ss double").groupBy("d", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss")).collect()
    n, d = max(((r["n"], r["d"]) for r in sums if r["i"] == -1), default=(0, 0))
    wide = [(r["ss"] / r["n"] - (r["s"] / r["n"]) ** 2, -r["i"]) for r in sums if r["d"] == d and r["i"] >= 0]
    return n, d, -max(wide)[1] if wide else 0


def pack(rows: DataFrame, n: int, dims: int, coordinate: int, folder: str) -> DataFrame:
    """The tree's leaves as written rows (part, ids, labels, low, high, v)."""
    cores = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(math.ceil(n / PART_ROWS), min(cores, math.ceil(n / LEAST_ROWS)))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array([len(r) == dims * 8 for r in batch.column("v").to_pylist()], pa.bool_()))
            if len(batch):
                key = _numbers(batch.column("v").to_pylist())[:, coordinate] if dims else np.zeros(len(batch))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key)], ["id", "label", "v", "key"])

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if len(b)]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        v, part = _numbers(table.column("v").to_pylist()), int(table.column("part")[0].as_py())
        ids = table.column("id").fill_null(NO_ID).to_numpy()
        labels = table.column("label").to_numpy()
        keys = np.column_stack([labels, v[:, widest(v)]])
        out = []
        for tile in str_tiles(keys, LEAF):
            some = v[tile]
            out.append((part, ids[tile].tolist(), labels[tile].tolist(), some.min(0).tobytes(), some.max(0).tobytes(), some.tobytes()))
        types = [pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]
        for start in range(0, len(out), FAN):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[start : start + FAN]), types)], [c.split()[0] for c in _LEAF.split(", ")])

    # equal labels and coordinates are dealt on by id and a hash of the vector, so no value fills a part alone
    dealt = rows.mapInArrow(keyed, _ROW + ", key double").repartitionByRange(parts, "label", "key", F.xxhash64("id", "v"))
    return save(dealt.select("id", "label", "v", F.spark_partition_id().alias("part")).mapInArrow(leaves, _LEAF), folder)


def _boxes(tree: DataFrame) -> list:
    """Per part its bounding box and label range; [] where these exceed BOX_BYTES."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list] = {}
        for batch in batches:
            for part, labels, low, high in zip(*(batch.column(c).to_pylist() for c in ("part", "labels", "low", "high"))):
                low, high = np.frombuffer(low), np.frombuffer(high)
                b = best.setdefault(part, [low, high, min(labels), max(labels)])
                b[:] = [np.minimum(b[0], low), np.maximum(b[1], high), min(b[2], *labels), max(b[3], *labels)]
        out = [(p, b[0].tobytes(), b[1].tobytes(), b[2], b[3]) for p, b in best.items()]
        types = [pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, types)], ["part", "low", "high", "least", "most"])

    boxes = tree.select("part", "labels", "low", "high").mapInArrow(run, "part int, low binary, high binary, least long, most long")
    size = boxes.agg(F.sum(F.octet_length("low") * 2 + 32)).first()[0] or 0
    return [] if size > BOX_BYTES else boxes.collect()


#: A window is a positive, its score, and the least and greatest score sought; null ends are open.
_WINDOW = "struct<p:bigint,s:bigint,a:bigint,b:bigint>"
_QUERY = f"anchor long, id long, label long, v binary, windows array<{_WINDOW}>"


def _ends(windows: list[dict]) -> list[tuple[float, float]]:
    return [(-math.inf if w["a"] is None else w["a"], math.inf if w["b"] is None else w["b"]) for w in windows]


def _search(tree: DataFrame, boxes: list, queries: DataFrame, total: int, parts: int, k: int, same: bool) -> DataFrame:
    """(anchor, id, positive_id, positive_score, score, found): the ``k`` best of every part visited, per window."""
    blocks = max(1, math.ceil(total / BLOCK))
    if boxes:
        every = [b["part"] for b in boxes]
        low, high = _numbers([b["low"] for b in boxes]), _numbers([b["high"] for b in boxes])
        least, most = np.array([b["least"] for b in boxes]), np.array([b["most"] for b in boxes])
        reach = float(max(np.abs(low).max(initial=0), np.abs(high).max(initial=0)))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not boxes:
                where, rows = np.tile(np.arange(parts), len(batch)), np.repeat(np.arange(len(batch)), parts)
            else:
                where, rows = [], []
                columns = (batch.column(c).to_pylist() for c in ("label", "v", "windows"))
                for row, (label, v, windows) in enumerate(zip(*columns)):
                    q = np.frombuffer(v)
                    up, down = np.maximum(q, 0), np.minimum(q, 0)
                    slack = 0.0 if (size := reach * float(np.abs(q).sum())) < EXACT else size * 1e-12
                    over, under = high @ up + low @ down + slack, low @ up + high @ down - slack
                    fits = (least <= label) & (label <= most) if same else (least != label) | (most != label)
                    fits &= np.any([(over >= a) & (under <= b) for a, b in _ends(windows)], 0)
                    where += [every[i] for i in np.flatnonzero(fits)]
                    rows += [row] * int(fits.sum())
            for start in range(0, len(rows), 4096):
                some = batch.take(pa.array(rows[start : start + 4096], pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(where[start : start + 4096], pa.int32()), *some.columns], ["part", *batch.schema.names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tree_of, at = [], None, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if (row["part"], row["block"]) != at:
                    held, tree_of, at = [], None, (row["part"], row["block"])
                if row["ids"] is not None:  # leaves come before the anchors
                    held.append((np.array(row["ids"]), np.array(row["labels"]), np.frombuffer(row["low"]), np.frombuffer(row["high"]), row["v"]))
                    continue
                if not held:
                    continue
                if tree_of is None:
                    ids, labels, lows, highs, raw = zip(*held)
                    tree_of = Tree(ids, labels, lows, highs, [np.frombuffer(r).reshape(len(i), -1) for r, i in zip(raw, ids)])
                windows = row["windows"]
                best = tree_of.search(row["id"], row["label"], np.frombuffer(row["v"]), _ends(windows), k, same)
                out += [(row["anchor"], row["id"], w["p"], w["s"], s, None if i == NO_ID else i) for w, some in zip(windows, best) for s, i in some]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["anchor", "id", "positive_id", "positive_score", "score", "found"])

    routed = queries.mapInArrow(route, "part int, " + _QUERY).withColumn("block", F.pmod(F.xxhash64("anchor"), F.lit(blocks)).cast("int"))
    leaves = tree.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    work = leaves.unionByName(routed, allowMissingColumns=True)
    units, cores = parts * blocks, int(tree.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # a unit's leaves (which have ids) come before its anchors; the number is given, so small units are not put into one task
    dealt = work.repartition(min(2 * units, max(cores, units // 32)), "part", "block").sortWithinPartitions("part", "block", F.col("ids").isNull(), "anchor")
    return dealt.mapInArrow(run, "anchor long, id long, positive_id long, positive_score long, score long, found long")


def _best(rows: DataFrame, per: list[str], k: int) -> DataFrame:
    """The ``k`` best rows per group, numbered from 1; partial top-k goes before the shuffle."""
    order = Window.partitionBy(*per).orderBy(F.desc("score"), F.asc_nulls_last("found"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    df: DataFrame,
    anchors: Column,
    relabel: Column | None = None,
    positives: int = 5,
    negatives: int = 3,
    window: tuple[int, int] = (50, 95),
    id_col: str = "vec_id",
    label_col: str = "label",
    vector: str = "embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score): of every anchor (``anchors`` holds, an expression of the
    column ``id``) the ``positives`` best rows of its label, and for each the
    ``negatives`` best rows of another label whose score lies between
    ``window[0]`` and ``window[1]`` percent of the positive's."""
    spark = df.sparkSession
    bound_batches(spark)
    folder = shared_folder(spark)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = save(prepared(df, id_col, label_col, vector, relabel), folder)
    n, dims, coordinate = spread(rows)
    if not n:
        return spark.createDataFrame([], schema)
    tree = pack(rows, n, dims, coordinate, folder)
    boxes = _boxes(tree)
    parts = tree.agg(F.max("part")).first()[0] + 1
    chosen = rows.where(F.col("id").isNotNull() & anchors & (F.octet_length("v") == dims * 8))
    asked = save(chosen.select(F.monotonically_increasing_id().alias("anchor"), "id", "label", "v"), folder)
    total = asked.count()
    everything = F.from_json(F.lit("[{}]"), f"array<{_WINDOW}>")
    near = _search(tree, boxes, asked.withColumn("windows", everything), total, parts, positives, True)
    near = save(_best(near, ["anchor"], positives).select("anchor", "rank", "found", "score"), folder)
    # 100 * score lies between the two ends exactly when the score lies between these whole numbers
    s = F.col("score").cast("decimal(38,0)")
    ends = F.struct(
        F.col("found").alias("p"),
        F.col("score").alias("s"),
        F.ceil(s * window[0] / 100).cast("long").alias("a"),
        F.floor(s * window[1] / 100).cast("long").alias("b"),
    )
    windows = near.select("anchor", F.struct(F.col("rank"), ends.alias("w")).alias("w")).groupBy("anchor").agg(F.sort_array(F.collect_list("w")).alias("w"))
    sought = asked.join(windows, "anchor").withColumn("windows", F.col("w.w")).drop("w")
    hard = _search(tree, boxes, sought, total, parts, negatives, False)
    hard = _best(hard, ["anchor", "id", "positive_id", "positive_score"], negatives)
    return hard.select(
        F.col("id").alias("anchor_id"), "positive_id", F.col("rank").cast("int"), F.col("found").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
