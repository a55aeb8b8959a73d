"""Sharding by a hierarchical weighted hash tree.

The tree has regions, racks and shards; every node weighs what its shards
weigh.  A row descends from the root: at each level every child draws
``ln(u) / weight`` with ``u`` hashed from the row's key and the child, and
the largest draw wins, so a child is chosen in proportion to its weight.
When a weight changes, the draws of other children stay as they are: rows
move only into or out of subtrees whose weights changed.  Shards are added
as a subtree of their own, so an added shard takes rows only into itself.

A row's place depends on its key and the tree alone (law ``key``); rows with
one key share a shard.  Slots are numbered per shard without gaps from
counts per shard and partition of a written table, so no task ever holds a
shard.

Defined cases: a null key is a key like any other; null text has no bytes
(size 1); rows that repeat each get a slot; extra columns are ignored;
shards that no row falls into have no slots.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowsieve.llm.tables import save, shared_folder

#: regions -> racks -> weights of shards, numbered in order
Tree = tuple[tuple[tuple[float, ...], ...], ...]


def even_tree(shards: int, fan: int = 2) -> Tree:
    """``shards`` of weight 1 in racks of ``fan`` shards, regions of ``fan`` racks."""
    racks = [(1.0,) * min(fan, shards - i) for i in range(0, shards, fan)]
    return tuple(tuple(racks[i : i + fan]) for i in range(0, len(racks), fan))


def grow(tree: Tree, weight: float = 1.0) -> Tree:
    """The tree with one more shard, a region of its own."""
    return (*tree, ((weight,),))


def _weight(node) -> float:
    return float(node) if isinstance(node, (int, float)) else sum(map(_weight, node))


def _draw(key: Column, path: tuple[int, ...], weight: float) -> Column:
    """The child's draw for a key; a child without weight never wins."""
    if weight <= 0:
        return F.lit(float("-inf"))
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit("/".join(map(str, path)))), 11)
    return F.ln((bits.cast("double") + 0.5) * F.lit(2.0**-53)) / F.lit(weight)


def shard_of(key: Column, tree: Tree) -> Column:
    """Number of the shard that a key falls into."""
    number = 0

    def descend(node, path: tuple[int, ...]) -> Column:
        nonlocal number
        if isinstance(node, (int, float)):
            number += 1
            return F.lit(number - 1)
        below = [(child, descend(child, (*path, i)), (*path, i)) for i, child in enumerate(node)]
        if len(below) == 1:
            return below[0][1]
        best = F.greatest(*[_draw(key, p, _weight(c)) for c, _, p in below])
        return reduce(lambda rest, b: F.when(_draw(key, b[2], _weight(b[0])) == best, b[1]).otherwise(rest), reversed(below[:-1]), below[-1][1])

    return descend(tree, ()).cast("int")


def assign(df: DataFrame, tree: Tree, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row:
    its shard in ``tree``, its place there, and its shard in the grown tree."""
    folder = shared_folder(df.sparkSession)
    key, raw = F.col(id_col).cast("long"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = save(
        df.select(
            key.alias("doc_id"),
            (F.octet_length(raw) + 1).cast("long").alias("size"),
            F.crc32(raw).alias("text_crc32"),
            shard_of(key, tree).alias("shard"),
            shard_of(key, grow(tree)).alias("grown_shard"),
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().alias("row"),
        ),
        folder,
    )
    # a partition's rows in runs of bounded length: (part, run) is written, so it is the same for every later read
    run = F.shiftright(F.col("row").bitwiseAND(F.lit((1 << 33) - 1)), 14).alias("run")
    rows = rows.select("*", run)
    counts = rows.groupBy("shard", "part", "run").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("part", "run")) - F.col("n")
    first = save(counts.select("shard", "part", "run", before.alias("first")), folder)
    within = F.row_number().over(Window.partitionBy("shard", "part", "run").orderBy("row")) - 1
    placed = rows.withColumn("within", within).join(first, ["shard", "part", "run"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("first") + F.col("within")).cast("long").alias("slot"), "grown_shard"
    )


def write_shards(df: DataFrame, tree: Tree, path: str, id_col: str = "doc_id") -> None:
    """``df`` as Parquet below ``path``, a folder ``shard=N`` per shard."""
    df.withColumn("shard", shard_of(F.col(id_col).cast("long"), tree)).write.partitionBy("shard").parquet(path)
