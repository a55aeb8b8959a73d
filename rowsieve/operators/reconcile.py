"""Reconciliation of two versions of a table: the exact multiset difference.

Rows are compared by content and counted, so a row that stands three times on
one side and once on the other differs by two copies.  Moving two whole
tables through a shuffle to find a few differences is what this avoids:

1. a row's key (or, without keys, the row) falls into one of ``FANOUT`` ranges
   of a hash; each side is aggregated to a count and two order-free checksums
   (sums of two 64-bit row hashes) per range: a scan, and one row per range
   and task in the shuffle.  One range in ``TRIAL`` is summed by its smaller
   ranges as well, which tells what cutting the others would leave out;
2. ranges whose counts or sums differ are cut into ``FANOUT`` smaller ones, and
   only their rows are summed again, while that moves fewer bytes than it
   saves: sums of small ranges are as many as the rows and wider than narrow
   rows, and a list of ranges too long to broadcast would move both tables;
3. rows of the ranges left are counted with a sign (left +, right -) per
   content.  Where many are left, each is moved once and met by its other side
   before it is counted, so that no task holds the rows of a whole scan; only
   in ranges with very many rows partial aggregation folds copies before the
   shuffle, so a row with very many copies is no hot key.

So a row is moved about once at most, however many rows differ.  Two different
multisets of one range agree in both sums with a chance of about 2^-100; apart
from that the result is exact.  Range lists are joined as measured helper sets
(broadcast under the bound).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsieve.functions.columns import column_ref
from rowsieve.operators.validate import qcol
from rowsieve.plans.joins import DEFAULT, JoinPolicy, Sized, _width, sized_side

FANOUT = 4096
#: Ranges are cut again, and rows dealt before they are counted, only while more rows than this are left.
DRILL_ROWS = 1_000_000
LEVELS = 4
#: One range in so many is also summed a level finer.
TRIAL = 64
#: Rows, about, that a task counts.
TASK_ROWS = 2_000_000


def _hashable(c: Column, kind: T.DataType) -> Column:
    """What a value is hashed by: maps, which have no hash and no order, as
    sorted entries; -0.0 as 0.0, since Spark groups them together."""
    if isinstance(kind, T.MapType):
        return F.sort_array(F.map_entries(c))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(c == 0, F.lit(0.0).cast(kind)).otherwise(c)
    return c


def _marked(values: list[Column], seed: int) -> Column:
    """A hash of values in which a NULL is told from a value left out."""
    return F.xxhash64(F.lit(seed), *[x for v in values for x in (v.isNull(), v)])


def _cutting_pays(left_over: Row, level: int, policy: JoinPolicy) -> bool:
    """Are the sums of smaller ranges, one per row at worst, and the rows that
    they leave fewer bytes than all rows, by the ranges tried?  Where none was,
    few are left."""
    if not left_over["tried"]:
        return True
    row, kept = left_over["bytes"] / left_over["tried"], left_over["finer"] / left_over["tried"]
    summed = 16 + 8 * (level + 5) + 2 * 24
    listed = left_over["parts"] * left_over["rows"] / left_over["tried"]
    short = listed <= policy.broadcast_max_rows and listed * (16 + 8 * (level + 6)) <= policy.broadcast_max_bytes
    return short and summed + kept * row < row


def _counted(some: DataFrame, names: list[str], differ: Sized, held: list[str], rows: int) -> DataFrame:
    """Contents of ``some`` whose signs do not add up to 0.  Many rows are dealt
    to tasks by content first; those of ranges that hold far more than their
    share are folded where they are read, as one content may make up a range."""

    def by_content(df: DataFrame) -> DataFrame:
        return df.groupBy(*map(qcol, names)).agg(F.sum("__rs_sign").alias("n")).where("n <> 0")

    if rows <= DRILL_ROWS:
        return by_content(some)
    hot = differ.frame.where(F.col("rows") > max(DRILL_ROWS, 4 * rows // FANOUT)).select(*held)
    any_hot = not hot.isEmpty()
    light = some.join(F.broadcast(hot), held, "left_anti") if any_hot else some
    tasks = rows // TASK_ROWS + 1
    usual = int(some.sparkSession.conf.get("spark.sql.shuffle.partitions", None) or 200)
    light = light.select(*map(qcol, names), "__rs_sign").repartition(*([tasks] if tasks > usual else []), *map(qcol, names))
    if not any_hot:
        return by_content(light)
    return by_content(light).unionByName(by_content(some.join(F.broadcast(hot), held, "left_semi")))


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str] = (), columns: Sequence[str] | None = None, policy: JoinPolicy = DEFAULT) -> DataFrame:
    """Rows that the two sides do not have equally often: the compared columns,
    ``side`` (``left`` or ``right``, which has more) and ``copies`` (how many).

    ``columns`` (default: those of ``left``) are compared, as the types of
    ``left``; ``keys`` among them give the ranges, so that versions of one row
    fall into one range.  NULL equals NULL, NaN equals NaN, 0.0 equals -0.0."""
    names = list(columns or left.columns)
    if len({n.lower() for n in names} & {"side", "copies"}):
        raise ValueError("compared columns may not be named side or copies")
    unknown = [k for k in keys if k not in names]
    if unknown:
        raise ValueError(f"keys {unknown} are not among the compared columns")
    kinds = {f.name: f.dataType for f in left.select(*[F.col(column_ref(left, n)).alias(n) for n in names]).schema}

    def side(df: DataFrame, sign: int) -> DataFrame:
        rows = df.select(*[F.col(column_ref(df, n)).cast(kinds[n]).alias(n) for n in names])
        ranged = [_hashable(qcol(n), kinds[n]) for n in keys or names]
        return rows.withColumns({"__rs_sign": F.lit(sign).cast("long"), "__rs_place": _marked(ranged, 1)})

    every = side(left, 1).unionByName(side(right, -1))
    hashed = [_hashable(qcol(n), kinds[n]) for n in names]
    sums = [F.sum(F.col("__rs_sign") * _marked(hashed, s).cast("decimal(20,0)")).alias(f"s{s}") for s in (2, 3)]
    width = reduce(lambda a, b: a + b, [_width(T.StructField(n.replace("`", "``"), kinds[n])) for n in names], F.lit(16))
    differ, held, left_over = None, [], None
    while True:
        level = len(held) + 1
        places = [F.pmod(F.shiftrightunsigned("__rs_place", 12 * i), F.lit(FANOUT)) for i in range(level + 1)]
        ranges = [f"__rs_r{i}" for i in range(level)]
        work = every.withColumns(dict(zip(ranges, places)))
        if differ is not None:
            work = work.join(differ.side(differ.frame.select(*held)), held, "left_semi")
        tried = F.col(ranges[-1]) % TRIAL == 0
        parts = work.withColumn("__rs_part", F.when(tried, places[-1])).groupBy(*ranges, "__rs_part")
        parts = parts.agg(F.sum("__rs_sign").alias("n"), F.count("*").alias("rows"), F.sum(F.when(tried, width)).alias("bytes"), *sums)
        parts = parts.withColumns({"differs": F.expr("n <> 0 OR s2 <> 0 OR s3 <> 0"), "tried": F.col("__rs_part").isNotNull()})
        totals = parts.groupBy(*ranges).agg(
            F.sum("rows").alias("rows"), F.bool_or("differs").alias("differs"), F.sum(F.expr("IF(tried, rows, 0)")).alias("tried"),
            F.sum(F.expr("IF(tried AND differs, rows, 0)")).alias("finer"), F.count_if(F.expr("tried AND differs")).alias("parts"), F.sum("bytes").alias("bytes"),
        )
        found = sized_side(totals.where("differs").drop("differs"), policy)
        if differ is not None and differ.broadcast and not found.broadcast:
            break
        differ, held = found, ranges
        left_over = differ.frame.agg(F.count("*").alias("ranges"), *[F.sum(c).alias(c) for c in ("rows", "tried", "finer", "parts", "bytes")]).first()
        if (left_over["rows"] or 0) <= DRILL_ROWS or level == LEVELS or not _cutting_pays(left_over, level, policy):
            break
    if len(held) == 1 and left_over["ranges"] > 0.9 * FANOUT:
        some = every.withColumns(dict(zip(held, places)))
    else:
        some = every.withColumns(dict(zip(held, places))).join(differ.side(differ.frame.select(*held)), held, "left_semi")
    # maps cannot be grouped by: their entries stand for them
    maps = {n for n in names if isinstance(kinds[n], T.MapType)}
    some = some.select(*[_hashable(qcol(n), kinds[n]).alias(n) if n in maps else qcol(n) for n in names], "__rs_sign", *held)
    counted = _counted(some, names, differ, held, left_over["rows"] or 0)
    out = [F.map_from_entries(qcol(n)).alias(n) if n in maps else qcol(n) for n in names]
    return counted.select(*out, F.when(F.col("n") > 0, "left").otherwise("right").alias("side"), F.abs("n").alias("copies"))


def changed_keys(difference: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What became of each key of a difference from old (left) to new (right):
    ``removed``, ``added`` or ``changed``, with the copies on either side.
    Both sides' rows of a key are in the difference if it changed."""
    copies = {s: F.coalesce(F.sum(F.when(F.col("side") == s, F.col("copies"))), F.lit(0)).alias(f"{s}_copies") for s in ("left", "right")}
    counted = difference.groupBy(*[qcol(k) for k in keys]).agg(*copies.values())
    change = F.when(F.col("right_copies") == 0, "removed").when(F.col("left_copies") == 0, "added").otherwise("changed")
    return counted.withColumn("change", change)


def same(left: DataFrame, right: DataFrame, columns: Sequence[str] | None = None) -> bool:
    """Are both the same multiset of rows?  One row per side is compared."""
    names = list(columns or left.columns)
    kinds = {f.name: f.dataType for f in left.schema}
    ends = []
    for df in (left, right):
        rows = df.select(*[F.col(column_ref(df, n)).cast(kinds[n]).alias(n) for n in names])
        hashed = [_hashable(qcol(n), kinds[n]) for n in names]
        ends.append(rows.agg(F.count("*"), *[F.sum(_marked(hashed, s).cast("decimal(20,0)")) for s in (2, 3)]))
    first, second = (e.toDF("n", "a", "b").first() for e in ends)
    return first == second
