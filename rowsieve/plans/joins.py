"""How the helper joins of dataset-level rules are planned.

G1 (duplicate keys) and G2 (reference keys) each join a *helper set* — keys
aggregated from a table — onto the input.  The helper set is usually tiny
(few duplicates, a dimension table), but its size grows with the data, so
it is broadcast only after it is measured:

1. materialize the helper set once: into the shared checkpoint folder
   (``spark.checkpoint.dir``) when the session names one, else persisted
   MEMORY_AND_DISK (blocks lost with an executor are recomputed from
   lineage);
2. measure its row count and key bytes in that same job (observed metrics),
   or with a bounded read (``limit(max_rows + 1)``) when not materialized;
3. under both bounds → ``broadcast`` (the input is never shuffled);
   otherwise → a shuffle join made skew-safe by ``skew_split_join``.

Skew: one key may hold a third of all rows, and NULL keys all hash to one
partition.  AQE's skew-join split does not apply here (it needs both join
inputs to be plain shuffle stages; the helper side is an aggregate), so the
split is explicit.  Keys with more than ``heavy_key_rows`` rows are answered
by a broadcast join on the map side; if they are too many to broadcast, the
hottest ones that fit are, so a key left over holds at most as many rows as
any of these.  Rows whose key is hot or NULL then get a salt, so they scatter
over the shuffle partitions and match nothing in the shuffle join, which only
carries light keys.  The salt is the row's place in its file (so equal rows
scatter as well, and no other column is read) or, where the input is no
Parquet scan, a hash of its content.  Either is the same whenever a task runs
again, whatever order its rows come in.

Rules of one validation that look at the same key share one shuffle join:
their sets are merged, a column per rule, before the input meets them.

All helper sets of one validation share one broadcast budget
(``broadcast_max_bytes``).  Hot keys do not depend on what is left of it: each
shuffle join may broadcast ``hot_bytes`` of them on top.

``LAZY`` skips all probes and builds one lazy plan (no job at build time);
joins are then left entirely to Spark, without the explicit skew split: a
hot key's rows meet in one task.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace
from functools import reduce

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class JoinPolicy:
    probe: bool = True
    materialize: bool = True
    broadcast_max_rows: int = 2_000_000
    broadcast_max_bytes: int = 32 << 20
    heavy_key_rows: int = 1_000_000

    @property
    def hot_bytes(self) -> int:
        """Bytes of hot keys that every shuffle join may broadcast."""
        return max(self.broadcast_max_bytes // 16, 4096)


DEFAULT = JoinPolicy()
LAZY = JoinPolicy(probe=False, materialize=False)

_FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _width(field: T.StructField) -> Column:
    if isinstance(field.dataType, _FIXED_WIDTH):
        return F.lit(8)
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0))
    return F.coalesce(F.octet_length(F.col(f"`{field.name}`").cast("string")), F.lit(0))


def row_bytes(df: DataFrame) -> Column:
    """Rough in-memory bytes of one row (16 bytes overhead + field widths)."""
    return reduce(lambda a, b: a + b, [_width(f) for f in df.schema.fields], F.lit(16))


def checkpoint_dir(df: DataFrame) -> str | None:
    """The session's checkpoint folder, or None (then helper sets are
    persisted instead)."""
    spark = df.sparkSession
    try:
        sc = spark.sparkContext
    except Exception:  # sessions without a driver-side context (Spark Connect)
        return spark.conf.get("spark.checkpoint.dir", None)
    return sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)


@dataclass(frozen=True)
class Sized:
    """A measured helper set.  ``frame`` carries no hint; use ``side()``."""

    frame: DataFrame
    broadcast: bool
    rows: int | None = None
    bytes: int | None = None
    cached: DataFrame | None = None  # persisted helper set, to unpersist later
    path: str = "lazy"  # lazy | broadcast | shuffle | shuffle+split
    hot: Sized | None = None  # measured hot keys of a shuffle join

    def side(self, df: DataFrame | None = None) -> DataFrame:
        df = self.frame if df is None else df
        return F.broadcast(df) if self.broadcast else df


def _size_columns(side: DataFrame) -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), F.sum(row_bytes(side)).alias("b")]


def _materialize(side: DataFrame, policy: JoinPolicy) -> tuple[DataFrame, DataFrame | None, dict]:
    """Write the helper set once and measure it in the same job: the row
    count and key bytes are observed (``DataFrame.observe``) while the set is
    checkpointed — or persisted and counted when no checkpoint folder is
    set."""
    obs = Observation()
    observed = side.observe(obs, *_size_columns(side))
    target = checkpoint_dir(side)
    if target:
        try:
            sc = side.sparkSession.sparkContext
            if not sc.getCheckpointDir():
                sc.setCheckpointDir(target)
        except Exception:  # the server side reads spark.checkpoint.dir itself
            pass
        return observed.checkpoint(eager=True), None, obs.get
    cached = observed.persist(StorageLevel.MEMORY_AND_DISK)
    cached.count()
    return cached, cached, obs.get


def broadcast_disabled(side: DataFrame) -> bool:
    """The session turned broadcast joins off (threshold -1): honour it."""
    value = side.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", None)
    return value is not None and value.strip().startswith("-")


def budget_left(policy: JoinPolicy, sizes: dict | None) -> int:
    """Bytes that the helper sets measured so far leave to broadcast."""
    spent = sum(s.bytes for s in (sizes or {}).values() if s.broadcast and s.bytes)
    return max(0, policy.broadcast_max_bytes - spent)


def sized_side(side: DataFrame, policy: JoinPolicy = DEFAULT, materialize: bool = True, sizes: dict | None = None) -> Sized:
    """Measure a helper set under the bounds; materialize it first (and
    measure while writing) unless ``materialize`` is off, in which case an
    aggregate measures it.  ``sizes`` holds the sets measured before."""
    if not policy.probe:
        return Sized(side, False)
    cached = None
    if materialize and policy.materialize:
        side, cached, metrics = _materialize(side, policy)
    else:
        metrics = side.agg(*_size_columns(side)).first()
    n, nbytes = int(metrics["n"]), int(metrics["b"] or 0)
    small = n <= policy.broadcast_max_rows and nbytes <= budget_left(policy, sizes)
    small = small and not broadcast_disabled(side)
    return Sized(side, small, n, nbytes, cached, "broadcast" if small else "shuffle")


def hot_keys(counted: DataFrame, count: str, policy: JoinPolicy) -> Sized | None:
    """The keys of ``counted`` to split off a shuffle join, or None if there
    are none: those with more than ``heavy_key_rows`` rows; if they are too
    many to broadcast, the hottest ones that fit."""
    over = counted.where(F.col(count) > policy.heavy_key_rows)
    m = over.agg(*_size_columns(over), F.max(row_bytes(over)).alias("w")).first()
    if not m["n"]:
        return None
    if m["n"] <= policy.broadcast_max_rows and m["b"] <= policy.hot_bytes:
        return Sized(over, True, m["n"], m["b"], path="hot")
    fitting = max(1, min(policy.broadcast_max_rows, policy.hot_bytes // m["w"]))
    rest = [c for c in over.columns if c != count]
    hottest, cached, m = _materialize(over.orderBy(F.desc(count), *rest).limit(fitting), policy)
    return Sized(hottest, True, int(m["n"]), int(m["b"] or 0), cached, "hot")


#: Where an input's rows stand; added before joins, which hide it.  Not read unless a join needs it.
PLACE = "__rs_place"


def with_place(df: DataFrame) -> DataFrame:
    """``df`` with ``PLACE``, where Spark knows it."""
    place = row_place(df)
    return df if place is None else df.withColumn(PLACE, place)


def row_place(df: DataFrame) -> Column | None:
    """A hash of the file and position a row comes from, where Spark knows it
    (Parquet scans, also below projections and filters)."""
    if "_metadata" in df.columns:
        return None
    try:
        df.select("_metadata.file_path", "_metadata.row_index").schema
    except AnalysisException:
        return None
    return F.xxhash64("_metadata.file_path", "_metadata.row_index")


def content_hash(df: DataFrame, columns: list[str]) -> Column:
    """A hash of a row's values; maps, which have no hash, as JSON."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    plain = [F.to_json(F.struct(f"`{c}`")) if "map<" in fields[c].simpleString() else F.col(f"`{c}`") for c in columns]
    return F.xxhash64(*plain)


def salt_expr(spread: Column, keys: list[str], place: Column) -> Column:
    """0 for rows that must meet the light join; a positive number made of
    the row's ``place`` for rows to scatter (``spread`` or any NULL key
    part).  A scattered row's salt never matters for the result, only where
    the row lands, and it lands there again when its task is run again."""
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    positive = F.pmod(place, F.lit(2**62)) + F.lit(1)
    return F.when(spread | any_null, positive).otherwise(F.lit(0).cast("bigint"))


def skew_split_join(
    work: DataFrame,
    keys: list[str],
    light: DataFrame,
    heavy: DataFrame | None,
    heavy_marker: str,
    salt: str,
    content: list[str],
) -> DataFrame:
    """Left-join ``light`` on ``keys`` without a hot partition.

    ``heavy`` (same key names, a non-NULL ``heavy_marker`` column, bounded)
    is broadcast-joined first; rows it marks, and rows with a NULL key part,
    get a non-zero salt from their place in the input (from their ``content``
    columns where that is unknown), spreading them over the shuffle
    partitions, while ``light`` rows carry salt 0 — so those rows pass through
    the shuffle join unmatched and no split-off key gathers in one task.
    """
    place = F.col(PLACE) if PLACE in work.columns else row_place(work)
    place = content_hash(work, content) if place is None else place
    work = work.withColumn(f"{salt}p", place)
    if heavy is not None:
        work = work.join(F.broadcast(heavy), on=keys, how="left")
        spread = F.col(heavy_marker).isNotNull()
    else:
        spread = F.lit(False)
    work = work.withColumn(salt, salt_expr(spread, keys, F.col(f"{salt}p"))).drop(f"{salt}p")
    # The light side's salt is 0, but must not be a literal: Catalyst would
    # propagate the constant, turn the salt equality into a plain filter and
    # hash the shuffle on the key alone (every hot row back on one task).
    # spark_partition_id() is not foldable, so (key, salt) stays the
    # equi-join key and the shuffle is partitioned by both.
    light = light.withColumn(salt, (F.spark_partition_id() * F.lit(0)).cast("bigint"))
    return work.join(light, on=[*keys, salt], how="left").drop(salt)


def attach_found(
    work: DataFrame,
    source: DataFrame,
    keys: Mapping[str, Column],
    found: Sized,
    value: str,
    flag: str,
    policy: JoinPolicy = DEFAULT,
    sizes: dict | None = None,
    count: str | None = None,
) -> DataFrame:
    """``work`` plus ``flag``: the ``value`` of the row of ``found`` with the
    same keys, or NULL.  ``keys`` maps the key columns of ``found`` (distinct,
    a measured helper set) to expressions over ``source``, whose rows ``work``
    has.  ``count`` names a column of ``found`` with the input's rows per key,
    where it has one for all hot keys; otherwise ``source`` is counted, only
    if the set is too large to broadcast."""
    names = list(keys)
    kind = found.frame.schema[value].dataType
    if policy.probe and found.rows == 0:  # nothing to join
        if sizes is not None:
            sizes[flag] = Sized(found.frame, False, 0, 0, found.cached, "empty")
        return work.withColumn(flag, F.lit(None).cast(kind))
    side = found.frame.select(*names, F.col(value).alias(flag))
    if not policy.probe or found.broadcast:
        if sizes is not None:
            sizes[flag] = found
        return work.withColumns(dict(keys)).join(found.side(side), on=names, how="left").drop(*names)
    wide = Wide(dict(keys), side, flag, found, count)
    if isinstance(sizes, Helpers):
        sizes.wide.append(wide)
        return work
    return _join_wide(work, source, [wide], policy, sizes)


@dataclass(frozen=True)
class Wide:
    """A helper set too large to broadcast: key columns, the set with its value as ``flag``."""

    keys: dict[str, Column]
    side: DataFrame
    flag: str
    found: Sized
    count: str | None


class Helpers(dict):
    """Measured helper sets by flag.  Those too large to broadcast wait in
    ``wide`` until ``join_wide``, so that sets of one key share a shuffle."""

    def __init__(self) -> None:
        super().__init__()
        self.wide: list[Wide] = []


def join_wide(work: DataFrame, source: DataFrame, policy: JoinPolicy, sizes: Helpers) -> DataFrame:
    """``work`` plus the flags of all waiting sets: one shuffle join per key,
    however many rules look at it."""
    by_key: dict[tuple[str, ...], list[Wide]] = {}
    for wide in sizes.wide:
        kinds = [f.dataType.simpleString() for f in wide.side.select(*wide.keys).schema]
        by_key.setdefault((*map(str, wide.keys.values()), *kinds), []).append(wide)
    for group in by_key.values():
        work = _join_wide(work, source, group, policy, sizes)
    sizes.wide.clear()
    return work


def _merged(group: list[Wide]) -> DataFrame:
    """The sets of one key as one: a row per key, a column per flag."""
    names, flags = list(group[0].keys), {w.flag: w.side.schema[w.flag].dataType for w in group}
    sides = [
        w.side.select(
            *[F.col(own).alias(n) for own, n in zip(w.keys, names)],
            *[(F.col(f) if f == w.flag else F.lit(None).cast(kind)).alias(f) for f, kind in flags.items()],
        )
        for w in group
    ]
    every = reduce(lambda a, b: a.unionByName(b), sides)
    return every.groupBy(*names).agg(*[F.any_value(F.col(f), F.lit(True)).alias(f) for f in flags])


def _join_wide(work: DataFrame, source: DataFrame, group: list[Wide], policy: JoinPolicy, sizes: dict | None) -> DataFrame:
    """Shuffle join with sets of one key, hot keys split off."""
    first, flags = group[0], [w.flag for w in group]
    names, side = list(first.keys), first.side if len(group) == 1 else _merged(group)
    marker, cached = f"{first.flag}_h", None
    hits = {f: f"{f}_hh" for f in flags}
    if first.count is not None and len(group) == 1:
        hot = hot_keys(first.found.frame.select(*names, first.count), first.count, policy)
    else:
        present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in names])
        counted = source.select(*[c.alias(k) for k, c in first.keys.items()]).where(present).groupBy(*names).agg(F.count(F.lit(1)).alias("__rs_n"))
        measured = sized_side(counted.where(F.col("__rs_n") > policy.heavy_key_rows), policy)
        hot, cached = hot_keys(measured.frame, "__rs_n", policy), measured.cached
    heavy = None
    if hot is not None:
        hottest = hot.frame.select(*names)
        found = side.join(F.broadcast(hottest), on=names, how="inner").withColumnsRenamed(hits)
        heavy = hottest.join(F.broadcast(found), on=names, how="left").select(*names, F.lit(True).alias(marker), *hits.values())
    joined = skew_split_join(work.withColumns(first.keys), names, side, heavy, marker, f"{first.flag}_s", source.columns)
    if heavy is not None:
        split = F.col(marker).isNotNull()
        joined = joined.withColumns({f: F.when(split, F.col(h)).otherwise(F.col(f)) for f, h in hits.items()}).drop(marker, *hits.values())
        hot = replace(hot, cached=hot.cached or cached)
    elif cached is not None:
        cached.unpersist()
    if sizes is not None:
        for w in group:
            sizes[w.flag] = replace(w.found, broadcast=False, path="shuffle" if hot is None else "shuffle+split", hot=hot)
    return joined.drop(*names)
