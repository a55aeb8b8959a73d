"""Exact quantiles without sorting a column in one task, and the robust
outlier rule on them (``statistical`` with ``statistic: mad``).

A quantile is the value at rank ``ceil(p n)`` of a group's known values (what
SQL calls ``percentile_disc``).  It is found by refining histograms: a pass
deals the values between the least and the greatest candidate into
``BUCKETS`` buckets of equal width, counts them (partial aggregation on the
map side: a row per group, quantile and bucket leaves a task), and the bucket
that holds the rank gives the candidates of the next pass, as its own least
and greatest value.  The ends always part, so every pass narrows; values of
any spread take a few passes, each a scan of the group and value columns.
Once a target has at most ``SETTLE`` candidates left, their distinct values
are counted and ranked, at most that many in a task.

Targets are attached to rows like any helper set: measured and broadcast, or
by a shuffle join with hot groups split off, so there may be any number of
groups and one of them may hold a third of all rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsieve.functions.columns import column_ref
from rowsieve.operators.outliers import numeric_value
from rowsieve.operators.uniqueness import key_value
from rowsieve.plans.joins import DEFAULT, JoinPolicy, attach_found, sized_side

BUCKETS = 4096
SETTLE = 10_000
#: A normal sample's standard deviation over its median absolute deviation.
NORMAL = 1.4826

_GREATEST = 1.7976931348623157e308


def known_number(df: DataFrame, column: str) -> Column:
    """A number, or text that is one; NaN is unknown."""
    value = numeric_value(df, column)
    kind = df.select(value.alias("v")).schema["v"].dataType
    return F.when(~F.isnan(value), value) if isinstance(kind, (T.FloatType, T.DoubleType)) else value


def _bucket(x: Column, low: Column, high: Column, kind: T.DataType) -> Column:
    """0 to BUCKETS - 1, never falling as x rises; low and high differ in theirs."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        x, low, high = [F.greatest(F.least(c.cast("double"), F.lit(_GREATEST)), F.lit(-_GREATEST)) for c in (x, low, high)]
        wide = high / 2 - low / 2 > _GREATEST / 2  # the difference itself would overflow
        part = F.when(wide, F.try_divide(x / 2 - low / 2, high / 2 - low / 2)).otherwise(F.try_divide(x - low, high - low))
    else:
        whole = f"decimal(38,{kind.scale if isinstance(kind, T.DecimalType) else 0})"
        x, low, high = [c.cast(whole) for c in (x, low, high)]
        part = F.try_divide((x - low).cast("double"), (high - low).cast("double"))
    spread = F.least(F.floor(part * BUCKETS), F.lit(BUCKETS - 1))
    return F.coalesce(spread, F.when(x == low, F.lit(0)).otherwise(F.lit(BUCKETS - 1))).cast("int")


def _ranked(counted: DataFrame, names: list[str], at: str) -> DataFrame:
    """The row of each (group, quantile) in which its rank falls; ``before`` counts what lies under it."""
    window = Window.partitionBy(*names, "i").orderBy(at).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = counted.withColumn("upto", F.sum("m").over(window))
    return upto.withColumn("before", F.col("upto") - F.col("m")).where("before < rank AND rank <= upto")


def exact_quantiles(rows: DataFrame, names: list[str], value: str, probabilities: Sequence[float], policy: JoinPolicy = DEFAULT) -> DataFrame:
    """(names..., i, n, v): per group of the columns ``names`` (rows with a
    NULL among them are left out) and probability number ``i``, the count of
    known ``value``s and the quantile."""
    if not probabilities or any(not 0 <= p <= 1 for p in probabilities):
        raise ValueError(f"probabilities lie between 0 and 1, got {list(probabilities)}")
    kind = rows.schema[value].dataType
    known = rows.select(*names, F.col(value).alias("x")).where("x IS NOT NULL")
    for n in names:
        known = known.where(F.col(n).isNotNull())
    if not names:  # not a literal, see rowsieve.operators.ordered
        known, names = known.withColumn("__rs_all", F.spark_partition_id() * F.lit(0)), ["__rs_all"]
    ranks = F.array(*[F.struct(F.lit(i).alias("i"), F.greatest(F.ceil(F.lit(float(p)) * F.col("n")), F.lit(1)).cast("long").alias("rank")) for i, p in enumerate(probabilities)])
    first = known.groupBy(*names).agg(F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
    targets = first.select(*names, "n", F.col("n").alias("left"), "low", "high", F.inline(ranks))
    targets = sized_side(targets, policy).frame if policy.probe else targets

    def candidates(of: DataFrame) -> DataFrame:
        """Rows that may be the quantile of a target, once for each."""
        per_group = of.groupBy(*names).agg(F.collect_list(F.struct("i", "n", "rank", "low", "high")).alias("targets"))
        work = attach_found(known, known, {f"__rs_{n}": F.col(n) for n in names}, sized_side(per_group.withColumnsRenamed({n: f"__rs_{n}" for n in names}), policy), "targets", "__rs_t", policy)
        return work.select(*names, "x", F.inline("__rs_t")).where("x >= low AND x <= high")

    done = None
    while True:
        settled = targets.where(f"low = high OR left <= {SETTLE}")
        done = settled if done is None else done.unionByName(settled)
        targets = targets.where(f"low < high AND left > {SETTLE}")
        if not policy.probe or targets.isEmpty():
            break
        bucket = _bucket(F.col("x"), F.col("low"), F.col("high"), kind).alias("bucket")
        counted = candidates(targets).groupBy(*names, "i", "n", "rank", bucket).agg(F.count("*").alias("m"), F.min("x").alias("low"), F.max("x").alias("high"))
        found = _ranked(counted, names, "bucket")
        targets = sized_side(found.select(*names, "n", F.col("m").alias("left"), "low", "high", "i", (F.col("rank") - F.col("before")).alias("rank")), policy).frame
    if not policy.probe:  # one lazy plan: rank all values
        done = done.unionByName(targets)
    few = done.where("low < high")
    out = done.where("low = high").select(*names, "i", "n", F.col("low").alias("v"))
    if policy.probe and few.isEmpty():
        return out.drop("__rs_all")
    counted = candidates(few).groupBy(*names, "i", "n", "rank", "x").agg(F.count("*").alias("m"))
    return out.unionByName(_ranked(counted, names, "x").select(*names, "i", "n", F.col("x").alias("v"))).drop("__rs_all")


def quantiles(df: DataFrame, column: str, probabilities: Sequence[float], by: Sequence[str] = (), policy: JoinPolicy = DEFAULT) -> DataFrame:
    """(by..., probability, n, value) of every group, exactly."""
    names = [f"g{i}" for i in range(len(by))]
    rows = df.select(*[F.col(column_ref(df, c)).alias(n) for c, n in zip(by, names)], known_number(df, column).alias("value"))
    found = exact_quantiles(rows, names, "value", probabilities, policy)
    p = F.element_at(F.array(*[F.lit(float(x)) for x in probabilities]), F.col("i") + 1)
    return found.select(*[F.col(n).alias(c) for n, c in zip(names, by)], p.alias("probability"), "n", F.col("v").alias("value"))


def spread_about_median(rows: DataFrame, names: list[str], value: str, policy: JoinPolicy = DEFAULT) -> DataFrame:
    """(names..., median, mad): per group the median and the median absolute deviation from it."""
    middle = exact_quantiles(rows, names, value, [0.5], policy).select(*names, F.col("v").alias("median"))
    middle = sized_side(middle if names else middle.withColumn("__rs_one", F.spark_partition_id() * F.lit(0)), policy)
    keys = {f"__rs_{n}": F.col(n) for n in names} or {"__rs_one": F.spark_partition_id() * F.lit(0)}
    renamed = middle.frame.withColumnsRenamed({n: f"__rs_{n}" for n in names})
    about = attach_found(rows, rows, keys, replace(middle, frame=renamed), "median", "__rs_median", policy)
    away = about.select(*names, F.abs(F.col(value) - F.col("__rs_median")).alias(value))
    deviation = exact_quantiles(away, names, value, [0.5], policy).select(*names, F.col("v").alias("mad"))
    if names:
        return middle.frame.join(deviation, names)
    return middle.frame.select(deviation.select("mad").scalar().alias("mad"), "median")


def attach_robust_score(work, source, keys: Sequence[str], column: str, flag: str, policy=DEFAULT, sizes=None) -> DataFrame:
    """``work`` plus ``flag``: the median and MAD of the row's group (struct), NULL without one."""
    names = [f"{flag}_k{i}" for i in range(len(keys))]
    rows = source.select(*[key_value(source, k).alias(n) for k, n in zip(keys, names)], known_number(source, column).cast("double").alias("value"))
    found = spread_about_median(rows, names, "value", policy)
    values = {n: key_value(source, k) for k, n in zip(keys, names)}
    if not names:
        names, values = [f"{flag}_one"], {f"{flag}_one": F.spark_partition_id() * F.lit(0)}
        found = found.withColumn(names[0], F.spark_partition_id() * F.lit(0))
    side = found.select(*names, F.struct("median", "mad").alias(flag))
    return attach_found(work, source, values, sized_side(side, policy, sizes=sizes), flag, flag, policy, sizes)


def robust_outlier(df: DataFrame, column: str, threshold: float, flag: str) -> Column:
    """|x - median| / (1.4826 MAD) above the threshold; a MAD of zero passes, as a zero deviation does for z-scores."""
    away = F.abs(known_number(df, column).cast("double") - F.col(flag)["median"])
    return F.try_divide(away, F.col(flag)["mad"] * F.lit(NORMAL)) > F.lit(float(threshold))
