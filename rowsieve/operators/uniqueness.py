"""G1 unique_check: every row of a duplicated non-NULL key fails.

Plan: an aggregate over the key columns only (partial aggregation on the map
side collapses a hot key to one row per input partition before the shuffle),
keep keys seen more than once, and left-join that set back.  A row whose key
has a NULL part never matches (SQL equality), so it passes.

Text and binary keys are replaced by their SHA-256 digest and length before
anything is shuffled, at every size, so an exchange carries 32 bytes per key
instead of the text.  Equal digests of equal length are taken as equal texts.

The duplicate-key set grows with the data, so it is broadcast only after
it is measured under a bound (``rowsieve.plans.joins``); beyond the bound
the join is a shuffle join with hot and NULL keys split off.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsieve.functions.columns import column_ref, column_type
from rowsieve.plans.joins import DEFAULT, JoinPolicy, attach_found, sized_side

_LONG = (T.StringType, T.VarcharType, T.CharType, T.BinaryType)


def key_value(df: DataFrame, key: str) -> Column:
    """What a key column is grouped and joined on."""
    c = F.col(column_ref(df, key))
    if isinstance(column_type(df, key), _LONG):
        raw = c.cast("binary")
        return F.concat(F.unhex(F.sha2(raw, 256)), F.unhex(F.hex(F.octet_length(raw))))
    return c


def duplicate_keys(df: DataFrame, keys: Sequence[str], key_aliases: Sequence[str]) -> DataFrame:
    """Distinct keys (all parts non-NULL) that occur more than once, with
    their row count ``__rs_n``; key columns renamed to ``key_aliases``, long
    ones as digests."""
    base = df.select(*[key_value(df, k).alias(a) for k, a in zip(keys, key_aliases)])
    not_null = reduce(lambda a, b: a & b, [F.col(a).isNotNull() for a in key_aliases])
    return base.where(not_null).groupBy(*key_aliases).agg(F.count(F.lit(1)).alias("__rs_n")).where(F.col("__rs_n") > 1)


def attach_duplicate_flag(
    work: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    flag: str,
    policy: JoinPolicy = DEFAULT,
    sizes: dict | None = None,
    kept=None,
) -> DataFrame:
    """``work`` plus boolean ``flag`` (TRUE or NULL): the row's key is
    duplicated in ``source`` (with ``kept``: or in batches before it).  ``work`` must have the same rows as
    ``source`` (it is ``source`` with helper columns added)."""
    aliases = [f"{flag}_k{i}" for i in range(len(keys))]
    found = (kept.duplicate_keys if kept is not None else duplicate_keys)(source, keys, aliases)
    sized = sized_side(found.withColumn(flag, F.lit(True)), policy, sizes=sizes)
    values = {a: key_value(source, k) for k, a in zip(keys, aliases)}
    return attach_found(work, source, values, sized, flag, flag, policy, sizes, count="__rs_n")


def duplicates(df: DataFrame, keys: Sequence[str], policy: JoinPolicy = DEFAULT, sizes: dict | None = None) -> DataFrame:
    """Rows of ``df`` whose key is duplicated (stand-alone form of G1).
    ``sizes`` receives the measured helper set; unpersist its ``cached`` frame,
    if it has one, when the result is no longer needed."""
    flag = "__rs_dup"
    return attach_duplicate_flag(df, df, keys, flag, policy, sizes).where(F.col(flag)).drop(flag)
