"""URL filter with exact membership by a cascade of Bloom filters.

An *address* is a url's host and path.  The key universe is every distinct
address of the corpus; it is known, so membership in a list can be made exact
without keeping the list: level 1 is a Bloom filter of the listed addresses;
the other addresses that it wrongly holds go into level 2; the listed ones
that level 2 wrongly holds go into level 3, and so on until a level holds
nothing wrong.  The first level that does not hold an address decides: an odd
one says *not listed*, an even one *listed*; if all hold it, the last level's
kind decides.  Every level hashes with seeds of its own, so each one leaves a
fixed share of the keys; there is no bound on the number of levels.

Filters are built by DataFrame aggregation (``bit_or`` per 64-bit word) and
read by expressions, so pages are filtered in one pass over ``url`` without a
join.  Keys are dealt to shards by hash, one filter each, so no filter's size
grows with the corpus, only their number.  While all filters measure at most
``LITERAL_BYTES`` they reach the tasks as scalar subqueries; beyond it pages
are joined with the row of their shard.

Rules (host, path prefix) come first: a rule fits its host, all subdomains and
every path that starts with its own; the longest one wins (first given among
equals).  Addresses that a rule blocks, and those of ``listed`` that no rule
fits, are the listed keys; so every verdict comes from the cascade.

Defined cases: a null url, or one without ``://``, has an empty host and path:
an address like any other, which no rule fits.  Rows that repeat are judged
each; a null ``page_id`` is kept; extra columns are ignored, whatever their
names; an empty table gives no rows; a url of any length is read whole.  Null
keys in ``listed`` are ignored.  Verdicts hold for addresses of the corpus
that the cascade was built over, not for others.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsieve.llm.tables import save, shared_folder

#: Filters up to this size in all are handed to tasks as values; larger ones are joined by shard.
LITERAL_BYTES = 16 << 20
#: Addresses of the universe per shard, on average.
SHARD_KEYS = 1 << 22
#: False-positive rate of the levels after the first.
RATE = 1 / 16

#: (verdict, host, path prefix)
Rule = tuple[str, str, str]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    at = F.locate("://", text)
    rest = F.when(at > 0, F.substr(text, at + 3)).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path


def _fits(rule: Rule, host: Column, path: Column) -> Column:
    there = (host == rule[1]) | F.endswith(host, F.lit("." + rule[1]))
    return there & F.startswith(path, F.lit(rule[2]))


def longest_rule(rules: Sequence[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """(rule as text, its verdict) of the longest rule that fits, else null."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in reversed(sorted(rules, key=lambda r: -len(r[1] + r[2]))):
        fits = _fits(rule, host, path)
        text, verdict = F.when(fits, rule[1] + rule[2]).otherwise(text), F.when(fits, rule[0]).otherwise(verdict)
    return text, verdict


@dataclass(frozen=True)
class Level:
    """Filters of one level: a row (shard, words) each, with ``words`` 64-bit words."""

    seed: int
    hashes: int
    words: int
    filters: DataFrame


def _positions(key: Column, seed: int, hashes: int, words: int) -> list[Column]:
    """Bit positions of a key.  The seed goes before the key into the hash, so
    keys that meet in one level part in the next."""
    a, b = [F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(i), key), 24) for i in (0, 1)]
    return [F.pmod(a + F.lit(i) * (b + 1), F.lit(words * 64)) for i in range(hashes)]


def _bit(position: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(position, F.lit(64)).cast("int"))


def _holds(words: Column, key: Column, level: Level) -> Column:
    probes = [
        F.get(words, F.shiftright(p, 6).cast("int")).bitwiseAND(_bit(p)) != 0
        for p in _positions(key, level.seed, level.hashes, level.words)
    ]
    return reduce(lambda a, b: a & b, probes)


def _filters(keys: DataFrame, seed: int, hashes: int, words: int, shards: int, folder: str) -> DataFrame:
    """A row (shard, words) per shard: the Bloom filter of its keys."""
    spark = keys.sparkSession
    bits = keys.select("shard", F.explode(F.array(*_positions(F.col("address"), seed, hashes, words))).alias("at"))
    set_words = bits.groupBy("shard", F.shiftright("at", 6).alias("word")).agg(F.bit_or(_bit(F.col("at"))).alias("bits"))
    zeros = spark.range(shards * words).select(
        F.floor(F.col("id") / F.lit(words)).cast("int").alias("shard"), F.pmod("id", F.lit(words)).alias("word"), F.lit(0).cast("bigint").alias("bits")
    )
    every = set_words.unionByName(zeros).groupBy("shard", "word").agg(F.bit_or("bits").alias("bits"))
    packed = every.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("w"))
    return save(packed.select("shard", F.col("w.bits").alias("words")), folder)


class Cascade:
    """Levels over a universe of (address, shard, listed) rows."""

    def __init__(self, levels: list[Level], shards: int):
        self.levels, self.shards = levels, shards

    @property
    def bytes(self) -> int:
        return sum(level.words * 8 * self.shards for level in self.levels)

    def shard(self, key: Column) -> Column:
        return shard_of(key, self.shards)

    def _decide(self, key: Column, words: list[Column]) -> Column:
        listed = F.lit(len(self.levels) % 2 == 1)
        for i in reversed(range(len(self.levels))):
            listed = F.when(~_holds(words[i], key, self.levels[i]), F.lit(i % 2 == 1)).otherwise(listed)
        return listed

    def mark(self, df: DataFrame, key: str, to: str) -> DataFrame:
        """``df`` with boolean ``to``: is the address in ``key`` listed?"""
        if not self.levels:
            return df.withColumn(to, F.lit(False))
        names = [f"__w{i}" for i in range(len(self.levels))]
        shard = self.shard(F.col(key))
        if self.bytes <= LITERAL_BYTES:
            tables = [level.filters.agg(F.sort_array(F.collect_list(F.struct("shard", "words"))).alias("f")) for level in self.levels]
            held = df.withColumns({n: F.get(t.select(F.col("f.words")).scalar(), shard) for n, t in zip(names, tables)})
        else:
            sides = [level.filters.select(F.col("shard").alias("__shard"), F.col("words").alias(n)) for n, level in zip(names, self.levels)]
            held = df.withColumn("__shard", shard).join(reduce(lambda a, b: a.join(b, "__shard"), sides), "__shard", "left")
        return held.select(*df.columns, self._decide(F.col(key), [F.col(n) for n in names]).alias(to))


def shard_of(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(-1), key), F.lit(shards)).cast("int")


def _size(keys: int, shards: int, rate: float) -> tuple[int, int]:
    """(hashes, words) of a filter of one shard's share of ``keys``."""
    bits = math.log2(1 / rate)
    return max(1, round(bits)), math.ceil((keys / shards * 1.05 + 16) * 1.4427 * bits / 64)


def build(spark: SparkSession, universe: DataFrame) -> Cascade:
    """The cascade of a universe of distinct ``address`` with boolean ``listed``."""
    folder = shared_folder(spark)
    first = save(universe.select("address", "listed"), folder)
    total = first.count()
    shards = max(1, math.ceil(total / SHARD_KEYS))
    left = first.withColumn("shard", shard_of(F.col("address"), shards))
    levels: list[Level] = []
    while True:
        wanted = len(levels) % 2 == 0
        held = {r["listed"]: r["n"] for r in left.groupBy("listed").agg(F.count("*").alias("n")).collect()}
        keys, others = held.get(wanted, 0), held.get(not wanted, 0)
        if not keys:
            return Cascade(levels, shards)
        # the first level is sized so that what it holds wrongly is of the order of what it lists
        rate = RATE if levels else min(RATE, max(keys / max(others, 1) / 2, 2.0**-20))
        hashes, words = _size(keys, shards, rate)
        seed = len(levels) + 1
        chosen = left.where(F.col("listed") == F.lit(wanted))
        level = Level(seed, hashes, words, _filters(chosen, seed, hashes, words, shards, folder))
        levels.append(level)
        held_on = Cascade([level], shards).mark(left, "address", "held")
        left = save(held_on.where("held").drop("held"), folder)


def judge(pages: DataFrame, rules: Sequence[Rule], listed: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of ``pages``: the
    longest rule that fits, and block where the address is listed.
    ``listed`` holds addresses (host and path) in a column ``address``."""
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = longest_rule(rules, F.col("host"), F.col("path"))
    address = F.concat("host", "path").alias("address")
    # whole numbers, so that the universe is one hash aggregate: 2 blocked by a rule, 1 allowed by one, 0 none fits
    by_rule = F.when(verdict == "block", 2).when(verdict.isNotNull(), 1).otherwise(0)
    flags = rows.select(address, by_rule.alias("by_rule"), F.lit(1).alias("here"), F.lit(0).alias("on_list"))
    if listed is not None:
        given = listed.select("address").where("address IS NOT NULL")
        flags = flags.unionByName(given.select("address", F.lit(0).alias("by_rule"), F.lit(0).alias("here"), F.lit(1).alias("on_list")))
    keyed = flags.groupBy("address").agg(*[F.max(c).alias(c) for c in ("by_rule", "here", "on_list")])
    block = (F.col("by_rule") == 2) | ((F.col("by_rule") == 0) & (F.col("on_list") == 1))
    cascade = build(pages.sparkSession, keyed.where("here = 1").select("address", block.alias("listed")))
    judged = cascade.mark(rows.select("page_id", "host", "path", address), "address", "listed")
    return judged.select("page_id", "host", "path", rule.alias("rule"), F.when(F.col("listed"), "block").otherwise("allow").alias("verdict"))


def addresses_on(pages: DataFrame, words: Sequence[str], url_col: str = "url") -> DataFrame:
    """A list: the addresses of pages whose host names hold one of ``words``."""
    host, path = host_and_path(F.col(url_col))
    found = reduce(lambda a, b: a | b, [F.contains(host, F.lit(w)) for w in words], F.lit(False))
    return pages.where(found).select(F.concat(host, path).alias("address")).distinct()
