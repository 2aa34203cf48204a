"""Operator 1: URL rules by Bloom filter cascades.

A rule is an action, a host and the beginning of a path; it fits the host and its subdomains. The keys of a URL are those of
its host's suffixes and path's beginnings that have the shape (labels, characters) of some rule. A cascade
tells exactly whether a key is listed, for all keys of the corpus: level 1 is a Bloom filter of the listed keys, level 2
one of the corpus's keys that pass level 1 and aren't listed, level 3 one of the listed keys that pass level 2, and so
on until no key is told wrong. A key's answer is given by the first level it doesn't pass. Filters are arrays of 64-bit
words inside the expression, so judging a URL takes no join.

Everything is DataFrame functions. The list of rules is bounded by nature and comes from the driver; filters are at most
``most_bits`` long (checked), and level 1 has so many bits a key that few corpus keys pass it.

Defined cases: a null URL or one without ``://`` has empty host and path; no rule fits it. Without a fitting rule a URL
is allowed, as the cascade knows no key of it. Rows that repeat are judged each for itself.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, pick

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HASHES = 4


@dataclass(frozen=True)
class Rule:
    action: str  # block or allow
    host: str
    path: str

    @property
    def key(self) -> str:
        return self.host + self.path

    @property
    def shape(self) -> tuple[int, int]:
        return self.host.count(".") + 1, len(self.path)


def host_of(url: Column) -> Column:
    rest = F.substring(url, F.locate("://", url) + 3, F.length(url))
    return F.when(F.locate("://", url) > 0, F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)).otherwise("")


def path_of(url: Column) -> Column:
    rest = F.substring(url, F.locate("://", url) + 3, F.length(url))
    return F.when(F.locate("://", url) > 0, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)).otherwise("")


def keys_of(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """The keys of a URL that have one of the shapes, as (key, labels of its host)."""
    labels = F.split(host, r"\.")

    def key(shape: tuple[int, int]) -> Column:
        n, size = shape
        suffix = F.array_join(F.slice(labels, F.size(labels) - n + 1, F.lit(n)), ".")
        fits = (F.size(labels) >= n) & (F.length(path) >= size) & (host != "")
        return F.when(fits, F.struct(F.concat(suffix, F.substring(path, 1, size)).alias("key"), F.lit(n).alias("labels")))

    return F.array_compact(F.array(*[key(s) for s in shapes])) if shapes else F.array()


@dataclass(frozen=True)
class Level:
    """One Bloom filter: its words of 64 bits, and the seed of its hashes."""

    words: tuple[int, ...]
    seed: int

    def passes(self, key: Column) -> Column:
        table, bits = F.lit(list(self.words)).cast("array<long>"), 64 * len(self.words)

        def bit(place: Column) -> Column:
            word = F.get(table, F.shiftright(place, 6).cast("int"))
            return F.bit_get(word, F.pmod(place, F.lit(64)).cast("int")) == 1

        return reduce(and_, [bit(p) for p in places(key, bits, self.seed)])


def places(key: Column, bits: int, seed: int) -> list[Column]:
    """Where a key's bits lie."""
    a, b = F.xxhash64(key, F.lit(2 * seed)), F.xxhash64(key, F.lit(2 * seed + 1))
    return [F.pmod(F.shiftrightunsigned(a, 2) + F.lit(i) * F.shiftrightunsigned(b, 4), F.lit(bits)) for i in range(HASHES)]


class TooLarge(ValueError):
    """Of a filter that is larger than an expression should hold."""


def build_level(keys: DataFrame, seed: int, bits_per_key: int, most_bits: int) -> Level | None:
    """A Bloom filter of the keys; None for no keys. Its words alone come to the driver; a filter that is too large is an error."""
    n = keys.count()
    if not n:
        return None
    words = -(-max(64, n * bits_per_key) // 64)
    if 64 * words > most_bits:
        raise TooLarge(f"a level of {n} keys needs {64 * words} bits")
    at = keys.select(F.explode(F.array(*places(F.col("key"), 64 * words, seed))).alias("place"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("place", F.lit(64)).cast("int"))
    held = at.groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    table = [0] * words
    for r in held.collect():  # at most most_bits / 64 rows
        table[r["word"]] = r["bits"]
    return Level(tuple(table), seed)


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def lists(self, key: Column) -> Column:
        """Whether the key is listed: exact for listed keys and all keys of the universe."""
        out = F.lit(len(self.levels) % 2 == 1)
        for i in reversed(range(len(self.levels))):
            out = F.when(self.levels[i].passes(key), out).otherwise(F.lit(i % 2 == 1))
        return out


def build_cascade(listed: DataFrame, universe: DataFrame, bits_per_key: int = 24, later_bits: int = 8, most_bits: int = 1 << 26, small: int = 1_000_000) -> Cascade:
    """``listed`` and ``universe`` have a column key; the universe is all the corpus's distinct keys.

    Each level has fewer keys than the one two before, until none are left to tell apart. Up to ``small`` listed keys are broadcast.
    """
    levels: list[Level] = []
    encode = materialise(listed.select("key").distinct(), "cascade-listed")
    others = universe.join(F.broadcast(encode) if encode.count() <= small else encode, "key", "left_anti")
    while True:
        level = build_level(encode, len(levels), later_bits if levels else bits_per_key, most_bits)
        if level is None:
            return Cascade(tuple(levels))
        levels.append(level)
        encode, others = materialise(others.where(level.passes(F.col("key"))), "cascade-passed"), encode


def rules_table(spark: SparkSession, rules: list[Rule], action: str) -> DataFrame:
    return spark.createDataFrame([(r.key,) for r in rules if r.action == action], "key string")


def _with_listed(rows: DataFrame, listed: DataFrame, name: str) -> DataFrame:
    """Adds the keys of each row that are listed."""
    numbered = materialise(rows.withColumn("_n", F.monotonically_increasing_id()), "url-rows")
    met = numbered.select("_n", F.explode("keys.key").alias("key")).join(listed.distinct(), "key").groupBy("_n").agg(F.collect_set("key").alias(name))
    return numbered.join(met, "_n", "left").withColumn(name, F.coalesce(name, F.array().cast("array<string>"))).drop("_n")


def judge(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url", most_bits: int = 1 << 26) -> DataFrame:
    """(page_id, host, path, rule, verdict) of each row. Of the rules that fit, the longest decides.

    Where a cascade's level would be larger than ``most_bits``, the listed keys of each row are found by a join.
    """
    spark = pages.sparkSession
    shapes = sorted({r.shape for r in rules})
    rows = pick(pages, page_id=id_col, url=url_col).withColumn("url", F.coalesce("url", F.lit("")))
    rows = rows.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).withColumn("keys", keys_of(F.col("host"), F.col("path"), shapes))
    universe = materialise(rows.select(F.explode("keys").alias("k")).select("k.key").distinct(), "url-keys") if shapes else None

    def fit(action: str, cascade: Cascade | None) -> Column:
        found = F.filter("keys", lambda k: cascade.lists(k["key"]) if cascade else F.array_contains(f"listed_{action}", k["key"]))
        return F.transform(found, lambda k: F.struct(F.length(k["key"]).alias("size"), k["labels"].alias("labels"), k["key"].alias("key"), F.lit(action).alias("action")))

    fitting = []
    for action in ("allow", "block"):
        if any(r.action == action for r in rules):
            listed = rules_table(spark, rules, action)
            try:
                cascade = build_cascade(listed, universe, most_bits=most_bits)
            except TooLarge:
                cascade, rows = None, _with_listed(rows, listed, f"listed_{action}")
            fitting.append(fit(action, cascade))
    if not fitting:
        return rows.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit("allow").alias("verdict"))
    best = F.array_max(F.concat(*fitting))
    return rows.withColumn("best", best).select("page_id", "host", "path", F.col("best.key").alias("rule"), F.coalesce("best.action", F.lit("allow")).alias("verdict"))
