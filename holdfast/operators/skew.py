"""Splitting of hot keys: their rows are dealt over salts, and what meets them is there once for each salt."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hot(counts: DataFrame, keys: list[str], per: int, n: str = "n") -> DataFrame:
    """(keys, salts) of the keys with more than ``per`` rows by a table of counts (or partial counts): at most rows / ``per`` of them, so it may be broadcast."""
    whole = counts.where(F.col(n) > 0).groupBy(*keys).agg(F.sum(n).alias("_n"))
    return whole.where(F.col("_n") > per).select(*keys, F.ceil(F.col("_n") / per).cast("int").alias("salts"))


def _with_salts(rows: DataFrame, keys: list[str], hot_keys: DataFrame) -> DataFrame:
    named = hot_keys.select(*[F.col(k).alias(f"_hot_{i}") for i, k in enumerate(keys)], F.col("salts").alias("_salts"))
    same = [F.col(k).eqNullSafe(F.col(f"_hot_{i}")) for i, k in enumerate(keys)]
    return rows.join(F.broadcast(named), same, "left").drop(*[f"_hot_{i}" for i in range(len(keys))]).withColumn("_salts", F.coalesce("_salts", F.lit(1)))


def dealt(rows: DataFrame, keys: list[str], hot_keys: DataFrame, *by: Column) -> DataFrame:
    """Adds ``_salt``: rows of a hot key are dealt by a hash of ``by``, others have 0."""
    return _with_salts(rows, keys, hot_keys).withColumn("_salt", F.pmod(F.xxhash64(*by), F.col("_salts")).cast("int")).drop("_salts")


def copied(rows: DataFrame, keys: list[str], hot_keys: DataFrame) -> DataFrame:
    """Adds ``_salt``: rows of a hot key are there once for each of its salts."""
    return _with_salts(rows, keys, hot_keys).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))).drop("_salts")
