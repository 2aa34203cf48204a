"""Bounded samples of labelled rows, for fitting classifiers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bounded(rows: DataFrame, label: str, key: Column, per_label: int, most_labels: int = 1000) -> tuple[DataFrame, dict]:
    """At most ``per_label`` rows of each label, by the least hashes of ``key``, and the counts of the labels.

    Of more than ``most_labels`` labels the most frequent are taken, so what comes to the driver is bounded.
    A share of the hash range a little above the bound is taken first, so only that many rows meet in the ranking.
    """
    rows = rows.where(F.col(label).isNotNull())
    counts = {r[label]: r["n"] for r in rows.groupBy(label).agg(F.count("*").alias("n")).orderBy(F.desc("n"), label).limit(most_labels).collect()}
    if not counts:
        return rows, counts
    place = F.pmod(F.xxhash64(key, F.lit(17)), F.lit(1 << 30))
    share = lambda n: int(min(1.0, (per_label + 6 * per_label**0.5 + 20) / n) * (1 << 30))
    near = reduce(lambda a, b: a | b, [(F.col(label) == v) & (place < share(n)) for v, n in counts.items()])
    ranked = rows.where(near).withColumn("_rank", F.row_number().over(Window.partitionBy(label).orderBy(place, key)))
    return ranked.where(F.col("_rank") <= per_label).drop("_rank"), counts
