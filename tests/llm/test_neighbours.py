"""Recall of operator 7 over several shards, against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast.llm import neighbours


@pytest.mark.parametrize("spread, n", [(0.0, 20000), (1.0, 6000)])
def test_recall_on_vectors_of_unequal_length(spark, spread, n):
    rng = np.random.default_rng(11)
    v = (rng.normal(size=(n, 64)) * np.exp(spread * rng.normal(size=(n, 1)))).astype(np.float32)
    df = spark.createDataFrame([(i, x) for i, x in enumerate(v.tolist())], "vec_id long, embedding array<float>").repartition(8)
    out = neighbours.nearest(df, F.col("id") % 400 == 0, shard_size=4000).collect()
    found = {}
    for r in out:
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    exact, hit = v.astype(np.float64), 0
    for q in range(0, n, 400):
        s = (exact * exact[q]).sum(axis=1)
        s[q] = -np.inf
        hit += len(found[q] & set(np.argsort(-s)[:20].tolist()))
    assert hit >= 0.95 * 20 * len(found) and len(found) == len(range(0, n, 400))


def test_lengths_beyond_the_range_of_squares(spark):
    rows = [(i, [float(i + 1) * 10.0**e, 1.0 * 10.0**e]) for i, e in enumerate((-200, -200, 0, 200, 200))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = neighbours.nearest(df, F.col("id") == 0, k=3).orderBy("rank").collect()
    assert [r["vec_id"] for r in out] == [4, 3, 2]
