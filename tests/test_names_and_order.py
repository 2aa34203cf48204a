"""Near names, names in texts, and ordinals over any key, against plain versions."""

import math
import random
import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from holdfast.operators import observe, textsearch, transform


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        old, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            old, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, old + (x != y))
    return row[-1]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("most", [1, 2])
def test_near_pairs(spark, most):
    rng = random.Random(4)
    name = lambda: "".join(rng.choice("abAé ") for _ in range(rng.randrange(7)))
    left, right = [name() for _ in range(60)] + [None, ""], [name() for _ in range(60)] + [None, "", "x" * 300, "x" * 299 + "y"]
    a, b = (spark.createDataFrame([(x,) for x in side], "n string") for side in (left, right))
    out = textsearch.near_pairs(a, b, "n", "n", most)
    assert "NestedLoop" not in plan_of(out) and "Cartesian" not in plan_of(out)
    pairs = {(x, y): distance(x.lower(), y.lower()) for x in left for y in right if x is not None and y is not None}
    assert sorted(map(tuple, out.collect())) == sorted((x, y, d) for (x, y), d in pairs.items() if d <= most)
    exact = {x for (x, _), d in pairs.items() if d == 0}
    each = textsearch.near_matches_of(a, b, "n", "n", most)
    assert sorted(map(tuple, each.collect())) == sorted((x, y, d, d > 0) for (x, y), d in pairs.items() if d <= most and (d == 0 or x not in exact))


def test_near_names_of_files_are_not_broadcast(spark, tmp_path):
    spark.range(40).selectExpr("concat('Name#', lpad(id, 3, '0')) as n").write.parquet(f"{tmp_path}/n")
    names = spark.read.parquet(f"{tmp_path}/n")
    for out in (textsearch.near_pairs(names, names, "n", "n"), textsearch.near_matches_of(names, names, "n", "n")):
        assert "Broadcast" not in plan_of(out)
        # few bytes, yet the strings are made by all tasks
        assert out.count() and plan_of(out).count("REPARTITION_BY_NUM") == 2


def test_fulltext_with_repeated_keys_and_any_order_of_words(spark):
    words = ["red", "old", "new", "big", "low"]
    rng = random.Random(9)
    rows = [(k, " ".join(rng.sample(words, 5))) for k in range(60)] + [(k, rng.choice(words)) for k in range(100, 140)] + [(50, "red Old"), (139, "red"), (139, "red"), (7, None)]
    df = spark.createDataFrame(rows, "k int, t string").repartition(5)
    held = {(k, w.lower()) for k, t in rows for w in (t or "").split()}
    idf = {w: math.log(1 + len(rows) / sum(x == w for _, x in held)) for w in words}
    score = {k: sum(sorted(idf[w] for i, w in held if i == k)) for k, _ in held}
    out = [tuple(r) for r in textsearch.fulltext(df, "k", "t", "red old, NEW big low", 90).collect()]
    assert [k for k, _ in out] == sorted(score, key=lambda k: (-score[k], k))[:90]
    assert all(abs(s - score[k]) < 1e-12 for k, s in out)


def test_edges_are_not_gathered_where_a_feed_is_read(spark):
    rows = [(i % 7, "fund", f"u{i % 7}", f"s{i}") for i in range(20)]
    df = spark.createDataFrame(rows, "row_number int, kind string, uri string, source_uri string").withColumn("issue_code", F.lit(None).cast("string"))
    out = transform.edges(df)
    plan = plan_of(out)
    assert sorted(map(tuple, out.collect())) == sorted((f"s{i}", "DESCRIBES", f"u{i % 7}") for i in range(20))
    # both halves of the aggregation lie above the exchange
    assert "HashAggregate" in plan and "HashAggregate" not in plan.split("REPARTITION_BY_NUM")[1]


def mentions_by_hand(text, names):
    at = [(m.start(), m.group().lower()) for m in re.finditer(r"[^\W_]+", text or "")]
    found = set()
    for name in names:
        w = re.findall(r"[^\W_]+", name.lower()) if name else []
        found |= {(name, i, len(w), at[i][0]) for i in range(len(at) - len(w) + 1) if w and [x for _, x in at[i : i + len(w)]] == w}
    return {m for m in found if not any(x[1] <= m[1] and x[1] + x[2] >= m[1] + m[2] and x[2] > m[2] for x in found)}


@pytest.mark.parametrize("at_once", [100, 3])
def test_mentions(spark, at_once):
    rng = random.Random(5)
    names = ["Red Widget", "red", "widget red ring", "RED-WIDGET", "old", "old red widget", "new old", "é ring", None, "--", "absent name"]
    texts = [None, "", "...", "Red, widget!"] + [rng.choice(["", "- "]) + " ".join(rng.choice(["red", "Widget,", "ring.", "old", "new", "É", "x"]) + rng.choice(["", "\n"]) for _ in range(rng.randrange(25))) for _ in range(60)]
    docs = spark.createDataFrame([(i, "p", t) for i, t in enumerate(texts)], "k int, part string, body string").repartition(3)
    out = textsearch.mentions(docs, ["k", "part"], "body", spark.createDataFrame([(n,) for n in names], "title string"), "title", at_once)
    expected = {(i, "p", *m) for i, t in enumerate(texts) for m in mentions_by_hand(t, names)}
    got = [tuple(r) for r in out.collect()]
    assert set(got) == expected and len(got) == len(expected)
    assert textsearch.mentions(docs, ["k"], "body", spark.createDataFrame([(None,)], "title string"), "title").collect() == []


def test_ordinals_over_a_date_and_two_strings(spark):
    rng = random.Random(6)
    day = lambda: date(2026, 1, 1) + timedelta(days=rng.randrange(5)) if rng.random() > 0.1 else None
    rows = [(rng.choice(["hot"] * 8 + ["a", None]), day(), rng.choice("xyz"), f"d{rng.randrange(60)}", i) for i in range(900)] + [("hot", None, "x", "d0", 7)] * 3
    df = spark.createDataFrame(rows, "g string, as_of date, url string, doc string, i int").repartition(3)
    out = observe.shards(df, ["g"], ["as_of", "url", "doc"], size=40, ranges=9)
    assert "SinglePartition" not in plan_of(out)
    key = lambda r: (r["as_of"] or date.min, r["url"], r["doc"])
    seen = 0
    for g in {r[0] for r in rows}:
        own = sorted((r for r in out.collect() if r["g"] == g), key=lambda r: r["ordinal"])
        assert [r["ordinal"] for r in own] == list(range(1, len(own) + 1)) and [key(r) for r in own] == sorted(key(r) for r in own)
        assert all(r["shard"] == (r["ordinal"] - 1) // 40 for r in own)
        seen += len(own)
    assert seen == len(rows)
    # the hot group lies in several ranges
    parted = df.repartitionByRange(9, "g", "as_of", "url", "doc").where("g = 'hot'").select(F.spark_partition_id()).distinct().count()
    assert parted > 3
