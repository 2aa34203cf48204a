"""As-of joins, look-through holdings and neighbours by rounds, against plain versions."""

import random
import time
from collections import defaultdict
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from holdfast.operators import graph, holdings, observe, stages


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("per", [1_000_000, 7])
def test_as_of_each_rows_own_time(spark, per):
    rng = random.Random(1)
    day = lambda: date(2026, 1, 1) + timedelta(days=rng.randrange(400)) if rng.random() > 0.05 else None
    owner = lambda: rng.choice(["hot"] * 5 + ["a", "b", "c", None])
    left = [(i, owner(), day()) for i in range(400)]
    right = [(f"u{i:03}", owner(), day(), None if i % 11 == 0 else i) for i in range(150)] + [("u000a", "hot", date(2026, 2, 1), 1), ("u000b", "hot", date(2026, 2, 1), 2)]
    a = spark.createDataFrame(left, "i int, owner string, day date").repartition(3)
    b = spark.createDataFrame(right, "uri string, fund string, as_of date, day int").repartition(3)  # ``day`` clashes
    out = observe.as_of(a, b, ("owner", "fund"), ("day", "as_of"), "uri", {"uri": "state", "day": "value"}, per=per)
    assert "NestedLoop" not in plan_of(out) and "Cartesian" not in plan_of(out)
    expected = []
    for i, k, d in left:
        seen = [(x, u, v) for u, f, x, v in right if k is not None and d is not None and f == k and x is not None and x <= d]
        last = max(x for x, _, _ in seen) if seen else None
        expected.append((i, k, d, *min(((u, v) for x, u, v in seen if x == last), default=(None, None))))
    assert sorted(map(tuple, out.collect()), key=str) == sorted(expected, key=str)
    assert observe.as_of(a.limit(0), b, ("owner", "fund"), ("day", "as_of"), "uri", {"uri": "state"}).collect() == []
    assert {r["state"] for r in observe.as_of(a, b.limit(0), ("owner", "fund"), ("day", "as_of"), "uri", {"uri": "state"}).collect()} == {None}


def test_as_of_within_a_step(spark, rows):
    at = lambda h: datetime(2026, 3, 31, h)
    a = spark.createDataFrame([(1, "k", at(1)), (2, "k", at(3)), (3, "k", at(5)), (4, "k", datetime(2026, 9, 1))], "i int, k string, t timestamp")
    b = spark.createDataFrame([("x", "k", at(3)), ("y", "k", at(4))], "u string, k string, t timestamp")
    assert rows(observe.as_of(a, b, ("k", "k"), ("t", "t"), "u", {"u": "state"}).select("i", "state")) == [(1, None), (2, "x"), (3, "y"), (4, "y")]


def through_by_hand(root, held, depth):
    """{security: (least depth, weight)} by walking every chain."""
    found, todo = {}, [(root, (root,), 1.0)]
    for i in range(1, depth + 1):
        new = []
        for node, path, weight in todo:
            for security, share in held[node].items():
                if security not in path:
                    new.append((security, (*path, security), weight * share))
                    d, w = found.get(security, (i, 0.0))
                    found[security] = (d, w + weight * share)
        todo = new
    return found


@pytest.mark.parametrize("depth, per", [(1, 100), (3, 100), (6, 2)])
def test_look_through_with_cycles(spark, depth, per):
    rng = random.Random(2)
    pairs = [("f0", "f1"), ("f1", "f2"), ("f2", "f0"), ("f2", "f2"), ("f3", "f1"), ("f4", "f3"), ("f4", "s1"), ("f5", "f4"), ("f5", "f1")]
    pairs += [(f"f{rng.randrange(7)}", rng.choice([f"s{rng.randrange(5)}", f"f{rng.randrange(7)}"])) for _ in range(14)]
    lines = [(a, b, rng.choice([0.25, 0.5, 0.125])) for a, b in pairs] + [("f1", None, 1.0), (None, "s1", 1.0), ("f1", "s2", None)]
    held = defaultdict(lambda: defaultdict(float))
    for a, b, w in lines:
        if None not in (a, b, w):
            held[a][b] += w
    roots = [f"f{i}" for i in range(7)] + ["s1", "unknown"]
    df = spark.createDataFrame(lines, "fund string, security string, weight double")
    out = holdings.look_through(spark.createDataFrame([(r,) for r in [*roots, "f1", None]], "root string"), df, depth, per)
    expected = {(r, s): (d, pytest.approx(w), s in held) for r in roots for s, (d, w) in through_by_hand(r, dict(held) | {x: {} for x in roots + [f"s{i}" for i in range(5)] if x not in held}, depth).items()}
    got = {(r["root"], r["security"]): (r["depth"], r["weight"], r["is_fund"]) for r in out.collect()}
    assert got == expected


def test_look_through_remembers_only_cycles(spark):
    """On a ladder of diamonds, where chains double with each step, a round holds one row for each (root, security)."""
    lines = [(f"a{i}", f"{x}{i}", 0.5) for i in range(10) for x in "bc"] + [(f"{x}{i}", f"a{i + 1}", 1.0) for i in range(10) for x in "bc"]
    df = spark.createDataFrame(lines, "fund string, security string, weight double")
    out = {r["security"]: (r["depth"], r["weight"], r["is_fund"]) for r in holdings.look_through(spark.createDataFrame([("a0",)], "root string"), df, 20).collect()}
    assert out["a10"] == (20, 1.0, False) and out["b9"] == (19, 0.5, True)


@pytest.mark.parametrize("n_roots, cycle", [(50, False), (3, False), (50, True)])
def test_products_to_large_securities_take_turns(spark, monkeypatch, n_roots, cycle):
    """Many products add up to few securities: dealt by root (of few roots by what they hold too), some roots at a time."""
    monkeypatch.setattr(holdings, "_AT_ONCE", 100, raising=False)
    rng = random.Random(4)
    lines = [(f"r{i}", f"p{p}", 0.125) for i in range(50) for p in rng.sample(range(20), 8)] + [(f"p{p}", f"h{h}", 0.25) for p in range(20) for h in rng.sample(range(5), 4)]
    lines += [(f"h{h}", f"t{h % 2}", 0.5) for h in range(5)] + [("h0", "p0", 0.5)] * cycle
    held = defaultdict(dict)
    for a, b, w in lines:
        held[a][b] = w
    tables, was = [], stages.written
    monkeypatch.setattr(stages, "written", lambda df, name: (tables.append(name), was(df, name))[1])
    roots = [f"r{i}" for i in range(n_roots)]
    out = holdings.look_through(spark.createDataFrame([(r,) for r in roots], "root string"), spark.createDataFrame(lines, "fund string, security string, weight double"), 4, 30 if n_roots > 3 else 10)
    every = dict(held) | {"t0": {}, "t1": {}}
    expected = {(r, s): (d, pytest.approx(w), s in held) for r in roots for s, (d, w) in through_by_hand(r, every, 4).items()}
    assert {(r["root"], r["security"]): (r["depth"], r["weight"], r["is_fund"]) for r in out.collect()} == expected
    assert tables.count("look-through-wide") > (2 if n_roots > 3 else 0)


def test_look_through_frees_its_shuffles(spark, monkeypatch):
    """Once the rounds are written, their shuffle files are gone, without waiting for the driver's garbage collection."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    freed, was = [], stages.written
    monkeypatch.setattr(stages, "written", lambda df, table: (freed.append(spark.conf.get(name)), was(df, table))[1])
    place = Path(spark.conf.get("spark.local.dir"))
    lasting = lambda: {p.name.split("_")[1] for p in place.rglob("shuffle_*.data")}
    before = lasting()
    lines = [(f"a{i}", f"b{i % 7}", 0.5) for i in range(40)] + [(f"b{i}", f"c{i % 3}", 1.0) for i in range(7)]
    held, roots = spark.createDataFrame(lines, "fund string, security string, weight double"), spark.createDataFrame([(f"a{i}",) for i in range(40)], "root string")
    out = holdings.look_through(roots, held, 3)
    for _ in range(50):
        if not lasting() - before:
            break
        time.sleep(0.1)
    # a stage that a query no longer needs may end after it
    assert len(lasting() - before) <= 3
    assert set(freed) == {"true"} and spark.conf.get(name) == "false"
    assert out.count() == 80


def distances(root, links, depth):
    found, last = {root: 0}, {root}
    for i in range(1, depth + 1):
        last = {b for a in last for b in links[a]} - set(found)
        found |= dict.fromkeys(last, i)
    return {(root, n, d) for n, d in found.items() if d}


@pytest.mark.parametrize("per", [1_000_000, 5])
def test_neighbours_through_a_hub(spark, per):
    rng = random.Random(3)
    edges = [(f"n{i}", "r", "hub") for i in range(60)] + [("hub", "r", f"n{i}") for i in range(60)]
    edges += [(f"n{rng.randrange(60)}", "r", f"m{rng.randrange(30)}") for _ in range(80)] + [(f"m{rng.randrange(30)}", "s", "far") for _ in range(40)] + [("far", "r", "n0"), ("m1", "other", "x")]
    links = defaultdict(set)
    for a, rel, b in edges:
        if rel != "other":
            links[a].add(b)
    roots = [f"n{i}" for i in range(0, 60, 7)] + ["m3", "nowhere"]
    out = graph.neighbours(spark.createDataFrame([(r,) for r in [*roots, "m3"]], "root string"), spark.createDataFrame(edges, "src string, rel string, dst string"), ["r", "s"], 4, per)
    assert {tuple(r) for r in out.collect()} == {x for r in roots for x in distances(r, links, 4)}
    assert out.count() == out.select("root", "node").distinct().count()
    plan = plan_of(out)
    assert "path" not in out.columns and "array" not in plan and "Join" not in plan  # rounds are tables; no walks are made
    with pytest.raises(ValueError):
        graph.neighbours(out.select("root"), out, ["r"], 5)
