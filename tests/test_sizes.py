"""What keeps tasks, shuffles and passes small, by plans and by results on odd rows."""

import os
from datetime import date

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from holdfast.operators import graph, holdings, quality, query, stages, textsearch
from holdfast.plans import catalog

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


RECORD = "fund_isin string, constituent_isin string, as_of date, source_document_id string, source_row_id string, constituent_name string, weight double, source_quantity double, source_market_value double, source_currency string"
REST = ("n", 0.1, 1.0, 1.0, "USD")


def test_edges_follow_from_distinct_keys(spark, rows):
    day = date(2026, 1, 1)
    keys = [("F1", "S1", day, "d1", "1"), ("F1", "S1", day, "d1", "1"), ("F1", "S1", day, "d1", "2"), ("F1", None, day, "d1", "3"), ("F1", None, None, "d1", "3"), ("F1", "S1", day, None, "4"), ("F2", "S1", day, None, "4"), (None, "S1", day, "d2", "5")]
    records = spark.createDataFrame([(*k, *REST) for k in keys], RECORD)
    expected = set()
    for f, s, d, doc, r in keys:
        uri = lambda *x: None if None in x else ":".join(["urn:holdfast", *map(str, x)])
        fund, security, snapshot, position = uri("isin", f), uri("isin", s), uri("snapshot", f, d, doc), uri("position", f, s, d, doc, r)
        expected |= {(fund, "HAS_SNAPSHOT", snapshot), (snapshot, "HAS_POSITION", position), (position, "OF_SECURITY", security), (fund, "HOLDS", security), (snapshot, "HAS_HOLDING", position), (position, "DERIVED_FROM", uri("artifact", doc)), (uri("run", "r"), "UPSERTED", snapshot), (uri("run", "r"), "UPSERTED", position)}
    edges = holdings.to_graph(records, F.lit("r"))["edges"]
    assert rows(edges) == sorted(expected, key=str)
    # no edge with both ends is shuffled: each is made above the aggregations of its keys
    made = [line for line in plan_of(edges).splitlines() if "Aggregate [src" in line]
    assert len(made) == 1


def test_edges_take_one_shuffle_a_kind_of_key(spark, rows):
    day = date(2026, 1, 1)
    keys = [("F1", None, day, "d1", "1"), ("F1", "S1", day, "d2", "1"), ("F1", "S1", day, "d2", "2"), ("F1", "S2", day, "d2", "1"), ("F1", "S1", day, "d2", "1")]
    edges = holdings.to_graph(spark.createDataFrame([(*k, *REST) for k in keys], RECORD), F.lit("r"))["edges"]
    # holdings, snapshots with their positions, and what lacks an end
    assert edges._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 3
    of = lambda rel, like: [tuple(r) for r in edges.where((F.col("rel") == rel) & F.col("dst").like(like)).select("src", "dst").collect()]
    snapshots = [("urn:holdfast:isin:F1", f"urn:holdfast:snapshot:F1:2026-01-01:{d}") for d in ("d1", "d2")]
    assert sorted(of("HAS_SNAPSHOT", "%")) == snapshots
    assert sorted(of("UPSERTED", "%:snapshot:%")) == [("urn:holdfast:run:r", s) for _, s in snapshots]
    assert len(of("UPSERTED", "%:position:%")) == len(of("HAS_POSITION", "%:position:%")) == 3


@pytest.fixture(scope="module")
def plan(spark):
    if not os.path.isdir(SF):
        pytest.skip("no tables")
    return lambda name: plan_of(catalog.queries()[name](spark, SF))


def test_documents_are_judged_in_one_pass(spark, rows, plan):
    assert "Join" not in plan("contract_documents")
    records = spark.createDataFrame([("a", 1), ("a", -1), ("b", 2), (None, -3), (None, 4)], "d string, x int")
    broken = quality.violations({"x": F.col("x") > 0})
    assert rows(quality.document_breaks(records, "d", broken)) == [("a", 1, 2), ("b", 0, 1), (None, 1, 2)]
    assert rows(quality.reject_broken_documents(records, "d", broken)[0]) == [("b", 2), (None, -3), (None, 4)]


def test_evidence_is_dealt_before_it_is_gathered(spark, rows):
    e = spark.createDataFrame([("k", "d", 1), ("k", "d", 1), ("k", "d", 2), ("k", None, None), (None, "d", 3)], "k string, d string, r int")
    found = query.evidence_sources(e, "k", "r", "d", "d", "d", "d")
    assert rows(found) == sorted([("k", *["d"] * 4, 2), ("k", *[None] * 4, 0), (None, *["d"] * 4, 1)], key=str)
    assert "RepartitionByExpression" in plan_of(found)


def test_baskets_are_read_few_times(plan):
    assert plan("baskets_normalised").count("Relation [l_orderkey") <= 4


def test_a_timeline_has_only_the_columns_in_use(plan):
    assert not any(x in line for line in plan("asof_own_day").splitlines() if "Relation" not in line for x in ("l_extendedprice", "l_tax"))


def test_edges_are_dealt_before_they_are_distinct(plan):
    assert "RepartitionByExpression" in plan("relation_catalog")


def written_plans(monkeypatch):
    plans, was = [], stages.written
    monkeypatch.setattr(stages, "written", lambda df, name: (plans.append(plan_of(df)), was(df, name))[1])
    return plans


def test_filings_are_parsed_once(plan):
    assert plan("landed_filings").count("Relation [formData") == 1


def test_a_round_of_neighbours_is_one_aggregation(spark, rows, monkeypatch):
    plans = written_plans(monkeypatch)
    edges = spark.createDataFrame([("a", "r", "b"), ("a", "r", "b"), ("b", "r", "a"), ("b", "r", "c"), ("a", "r", "c")], "src string, rel string, dst string")
    found = graph.neighbours(spark.createDataFrame([("a",)], "root string"), edges, ["r"], 3)
    assert rows(found) == [("a", "b", 1), ("a", "c", 1)]
    assert not any("LeftAnti" in p for p in plans)


def test_long_names_are_looked_for_by_their_heads(spark, rows, monkeypatch):
    names = ["a b c d " + " ".join("x" * i) for i in range(1, 40)] + ["a b", "q b c d e"]
    text = "z a b c d x x x a b c d x q b c d e"
    docs = spark.createDataFrame([(1, text), (2, "nothing of these is in here at all"), (3, "a b c d"), (4, None)], "k int, body string")
    found = textsearch.mentions(docs, ["k"], "body", spark.createDataFrame([(n,) for n in names], "name string"), "name")
    assert rows(found.drop("start")) == sorted([(1, names[0], 8, 5), (1, names[2], 1, 7), (1, "q b c d e", 13, 5), (3, "a b", 0, 2)], key=str)
    calls, was = [], textsearch._among
    monkeypatch.setattr(textsearch, "_among", lambda known, x: (calls.append(1), was(known, x))[1])
    n = np.arange(1, 60)
    list(textsearch._hits(n, n * 7919, n * 104729)([pa.RecordBatch.from_pydict({"row": [1], "text": ["nothing of these is in here at all"]})]))
    assert len(calls) == 5


def test_nothing_is_remembered_without_cycles(spark, rows, monkeypatch):
    plans = written_plans(monkeypatch)
    held = holdings.shares(spark.createDataFrame([("a", "b", 1.0), ("a", "c", 2.0), ("a", "c", 1.0), ("b", "d", 4.0), ("c", "d", 2.0)], "fund string, security string, v double"), "v")
    assert rows(held) == [("a", "b", 0.25), ("a", "c", 0.75), ("b", "d", 1.0), ("c", "d", 1.0)]
    found = holdings.look_through(spark.createDataFrame([("a",)], "root string"), held, 3)
    assert rows(found) == [("a", "b", 1, 0.25, True), ("a", "c", 1, 0.75, True), ("a", "d", 2, 1.0, False)]
    assert not any("through" in p for p in plans)
