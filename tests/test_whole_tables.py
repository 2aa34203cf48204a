"""Queries over whole tables, against brute force on a small fixture whose ids the subsets of the older queries leave out."""

from datetime import date, datetime

import pytest

from holdfast.plans import catalog

LINES = [(o, n, p, 7, 10.0, 100.0 * n, 0.1, datetime(1997, 1, o % 28 + 1)) for o in range(1, 12) for n, p in ((1, o), (2, o + 11))]
ORDERS = [(o, o % 3, datetime(1996, 1, o)) for o in range(1, 12)]
EVENTS = [(i, i % 4, "click", datetime(2024, 1, 1 + i // 3)) for i in range(25)]
PARTS = [(1, "Bolt", "b1", 1), (2, "bolt", "b2", 1), (3, "BOLT", "b1", 9), (4, "nut", "b1", 1), (4, "nut", "b2", 2), (5, None, "b1", 1), (6, None, "b1", 1)]


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("tables"))
    line = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, l_shipdate timestamp_ntz"
    spark.createDataFrame(LINES, line).write.parquet(f"{at}/lineitem.parquet")
    spark.createDataFrame(ORDERS, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").write.parquet(f"{at}/orders.parquet")
    spark.createDataFrame(EVENTS, "event_id long, user_id long, event_type string, ts timestamp_ntz").write.parquet(f"{at}/events.parquet")
    spark.createDataFrame(PARTS, "p_partkey long, p_name string, p_brand string, p_size int").write.parquet(f"{at}/part.parquet")
    return lambda name: sorted(tuple(r) for r in catalog.queries()[name](spark, at).collect())


def test_every_position_is_checked(whole):
    kind = lambda p: "weight,identifier_method" if p % 22 == 0 else "weight" if p % 11 == 0 else ""
    found = [kind(x[2]) for x in LINES]
    assert whole("contract_violations_all") == sorted((k, found.count(k)) for k in set(found))


def test_every_position_becomes_edges(whole):
    held, dated = {(x[0], x[2]) for x in LINES}, {(x[0], x[7]) for x in LINES}
    assert whole("holdings_to_graph_all") == [("HAS_POSITION", len(LINES)), ("HAS_SNAPSHOT", len(dated)), ("HOLDS", len(held)), ("OF_SECURITY", len(LINES))]


def test_every_event_is_matched(whole):
    last = {c: max((d, -o) for o, x, d in ORDERS if x == c) for c in range(3)}
    assert whole("asof_holdings_aum_all") == sorted((i, -last[u][1]) for i, u, _, _ in EVENTS if u in last)


def test_every_security_has_its_holders(whole):
    fund = {o: (c, d.date()) for o, c, d in ORDERS}
    assert whole("holders_of_security_all") == sorted((p, *fund[o], price) for o, _, p, _, _, price, _, _ in LINES)
    assert fund[1][1] == date(1996, 1, 1)


def test_a_name_has_all_its_ids(whole):
    assert whole("name_only_groups") == [("bolt", 1, 3), ("bolt", 2, 3), ("bolt", 3, 3)]


def test_gaps_of_every_day(whole):
    seen = {(u, d.date()) for _, u, _, d in EVENTS}
    gaps = sorted((u, d) for u in range(4) for d in {d for _, d in seen} if (u, d) not in seen)
    assert whole("compute_missing_all") == gaps and gaps[-1][1] > date(2024, 1, 3)
