from datetime import date

import pytest
from pyspark.sql import functions as F

from holdfast.operators import fold, graph, holdings, identity, metrics, observe, predicates, quality, textsearch, transform
from holdfast.operators import query as Q
from holdfast.sources import landed, ontology
from holdfast.streaming import intake


def test_fold_rules(spark, rows):
    df = spark.createDataFrame([("a", 1, "x", 1.0), ("a", 2, None, None), ("b", 1, None, 3.0)], "k string, o int, s string, v double")
    out = fold.fold(df, ["k"], F.col("o"), {"s": "last_value", "v": "last_row"})
    assert rows(out) == [("a", "x", None), ("b", None, 3.0)]
    with pytest.raises(ValueError):
        fold.folded("s", F.col("o"), "other")


def test_month_grid_keeps_the_cut_day(spark):
    days = [r["day"] for r in observe.month_grid(spark, "2026-01-31", 3).orderBy("i").collect()]
    assert days == [date(2026, 1, 31), date(2026, 2, 28), date(2026, 3, 28), date(2026, 4, 28)]


def test_latest_prefers_dated(spark, rows):
    df = spark.createDataFrame([("a", None, "u1"), ("a", date(2026, 1, 1), "u2"), ("a", date(2026, 1, 1), "u0"), ("b", None, "u3")], "o string, d date, u string")
    assert rows(observe.latest(df, "o", "d", "u").select("o", "u")) == [("a", "u0"), ("b", "u3")]


def test_missing_is_unknown(spark, rows):
    df = spark.createDataFrame([(1, 5), (2, None)], "k int, x int")
    for p in (predicates.leaf(F.col("x"), "neq", 4, "number"), ~predicates.leaf(F.col("x"), "gt", 9, "number")):
        assert rows(df.where(p).select("k")) == [(1,)]
    for op, kind in (("gt", "string"), ("contains", "number"), ("like", "string")):
        with pytest.raises(ValueError, match="unsupported_operator"):
            predicates.leaf(F.col("x"), op, 1, kind)


def test_resolution_tries_nothing_else_after_a_malformed_isin(spark, rows):
    cross = spark.createDataFrame([("krx_code", "005380", "ISIN", "KR7005380008", "me"), ("krx_code", "1", "ISIN", "KR7000000001", None)], "local_key_type string, local_key string, standard_id_type string, standard_id string, reviewed_by string")
    df = spark.createDataFrame([(1, "bad", "005380"), (2, None, "005380"), (3, None, "1"), (4, "us0378331005", None)], "i int, isin string, key string").withColumn("kind", F.lit("KRX_code"))
    out = identity.resolve(df, identity.index(cross), "isin", "kind", "key")
    assert rows(out.select("i", "constituent_isin", "identifier_method")) == [(1, None, "unresolved"), (2, "KR7005380008", "crosswalk"), (3, None, "unresolved"), (4, "US0378331005", "source_isin")]


def test_basket_fixture(spark, tmp_path):
    (tmp_path / "b.csv").write_text('﻿기준일,종목명,표준코드,종목코드,비중(%),수량,평가금액,통화\n2026-06-30,가,KR7005930003,005930,"32.5%","1,000","450,000",KRW\n\n2026.06.30,나,,005380,25.0,500,,\n,다,KR7000660001,000660,,200,"300,000",\n2026-06-30,라,,999999,5,10,"100,000",KRW\n2026-06-30,마,KR7035420009,035420,2.5,"-50","150,000",KRW\n', encoding="utf-8")
    cross = spark.createDataFrame([("krx_code", "005380", "KR7005380008")], "kind string, key string, isin string")
    out = {r["row"]: r for r in holdings.normalise_baskets(landed.basket_csv(spark, str(tmp_path)), cross).collect()}
    assert sorted(out) == [2, 3, 4, 5, 6]
    assert (out[2]["weight"], out[2]["weight_source"], out[2]["quantity"], out[2]["currency"]) == (0.325, "source_published", 1000.0, "KRW")
    assert (out[3]["constituent_isin"], out[3]["identifier_method"], out[3]["weight"], out[3]["currency"]) == ("KR7005380008", "crosswalk", 0.25, None)
    assert (out[4]["weight"], out[4]["weight_source"], out[4]["currency"]) == (0.3, "derived_from_value", "KRW")
    assert out[5]["reason"] == "no reviewed ISIN crosswalk entry" and out[6]["reason"] == "quantity is negative: -50.0"
    assert out[2]["reason"] is None


def test_filing_fixture(spark, tmp_path):
    position = "<n:invstOrSec><n:name>{}</n:name><n:isin>{}</n:isin><n:cusip>{}</n:cusip><n:balance>{}</n:balance><n:valUSD>{}</n:valUSD>{}</n:invstOrSec>"
    body = "".join(position.format(*p) for p in [("One", "US0378331005", "000000001", 1, 400000, "<n:pctVal>40</n:pctVal>"), ("Two", "N/A", "000000002", 1, 100000, "<n:pctVal>10</n:pctVal>"), ("Three", "US5949181045", "000000003", 1, 200000, ""), ("Four", "US0231351067", "000000004", -500, 50000, "<n:pctVal>5</n:pctVal>"), ("Five", "US02079K3059", "000000005", 1, 200000, "<n:pctVal>150</n:pctVal>")])
    (tmp_path / "f.xml").write_text(f'<n:edgarSubmission xmlns:n="u"><n:formData><n:genInfo><n:repPdDate>2026-06-30</n:repPdDate></n:genInfo><n:fundInfo><n:invstOrSecs>{body}</n:invstOrSecs></n:fundInfo></n:formData></n:edgarSubmission>')
    cross = spark.createDataFrame([], "kind string, key string, isin string")
    out = {r["name"]: r for r in holdings.normalise_filings(landed.filings_xml(spark, str(tmp_path / "f.xml")), cross).collect()}
    assert out["One"]["weight"] == 0.4 and out["One"]["reason"] is None and out["One"]["key"] == "000000001"
    assert out["Two"]["reason"] == "no reviewed ISIN crosswalk entry"
    assert out["Four"]["reason"] == "quantity is negative: -500.0" and out["Five"]["reason"] == "weight exceeds 1.0"
    assert abs(out["Three"]["weight"] - 200000 / 950000) < 1e-12 and out["Three"]["weight_source"] == "derived_from_value"
    assert out["One"]["report_date"] == date(2026, 6, 30)


def test_ontology_and_paths(spark, rows):
    closed = graph.closure(ontology.subclass_of(spark))
    assert ("KoreanETF", "FinancialInstrument") in {(r["node"], r["ancestor"]) for r in closed.collect()}
    edges = spark.createDataFrame([("a", "r", "b"), ("b", "r", "a"), ("b", "r", "c"), ("a", "s", "c")], "src string, rel string, dst string")
    root = spark.createDataFrame([("a",)], "root string")
    assert rows(graph.neighbours(root, edges, ["r"], 3)) == [("a", "b", 1), ("a", "c", 2)]
    with pytest.raises(ValueError):
        graph.paths(root, edges, ["r"], 5)


def test_routing_and_totals(spark, rows):
    df = spark.createDataFrame([("d", 1.0), ("d", None), ("e", 2.0), ("e", 2.0), ("f", -1.0)], "doc string, v double")
    strict = df.select("doc", quality.document_total(F.col("v"), "doc", True).alias("t")).distinct()
    positive = df.select("doc", quality.document_total(F.col("v"), "doc", False).alias("t")).distinct()
    assert rows(strict) == [("d", None), ("e", 4.0), ("f", None)] and rows(positive) == [("d", 1.0), ("e", 4.0), ("f", None)]
    assert rows(quality.with_document_total(df, "doc", "v", True).select("doc", "document_total").distinct()) == rows(strict)
    assert rows(quality.reject_documents(df, "doc", F.col("v").isNull())) == [("e", 2.0), ("e", 2.0), ("f", -1.0)]


def test_public_fund_rows(spark):
    data = [(2, " KR123456789a ", "가 ETF", None, "01", "Y", "7"), (3, '"', "x", None, None, None, None), (4, "ABC", "ETF", None, None, None, None), (5, "KR0000000001", None, "x etf", None, "N", "000"), (6, "KR0000000002", None, None, None, None, None)]
    df = spark.createDataFrame(data, "row_number int, itm_no string, itm_nm string, itm_abrv_nm string, prfd_attr_cd string, sale_yn string, own_no string")
    out = transform.public_funds(df, F.lit("2026-07-11").cast("date"), firm_item="own_no")
    a, b, c, d, e = out.orderBy("row_number").collect()
    assert a["classes"] == ["ETF", "PublicFund"] and a["issue_code"] is None and [x["scheme"] for x in a["identifiers"]] == ["SOURCE_ITEM", "FIRM_ITEM"]
    assert a["listing_uri"] == "urn:holdfast:listing:public-funds:krx-unspecified:KR123456789a" and a["market_code"] == "KRX_UNSPECIFIED" and a["listingInferredFromName"]
    assert b["issue_code"] == c["issue_code"] == "malformed_item_number"  # three letters aren't a key
    assert d["unit_classes"] == ["TradableFundUnit", "ListedSecurity", "PublicFundUnit"] and d["name"] == "KR0000000001" and [x["scheme"] for x in d["identifiers"]] == ["SOURCE_ITEM"]
    assert e["unit_classes"] == ["NonTradableFundUnit", "PublicFundUnit"] and e["listing_uri"] is None and e["availableForSale"] is None
    kinds = {r["rel"] for r in transform.edges(out).collect()}
    assert kinds == {"HAS_IDENTIFIER", "CLASSIFIED_AS", "INSTANCE_OF", "HAS_UNIT", "LISTED_AS", "ON_MARKET", "HAS_OBSERVATION", "OFFERS", "DESCRIBES"}


def test_listed_bonds(spark, rows):
    df = spark.createDataFrame([(2, "KR6000000001", "장내"), (3, "B/1", " 장내 "), (4, "B2", "장외"), (5, None, "장내")], "row_number int, PD_NO string, PD_EXG_MKT string")
    out = transform.edges(transform.bonds(df, F.lit(None).cast("date")))
    assert rows(out.where("rel in ('LISTED_AS', 'ON_MARKET')")) == [
        ("urn:holdfast:bond:B%2F1", "LISTED_AS", "urn:holdfast:listing:bonds:krx-bond:B%2F1"), ("urn:holdfast:isin:KR6000000001", "LISTED_AS", "urn:holdfast:listing:bonds:krx-bond:KR6000000001"),
        ("urn:holdfast:listing:bonds:krx-bond:B%2F1", "ON_MARKET", "urn:holdfast:market:krx-bond"), ("urn:holdfast:listing:bonds:krx-bond:KR6000000001", "ON_MARKET", "urn:holdfast:market:krx-bond"),
    ]


def test_text_and_metrics(spark, rows):
    names = spark.createDataFrame([("Acme Fund",), ("Acne Fund",)], "n string")
    assert rows(textsearch.near_matches(names, "n", "acme fund", 1)) == [("Acme Fund", 0, False)]
    assert rows(textsearch.near_matches(names, "n", "acre fund", 1)) == [("Acme Fund", 1, True), ("Acne Fund", 1, True)]
    docs = spark.createDataFrame([(1, "ab\n\ncd"), (2, None)], "k int, t string")
    assert rows(textsearch.passages(docs, "k", "t")) == [(1, 0, 0, "ab"), (1, 2, 4, "cd")]
    scale = spark.createDataFrame([("AA", 2), ("A", 1)], "code string, place int")
    grades = spark.createDataFrame([("AA",), ("A",), ("B",)], "g string")
    assert rows(metrics.scaled(grades, scale, "g", "AA").select("g", "meets")) == [("A", False), ("AA", True), ("B", None)]


def test_query_limits(spark):
    df = spark.range(5)
    for limit, offset in ((0, 0), (101, 0), (1, 10001)):
        with pytest.raises(ValueError):
            Q.page(df, limit, offset)
    with pytest.raises(ValueError):
        Q.aggregate(df, [], {"x": ("sum", "id")}, {"id": "string"})
    with pytest.raises(ValueError, match="unknown_field"):
        Q.find(df, {"field": "no", "op": "eq", "value": 1}, {}, {"id": F.col("id")}, [], "id")


def test_gaps_and_strict_lines(spark, rows):
    day = lambda m: date(2026, m, 11)
    expected = spark.createDataFrame([("h", day(m)) for m in (1, 2, 3, 4, 5)] + [("c", day(m)) for m in (1, 2, 3)], "s string, d date")
    loaded = spark.createDataFrame([("h", day(1)), ("h", day(5)), ("c", day(1)), ("c", day(2)), ("c", day(3))], "s string, d date")
    assert rows(intake.missing(expected, loaded, ["s", "d"])) == [("h", day(m)) for m in (2, 3, 4)]
    points = observe.grid(expected, "d")
    found = observe.gaps(expected, loaded, "s", "d", points)
    assert rows(found.select("s", "first", "last", "n")) == [("c", day(4), day(5), 2), ("h", day(2), day(4), 3)]
    assert rows(observe.gap_days(found, "s", points)) == [("c", day(4)), ("c", day(5))] + [("h", day(m)) for m in (2, 3, 4)]
    off = spark.createDataFrame([("c", date(2026, 1, 12)), ("x", day(1)), (None, day(3))], "s string, d date")  # off the calendar, not asked for, no target
    assert rows(observe.gaps(expected, off, "s", "d", points).select("s", "first", "last", "n")) == [(s, day(1), day(5), 5) for s in "ch"]
    lines = spark.createDataFrame([('{"a": 1}',), ('{"a": 1, "b": 2}',), ("x",)], "value string")
    assert [r["problem"] for r in landed.strict_json(lines, "value", "a int", ["a"]).collect()] == [None, "unexpected or missing keys", "not an object"]
