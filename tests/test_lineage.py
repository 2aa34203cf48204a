"""Issues and lineage, refused feeds and sheets, venues, expansion after a vector search, days of documents."""

from datetime import date

from pyspark.sql import functions as F

from holdfast.operators import graph, holdings, identity, lineage, textsearch, transform
from holdfast.sources import landed, ontology


def test_issues_and_edges(spark, rows):
    feed = spark.createDataFrame([(2, "KR0000000001"), (3, "ABC"), (4, None)], "row_number int, itm_no string")
    stamp = F.lit("2026-07-11").cast("date")
    entities = transform.public_funds(feed, stamp)
    found = lineage.issues(entities.unionByName(entities), "public-funds")  # a rerun
    assert rows(found.select("uri", "code", "row_number")) == [(f"urn:holdfast:source-record:public-funds:2026-07-11:{i}:issue:malformed-item-number", "malformed_item_number", i) for i in (3, 4)]
    fields = spark.createDataFrame([("public-funds", "itm no"), ("public-funds", "x")], "dataset string, field string")
    edges = lineage.edges(transform.source_records(feed, "public-funds", stamp), fields, found)
    assert sorted(r["rel"] for r in edges.collect()) == ["EXTRACT_OF"] + ["HAS_FIELD"] * 2 + ["HAS_ISSUE"] * 2 + ["IN_FILE"] * 3
    assert "urn:holdfast:field:public-funds:itm%20no" in {r["dst"] for r in edges.collect()}
    assert lineage.edges(transform.source_records(feed.limit(0), "d", F.lit(None).cast("date")), fields.limit(0), found.limit(0)).collect() == []


def test_sheets_and_feeds_that_are_refused(spark, rows):
    sheet = [("a", 1, ["title"]), ("a", 2, None), ("a", 3, [" 컬럼명 ", "x"]), ("a", 4, ["f1", "PK", "char"]), ("a", 5, [None, "PK"]), ("a", 6, ["컬럼명"]), ("b", 1, ["f"]), ("c", 1, [])]
    found, problems = landed.field_sheets(spark.createDataFrame(sheet, "dataset string, row_number int, cells array<string>"))
    assert rows(found.select("field", "ordinal", "key_role", "type", "local_name")) == [("f1", 1, "PK", "char", None), ("컬럼명", 3, None, None, None)]
    assert rows(problems) == [("b", "no schema header"), ("c", "no schema header")]
    files = spark.createDataFrame([("a", "x_20260711.csv"), ("a", "x_20260710.csv"), ("b", "y_20260711.csv"), ("c", "z.csv"), ("d", "w_20261399.csv")], "feed string, file string")
    kept, off = landed.refused_feeds(files, "feed", "file", F.lit("2026-07-11").cast("date"))
    assert rows(kept) == [("b", "y_20260711.csv")] and rows(off) == [("a", 1, "x_20260710.csv"), ("c", 1, "z.csv"), ("d", 1, "w_20261399.csv")]


def test_venues(spark, rows):
    df = spark.createDataFrame([("a", "y"), ("a", "x"), ("a", "x"), ("b", "x"), ("b", None), ("c", "z"), ("c", "y"), ("c", "x")], "s string, v string")
    assert rows(identity.listings(df, "s", "v", most=2)) == [("a", 2, ["x", "y"]), ("c", 3, ["x", "y"])]


def test_expansion_after_a_vector_search(spark, rows):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.9, 0.1]), (3, [0.0, 1.0]), (4, None)], "id long, v array<double>")
    edges = spark.createDataFrame([("1", "r", "a"), ("a", "r", "b"), ("2", "s", "c"), ("3", "r", "d")], "src string, rel string, dst string")
    out = textsearch.vector_expanded(df, "id", "v", [1.0, 0.0], 2, edges, ["r"], 2)
    assert rows(out.select("root", "node", "depth")) == [("1", "1", 0), ("1", "a", 1), ("1", "b", 2), ("2", "2", 0)]


def test_classes_with_several_parents(spark):
    closed = {(r["node"], r["ancestor"]) for r in graph.closure(ontology.subclass_of(spark)).collect()}
    assert {("KoreanETN", "ListedSecurity"), ("KoreanETN", "FinancialProduct"), ("Company", "Organization"), ("EvidencePassage", "SourceRecord")} <= closed
    assert len({c for c, _ in ontology.SUBCLASSES}) == ontology.classes(spark).count() > 34
    assert {p for _, p in ontology.SUBCLASSES if p} <= {c for c, _ in ontology.SUBCLASSES}


def test_documents_of_other_days(spark, rows):
    day = date(2026, 6, 30)
    df = spark.createDataFrame([("a", 1, day), ("a", 2, day), ("b", 1, day), ("b", 2, date(2026, 6, 29)), ("c", 1, day), ("c", 2, None)], "document string, row int, report_date date")
    target = F.lit("2026-06-30").cast("date")
    assert rows(holdings.reject_other_days(df, target, True).select("document", "row")) == [("a", 1), ("a", 2)]
    assert rows(holdings.reject_other_days(df, target, False).select("document", "row")) == [("a", 1), ("a", 2), ("c", 1), ("c", 2)]
