"""Queries of row transforms, folds, identity, joins, graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from holdfast.functions import scalars as S
from holdfast.operators import fold, graph, holdings, identity, lineage, observe, quality, transform
from holdfast.operators import query as Q
from holdfast.plans.catalog import query
from holdfast.sources import ontology

c = F.col
V0 = "CASE WHEN event_type <> 'error' THEN value END"


def _value0():
    return F.when(c("event_type") != "error", c("value"))


@query("SELECT 'urn:holdfast:source-record:events:undated:' || event_id AS uri, 'events' AS dataset, event_id AS row_number, event_type AS kind FROM events")
def scan_source_records(t):
    r = transform.source_records(t.events.select(c("event_id").alias("row_number"), "event_type", c("user_id").cast("string").alias("user_id")), "events", F.lit(None).cast("date"))
    return r.select("uri", "dataset", "row_number", F.try_element_at("raw", F.lit("event_type")).alias("kind"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice, 6) AS v FROM lineitem")
def scan_holdings(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.round("l_extendedprice", 6).alias("v"))


def _bond_rows(t):
    return t.part.select(c("p_partkey").alias("row_number"), F.when(c("p_partkey") % 10 == 0, "  ").when(c("p_partkey") % 10 == 1, F.concat(F.lit("KR"), F.lpad(c("p_partkey").cast("string"), 9, "0"), F.lit("7"))).otherwise(F.concat(F.lit("B"), c("p_partkey").cast("string"))).alias("PD_NO"), c("p_name").alias("PD_NM"), c("p_brand").alias("PD_PBCM"), F.when(c("p_partkey") % 2 == 0, "장내").alias("PD_EXG_MKT"), c("p_size").cast("string").alias("SRFC_IRT"), F.when(c("p_partkey") % 3 == 0, "20260711").otherwise("x").alias("PD_STD_INFO_UPDATE"), c("p_type").alias("CRD_GRD"), c("p_retailprice").cast("string").alias("BUY_YIELD"))


BOND = """b AS (SELECT p_partkey AS row_number, CASE WHEN p_partkey % 10 = 0 THEN NULL WHEN p_partkey % 10 = 1 THEN 'KR' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') || '7' ELSE 'B' || p_partkey END AS no, * FROM part),
bond AS (SELECT *, CASE WHEN no IS NULL THEN 'missing_product_number' END AS issue_code, CASE WHEN p_partkey % 10 = 1 THEN 'urn:holdfast:isin:' || no WHEN no IS NOT NULL THEN 'urn:holdfast:bond:' || no END AS uri FROM b)"""


@query(f"WITH {BOND} SELECT row_number, issue_code, uri, p_name AS name, CAST(p_size AS DOUBLE) AS rate, p_partkey % 2 = 0 AS listed, CASE WHEN p_partkey % 3 = 0 THEN DATE '2026-07-11' ELSE DATE '2026-01-01' END AS as_of, round(p_retailprice, 6) AS buy_yield FROM bond")
def bond_projection(t):
    b = transform.bonds(_bond_rows(t), F.lit("2026-01-01").cast("date"))
    return b.select("row_number", "issue_code", "uri", "name", c("couponRate").alias("rate"), "listed", "as_of", F.round(F.try_element_at("metrics", F.lit("buyYield")), 6).alias("buy_yield"))


@query(f"WITH {BOND} SELECT row_number, issue_code FROM bond WHERE issue_code IS NOT NULL")
def quarantine_rows(t):
    b = transform.bonds(_bond_rows(t), F.lit("2026-01-01").cast("date"))
    return quality.route(b, c("issue_code"))[1].select("row_number", "issue_code")


BOND_EDGES = f"""WITH {BOND}, sound AS (SELECT *, CASE WHEN p_partkey % 3 = 0 THEN '2026-07-11' ELSE '2026-01-01' END AS day FROM bond WHERE issue_code IS NULL)
SELECT DISTINCT src, rel, dst FROM (
SELECT uri AS src, 'HAS_IDENTIFIER' AS rel, 'urn:holdfast:identifier:' || CASE WHEN p_partkey % 10 = 1 THEN 'isin:' ELSE 'pd_no:' END || no AS dst FROM sound
UNION ALL SELECT uri, 'CLASSIFIED_AS', 'urn:holdfast:classification:credit-grade:' || url_encode(p_type) FROM sound
UNION ALL SELECT uri, 'ISSUED_BY', 'urn:holdfast:organization:name:' || substr(sha256(lower(p_brand)), 1, 24) FROM sound
UNION ALL SELECT uri, 'INSTANCE_OF', 'urn:holdfast:class:Bond' FROM sound
UNION ALL SELECT uri, 'HAS_OBSERVATION', 'urn:holdfast:observation:' || url_encode(uri) || ':' || day FROM sound
UNION ALL SELECT uri, 'LISTED_AS', 'urn:holdfast:listing:bonds:krx-bond:' || no FROM sound WHERE p_partkey % 2 = 0
UNION ALL SELECT 'urn:holdfast:listing:bonds:krx-bond:' || no, 'ON_MARKET', 'urn:holdfast:market:krx-bond' FROM sound WHERE p_partkey % 2 = 0
UNION ALL SELECT 'urn:holdfast:source-record:bonds:2026-01-01:' || row_number, 'DESCRIBES', uri FROM sound)"""


@query(BOND_EDGES)
def edge_table(t):
    return transform.edges(transform.bonds(_bond_rows(t), F.lit("2026-01-01").cast("date")))


def _exchange_rows(t):
    k = c("p_partkey")
    return t.part.select(k.alias("row_number"), F.when(k % 3 == 0, "etn").otherwise("ETF").alias("pd_grp_no"), F.concat(F.lit("P"), k.cast("string")).alias("pd_itm_no"), F.when(k % 4 == 0, "XK").alias("pd_exg_mkt_cd"), F.when(k % 5 == 0, "y").alias("cu_etn_yn"), c("p_brand").alias("cu_fund_mgmt_co"), c("p_retailprice").cast("string").alias("du_clpr"), c("p_size").cast("string").alias("du_last_aum"), F.when(k % 2 == 0, "2026-07-10").alias("du_upt_dt"), F.when(k % 6 == 0, "Y").when(k % 6 == 1, "N").alias("pd_sale_yn"))


def _exchange(t):
    return transform.exchange_products(_exchange_rows(t), "exchange", F.lit("2026-07-11").cast("date"), "pd_isin_cd")


EXCHANGE = """e AS (SELECT p_partkey AS k, 'P' || p_partkey AS item, p_partkey % 3 = 0 OR p_partkey % 5 = 0 AS note, CASE WHEN p_partkey % 2 = 0 THEN '2026-07-10' ELSE '2026-07-11' END AS day, p_brand,
'urn:holdfast:exchange:' || CASE WHEN p_partkey % 4 = 0 THEN 'XK' ELSE 'unknown-market' END || ':P' || p_partkey AS uri, CASE WHEN p_partkey % 4 = 0 THEN 'urn:holdfast:listing:exchange:XK:P' || p_partkey END AS listing FROM part),
x AS (SELECT *, CASE WHEN NOT note THEN uri || ':unit' END AS unit, coalesce(CASE WHEN NOT note THEN uri || ':unit' END, uri) AS held FROM e)"""
EXCHANGE_EDGES = f"""WITH {EXCHANGE} SELECT DISTINCT src, rel, dst FROM (
SELECT held AS src, 'HAS_IDENTIFIER' AS rel, 'urn:holdfast:identifier:source_item:' || item AS dst FROM x UNION ALL SELECT held, 'HAS_IDENTIFIER', 'urn:holdfast:identifier:listing_ticker:' || item FROM x
UNION ALL SELECT held, 'CLASSIFIED_AS', 'urn:holdfast:classification:product-group:' || CASE WHEN k % 3 = 0 THEN 'etn' ELSE 'ETF' END FROM x
UNION ALL SELECT uri, 'INSTANCE_OF', 'urn:holdfast:class:' || CASE WHEN note THEN 'ETN' ELSE 'ETF' END FROM x
UNION ALL SELECT unit, 'INSTANCE_OF', 'urn:holdfast:class:' || unnest(['TradableFundUnit', 'ListedSecurity']) FROM x
UNION ALL SELECT uri, CASE WHEN note THEN 'ISSUED_BY' ELSE 'MANAGED_BY' END, 'urn:holdfast:organization:name:' || substr(sha256(lower(p_brand)), 1, 24) FROM x
UNION ALL SELECT uri, 'HAS_UNIT', unit FROM x UNION ALL SELECT held, 'LISTED_AS', listing FROM x
UNION ALL SELECT listing, 'ON_MARKET', 'urn:holdfast:market:exchange:XK' FROM x UNION ALL SELECT listing, 'HAS_OBSERVATION', 'urn:holdfast:observation:' || url_encode(listing) || ':' || day FROM x
UNION ALL SELECT held, 'HAS_OBSERVATION', 'urn:holdfast:observation:' || url_encode(uri) || ':' || day FROM x
UNION ALL SELECT CASE WHEN k % 6 < 2 THEN 'urn:holdfast:offering:exchange:' || item END, 'OFFERS', held FROM x
UNION ALL SELECT 'urn:holdfast:source-record:exchange:2026-07-11:' || k, 'DESCRIBES', d FROM (SELECT k, unnest([uri, unit]) AS d FROM x)) WHERE src IS NOT NULL AND dst IS NOT NULL"""


@query(EXCHANGE_EDGES)
def fund_edges(t):
    return transform.edges(_exchange(t))


@query(f"WITH {EXCHANGE} SELECT k AS row_number, CASE WHEN note THEN 'note' ELSE 'fund' END AS kind, uri, unit AS unit_uri, listing AS listing_uri FROM x")
def kind_split(t):
    return _exchange(t).select("row_number", "kind", "uri", "unit_uri", "listing_uri")


def _public_rows(t):
    k = c("p_partkey")
    name = F.when(k % 6 == 0, "가나 상장지수").when(k % 5 == 0, c("p_name"))
    short = F.when(k % 7 == 0, F.concat("p_name", F.lit(" etf"))).otherwise(c("p_name"))
    item = F.when(k % 4 == 0, F.concat(F.lit("ABC"), k.cast("string"))).otherwise(F.concat(F.lit("KR"), F.lpad(k.cast("string"), 10, "0")))
    return t.part.select(k.alias("row_number"), item.alias("itm_no"), name.alias("itm_nm"), short.alias("itm_abrv_nm"), F.concat(F.lit("00"), (k % 9).cast("string")).alias("or_co_xtn_itt_cd"), c("p_brand").alias("bmrk_nm"), c("p_type").alias("prfd_attr_cd"), F.concat(F.lit("M"), k.cast("string")).alias("own_no"), F.when(k % 3 == 0, "0").otherwise(F.concat(F.lit("S"), k.cast("string"))).alias("std_itm_no"), c("p_retailprice").cast("string").alias("fd_nast_suma"), F.when(k % 2 == 0, "판매중").alias("sale_yn"))


def _public(t):
    return transform.public_funds(_public_rows(t), F.lit("2026-07-11").cast("date"), firm_item="own_no")


PUBLIC = """p AS (SELECT p_partkey AS k, 'KR' || lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS item, p_partkey % 6 = 0 OR p_partkey % 7 = 0 AS etf, * FROM part WHERE p_partkey % 4 <> 0),
f AS (SELECT *, 'urn:holdfast:public-fund:' || item AS uri, 'urn:holdfast:public-fund:' || item || ':unit' AS unit, CASE WHEN etf THEN 'urn:holdfast:listing:public-funds:krx-unspecified:' || item END AS listing FROM p)"""
PUBLIC_EDGES = f"""WITH {PUBLIC} SELECT DISTINCT src, rel, dst FROM (
SELECT unit AS src, 'HAS_IDENTIFIER' AS rel, 'urn:holdfast:identifier:source_item:' || item AS dst FROM f UNION ALL SELECT unit, 'HAS_IDENTIFIER', 'urn:holdfast:identifier:firm_item:M' || k FROM f
UNION ALL SELECT unit, 'HAS_IDENTIFIER', 'urn:holdfast:identifier:std_item:S' || k FROM f WHERE k % 3 <> 0
UNION ALL SELECT unit, 'CLASSIFIED_AS', 'urn:holdfast:classification:product-attribute:' || url_encode(p_type) FROM f
UNION ALL SELECT uri, 'INSTANCE_OF', 'urn:holdfast:class:' || unnest(CASE WHEN etf THEN ['ETF', 'PublicFund'] ELSE ['MutualFund', 'PublicFund'] END) FROM f
UNION ALL SELECT unit, 'INSTANCE_OF', 'urn:holdfast:class:' || unnest(CASE WHEN etf THEN ['TradableFundUnit', 'ListedSecurity', 'PublicFundUnit'] ELSE ['NonTradableFundUnit', 'PublicFundUnit'] END) FROM f
UNION ALL SELECT uri, 'MANAGED_BY', 'urn:holdfast:organization:source-code:' || substr(sha256('00' || k % 9), 1, 24) FROM f WHERE k % 9 <> 0
UNION ALL SELECT uri, 'TRACKS', 'urn:holdfast:benchmark:' || substr(sha256(lower(p_brand)), 1, 24) FROM f
UNION ALL SELECT uri, 'HAS_UNIT', unit FROM f UNION ALL SELECT unit, 'LISTED_AS', listing FROM f UNION ALL SELECT listing, 'ON_MARKET', 'urn:holdfast:market:krx-unspecified' FROM f
UNION ALL SELECT listing, 'HAS_OBSERVATION', 'urn:holdfast:observation:' || url_encode(listing) || ':2026-07-11' FROM f UNION ALL SELECT unit, 'HAS_OBSERVATION', 'urn:holdfast:observation:' || url_encode(uri) || ':2026-07-11' FROM f
UNION ALL SELECT 'urn:holdfast:offering:public-funds:' || item, 'OFFERS', unit FROM f
UNION ALL SELECT 'urn:holdfast:source-record:public-funds:2026-07-11:' || k, 'DESCRIBES', unnest([uri, unit]) FROM f) WHERE src IS NOT NULL AND dst IS NOT NULL"""


@query(PUBLIC_EDGES)
def public_fund_edges(t):
    return transform.edges(_public(t))


@query("""SELECT p_partkey AS row_number, CASE WHEN p_partkey % 4 = 0 THEN 'malformed_item_number' END AS issue_code, CASE WHEN p_partkey % 6 = 0 THEN '가나 상장지수' WHEN p_partkey % 5 = 0 THEN p_name WHEN p_partkey % 4 = 0 THEN 'ABC' || p_partkey ELSE 'KR' || lpad(CAST(p_partkey AS VARCHAR), 10, '0') END AS name,
CASE WHEN p_partkey % 6 = 0 OR p_partkey % 7 = 0 THEN 'KRX_UNSPECIFIED' END AS market_code, CASE WHEN p_partkey % 2 = 0 THEN true END AS for_sale, CASE WHEN p_partkey % 2 = 0 THEN '판매중' END AS sale_status, round(p_retailprice, 6) AS net_assets FROM part""")
def public_fund_projection(t):
    f = _public(t)
    return f.select("row_number", "issue_code", "name", "market_code", c("availableForSale").alias("for_sale"), c("saleStatus").alias("sale_status"), F.round(F.try_element_at("metrics", F.lit("netAssetTotal")), 6).alias("net_assets"))


@query(f"""WITH {BOND}, {EXCHANGE}, {PUBLIC} SELECT 3 * (SELECT count(*) FROM part) AS n_records, (SELECT count(*) FROM bond WHERE issue_code IS NOT NULL) + (SELECT count(*) FROM part WHERE p_partkey % 4 = 0) AS n_rejected, (SELECT count(DISTINCT uri) FROM bond WHERE issue_code IS NULL) AS n_bonds,
(SELECT count(DISTINCT uri) FROM x WHERE NOT note) + (SELECT count(*) FROM f) AS n_funds, (SELECT count(DISTINCT uri) FROM x WHERE note) AS n_notes, (SELECT count(DISTINCT unit) FROM x) + (SELECT count(*) FROM f) AS n_units,
(SELECT count(DISTINCT listing) FROM x) + (SELECT count(listing) FROM f) + (SELECT count(DISTINCT no) FROM bond WHERE issue_code IS NULL AND p_partkey % 2 = 0) AS n_listings,
(SELECT count(DISTINCT uri) FROM bond WHERE issue_code IS NULL) + (SELECT count(DISTINCT uri) + count(DISTINCT listing) FROM x) + (SELECT count(*) + count(listing) FROM f) AS n_observations, 0 AS n_unlinked, 0 AS n_duplicate_uris""")
def validation_report(t):
    """The ten totals of a load, over a bond, an exchange-product and a public-fund feed made from all products."""
    feeds = [transform.bonds(_bond_rows(t), F.lit("2026-01-01").cast("date")), _exchange(t), _public(t)]
    every = feeds[0].unionByName(feeds[1], allowMissingColumns=True).unionByName(feeds[2], allowMissingColumns=True)
    records = every.select(c("source_uri").alias("uri"))
    edges = [transform.edges(f) for f in feeds]
    out = quality.validation_totals(records, every, edges[0].unionByName(edges[1]).unionByName(edges[2]))
    return out.select(*[c(x).cast("long").alias(x) for x in out.columns])


@query("""SELECT 'urn:holdfast:source-record:public-funds:2026-07-11:' || p_partkey || ':issue:malformed-item-number' AS uri, 'malformed_item_number' AS code, 'public-funds' AS dataset, p_partkey AS row_number FROM part WHERE p_partkey % 4 = 0
UNION ALL SELECT 'urn:holdfast:source-record:bonds:2026-01-01:' || p_partkey || ':issue:missing-product-number', 'missing_product_number', 'bonds', p_partkey FROM part WHERE p_partkey % 10 = 0""")
def issue_entities(t):
    found = lineage.issues(_public(t), "public-funds").unionByName(lineage.issues(transform.bonds(_bond_rows(t), F.lit("2026-01-01").cast("date")), "bonds"))
    return found.select("uri", "code", "dataset", "row_number")


@query("""SELECT DISTINCT src, rel, dst FROM (SELECT 'urn:holdfast:source-record:public-funds:2026-07-11:' || p_partkey AS src, 'IN_FILE' AS rel, 'urn:holdfast:file:public-funds:2026-07-11' AS dst FROM part
UNION ALL SELECT 'urn:holdfast:file:public-funds:2026-07-11', 'EXTRACT_OF', 'urn:holdfast:dataset:public-funds' FROM part UNION ALL SELECT 'urn:holdfast:dataset:public-funds', 'HAS_FIELD', 'urn:holdfast:field:public-funds:' || replace(p_name, ' ', '%20') FROM part
UNION ALL SELECT 'urn:holdfast:source-record:public-funds:2026-07-11:' || p_partkey, 'HAS_ISSUE', 'urn:holdfast:source-record:public-funds:2026-07-11:' || p_partkey || ':issue:malformed-item-number' FROM part WHERE p_partkey % 4 = 0)""")
def lineage_edges(t):
    records = transform.source_records(_public_rows(t), "public-funds", F.lit("2026-07-11").cast("date"))
    fields = t.part.select(F.lit("public-funds").alias("dataset"), c("p_name").alias("field"))
    return lineage.edges(records, fields, lineage.issues(_public(t), "public-funds"))


CLASS_PAIRS = ", ".join(f"('{a}', '{b}')" for a, b in ontology.SUBCLASSES if b)


@query(f"""WITH RECURSIVE pairs(child, parent) AS (VALUES {CLASS_PAIRS}), up(node, class) AS (SELECT child, child FROM pairs UNION SELECT parent, parent FROM pairs UNION SELECT up.node, parent FROM up JOIN pairs ON child = class),
{BOND}, {EXCHANGE}, {PUBLIC}, own(entity, node) AS (SELECT uri, 'Bond' FROM bond WHERE issue_code IS NULL UNION SELECT uri, CASE WHEN note THEN 'ETN' ELSE 'ETF' END FROM x UNION SELECT unit, unnest(['TradableFundUnit', 'ListedSecurity']) FROM x WHERE unit IS NOT NULL
UNION SELECT uri, unnest(CASE WHEN etf THEN ['ETF', 'PublicFund'] ELSE ['MutualFund', 'PublicFund'] END) FROM f UNION SELECT unit, unnest(CASE WHEN etf THEN ['TradableFundUnit', 'ListedSecurity', 'PublicFundUnit'] ELSE ['NonTradableFundUnit', 'PublicFundUnit'] END) FROM f)
SELECT class, count(DISTINCT entity) AS n FROM own JOIN up USING (node) GROUP BY class""")
def instances_by_class(t):
    """How many entities of the three feeds each class of the class table has, those of narrower classes included."""
    feeds = [transform.bonds(_bond_rows(t), F.lit("2026-01-01").cast("date")), _exchange(t), _public(t)]
    every = feeds[0].unionByName(feeds[1], allowMissingColumns=True).unionByName(feeds[2], allowMissingColumns=True)
    of = transform.edges(every).where("rel = 'INSTANCE_OF'").select("src", F.substring_index("dst", ":", -1).alias("node"))
    closed = graph.closure(ontology.subclass_of(t.spark)).select("node", c("ancestor").alias("class")).distinct()
    closed = closed.unionByName(ontology.classes(t.spark).select(c("class").alias("node"), "class"))
    return of.join(F.broadcast(closed), "node").select("src", "class").distinct().groupBy("class").agg(F.count("*").alias("n"))


@query("SELECT p_partkey AS row_number, 'P' || p_partkey AS ticker, CASE WHEN p_partkey % 2 = 0 THEN DATE '2026-07-10' ELSE DATE '2026-07-11' END AS as_of, round(p_retailprice, 6) AS close FROM part WHERE p_partkey % 4 = 0")
def market_observation(t):
    e = _exchange(t).where("listing_uri is not null")
    return e.select("row_number", "ticker", c("market_as_of").alias("as_of"), F.round(F.try_element_at("market_metrics", F.lit("closePrice")), 6).alias("close"))


@query("SELECT p_partkey AS row_number, CASE WHEN p_partkey % 2 = 0 THEN DATE '2026-07-10' ELSE DATE '2026-07-11' END AS as_of, CAST(p_size AS DOUBLE) AS aum FROM part")
def fund_observation(t):
    e = _exchange(t)
    return e.select("row_number", "as_of", F.try_element_at("metrics", F.lit("assetsUnderManagement")).alias("aum"))


@query("SELECT p_partkey AS row_number, CASE WHEN p_partkey % 4 = 0 THEN 'malformed_item_number' END AS issue_code, CASE WHEN p_partkey % 3 = 0 THEN 'ETF,PublicFund' ELSE 'MutualFund,PublicFund' END AS classes FROM part")
def name_heuristic_class(t):
    k = c("p_partkey")
    rows = t.part.select(k.alias("row_number"), F.when(k % 4 == 0, '"').otherwise(F.concat(F.lit("KR"), F.lpad(k.cast("string"), 10, "0"))).alias("itm_no"), F.when(k % 6 == 0, "가나 상장지수").when(k % 3 == 0, F.concat("p_name", F.lit(" etf"))).otherwise(F.lit("fund")).alias("itm_nm"))
    return transform.public_funds(rows, F.lit("2026-07-11").cast("date")).select("row_number", "issue_code", F.array_join("classes", ",").alias("classes"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, metric, round(value, 6) AS value FROM (UNPIVOT (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, CASE WHEN l_returnflag <> 'N' THEN l_tax END AS l_tax FROM lineitem) ON l_quantity, l_tax INTO NAME metric VALUE value)")
def unpivot_metrics(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", F.when(c("l_returnflag") != "N", c("l_tax")).alias("l_tax"))
    return transform.unpivot(rows, ["l_orderkey", "l_linenumber", "l_partkey"], ["l_quantity", "l_tax"]).withColumn("value", F.round("value", 6))


@query("SELECT 'urn:holdfast:class:' || CASE WHEN p_size > 25 THEN 'ETF' ELSE 'MutualFund' END AS class_uri, count(*) AS n FROM part GROUP BY 1")
def entity_classes(t):
    ref = t.part.select(S.uri("class", F.when(c("p_size") > 25, "ETF").otherwise("MutualFund")).alias("class_uri"), F.when(c("p_size") > 25, "ETF").otherwise("MutualFund").alias("class"))
    return ref.join(F.broadcast(ontology.classes(t.spark)), "class", "left_semi").groupBy("class_uri").agg(F.count("*").alias("n"))


# folds ------------------------------------------------------------------------------------------------------------


@query(f"SELECT user_id, round(arg_max(v, event_id) FILTER (v IS NOT NULL), 6) AS v FROM (SELECT user_id, event_id, {V0} AS v FROM events) GROUP BY user_id")
def fold_last_non_null(t):
    return fold.fold(t.events.withColumn("v", _value0()), ["user_id"], c("event_id"), {"v": "last_value"}).withColumn("v", F.round("v", 6))


@query(f"SELECT user_id, round(v, 6) AS v FROM (SELECT user_id, {V0} AS v, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS k FROM events) WHERE k = 1")
def fold_last_wins(t):
    return fold.fold(t.events.withColumn("v", _value0()), ["user_id"], c("event_id"), {"v": "last_row"}).withColumn("v", F.round("v", 6))


@query(f"SELECT user_id, round(arg_min(v, event_id) FILTER (v IS NOT NULL), 6) AS v FROM (SELECT user_id, event_id, {V0} AS v FROM events) GROUP BY user_id")
def fold_first_wins(t):
    return fold.fold(t.events.withColumn("v", _value0()), ["user_id"], c("event_id"), {"v": "first_value"}).withColumn("v", F.round("v", 6))


@query(f"WITH e AS (SELECT user_id, event_type, {V0} AS v, row_number() OVER (PARTITION BY user_id ORDER BY floor((event_id - 2) / 500), event_type, event_id) AS k, count(*) OVER (PARTITION BY user_id) AS n FROM events) SELECT user_id, max(event_type) FILTER (k = n) AS kind, round(arg_max(v, k) FILTER (v IS NOT NULL), 6) AS v FROM e GROUP BY user_id")
def fold_entities(t):
    order = fold.load_order(F.lit(0), c("event_id"), c("event_type"), F.lit(0))
    return fold.fold(t.events.select("user_id", c("event_type").alias("kind"), "event_id", "event_type", _value0().alias("v")), ["user_id"], order, {"kind": "last_row", "v": "last_value"}).withColumn("v", F.round("v", 6))


# identity ---------------------------------------------------------------------------------------------------------


def _isin(k):
    return F.concat(F.lit("US"), F.lpad(k.cast("string"), 9, "0"), F.lit("1"))


def _crosswalk(t):
    k = c("p_partkey")
    return t.part.select(F.lit("krx_code").alias("local_key_type"), F.concat(F.lit("a"), k.cast("string")).alias("local_key"), c("p_name").alias("local_name"), F.lit("ISIN").alias("standard_id_type"), _isin(k).alias("standard_id"), F.when(k % 2 == 0, "reviewer").alias("reviewed_by"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey,
CASE WHEN l_linenumber = 1 THEN 'US' || lpad(CAST(l_partkey AS VARCHAR), 9, '0') || '9' WHEN l_linenumber = 2 THEN NULL WHEN l_partkey % 2 = 0 THEN 'US' || lpad(CAST(l_partkey AS VARCHAR), 9, '0') || '1' END AS isin,
CASE WHEN l_linenumber = 1 THEN 'source_isin' WHEN l_linenumber = 2 THEN 'unresolved' WHEN l_partkey % 2 = 0 THEN 'crosswalk' ELSE 'unresolved' END AS method,
CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber = 2 THEN 'malformed source ISIN' WHEN l_partkey % 2 = 0 THEN NULL ELSE 'no reviewed ISIN crosswalk entry' END AS reason FROM lineitem""")
def resolve_identity(t):
    k = c("l_partkey")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.when(c("l_linenumber") == 1, F.concat(F.lit(" us"), F.lpad(k.cast("string"), 9, "0"), F.lit("9"))).when(c("l_linenumber") == 2, "bad").when(c("l_linenumber") == 3, "N/A").alias("isin"), F.lit("KRX_CODE").alias("kind"), F.concat(F.lit("A"), k.cast("string")).alias("key"))
    out = identity.resolve(rows, identity.index(_crosswalk(t)), "isin", "kind", "key")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", c("constituent_isin").alias("isin"), c("identifier_method").alias("method"), c("unresolved_reason").alias("reason"))


@query("SELECT 'urn:holdfast:crosswalk:security:krx_code:a' || p_partkey AS uri, p_name AS standard_name, CASE WHEN p_partkey % 2 = 0 THEN 'reviewer' END AS reviewed_by, 'urn:holdfast:run:second' AS run FROM part")
def crosswalk_upsert(t):
    """Each entry comes twice; the second one's fields hold, blank ones as null."""
    own = _crosswalk(t).select(F.lit("security").alias("entity_kind"), "*")
    first = own.withColumns({"standard_name": F.lit("old"), "run": F.lit("first"), "place": F.lit(1)})
    second = own.withColumns({"standard_name": c("local_name"), "reviewed_by": F.coalesce("reviewed_by", F.lit(" ")), "run": F.lit("second"), "place": F.lit(2)})
    entries, edges = identity.upsert_crosswalk(first.unionByName(second), c("place"), c("run"))
    return entries.join(edges.select(c("dst").alias("uri"), c("src").alias("run_uri")), "uri").select("uri", "standard_name", "reviewed_by", c("run_uri").alias("run"))


@query("SELECT lower(p_name) AS name, count(DISTINCT p_partkey) AS n_ids FROM part GROUP BY 1 HAVING count(DISTINCT p_partkey) > 1")
def crosswalk_conflicts(t):
    return identity.conflicts(t.part.withColumn("name", F.lower("p_name")), ["name"], "p_partkey")


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN upper(p_name) ELSE p_name END AS k FROM part")
def crosswalk_keys(t):
    return t.part.select("p_partkey", identity.mapping_key(F.when(c("p_partkey") % 2 == 0, "ISIN").otherwise("name"), c("p_name")).alias("k"))


@query("SELECT p_brand, count(*) AS n_rows, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS members FROM part GROUP BY p_brand")
def group_by_standard_id(t):
    return identity.by_standard_id(t.part, "p_brand", "p_type").withColumn("members", F.array_join("members", ","))


@query("SELECT name, id_a, id AS id_b FROM (SELECT name, id, min(id) OVER (PARTITION BY name) AS id_a FROM (SELECT DISTINCT lower(p_name) AS name, p_partkey AS id FROM part WHERE p_name IS NOT NULL AND p_partkey IS NOT NULL)) WHERE id_a < id")
def name_only_merge(t):
    return identity.name_only_merges(t.part, "p_name", "p_partkey")


@query("SELECT name, id, n_ids FROM (SELECT name, id, count(*) OVER (PARTITION BY name) AS n_ids FROM (SELECT DISTINCT lower(p_name) AS name, p_partkey AS id FROM part WHERE p_name IS NOT NULL AND p_partkey IS NOT NULL)) WHERE n_ids > 1")
def name_only_groups(t):
    """All ids under one name, over all brands and sizes: membership, which holds every pair and grows with the table."""
    return identity.name_groups(t.part, "p_name", "p_partkey")


# joins ------------------------------------------------------------------------------------------------------------


@query("SELECT l_orderkey, l_linenumber, l_partkey, o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def describes_join(t):
    return graph.attached(t.lineitem, t.orders, "l_orderkey", "o_orderkey").select("l_orderkey", "l_linenumber", "l_partkey", "o_custkey")


@query("SELECT o_orderkey, c_name, n_name, r_name FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def etf_full_path(t):
    j = graph.path_join(t.orders, (t.customer, "o_custkey", "c_custkey", True), (t.nation, "c_nationkey", "n_nationkey", False), (t.region, "n_regionkey", "r_regionkey", False))
    return j.select("o_orderkey", "c_name", "n_name", "r_name")


@query("SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) AND o_orderstatus <> 'P'")
def unlinked_records(t):
    return quality.unlinked(t.orders.where("o_orderstatus <> 'P'"), t.lineitem, "o_orderkey", "l_orderkey").select("o_orderkey")


@query("WITH l AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_quantity > 45) SELECT o_orderpriority AS dataset, count(*) AS n_records, count(l_orderkey) AS n_linked, count(*) FILTER (o_orderstatus = 'P') AS n_rejected, count(*) FILTER (l_orderkey IS NULL AND o_orderstatus <> 'P') AS n_unlinked FROM orders LEFT JOIN l ON l_orderkey = o_orderkey GROUP BY 1")
def dataset_link_report(t):
    linked = t.lineitem.where("l_quantity > 45").select(c("l_orderkey").alias("o_orderkey"))
    return quality.link_report(t.orders, linked, t.orders.where("o_orderstatus = 'P'"), "o_orderkey", "o_orderpriority")


@query("SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderpriority = '1-URGENT'")
def optional_projection(t):
    return Q.related(t.customer, t.orders.where("o_orderpriority = '1-URGENT'"), "c_custkey", "o_custkey", required=False).select("c_custkey", "o_orderkey")


def _asof(t, events, *more):
    last = observe.at_or_before(t.orders.withColumn("day", c("o_orderdate").cast("date")), "o_custkey", "o_orderdate", "o_orderkey", F.lit("1998-01-01").cast("timestamp_ntz"))
    return events.select("event_id", "user_id").distinct().join(last, c("user_id") == c("o_custkey")).select("event_id", "o_orderkey", *more)


def _holders(t, lines):
    held = lines.join(t.orders, c("l_orderkey") == c("o_orderkey"))
    return held.groupBy(c("l_partkey").alias("security"), c("o_custkey").alias("fund"), c("o_orderdate").cast("date").alias("as_of")).agg(F.round(F.sum("l_extendedprice"), 4).alias("exposure"))


@query("SELECT e.event_id, o.o_orderkey, o.day FROM (SELECT DISTINCT event_id, user_id FROM events) e JOIN (SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS day, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS k FROM orders WHERE o_orderdate <= TIMESTAMP '1998-01-01') o ON e.user_id = o.o_custkey AND k = 1")
def asof_holdings_aum(t):
    """With the day of the snapshot that is matched."""
    return _asof(t, t.events, "day")


@query("SELECT e.event_id, o.o_orderkey FROM (SELECT DISTINCT event_id, user_id FROM events) e JOIN (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS k FROM orders WHERE o_orderdate <= TIMESTAMP '1998-01-01') o ON e.user_id = o.o_custkey AND k = 1")
def asof_holdings_aum_all(t):
    return _asof(t, t.events)


@query("SELECT e.event_id, e.user_id, p.event_id AS last_purchase, p.value AS last_value FROM events e LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id) AS k FROM events WHERE event_type = 'purchase') p ON p.user_id = e.user_id AND p.k = 1 AND p.ts = (SELECT max(x.ts) FROM events x WHERE x.event_type = 'purchase' AND x.user_id = e.user_id AND x.ts <= e.ts)")
def asof_own_time(t):
    """Each event with its user's latest purchase at or before it."""
    out = observe.as_of(t.events.select("event_id", "user_id", "ts"), t.events.where("event_type = 'purchase'"), ("user_id", "user_id"), ("ts", "ts"), "event_id", {"event_id": "last_purchase", "value": "last_value"}, "week")
    return out.drop("ts")


@query("""WITH o AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, min(o_orderkey) AS k FROM orders GROUP BY ALL),
l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_custkey, CAST(l_shipdate AS DATE) AS day FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, o.k AS last_order FROM l ASOF LEFT JOIN o ON l.o_custkey = o.o_custkey AND l.day >= o.day""")
def asof_own_day(t):
    """Each shipped line with its customer's latest order on or before that day; of one day's orders the least key."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", c("l_shipdate").cast("date").alias("day")).join(t.orders.select(c("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    out = observe.as_of(lines, t.orders.withColumn("o_day", c("o_orderdate").cast("date")), ("o_custkey", "o_custkey"), ("day", "o_day"), "o_orderkey", {"o_orderkey": "last_order"}, "quarter")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "last_order")


LEVELS = """h AS (SELECT 'c' || o_custkey AS fund, 'o' || o_orderkey AS security, o_totalprice / sum(o_totalprice) OVER (PARTITION BY o_custkey) AS weight FROM orders
UNION ALL SELECT 'o' || l_orderkey, 'p' || l_partkey, sum(l_extendedprice) / sum(sum(l_extendedprice)) OVER (PARTITION BY l_orderkey) FROM lineitem GROUP BY l_orderkey, l_partkey
UNION ALL SELECT 'p' || l_partkey, 'n' || s_nationkey, sum(l_quantity) / sum(sum(l_quantity)) OVER (PARTITION BY l_partkey) FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_partkey, s_nationkey
UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, 1.0 FROM nation)"""


@query(f"""WITH RECURSIVE {LEVELS},
w AS (SELECT 'c' || c_custkey AS root, 'c' || c_custkey AS node, 0 AS depth, 1.0::DOUBLE AS weight FROM customer
UNION ALL (SELECT w.root, h.security, w.depth + 1, sum(w.weight * h.weight) FROM w JOIN h ON h.fund = w.node WHERE w.depth < 4 GROUP BY w.root, h.security, w.depth))
SELECT root, node AS security, min(depth) AS depth, round(sum(weight), 6) AS weight, node IN (SELECT fund FROM h) AS is_fund FROM w WHERE depth > 0 GROUP BY root, node""")
def look_through(t):
    """Customers through their orders, the parts in them and the nations that supply those, to regions: shares multiplied and added up."""
    # a key and its kind are one number until the end
    kinds = "copnr"
    code = lambda p, k: F.shiftleft(c(k).cast("long"), 3).bitwiseOR(F.lit(kinds.index(p)))
    name = lambda k: F.concat(F.substring(F.lit(kinds), (c(k).bitwiseAND(F.lit(7)) + 1).cast("int"), F.lit(1)), F.shiftright(k, 3).cast("string")).alias(k)
    held = lambda rows, fund, security, value: rows.select(fund.alias("fund"), security.alias("security"), value.cast("double").alias("value"))
    supplied = t.lineitem.join(t.supplier, c("l_suppkey") == c("s_suppkey"))
    rows = held(t.orders, code("c", "o_custkey"), code("o", "o_orderkey"), c("o_totalprice")).unionByName(held(t.lineitem, code("o", "l_orderkey"), code("p", "l_partkey"), c("l_extendedprice")))
    rows = rows.unionByName(held(supplied, code("p", "l_partkey"), code("n", "s_nationkey"), c("l_quantity"))).unionByName(held(t.nation, code("n", "n_nationkey"), code("r", "n_regionkey"), F.lit(1.0)))
    out = holdings.look_through(t.customer.select(code("c", "c_custkey").alias("root")), rows, 4, value="value")
    return out.select(name("root"), name("security"), "depth", F.round("weight", 6).alias("weight"), "is_fund")


@query("SELECT 'urn:holdfast:isin:US' || l_partkey AS security_uri, 'urn:holdfast:isin:KR' || o_custkey AS fund_uri, CAST(o_orderdate AS DATE) AS as_of, round(sum(l_extendedprice), 4) AS market_value FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL")
def holders_of_security(t):
    """Through snapshots and positions: each security's holders on each day."""
    snapshot = lambda k: S.uri("snapshot", c(k).cast("string"))
    isin = lambda country, k: F.concat(F.lit(f"{S.URN}:isin:{country}"), c(k).cast("string"))
    snapshots = t.orders.select(snapshot("o_orderkey").alias("uri"), isin("KR", "o_custkey").alias("fund_uri"), c("o_orderdate").cast("date").alias("as_of"))
    positions = t.lineitem.select(snapshot("l_orderkey").alias("snapshot_uri"), isin("US", "l_partkey").alias("security_uri"), c("l_discount").alias("weight"), c("l_extendedprice").alias("source_market_value"))
    return holdings.exposures(positions, snapshots).select("security_uri", "fund_uri", "as_of", F.round("market_value", 4).alias("market_value"))


@query("SELECT l_partkey AS security, o_custkey AS fund, CAST(o_orderdate AS DATE) AS as_of, round(sum(l_extendedprice), 4) AS exposure FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL")
def holders_of_security_all(t):
    return _holders(t, t.lineitem)


@query("""WITH h AS (SELECT DISTINCT o_custkey AS fund, o_orderpriority AS item, year(o_orderdate) AS snap FROM orders),
s AS (SELECT *, lag(snap) OVER (PARTITION BY fund ORDER BY snap) AS pv, lead(snap) OVER (PARTITION BY fund ORDER BY snap) AS nx FROM (SELECT DISTINCT fund, snap FROM h))
SELECT h.fund, h.item, h.snap, 'entry' AS change FROM h JOIN s USING (fund, snap) WHERE pv IS NOT NULL AND NOT EXISTS (SELECT 1 FROM h x WHERE x.fund = h.fund AND x.item = h.item AND x.snap = s.pv)
UNION ALL SELECT h.fund, h.item, s.nx, 'exit' FROM h JOIN s USING (fund, snap) WHERE nx IS NOT NULL AND NOT EXISTS (SELECT 1 FROM h x WHERE x.fund = h.fund AND x.item = h.item AND x.snap = s.nx)""")
def holding_changes(t):
    pos = t.orders.select(c("o_custkey").alias("fund"), c("o_orderpriority").alias("item"), F.year("o_orderdate").cast("long").alias("snap"))
    return observe.changes(pos, "fund", "item", "snap")


# graph ------------------------------------------------------------------------------------------------------------


def _tree(t):
    nation = t.nation.select(F.concat(F.lit("n"), "n_nationkey").alias("child"), F.concat(F.lit("r"), "n_regionkey").alias("parent"))
    return nation.unionByName(t.region.select(F.concat(F.lit("r"), "r_regionkey").alias("child"), F.lit("root").alias("parent")))


@query("SELECT 'n' || n_nationkey AS node, 'r' || n_regionkey AS ancestor, 1 AS depth FROM nation UNION ALL SELECT 'n' || n_nationkey, 'root', 2 FROM nation UNION ALL SELECT 'r' || r_regionkey, 'root', 1 FROM region")
def ontology_closure(t):
    return graph.closure(_tree(t)).select("node", "ancestor", "depth")


@query("SELECT 'r' || n_regionkey AS class, count(*) AS n FROM nation GROUP BY 1")
def ontology_tables(t):
    return _tree(t).where("parent <> 'root'").groupBy(c("parent").alias("class")).agg(F.count("*").alias("n"))


@query("SELECT CAST(c_custkey AS VARCHAR) AS src FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 1")
def instances_of_class(t):
    of = t.customer.select(c("c_custkey").cast("string").alias("src"), F.concat(F.lit("n"), "c_nationkey").alias("dst"))
    return graph.instances(of, graph.closure(_tree(t)), "r1")


def _edges(t):
    orders = t.orders.select(F.concat(F.lit("c"), "o_custkey").alias("src"), F.lit("HAS_ORDER").alias("rel"), F.concat(F.lit("o"), "o_orderkey").alias("dst"))
    parts = t.lineitem.select(F.concat(F.lit("o"), "l_orderkey").alias("src"), F.lit("HAS_PART").alias("rel"), F.concat(F.lit("p"), "l_partkey").alias("dst"))
    return orders.unionByName(parts).distinct()


PATHS = "p AS (SELECT DISTINCT 'c' || c_custkey AS root, 'o' || o_orderkey AS o, 'p' || l_partkey AS pt FROM customer JOIN orders ON c_custkey = o_custkey LEFT JOIN lineitem ON l_orderkey = o_orderkey WHERE c_custkey % 100 = 0)"


@query(f"WITH {PATHS} SELECT root, o AS node, 1 AS depth, root || '>' || o AS path FROM (SELECT DISTINCT root, o FROM p) UNION ALL SELECT root, pt, 2, root || '>' || o || '>' || pt FROM p WHERE pt IS NOT NULL")
def neighbors_paths(t):
    roots = t.customer.where("c_custkey % 100 = 0").select(F.concat(F.lit("c"), "c_custkey").alias("root"))
    return graph.paths(roots, _edges(t), ["HAS_ORDER", "HAS_PART"], 2).withColumn("path", F.array_join("path", ">"))


@query(f"WITH {PATHS} SELECT root, o AS node, 1 AS depth FROM (SELECT DISTINCT root, o FROM p) UNION ALL SELECT DISTINCT root, pt, 2 FROM p WHERE pt IS NOT NULL")
def neighbors_nodes(t):
    roots = t.customer.where("c_custkey % 100 = 0").select(F.concat(F.lit("c"), "c_custkey").alias("root"))
    return graph.neighbours(roots, _edges(t), ["HAS_ORDER", "HAS_PART"], 2)


@query("""WITH n AS (SELECT n_nationkey, n_regionkey FROM nation), s AS (SELECT DISTINCT l_orderkey, s_nationkey FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)
SELECT root, node, min(depth) AS depth FROM (
SELECT 'c' || o_custkey AS root, 'o' || o_orderkey AS node, 1 AS depth FROM orders
UNION ALL SELECT 'c' || o_custkey, 's' || l_suppkey, 2 FROM orders JOIN lineitem ON l_orderkey = o_orderkey
UNION ALL SELECT 'c' || o_custkey, 'n' || s_nationkey, 3 FROM orders JOIN s ON l_orderkey = o_orderkey
UNION ALL SELECT 'c' || o_custkey, 'r' || n_regionkey, 4 FROM orders JOIN s ON l_orderkey = o_orderkey JOIN n ON n_nationkey = s_nationkey
UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, 1 FROM customer UNION ALL SELECT 'c' || c_custkey, 'r' || n_regionkey, 2 FROM customer JOIN n ON n_nationkey = c_nationkey) GROUP BY root, node""")
def neighbors_depth(t):
    """From every customer four steps far, through nations and regions that nearly all of them reach."""
    name = lambda p, k: F.concat(F.lit(p), c(k).cast("string"))
    edge = lambda df, a, b: df.select(a.alias("src"), F.lit("TO").alias("rel"), b.alias("dst"))
    edges = edge(t.orders, name("c", "o_custkey"), name("o", "o_orderkey")).unionByName(edge(t.lineitem, name("o", "l_orderkey"), name("s", "l_suppkey")))
    edges = edges.unionByName(edge(t.supplier, name("s", "s_suppkey"), name("n", "s_nationkey"))).unionByName(edge(t.nation, name("n", "n_nationkey"), name("r", "n_regionkey"))).unionByName(edge(t.customer, name("c", "c_custkey"), name("n", "c_nationkey")))
    return graph.neighbours(t.customer.select(name("c", "c_custkey").alias("root")), edges, ["TO"], 4)


@query("""WITH u AS (SELECT DISTINCT o_custkey AS fund, o_orderkey AS unit FROM orders), m AS (SELECT c_custkey AS fund, c_nationkey AS mgr FROM customer)
SELECT 'has_unit' AS rel, count(*) AS n FROM u UNION ALL SELECT 'of_fund', count(*) FROM u UNION ALL SELECT 'managed_by', (SELECT count(*) FROM m) + (SELECT count(*) FROM u JOIN m USING (fund))""")
def relation_catalog(t):
    f = F.concat(F.lit("c"), "o_custkey")
    edges = graph.edge_union((t.orders, f, "HAS_UNIT", F.concat(F.lit("o"), "o_orderkey")), (t.customer, F.concat(F.lit("c"), "c_custkey"), "MANAGED_BY", F.concat(F.lit("m"), "c_nationkey")))
    return graph.logical_edges(edges).groupBy("rel").agg(F.count("*").alias("n"))


@query("SELECT DISTINCT 'p' || l_partkey AS root, 'o' || l_orderkey AS record, 'c' || o_custkey AS file FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_partkey % 100 = 0")
def provenance_trace(t):
    roots = t.part.where("p_partkey % 100 = 0").select(F.concat(F.lit("p"), "p_partkey").alias("root"))
    describes = t.lineitem.select(F.concat(F.lit("o"), "l_orderkey").alias("src"), F.concat(F.lit("p"), "l_partkey").alias("dst")).distinct()
    in_file = t.orders.select(F.concat(F.lit("o"), "o_orderkey").alias("src"), F.concat(F.lit("c"), "o_custkey").alias("dst"))
    return graph.provenance(roots, describes, in_file)
