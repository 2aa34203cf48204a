"""Queries of scalar functions, predicates, aggregates, selection in time, sort and page."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.functions import scalars as S
from holdfast.operators import fold, identity, observe, predicates, quality, textsearch
from holdfast.operators import query as Q
from holdfast.plans.catalog import Tables, query

c = F.col


def _obs(t: Tables) -> DataFrame:
    """(uri, owner, as_of, value, value0, kind): value0 is absent for errors."""
    return t.events.select(c("event_id").alias("uri"), c("user_id").alias("owner"), c("ts").cast("date").alias("as_of"), "value", F.when(c("event_type") != "error", c("value")).alias("value0"), c("event_type").alias("kind"))


OBS = "obs AS (SELECT event_id AS uri, user_id AS owner, CAST(ts AS DATE) AS as_of, value, CASE WHEN event_type <> 'error' THEN value END AS value0, event_type AS kind FROM events)"
LATEST = OBS + ", latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY owner ORDER BY as_of DESC NULLS LAST, uri) AS rk FROM obs) WHERE rk = 1)"


# scalar functions -------------------------------------------------------------------------------------------------


@query("SELECT event_id, nullif(trim(CASE WHEN event_id % 3 = 0 THEN '   ' ELSE chr(9) || event_type || '  ' END, ' ' || chr(9)), '') AS t FROM events")
def fn_text(t):
    return t.events.select("event_id", S.text(F.when(c("event_id") % 3 == 0, F.lit("   ")).otherwise(F.concat(F.lit("\t"), "event_type", F.lit("  ")))).alias("t"))


@query("SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 4 = 1 THEN NULL ELSE CAST(event_id AS DOUBLE) / 8 END AS n FROM events")
def fn_number(t):
    raw = F.when(c("event_id") % 4 == 0, "nan").when(c("event_id") % 4 == 1, F.concat(c("event_id").cast("string"), F.lit("d"))).otherwise(F.concat(F.lit(" "), (c("event_id") / 8).cast("string")))
    return t.events.select("event_id", S.number(raw).alias("n"))


@query("SELECT p_partkey, CASE WHEN (p_partkey * 10) % 20 = 0 THEN CAST(p_partkey / 2 AS BIGINT) END AS i FROM part")
def fn_integer(t):
    return t.part.select("p_partkey", S.integer((c("p_partkey") / 2).cast("string")).alias("i"))


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS b FROM orders")
def fn_boolean(t):
    return t.orders.select("o_orderkey", S.boolean(F.when(c("o_orderstatus") == "F", " y ").when(c("o_orderstatus") == "O", "0").otherwise(c("o_orderstatus"))).alias("b"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS d FROM orders")
def fn_date(t):
    raw = F.when(c("o_orderkey") % 5 == 0, "20260231").when(c("o_orderkey") % 5 == 1, F.date_format("o_orderdate", "yyyyMMdd")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return t.orders.select("o_orderkey", S.parsed_date(raw).alias("d"))


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders")
def fn_multi_date(t):
    d = c("o_orderdate")
    raw = F.when(c("o_orderkey") % 3 == 0, F.date_format(d, "yyyy.MM.dd")).when(c("o_orderkey") % 3 == 1, F.date_format(d, "yyyy/MM/dd")).otherwise(F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit("T10:00:00")))
    return t.orders.select("o_orderkey", S.multi_date(raw).alias("d"))


@query("SELECT p_partkey, (p_partkey % 3 <> 0) AS isin FROM part")
def fn_is_isin(t):
    body = F.concat(F.lit("us"), F.lpad(c("p_partkey").cast("string"), 9, "A"))
    return t.part.select("p_partkey", S.is_isin(F.when(c("p_partkey") % 3 == 0, F.concat(body, F.lit("X"))).otherwise(F.concat(body, F.lit("7")))).alias("isin"))


@query("SELECT p_partkey, p_partkey % 2 = 0 AS k FROM part")
def fn_source_key(t):
    return t.part.select("p_partkey", S.is_source_key(F.concat(F.when(c("p_partkey") % 2 == 0, "KR").otherwise("US"), F.lpad(c("p_partkey").cast("string"), 10, "0"))).alias("k"))


@query("SELECT s_suppkey, s_suppkey % 4 < 2 AS p FROM supplier")
def fn_placeholder(t):
    return t.supplier.select("s_suppkey", S.is_placeholder(F.when(c("s_suppkey") % 4 == 0, "000").when(c("s_suppkey") % 4 == 2, c("s_name")).when(c("s_suppkey") % 4 == 3, "00x")).alias("p"))


@query("SELECT p_partkey, url_encode(p_name || ' */~é&' || p_brand) AS u FROM part")
def fn_uri_component(t):
    return t.part.select("p_partkey", S.uri_component(F.concat("p_name", F.lit(" */~é&"), "p_brand")).alias("u"))


@query("SELECT s_suppkey, substr(sha256(lower(s_name)), 1, 24) AS h FROM supplier")
def fn_hash_id(t):
    return t.supplier.select("s_suppkey", S.hash_id(c("s_name")).alias("h"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, round(l_discount * 100, 6) AS pct, round(l_quantity * 1000, 6) AS n FROM lineitem")
def fn_percent_number(t):
    pct = F.concat(F.round(c("l_discount") * 100, 6).cast("string"), F.lit("%"))
    n = F.format_number(c("l_quantity") * 1000, 2)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.round(S.percent_number(pct), 6).alias("pct"), F.round(S.percent_number(n), 6).alias("n"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_name END AS i FROM customer")
def fn_usable_identifier(t):
    return t.customer.select("c_custkey", S.usable_identifier(F.when(c("c_custkey") % 6 == 0, " N/A ").when(c("c_custkey") % 6 == 3, "--").otherwise(c("c_name"))).alias("i"))


@query("SELECT s_suppkey, 'https://***@host/x?token=*** ' || s_name AS m FROM supplier")
def redact_text(t):
    return t.supplier.select("s_suppkey", S.redact(F.concat(F.lit("https://user:pw@host/x?token=abc"), c("s_suppkey").cast("string"), F.lit("\n"), "s_name")).alias("m"))


@query("SELECT event_type AS t, k AS s, sha256(event_type || '|' || k || '|') AS id FROM (SELECT DISTINCT event_type, user_id % 7 AS k FROM events)")
def batch_ids(t):
    return t.events.select(c("event_type").alias("t"), (c("user_id") % 7).alias("s")).distinct().withColumn("id", S.digest(c("t"), c("s"), F.lit(None)))


@query("SELECT p_partkey, 'urn:holdfast:product:' || p_partkey || ':' || url_encode(p_brand) AS u, 'urn:holdfast:organization:name:' || substr(sha256(lower(p_brand)), 1, 24) AS o, 'urn:holdfast:identifier:ticker:' || url_encode(p_name) AS i FROM part")
def build_uris(t):
    return t.part.select("p_partkey", S.uri("product", c("p_partkey").cast("string"), c("p_brand")).alias("u"), S.organization_uri("name", c("p_brand")).alias("o"), S.identifier_uri(F.lit("TICKER"), c("p_name")).alias("i"))


@query("SELECT p_partkey, CASE WHEN p_size > 25 THEN 2 ELSE 3 END AS n, CASE WHEN p_size > 25 THEN NULL ELSE p_type END AS type FROM part")
def raw_map_compact(t):
    m = F.create_map(F.lit("name"), c("p_name"), F.lit("type"), F.when(c("p_size") <= 25, c("p_type")), F.lit("brand"), c("p_brand"))
    m = F.map_filter(m, lambda _, v: v.isNotNull())
    return t.part.select("p_partkey", F.size(m).alias("n"), textsearch.raw_field(m, "type").alias("type"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'click' WHEN event_id % 3 = 1 THEN event_type ELSE 'none' END AS v FROM events")
def asof_fallback(t):
    return t.events.select("event_id", S.first_of(F.when(c("event_id") % 3 == 0, " click").otherwise(" "), F.when(c("event_id") % 3 == 1, c("event_type")), F.lit("none")).alias("v"))


# selection in time ------------------------------------------------------------------------------------------------


@query(f"WITH {LATEST} SELECT owner, as_of, uri, value FROM latest")
def obs_latest(t):
    return observe.latest(_obs(t), "owner", "as_of", "uri").select("owner", "as_of", "uri", "value")


@query(f"WITH {OBS}, mid AS (SELECT max(as_of) - 10 AS d FROM obs) SELECT owner, as_of, uri, value FROM (SELECT *, row_number() OVER (PARTITION BY owner ORDER BY as_of DESC, uri) AS rk FROM obs, mid WHERE as_of <= d) WHERE rk = 1")
def obs_at_or_before(t):
    o = _obs(t)
    last = o.agg(F.date_sub(F.max("as_of"), 10).alias("d"))
    return observe.latest(o.join(F.broadcast(last)).where("as_of <= d"), "owner", "as_of", "uri").select("owner", "as_of", "uri", "value")


@query(f"WITH {OBS} SELECT uri, owner FROM obs WHERE as_of = DATE '2024-01-05'")
def obs_on(t):
    return observe.on_day(_obs(t), "as_of", F.lit("2024-01-05").cast("date")).select("uri", "owner")


@query(f"WITH {OBS} SELECT uri, owner FROM obs WHERE as_of BETWEEN DATE '2024-01-05' AND DATE '2024-01-09'")
def obs_between(t):
    return observe.between_days(_obs(t), "as_of", F.lit("2024-01-05").cast("date"), F.lit("2024-01-09").cast("date")).select("uri", "owner")


@query(f"WITH {OBS} SELECT owner, count(*) AS n, count(value0) AS n_values FROM obs GROUP BY owner")
def obs_all(t):
    return observe.every(_obs(t)).groupBy("owner").agg(F.count("*").alias("n"), F.count("value0").alias("n_values"))


@query(f"WITH {LATEST} SELECT owner, as_of, uri, round(value, 6) AS value FROM latest WHERE value > 10")
def latest_then_filter(t):
    rows = observe.latest(_obs(t), "owner", "as_of", "uri").where(predicates.leaf(c("value"), "gt", 10, "number"))
    return rows.select("owner", "as_of", "uri", F.round("value", 6).alias("value"))


@query("WITH e AS (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rn FROM events), s AS (SELECT event_type, CAST(floor((rn - 1) / 500) AS BIGINT) AS shard, event_id FROM e) SELECT event_type, shard, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id, sha256(event_type || '|' || shard * 500 || '|' || shard * 500 + count(*)) AS shard_id FROM s GROUP BY event_type, shard")
def shard_assignment(t):
    s = observe.shards(t.events.select("event_type", "event_id"), ["event_type"], ["event_id"])
    g = s.groupBy("event_type", "shard").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))
    return g.withColumn("shard_id", S.digest(c("event_type"), c("shard") * 500, c("shard") * 500 + c("n")))


@query("SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS version FROM orders")
def amendment_versions(t):
    return observe.versions(t.orders.select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], "o_orderdate", "o_orderkey").select("o_custkey", "o_orderkey", "version")


@query("""WITH RECURSIVE s AS (SELECT CAST(min(o_orderdate) AS DATE) AS d0 FROM orders), g(i, d) AS (SELECT 0, date_trunc('month', d0)::DATE + 30 FROM s WHERE true
UNION ALL SELECT i + 1, least(last_day((date_trunc('month', d) + INTERVAL 1 MONTH)::DATE), (date_trunc('month', d) + INTERVAL 1 MONTH)::DATE + day(d)::INT - 1) FROM g WHERE i < 6),
f AS (SELECT i, d FROM g)
SELECT f.i, f.d AS day, count(o.o_orderkey) AS n FROM f LEFT JOIN orders o ON CAST(o.o_orderdate AS DATE) = f.d GROUP BY f.i, f.d""")
def month_grid(t):
    first = t.orders.agg(F.date_add(F.trunc(F.min("o_orderdate").cast("date"), "month"), 30)).first()[0]
    grid = observe.month_grid(t.spark, str(first), 6)
    n = t.orders.groupBy(c("o_orderdate").cast("date").alias("day")).agg(F.count("*").alias("n"))
    return grid.join(n, "day", "left").select("i", "day", F.coalesce("n", F.lit(0)).alias("n"))


# predicates -------------------------------------------------------------------------------------------------------


@query("SELECT p_partkey, p_size >= 10 AS gte, p_size < 40 AS lt, p_size BETWEEN 10 AND 20 AS btw, p_brand = 'Brand#11' AS eq, p_brand <> 'Brand#11' AS neq, p_size IN (1, 2, 3) AS inn, p_size NOT IN (1, 2, 3) AS nin FROM part")
def pred_comparison(t):
    p = lambda col, op, v, k="number": predicates.leaf(c(col), op, v, k)
    return t.part.select("p_partkey", p("p_size", "gte", 10).alias("gte"), p("p_size", "lt", 40).alias("lt"), p("p_size", "between", (10, 20)).alias("btw"), p("p_brand", "eq", "Brand#11").alias("eq"), p("p_brand", "neq", "Brand#11").alias("neq"), p("p_size", "in", [1, 2, 3]).alias("inn"), p("p_size", "not_in", [1, 2, 3]).alias("nin"))


_NUMERIC = " UNION ALL ".join(f"SELECT '{f}' AS field, '{op}' AS op, count(*) FILTER ({f} {sql}) AS n, NULL AS problem FROM lineitem" for f, v in (("l_quantity", "25"), ("l_shipdate", "TIMESTAMP '1998-06-01'")) for op, sql in (("eq", f"= {v}"), ("neq", f"<> {v}"), ("gt", f"> {v}"), ("gte", f">= {v}"), ("lt", f"< {v}"), ("lte", f"<= {v}"), ("between", f"BETWEEN {v} AND {v}"), ("in", f"IN ({v})"), ("not_in", f"NOT IN ({v})"), ("exists", "IS NOT NULL"), ("not_exists", "IS NULL")))
_STRINGS = " UNION ALL ".join(f"SELECT 'l_returnflag', '{op}', count(*) FILTER ({sql}), NULL FROM lineitem" for op, sql in (("eq", "l_returnflag = 'R'"), ("neq", "l_returnflag <> 'R'"), ("in", "l_returnflag IN ('R')"), ("not_in", "l_returnflag NOT IN ('R')"), ("contains", "contains(lower(l_returnflag), 'r')"), ("starts_with", "starts_with(lower(l_returnflag), 'r')"), ("ends_with", "ends_with(lower(l_returnflag), 'r')"), ("exists", "l_returnflag IS NOT NULL"), ("not_exists", "l_returnflag IS NULL")))
_REFUSED = "SELECT field, op, NULL, 'unsupported_operator' FROM (VALUES ('l_quantity', ['contains', 'starts_with', 'ends_with']), ('l_shipdate', ['contains', 'starts_with', 'ends_with']), ('l_returnflag', ['gt', 'gte', 'lt', 'lte', 'between'])) v(field, ops), unnest(ops) AS u(op)"


@query(f"{_NUMERIC} UNION ALL {_STRINGS} UNION ALL {_REFUSED}")
def pred_domain(t):
    """All fourteen operators on a number, a time and a string: rows that each holds for, or that it doesn't fit the field's kind."""
    kinds = {"l_quantity": "number", "l_shipdate": "datetime", "l_returnflag": "string"}
    return predicates.answers(t.lineitem, kinds, {"l_quantity": 25, "l_shipdate": datetime.datetime(1998, 6, 1), "l_returnflag": "R"})


@query("SELECT p_partkey, contains(lower(p_name), 'e') AS con, starts_with(lower(p_type), 'st') AS sta, ends_with(lower(p_type), 'el') AS en FROM part")
def pred_string(t):
    p = lambda col, op, v: predicates.leaf(c(col), op, v)
    return t.part.select("p_partkey", p("p_name", "contains", "E").alias("con"), p("p_type", "starts_with", "ST").alias("sta"), p("p_type", "ends_with", "el").alias("en"))


@query(f"WITH {OBS} SELECT kind, count(*) FILTER (value0 IS NOT NULL) AS has, count(*) FILTER (value0 IS NULL) AS has_not FROM obs GROUP BY kind")
def pred_exists(t):
    return _obs(t).groupBy("kind").agg(F.count_if(predicates.leaf(c("value0"), "exists")).alias("has"), F.count_if(predicates.leaf(c("value0"), "not_exists")).alias("has_not"))


@query("SELECT p_partkey FROM part WHERE (p_size > 10 AND (p_brand = 'Brand#11' OR contains(lower(p_name), 'a')) AND NOT (p_type = 'STEEL'))")
def pred_tree(t):
    fields = {"size": (c("p_size"), "number"), "brand": (c("p_brand"), "string"), "name": (c("p_name"), "string"), "type": (c("p_type"), "string")}
    tree = {"all": [{"field": "size", "op": "gt", "value": 10}, {"any": [{"field": "brand", "op": "eq", "value": "Brand#11"}, {"field": "name", "op": "contains", "value": "A"}]}, {"not": {"field": "type", "op": "eq", "value": "STEEL"}}]}
    return t.part.where(predicates.tree(tree, fields.__getitem__)).select("p_partkey")


@query(f"WITH {OBS} SELECT uri FROM obs WHERE value0 <> 10 AND NOT (value0 > 50)")
def pred_null_semantics(t):
    return _obs(t).where(predicates.leaf(c("value0"), "neq", 10, "number") & ~predicates.leaf(c("value0"), "gt", 50, "number")).select("uri")


@query("SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 40 AND l_discount > 0.05)")
def scope_same_node(t):
    return predicates.having_related(t.orders.select("o_orderkey"), t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey"), ["o_orderkey"], c("l_quantity") > 40, c("l_discount") > 0.05)


@query("SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 40) AND EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_discount > 0.05)")
def scope_two_nodes(t):
    lines = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    one = predicates.having_related(t.orders.select("o_orderkey"), lines, ["o_orderkey"], c("l_quantity") > 40)
    return predicates.having_related(one, lines, ["o_orderkey"], c("l_discount") > 0.05)


# aggregates -------------------------------------------------------------------------------------------------------


@query(f"WITH {OBS} SELECT kind, count(value0) AS n, count(DISTINCT owner) AS owners, round(min(value0), 6) AS lo, round(max(value0), 6) AS hi, round(avg(value0), 6) AS mean, round(sum(value0), 4) AS total FROM obs GROUP BY kind")
def agg_functions(t):
    a = Q.aggregate(_obs(t), ["kind"], {"n": ("count", "value0"), "owners": ("count_distinct", "owner"), "lo": ("min", "value0"), "hi": ("max", "value0"), "mean": ("avg", "value0"), "total": ("sum", "value0")})
    return a.select("kind", "n", "owners", *[F.round(x, 6).alias(x) for x in ("lo", "hi", "mean")], F.round("total", 4).alias("total"))


@query("SELECT c_custkey, round(c_acctbal, 6) AS balance, n_orders FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey")
def agg_no_fanout(t):
    return Q.without_fanout(t.customer.select("c_custkey", F.round("c_acctbal", 6).alias("balance")), t.orders.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", F.count("*").alias("n_orders"))


@query("SELECT p_brand AS manager, count(*) AS n, round(avg(p_retailprice), 6) AS fee FROM part WHERE p_size >= 5 GROUP BY p_brand")
def aggregate_by_manager(t):
    rows = t.part.where(predicates.leaf(c("p_size"), "gte", 5, "number"))
    return Q.aggregate(rows, ["p_brand"], {"n": ("count", "p_partkey"), "fee": ("avg", "p_retailprice")}).select(c("p_brand").alias("manager"), "n", F.round("fee", 6).alias("fee"))


@query("SELECT event_type AS dataset, CASE WHEN user_id % 2 = 0 THEN 'fund' ELSE 'note' END AS kind, count(*) AS n FROM events GROUP BY ALL UNION ALL SELECT event_type, NULL, count(*) FROM events GROUP BY event_type")
def dry_run_profile(t):
    return quality.profile(t.events.select("event_type", F.when(c("user_id") % 2 == 0, "fund").otherwise("note").alias("k")), "event_type", "k")


@query("SELECT (SELECT count(*) FROM events) AS n_records, (SELECT count(DISTINCT user_id) FROM events) AS n_owners, (SELECT count(*) FROM part) AS n_products, (SELECT count(*) FROM (SELECT event_id FROM events GROUP BY event_id HAVING count(*) > 1)) AS n_duplicate_uris")
def validate_totals(t):
    a = t.events.agg(F.count("*").alias("n_records"), F.countDistinct("user_id").alias("n_owners"))
    b = t.part.agg(F.count("*").alias("n_products"))
    d = quality.duplicates(t.events, "event_id").agg(F.count("*").alias("n_duplicate_uris"))
    return a.join(b).join(d)


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_uris(t):
    return quality.duplicates(t.lineitem, "l_orderkey", "l_linenumber")


@query("SELECT label, count(*) AS n FROM (SELECT unnest(CASE WHEN p_size > 25 THEN ['Product', 'Large'] ELSE ['Product'] END) AS label FROM part) GROUP BY label")
def label_counts(t):
    labels = F.when(c("p_size") > 25, F.array(F.lit("Product"), F.lit("Large"))).otherwise(F.array(F.lit("Product")))
    return quality.label_counts(t.part, labels)


@query("SELECT p_brand, list_aggregate(list_sort(list(DISTINCT p_type)), 'string_agg', ',') AS types FROM part GROUP BY p_brand")
def collect_attributes(t):
    return fold.collected(t.part, ["p_brand"], "p_type").select("p_brand", F.array_join("p_type", ",").alias("types"))


@query("SELECT l_partkey, count(DISTINCT l_suppkey) AS venues FROM lineitem GROUP BY l_partkey HAVING count(DISTINCT l_suppkey) > 1")
def multi_listing(t):
    return identity.conflicts(t.lineitem, ["l_partkey"], "l_suppkey").withColumnRenamed("n_ids", "venues")


@query("SELECT l_partkey, count(DISTINCT l_suppkey) AS n_venues, array_to_string(list_sort(list(DISTINCT l_suppkey))[1:50], ',') AS venues FROM lineitem GROUP BY l_partkey HAVING count(DISTINCT l_suppkey) > 1")
def listing_venues(t):
    return identity.listings(t.lineitem, "l_partkey", "l_suppkey").withColumn("venues", F.array_join(F.transform("venues", lambda v: v.cast("string")), ","))


@query("SELECT 'quantity' AS field, count(*) AS total, count(l_quantity) AS populated, count(*) FILTER (l_quantity <> 0) AS non_zero, false AS constant_zero FROM lineitem UNION ALL SELECT 'tax', count(*), count(l_tax), count(*) FILTER (l_tax <> 0), false FROM lineitem UNION ALL SELECT 'blank', count(*), count(*) FILTER (l_returnflag = 'R'), 0, true FROM lineitem")
def field_coverage(t):
    return quality.coverage(t.lineitem.select(c("l_quantity").alias("quantity"), c("l_tax").alias("tax"), F.when(c("l_returnflag") == "R", 0.0).alias("blank")), ["quantity", "tax", "blank"])


# sort, page, distinct ---------------------------------------------------------------------------------------------


@query(f"WITH {OBS} SELECT uri, round(value0, 6) AS v FROM obs ORDER BY value0 DESC NULLS LAST, uri LIMIT 100")
def order_nulls_last(t):
    return Q.page(Q.ordered(_obs(t), [("value0", "desc", "last")], "uri"), 100).select("uri", F.round("value0", 6).alias("v"))


@query(f"WITH {OBS} SELECT uri, round(value0, 6) AS v FROM obs ORDER BY value0 ASC NULLS FIRST, uri LIMIT 100")
def order_nulls_first(t):
    return Q.page(Q.ordered(_obs(t), [("value0", "asc", "first")], "uri"), 100).select("uri", F.round("value0", 6).alias("v"))


@query("SELECT p_partkey, p_name FROM part ORDER BY p_name, p_partkey LIMIT 20 OFFSET 40")
def page_offset(t):
    return Q.page(Q.ordered(t.part, [("p_name", "asc", "last")], "p_partkey"), 20, 40).select("p_partkey", "p_name")


@query("SELECT DISTINCT p_brand, p_type FROM part")
def find_distinct(t):
    return t.part.select("p_brand", "p_type").distinct()


@query("SELECT p_partkey AS uri, p_name AS name, round(p_retailprice, 6) AS fee FROM part WHERE p_retailprice < 1000 AND contains(lower(p_type), 'e') ORDER BY p_retailprice, p_partkey LIMIT 20")
def find_fee_aum(t):
    fields = {"fund.fee_rate": (c("p_retailprice"), "number"), "entity.kind": (c("p_type"), "string")}
    where = {"all": [{"field": "fund.fee_rate", "op": "lt", "value": 1000}, {"field": "entity.kind", "op": "contains", "value": "E"}]}
    return Q.find(t.part, where, fields, {"uri": c("p_partkey"), "name": c("p_name"), "fee": c("p_retailprice")}, [("fee", "asc", "last")], "uri").select("uri", "name", F.round("fee", 6).alias("fee"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_name = (SELECT max(c_name) FROM customer)")
def find_by_isin(t):
    last = t.customer.agg(F.max("c_name").alias("c_name"))
    return t.customer.join(F.broadcast(last), "c_name", "left_semi").select("c_custkey", "c_name")


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, o_orderpriority AS grade FROM orders WHERE o_orderpriority IN (SELECT min(o_orderpriority) FROM orders) AND CAST(o_orderdate AS DATE) >= DATE '1998-01-01' ORDER BY d, o_orderkey LIMIT 100")
def find_bond_maturity_grade(t):
    grade = t.orders.agg(F.min("o_orderpriority").alias("o_orderpriority"))
    rows = t.orders.join(F.broadcast(grade), "o_orderpriority", "left_semi").withColumn("d", c("o_orderdate").cast("date"))
    rows = rows.where(predicates.leaf(c("d"), "gte", F.lit("1998-01-01").cast("date"), "date"))
    return Q.page(Q.ordered(rows.select("o_orderkey", "d", c("o_orderpriority").alias("grade")), [("d", "asc", "last")], "o_orderkey"), 100)
