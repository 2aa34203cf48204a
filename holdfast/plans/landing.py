"""Queries of landed files: whole tables written as the files that feeds come in, and read by the library's readers."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from holdfast.functions import scalars as S
from holdfast.operators import graph, observe, stages
from holdfast.operators import query as Q
from holdfast.plans.catalog import query, shared_place
from holdfast.sources import landed
from holdfast.streaming import intake as I

c = F.col


@query("SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS source_row_id, lpad(CAST(l_orderkey AS VARCHAR), 12, '0') AS fund_isin, l_discount AS weight, CAST(l_shipdate AS DATE) AS as_of, round(l_extendedprice, 4) AS source_market_value FROM lineitem")
def landed_holdings(t):
    place = shared_place(t.spark, "holdings")
    own = {"fund_isin": F.lpad(c("l_orderkey").cast("string"), 12, "0"), "weight": c("l_discount"), "as_of": c("l_shipdate").cast("date"), "source_market_value": c("l_extendedprice"), "source_row_id": F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey")}
    names = [x.split()[0] for x in landed.HOLDINGS.split(", ")]
    t.lineitem.select(*[own.get(n, F.lit(None).cast("string")).alias(n) for n in names]).write.option("header", True).csv(place)
    return landed.holdings_csv(t.spark, place).select("source_row_id", "fund_isin", "weight", "as_of", F.round("source_market_value", 4).alias("source_market_value"))


@query("SELECT lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS local_key, CASE WHEN p_partkey % 7 <> 0 THEN p_name END AS standard_id, CASE WHEN p_partkey % 7 = 0 THEN 'missing required field: standard_id' END AS problem FROM part")
def landed_crosswalk(t):
    """Keys keep their zeros; rows that lack a required field are told by its name."""
    place = shared_place(t.spark, "crosswalk")
    own = {"entity_kind": F.lit("security"), "local_key_type": F.lit("krx_code"), "local_key": F.lpad(c("p_partkey").cast("string"), 9, "0"), "standard_id_type": F.lit("name"), "standard_id": F.when(c("p_partkey") % 7 != 0, c("p_name"))}
    names = [x.split()[0] for x in landed.CROSSWALK.split(", ")]
    t.part.select(*[own.get(n, F.lit(None).cast("string")).alias(n) for n in names]).write.option("header", True).csv(place)
    rows = landed.crosswalk_csv(t.spark, place)
    bad = landed.crosswalk_problems(rows).select("local_key", "problem")
    return rows.join(bad, "local_key", "left").select("local_key", "standard_id", "problem")


@query("SELECT o_custkey AS list, count(*) AS n_targets, CASE WHEN o_custkey % 5 = 0 THEN 'unknown source' WHEN o_custkey % 5 = 1 THEN 'a target has unexpected or missing keys' WHEN o_custkey % 5 = 2 AND count(*) > 1 THEN 'duplicate document' END AS problem FROM orders GROUP BY o_custkey")
def target_lists(t):
    """One list of targets for each customer, of their orders; some lists break a rule."""
    k = c("o_custkey") % 5
    target = F.struct(F.when(k == 2, "same").otherwise(c("o_orderkey").cast("string")).alias("document"), c("o_orderpriority").alias("fund"), F.when(k == 1, "more").alias("other"))
    lists = t.orders.groupBy(c("o_custkey").alias("list")).agg(F.to_json(F.struct(F.when(F.first(k) == 0, "other").otherwise("manager").alias("source"), F.collect_list(target).alias("targets"))).alias("value"))
    return landed.target_lists(lists, "value", ["document", "fund"], ["document"], ["manager", "filing"]).select("list", F.size("targets").cast("long").alias("n_targets"), "problem")


@query("SELECT CAST(user_id AS VARCHAR) AS target, arg_max(event_type, event_id) AS phase, count(*) AS n FROM events GROUP BY user_id")
def manifest_append(t):
    """A log of all events, appended in two goes, and each target's latest phase."""
    place = shared_place(t.spark, "manifest")
    names = [x.split()[0] for x in landed.MANIFEST.split(", ")]
    own = {"target": c("user_id").cast("string"), "phase": c("event_type"), "n_records": c("event_id")}
    entries = t.events.select(*[own.get(n, F.lit(None).cast("string")).alias(n) for n in names])
    landed.append_manifest(entries.where("n_records % 2 = 0"), place)
    landed.append_manifest(entries.where("n_records % 2 = 1"), place)
    log = landed.manifest_json(t.spark, place).select("target", "phase", "n_records")
    last = I.state(log, "target", c("n_records"), "phase")
    return last.join(log.groupBy("target").agg(F.count("*").alias("n")), "target")


@query("SELECT p_partkey AS row_number, 'missing_name' AS issue_code, p_brand AS brand FROM part WHERE p_size > 25")
def quarantine_lines(t):
    """Rejected rows as JSON lines, read back strictly."""
    place = shared_place(t.spark, "quarantine")
    landed.write_json_lines(t.part.where("p_size > 25").select(c("p_partkey").alias("row_number"), F.lit("missing_name").alias("issue_code"), c("p_brand").alias("brand")), place)
    lines = landed.strict_json(t.spark.read.text(place), "value", "row_number long, issue_code string, brand string", ["row_number", "issue_code", "brand"])
    return lines.where("problem is null").select("record.*")


@query("SELECT 'urn:holdfast:source-record:' || p_brand || ':' || (CASE WHEN p_size > 25 THEN '2026-01-02' ELSE '2026-01-01' END) || ':' || p_partkey AS src, 'IN_FILE' AS rel, 'urn:holdfast:file:' || url_encode(p_brand) || ':' || (CASE WHEN p_size > 25 THEN '2026-01-02' ELSE '2026-01-01' END) AS dst FROM part")
def raw_record_upsert(t):
    """Records by dataset and snapshot: a snapshot that comes again replaces its own partition only. The first time around, names were wrong."""
    place = shared_place(t.spark, "raw")
    day = F.when(c("p_size") > 25, "2026-01-02").otherwise("2026-01-01").cast("date")
    rows = t.part.select(c("p_brand").alias("dataset"), day.alias("snapshot_date"), c("p_partkey").alias("row_number"), F.create_map(F.lit("name"), c("p_name")).alias("raw"))
    landed.write_partition(rows.withColumn("row_number", -c("row_number")), place, "dataset", "snapshot_date")
    landed.write_partition(rows.where("snapshot_date = '2026-01-01'"), place, "dataset", "snapshot_date")
    landed.write_partition(rows.where("snapshot_date = '2026-01-02'"), place, "dataset", "snapshot_date")
    kept = t.spark.read.schema(rows.schema).parquet(place)
    return graph.edge_union((kept, S.source_uri(c("dataset"), c("snapshot_date"), c("row_number")), "IN_FILE", S.uri("file", c("dataset"), c("snapshot_date").cast("string"))))


@query("SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS name, CAST(l_shipdate AS DATE) AS day, lpad(CAST(l_partkey AS VARCHAR), 6, '0') AS krx_code, CASE WHEN l_linenumber <> 2 THEN l_discount * 100 END AS percent, round(l_extendedprice, 2) AS market_value FROM lineitem")
def landed_baskets(t):
    """Baskets under headers in another language and order, with a column that isn't known."""
    place = shared_place(t.spark, "baskets")
    own = t.lineitem.select(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias(" 종목명"), F.lit("x").alias("note"), F.date_format("l_shipdate", "yyyy/MM/dd").alias("기준일"), F.lpad(c("l_partkey").cast("string"), 6, "0").alias("종목코드"), F.when(c("l_linenumber") != 2, F.concat(F.round(c("l_discount") * 100, 2).cast("string"), F.lit("%"))).alias("비중 (%)"), F.format_number("l_extendedprice", 2).alias("평가금액"))
    own.write.option("header", True).option("quoteAll", True).option("emptyValue", "").csv(place)
    return landed.basket_csv(t.spark, place).select("name", S.multi_date(c("as_of")).alias("day"), "krx_code", S.percent_number(c("weight_pct")).alias("percent"), S.percent_number(c("market_value")).alias("market_value"))


@query("SELECT 'o' || l_orderkey || '-' || l_linenumber || '-' || l_partkey AS name, DATE '2026-06-30' AS report_date, CASE WHEN l_linenumber <> 2 THEN 'US' || lpad(CAST(l_partkey AS VARCHAR), 9, '0') || '0' END AS isin, round(l_extendedprice, 4) AS value, count(*) OVER (PARTITION BY l_orderkey) AS n_positions FROM lineitem")
def landed_filings(t):
    """One filing for each order, its lines as positions; a thousand filings to a file."""
    place = shared_place(t.spark, "filings")
    tag = lambda name, x: F.concat(F.lit(f"<n:{name}>"), x.cast("string"), F.lit(f"</n:{name}>"))
    isin = F.when(c("l_linenumber") == 2, "N/A").otherwise(F.concat(F.lit("US"), F.lpad(c("l_partkey").cast("string"), 9, "0"), F.lit("0")))
    position = tag("invstOrSec", F.concat(tag("name", F.concat(F.lit("o"), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey"))), tag("isin", isin), tag("valUSD", c("l_extendedprice")), tag("curCd", F.lit("USD"))))
    body = tag("formData", F.concat(tag("genInfo", tag("repPdDate", F.lit("2026-06-30"))), tag("fundInfo", tag("invstOrSecs", F.array_join(F.collect_list(position), "")))))
    filing = F.concat(F.lit("<n:edgarSubmission>"), body, F.lit("</n:edgarSubmission>")).alias("x")
    n_files = -(-t.orders.count() // 1000) or 1
    # one shuffle: lines are dealt by their file, so filings and files come together where they are; a row is a file
    lines = stages.spread(t.lineitem.withColumn("file", F.pmod(F.xxhash64("l_orderkey"), F.lit(n_files))), "file")
    files = lines.groupBy("file", "l_orderkey").agg(filing).groupBy("file").agg(F.concat(F.lit('<n:all xmlns:n="u">'), F.array_join(F.collect_list("x"), ""), F.lit("</n:all>")).alias("value"))
    files.select("value").write.option("maxRecordsPerFile", 1).text(place)
    rows = landed.filings_xml(t.spark, place).withColumn("of", F.split_part("name", F.lit("-"), F.lit(1)))
    # files are parsed once: a window, not a join with a second reading
    n_positions = (F.max("position").over(Window.partitionBy("of")) + 1).cast("long")
    return rows.select("name", "report_date", "isin", F.round(S.number(c("value")), 4).alias("value"), n_positions.alias("n_positions"))


@query("SELECT p_brand AS dataset, p_name AS field, p_partkey AS ordinal FROM part WHERE p_partkey % 7 <> 0")
def field_definitions(t):
    """Rows without a field's name are skipped, and still counted in the ordinals."""
    null = F.lit(None).cast("string")
    rows = t.part.select(c("p_brand").alias("dataset"), F.when(c("p_partkey") % 7 == 0, " \t").otherwise(F.concat(F.lit(" "), "p_name")).alias("field"), c("p_partkey").alias("row_number"), null.alias("key_role"), null.alias("type"), null.alias("local_name"), null.alias("example"))
    return landed.field_definitions(rows).select("dataset", "field", "ordinal")


@query("SELECT l_orderkey, l_linenumber, l_partkey, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS quantity, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS day, CASE WHEN l_discount = 0 THEN '0' ELSE CAST(l_discount AS VARCHAR) END AS discount FROM lineitem")
def fn_cell_text(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", S.cell_text(c("l_quantity"), "double").alias("quantity"), S.cell_text(c("l_shipdate"), "timestamp").alias("day"), S.cell_text(c("l_discount"), "double").alias("discount"))


@query("SELECT p_partkey, lower(replace(p_name, ' ', '')) AS key FROM part")
def fn_header_key(t):
    return t.part.select("p_partkey", S.header_key(F.concat(F.lit("\u3000 "), F.upper("p_name"), F.lit("\t"))).alias("key"))


@query('SELECT n_nationkey AS "nNationkey", n_name AS "nName", n_regionkey AS "nRegionkey" FROM nation')
def fn_camel_names(t):
    return t.nation.select(*[c(x).alias(S.camel(x)) for x in ("n_nationkey", "n_name", "n_regionkey")])


@query("SELECT l_orderkey, CASE WHEN max(l_quantity) > 49 THEN 'FAILED' ELSE 'LOADED' END AS phase, CASE WHEN max(l_quantity) > 49 THEN 'quantity' END AS message, count(*) AS n_records, CASE WHEN max(l_quantity) > 49 THEN 0 ELSE count(*) END AS n_loaded FROM lineitem GROUP BY l_orderkey")
def partial_failure(t):
    """A target that fails is logged with its reason, and the others are loaded."""
    loaded, log = I.outcomes(t.lineitem.select("l_orderkey", "l_quantity"), "l_orderkey", F.when(c("l_quantity") > 49, "quantity"))
    n = loaded.groupBy("l_orderkey").agg(F.count("*").alias("n_loaded"))
    return log.join(n, "l_orderkey", "left").select("l_orderkey", "phase", "message", "n_records", F.coalesce("n_loaded", F.lit(0)).alias("n_loaded"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'as_of differs' WHEN o_orderkey % 5 = 1 THEN 'source_url differs,fund_isin differs' ELSE '' END AS problems FROM orders")
def artifact_identity(t):
    """Files whose records state another day, address or fund than the manifest."""
    k = c("o_orderkey") % 5
    n = t.orders.select("o_orderkey", S.digest(c("o_orderkey")).alias("sha256"), c("o_custkey").alias("size"), F.lit(1).alias("n_records"), c("o_orderdate").cast("date").alias("as_of"), F.concat(F.lit("https://a/"), "o_orderkey").alias("source_url"), c("o_custkey").cast("string").alias("fund_isin"))
    files = n.withColumns({"as_of": F.when(k == 0, F.date_add("as_of", 1)).otherwise(c("as_of")), "source_url": F.when(k != 1, c("source_url")), "fund_isin": F.when(k == 1, "x").otherwise(c("fund_isin"))})
    return I.audit(n, files, "o_orderkey", ("as_of", "source_url", "fund_isin")).withColumn("problems", F.array_join("problems", ","))


@query("SELECT l_partkey AS key, o_orderpriority AS dataset, o_orderstatus AS file, year(o_orderdate) AS snapshot, sha256(o_orderstatus) AS sha, count(DISTINCT l_orderkey) AS n_evidence FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL")
def evidence_sources(t):
    e = t.lineitem.join(t.orders, c("l_orderkey") == c("o_orderkey")).select("l_partkey", "l_orderkey", "o_orderpriority", "o_orderstatus", F.year("o_orderdate").cast("long").alias("snapshot"), F.sha2("o_orderstatus", 256).alias("sha"))
    return Q.evidence_sources(e, "l_partkey", "l_orderkey", "o_orderpriority", "o_orderstatus", "snapshot", "sha")


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) <= DATE '1996-06-30' AS visible FROM orders")
def late_evidence(t):
    return observe.visible(t.orders.select("o_orderkey", c("o_orderdate").cast("date").alias("published")), "published", F.lit("1996-06-30").cast("date")).select("o_orderkey", "visible")


@query("""WITH last AS (SELECT o_custkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS k FROM orders WHERE o_orderdate <= TIMESTAMP '1997-01-01'),
e AS (SELECT o_custkey, count(DISTINCT o_orderkey) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT c.c_custkey, c.c_name AS name, round(last.o_totalprice, 4) AS total, e.n AS n_evidence, 'ok' AS outcome FROM customer c JOIN last ON last.o_custkey = c.c_custkey AND last.k = 1 JOIN e ON e.o_custkey = c.c_custkey
WHERE contains(lower(c.c_name), 'customer') AND last.o_totalprice > 50000 AND c.c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1) ORDER BY last.o_totalprice DESC, c.c_custkey LIMIT 50""")
def find_whole(t):
    """Search by name, the observation at or before a day, a filter on it, a scope, required evidence, order and a page."""
    last = observe.at_or_before(t.orders, "o_custkey", "o_orderdate", "o_orderkey", F.lit("1997-01-01").cast("timestamp_ntz")).select(c("o_custkey").alias("c_custkey"), c("o_totalprice").alias("total"))
    scope = t.customer.join(F.broadcast(t.nation.where("n_regionkey = 1")), c("c_nationkey") == c("n_nationkey"), "left_semi")
    proof = t.orders.where("o_orderstatus = 'F'").select(c("o_custkey").alias("c_custkey"), "o_orderkey")
    found = Q.find_all(
        t.customer, "c_custkey", {"field": "fund.total", "op": "gt", "value": 50000}, {"fund.total": (c("total"), "number")}, {"name": c("c_name"), "total": F.round("total", 4)}, [("total", "desc", "last")],
        search=lambda rows: rows.where(F.contains(F.lower("c_name"), F.lit("customer"))), observations=last, scopes=(scope,), evidence=(proof, "o_orderkey"), required=True, limit=50,
    )
    return found.select("c_custkey", "name", "total", "n_evidence", "outcome")


@query("""SELECT p_brand AS dataset, p_name AS field, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS ordinal, p_type AS type, CASE WHEN p_size > 25 THEN 'PK' END AS key_role FROM part
QUALIFY p_partkey % 7 <> 0 AND p_brand <> 'Brand#3'""")
def field_sheet_rows(t):
    """A sheet of field definitions for each brand: two title rows, a header, a row for each part; one brand's has no header and is refused."""
    k = F.row_number().over(Window.partitionBy("p_brand").orderBy("p_partkey")) + 3
    body = t.part.select(c("p_brand").alias("dataset"), k.alias("row_number"), F.array(F.when(c("p_partkey") % 7 == 0, " ").otherwise(c("p_name")), F.when(c("p_size") > 25, "PK"), c("p_type")).alias("cells"))
    head = lambda i, cell: t.part.select(c("p_brand").alias("dataset"), F.lit(i).alias("row_number"), F.array(cell).alias("cells")).distinct()
    header = F.when(c("p_brand") != "Brand#3", f" {landed.FIELD_HEADER} ").otherwise("title")
    sheets = body.unionByName(head(1, F.lit("title"))).unionByName(head(2, F.lit(None).cast("string"))).unionByName(head(3, header))
    return landed.field_sheets(sheets)[0].select("dataset", "field", c("ordinal").cast("long").alias("ordinal"), "type", "key_role")
