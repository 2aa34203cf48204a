"""Queries of incremental intake: phase log, skips, gaps, completion, audits, streams."""

from __future__ import annotations


from pyspark.sql import functions as F

from holdfast.functions import scalars as S
from holdfast.operators import observe
from holdfast.plans.catalog import query, shared_place
from holdfast.sources import landed
from holdfast.streaming import intake as I
from holdfast.streaming import tables

c = F.col
LOG = "log AS (SELECT event_id AS seq, user_id AS target, CASE event_type WHEN 'purchase' THEN 'LOADED' WHEN 'click' THEN 'READY' WHEN 'error' THEN 'FAILED' ELSE 'FETCHED' END AS phase, CAST(ts AS DATE) AS day FROM events)"


def _log(t):
    phase = F.when(c("event_type") == "purchase", "LOADED").when(c("event_type") == "click", "READY").when(c("event_type") == "error", "FAILED").otherwise("FETCHED")
    return t.events.select(c("event_id").alias("seq"), c("user_id").alias("target"), phase.alias("phase"), c("ts").cast("date").alias("day"))


@query(f"WITH {LOG} SELECT target, phase, seq FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY seq DESC) AS k FROM log) WHERE k = 1")
def manifest_state(t):
    return I.state(_log(t), "target", c("seq"), "phase", "seq")


@query(f"WITH {LOG} SELECT phase, count(*) AS n, count(DISTINCT target) AS targets FROM log GROUP BY phase")
def manifest_replay(t):
    return I.replay(_log(t), "phase", "target")


@query(f"WITH {LOG} SELECT DISTINCT target, day FROM log l WHERE NOT EXISTS (SELECT 1 FROM log x WHERE x.phase = 'LOADED' AND x.target = l.target AND x.day = l.day)")
def skip_loaded(t):
    log = _log(t)
    return I.skip_loaded(log.select("target", "day").distinct(), log, ["target", "day"])


@query(f"WITH {LOG}, g AS (SELECT DISTINCT target FROM log), d AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM log) SELECT g.target, d.day FROM g CROSS JOIN d WHERE NOT EXISTS (SELECT 1 FROM log x WHERE x.target = g.target AND x.day = d.day)")
def compute_missing(t):
    """Gaps on every calendar day from the log's first to its last."""
    log = _log(t)
    gaps = observe.gaps(log.select("target").distinct(), log, "target", "day", observe.day_grid(log, "day"))
    return observe.gap_days(gaps, "target", observe.day_grid(log, "day")).withColumnRenamed("at", "day")


@query(f"WITH {LOG}, g AS (SELECT DISTINCT target FROM log), d AS (SELECT DISTINCT day FROM log) SELECT g.target, d.day FROM g CROSS JOIN d WHERE NOT EXISTS (SELECT 1 FROM log x WHERE x.target = g.target AND x.day = d.day)")
def compute_missing_all(t):
    """Gaps on every day that the log has."""
    log = _log(t)
    grid = observe.grid(log.select("day").distinct(), "day")
    return observe.gap_days(observe.gaps(log.select("target").distinct(), log, "target", "day", grid), "target", grid).withColumnRenamed("at", "day")


@query(f"""WITH {LOG}, g AS (SELECT DISTINCT target FROM log), d AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM log),
m AS (SELECT g.target, d.day FROM g CROSS JOIN d WHERE NOT EXISTS (SELECT 1 FROM log x WHERE x.target = g.target AND x.day = d.day AND x.phase = 'LOADED')),
r AS (SELECT *, day - CAST(row_number() OVER (PARTITION BY target ORDER BY day) AS INTEGER) AS run FROM m)
SELECT target, min(day) AS first, max(day) AS last, count(*) AS n FROM r GROUP BY target, run""")
def missing_intervals(t):
    """Each target's runs of days without a load, from the log's first day to its last."""
    log = _log(t)
    return observe.gaps(log.select("target").distinct(), log.where("phase = 'LOADED'"), "target", "day", observe.day_grid(log, "day")).select("target", "first", "last", "n")


@query("""WITH g AS (SELECT DISTINCT l_suppkey AS target FROM lineitem), b AS (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders),
k AS (SELECT CAST(i AS INTEGER) AS i, CAST(DATE '1995-01-01' + to_months(CAST(i AS INTEGER)) AS DATE) AS m FROM range(0, 90) AS u(i)),
c AS (SELECT i, CASE WHEN i = 0 THEN m + 30 ELSE m + 27 END AS point FROM k),
h AS (SELECT DISTINCT l_suppkey AS target, (year(l_shipdate) - 1995) * 12 + month(l_shipdate) - 1 AS i FROM lineitem WHERE l_shipdate >= TIMESTAMP '1995-01-01'),
m AS (SELECT g.target, c.i, c.point FROM g CROSS JOIN c WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.target = g.target AND h.i = c.i)),
r AS (SELECT *, i - row_number() OVER (PARTITION BY target ORDER BY i) AS run FROM m)
SELECT target, min(point) AS first, max(point) AS last, count(*) AS n FROM r GROUP BY target, run""")
def missing_months(t):
    """Each supplier's runs of months without a shipment, against a grid of months from 1995-01-31 whose day is cut once for all by February."""
    grid = observe.month_grid(t.spark, "1995-01-31", 89).select("i", c("day").alias("at"))
    month = grid.select("at", F.trunc("at", "month").alias("month"))
    shipped = t.lineitem.select(c("l_suppkey").alias("target"), F.trunc("l_shipdate", "month").alias("month")).distinct().join(F.broadcast(month), "month")
    return observe.gaps(t.lineitem.select(c("l_suppkey").alias("target")).distinct(), shipped, "target", "at", grid).select("target", "first", "last", "n")


READY = "r AS (SELECT DISTINCT target FROM log WHERE phase = 'READY' AND seq % 3 = 0), a AS (SELECT DISTINCT target, target % 5 AS source FROM log)"


@query(f"WITH {LOG}, {READY} SELECT a.source, count(*) AS n_targets, count(*) FILTER (r.target IS NULL) AS n_missing FROM a LEFT JOIN r ON a.target = r.target GROUP BY a.source")
def catch_up_report(t):
    log = _log(t)
    targets = log.select("target", (c("target") % 5).alias("source")).distinct()
    return I.catch_up(targets, log.where("seq % 3 = 0"), "target", "source")


@query(f"WITH {LOG}, {READY} SELECT a.source, a.target FROM a WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.target = a.target)")
def catch_up_targets(t):
    log = _log(t)
    return I.not_ready(log.select("target", (c("target") % 5).alias("source")).distinct(), log.where("seq % 3 = 0"), "target").select("source", "target")


@query(f"WITH {LOG} SELECT day, 0::BIGINT AS discovered, count(*) FILTER (phase = 'FETCHED') AS fetched, 0::BIGINT AS normalized, count(*) FILTER (phase = 'READY') AS ready, count(*) FILTER (phase = 'LOADED') AS loaded, 0::BIGINT AS validated, count(*) FILTER (phase = 'FAILED') AS failed FROM log GROUP BY day")
def run_summary(t):
    return I.run_summary(_log(t), "day", "phase")


@query("SELECT count(DISTINCT CAST(o_orderdate AS DATE)) AS n_days, count(*) AS n_documents, min(CAST(o_orderdate AS DATE)) AS first_day, max(CAST(o_orderdate AS DATE)) AS last_day FROM orders")
def target_summary(t):
    return I.target_summary(t.orders, c("o_orderdate").cast("date"))


@query("SELECT l_orderkey AS target, count(*) AS n_shards, bool_and(l_linestatus = 'F') AS complete FROM lineitem GROUP BY l_orderkey")
def target_completion(t):
    return I.completion(t.lineitem.withColumnRenamed("l_orderkey", "target"), "target", c("l_linestatus") == "F")


@query("SELECT l_orderkey, l_linenumber, count(DISTINCT l_partkey) AS n_evidence FROM lineitem GROUP BY ALL HAVING count(DISTINCT l_partkey) > 1")
def ready_conflicts(t):
    return I.ready_conflicts(t.lineitem, ["l_orderkey", "l_linenumber"], "l_partkey")


@query("SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey FROM lineitem GROUP BY ALL")
def idempotent_rerun(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return I.dedupe_batches(rows.unionByName(rows), ["l_orderkey", "l_linenumber"], ["l_partkey"])


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'missing' WHEN o_orderkey % 7 = 1 THEN 'size differs' WHEN o_orderkey % 7 = 2 THEN 'sha256 differs,n_records differs' ELSE '' END AS problems FROM orders")
def artifact_audit(t):
    n = t.orders.select("o_orderkey", S.digest(c("o_orderkey"), c("o_orderstatus")).alias("sha256"), c("o_custkey").alias("size"), F.lit(1).alias("n_records"))
    k = c("o_orderkey") % 7
    files = n.where(k != 0).select("o_orderkey", F.when(k == 2, "x").otherwise(c("sha256")).alias("sha256"), F.when(k == 1, -1).otherwise(c("size")).alias("size"), F.when(k == 2, 9).otherwise(c("n_records")).alias("n_records"))
    return I.audit(n, files, "o_orderkey").withColumn("problems", F.array_join("problems", ","))


@query("""WITH o AS (SELECT strftime(o_orderdate, '%Y-%m') AS m, '{"target": "' || strftime(o_orderdate, '%Y-%m') || '", "order": ' || o_orderkey || '}' || chr(10) AS line, o_orderkey FROM orders),
e AS (SELECT m, CAST(m[6:7] AS INTEGER) AS k, string_agg(line, '' ORDER BY o_orderkey) AS data, count(*) AS n FROM o GROUP BY m)
SELECT m AS target, n AS n_records, sha256(data) AS sha256, CASE k WHEN 1 THEN 'missing' WHEN 2 THEN 'sha256 differs,size differs,n_records differs,stated differs' WHEN 3 THEN 'sha256 differs,size differs' WHEN 4 THEN 'sha256 differs,stated differs' ELSE '' END AS problems FROM e""")
def artifact_audit_files(t):
    """Orders land as a file of JSON lines for each month, some of them altered; entries made from the table are audited against what the files hold."""
    place = shared_place(t.spark, "artifacts")
    month = F.date_format("o_orderdate", "yyyy-MM")
    line = lambda stated: F.concat(F.lit('{"target": "'), stated, F.lit('", "order": '), c("o_orderkey").cast("string"), F.lit("}"))
    own = t.orders.select(month.alias("target"), F.month("o_orderdate").alias("k"), "o_orderkey", line(month).alias("value"), line(F.concat(F.substring(month, 1, 6), F.lit("x"))).alias("other"))
    text = lambda rows, c: F.concat(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", c))), lambda x: x[c]), "\n"), F.lit("\n"))
    months = own.groupBy("target", "k").agg(text(own, "value").alias("data"), text(own, "other").alias("other"), F.count("*").alias("n_records"))
    entries = months.select("target", c("target").alias("stated"), F.sha2(c("data").cast("binary"), 256).alias("sha256"), F.octet_length("data").cast("long").alias("size"), "n_records")
    # an extra record, a blank line at the end, records of another month; the text writer ends each file with a line break
    landed_as = F.when(c("k") == 2, F.concat("data", F.lit("{}"))).when(c("k") == 3, F.concat("data", F.lit(" "))).when(c("k") == 4, F.regexp_replace("other", "\n$", "")).otherwise(F.regexp_replace("data", "\n$", ""))
    months.where("k <> 1").select(c("target").alias("m"), landed_as.alias("value")).repartition("m").write.partitionBy("m").text(place)
    found = landed.artifacts(t.spark, place, {"target": "string"})
    found = found.select(F.regexp_extract("path", "m=([0-9-]+)", 1).alias("target"), c("target").alias("stated"), "sha256", "size", "n_records")
    problems = I.audit(entries, found, "target", ("stated",))
    return entries.join(problems, "target").select("target", "n_records", "sha256", F.array_join("problems", ",").alias("problems"))


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1995-01-01' AND DATE '1996-12-31' AND o_orderdate + INTERVAL 30 DAY <= DATE '1996-06-30'")
def cutoff_filter(t):
    d = c("o_orderdate").cast("date")
    day = lambda x: F.lit(x).cast("date")
    return observe.in_window(t.orders, d, day("1995-01-01"), day("1996-12-31"), F.date_add(d, 30), day("1996-06-30")).select("o_orderkey", d.alias("d"))


@query("SELECT user_id, count(*) AS n, max(event_id) AS last_id FROM events GROUP BY user_id")
def stream_intake(t):
    """Events arrive as files through a file stream, twice; the table holds each once."""
    place = shared_place(t.spark, "intake")
    rows = t.events.select("event_id", "user_id", "value")
    rows.repartition(4, "event_id").write.parquet(f"{place}/landed")
    table = tables.BatchTable(t.spark, f"{place}/table", "event_id long, user_id long, value double", ["event_id"])
    for run in ("a", "b"):  # the second run has a checkpoint of its own, as after a loss, and adds nothing
        I.stream_intake(t.spark, f"{place}/landed", "event_id long, user_id long, value double", f"{place}/checkpoint-{run}", tables.append_new(table, run)).awaitTermination()
    return table.read().groupBy("user_id").agg(F.count("*").alias("n"), F.max("event_id").alias("last_id"))


SNAPSHOTS = "s AS (SELECT o_custkey, year(o_orderdate) AS snapshot, o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS priority, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS price, o_orderstatus AS status FROM orders)"


@query(f"""WITH {SNAPSHOTS} SELECT o_custkey, count(*) AS observations, arg_max(priority, (snapshot, o_orderkey)) FILTER (priority IS NOT NULL) AS priority,
arg_min(price, (snapshot, o_orderkey)) FILTER (price IS NOT NULL) AS first_price, arg_max(status, (snapshot, o_orderkey)) AS status FROM s GROUP BY o_custkey""")
def stream_fold(t):
    """Yearly snapshots of customers land as files, the latest first and one of them twice: properties are folded in load order, observations add up."""
    place = shared_place(t.spark, "fold")
    s = t.orders.select("o_custkey", F.year("o_orderdate").alias("snapshot"), "o_orderkey", F.when(c("o_orderkey") % 3 != 0, c("o_orderpriority")).alias("priority"), F.when(c("o_orderkey") % 5 != 0, c("o_totalprice")).alias("first_price"), c("o_orderstatus").alias("status"))
    s = s.withColumn("at", F.struct("snapshot", "o_orderkey"))
    rules = {"priority": "last_value", "first_price": "first_value", "status": "last_row"}
    entities = tables.FoldedTable(t.spark, f"{place}/entities", s.schema, ["o_custkey"], "at", rules)
    observed = tables.BatchTable(t.spark, f"{place}/observations", s.select("o_orderkey", "o_custkey", "snapshot").schema, ["o_orderkey"])
    landing = s.withColumn("landing", F.when(c("snapshot") >= 1998, 0).otherwise(1))
    for i, wanted in enumerate((0, 1, 0)):
        landing.where(c("landing") == wanted).drop("landing").write.parquet(f"{place}/landed/{i}")
        run = I.stream_intake(t.spark, f"{place}/landed/{i}", s.schema, f"{place}/checkpoint-{i}", tables.both(entities.sink(f"run{i}"), tables.append_new(observed, f"run{i}")))
        run.awaitTermination()
    entities.merge("merged")
    n = observed.read().groupBy("o_custkey").agg(F.count("*").alias("observations"))
    return entities.current().join(n, "o_custkey")


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, CASE WHEN event_id % 2 = 0 THEN 'unexpected or missing keys' END AS problem FROM events")
def strict_json_keys(t):
    lines = t.events.select("event_id", F.when(c("event_id") % 2 == 0, F.regexp_replace("props", r"\}$", ', "x": 1}')).otherwise(c("props")).alias("value"))
    return landed.strict_json(lines, "value", "k string", ["k"]).select("event_id", c("record.k").alias("k"), "problem")


@query("SELECT event_id, day FROM (SELECT event_id, CAST(ts AS DATE) AS day, max(CAST(ts AS DATE)) OVER () AS last FROM events) WHERE day <> last")
def baseline_gate(t):
    day = c("ts").cast("date")
    last = t.events.agg(F.max(day).alias("last"))
    files = t.events.select("event_id", day.alias("day"), F.concat(F.lit("feed_"), F.date_format("ts", "yyyyMMdd"), F.lit(".csv")).alias("file")).join(F.broadcast(last))
    return landed.off_baseline(files, "file", c("last")).select("event_id", "day")


@query("WITH f AS (SELECT event_id, user_id, CAST(ts AS DATE) < last - CAST(user_id % 30 AS INTEGER) AND user_id % 2 = 1 AS off FROM events, (SELECT max(CAST(ts AS DATE)) AS last FROM events)) SELECT user_id, count(*) AS n_files, count(*) FILTER (off) AS n_off FROM f GROUP BY user_id")
def feed_gate(t):
    """Each user's events as a feed of files: odd users' early ones carry another day than the baseline, which refuses the whole feed."""
    day = c("ts").cast("date")
    last = t.events.agg(F.max(day).alias("last"))
    off = (c("user_id") % 2 == 1) & (day < F.date_sub("last", (c("user_id") % 30).cast("int")))
    files = t.events.join(F.broadcast(last)).select("event_id", "user_id", "last", F.concat(F.lit("feed_"), F.date_format(F.when(off, F.date_sub("last", 40)).otherwise(c("last")), "yyyyMMdd")).alias("file"))
    kept, refused = landed.refused_feeds(files, "user_id", "file", c("last"))
    n = files.groupBy("user_id").agg(F.count("*").alias("n_files"))
    taken = kept.groupBy("user_id").agg(F.count("*").alias("n_kept"))
    out = n.join(refused, "user_id", "left").join(taken, "user_id", "left")
    return out.where("coalesce(n_kept, 0) = if(n_off is null, n_files, 0)").select("user_id", "n_files", F.coalesce("n_off", F.lit(0)).alias("n_off"))
