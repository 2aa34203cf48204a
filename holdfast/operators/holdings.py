"""Holdings documents: positions become typed records or go to quarantine with the first reason that applies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.functions import scalars as S
from holdfast.operators import identity, quality, skew, stages

# Fixed values
WEIGHT_SOURCES = ["source_published", "derived_from_value"]
IDENTIFIER_METHODS = ["source_isin", "crosswalk", "unresolved"]
EVIDENCE_BASES = ["manager_published", "regulatory_filing"]


def _invalid(raw: str, value: str) -> Column:
    return F.col(raw).isNotNull() & F.col(value).isNull()


def _sorted_out(rows: DataFrame, negative_value: bool) -> DataFrame:
    """Adds weight, weight_source and reason. ``rows``: unresolved_reason, document_total, name and raw / parsed balance, percent, value."""
    rows = rows.withColumnRenamed("document_total", "total")
    derived = F.when((F.col("total") > 0) & F.col("market_value").isNotNull(), F.col("market_value") / F.col("total"))
    weight = F.coalesce(F.col("percent") / 100, derived)
    checks = [
        (F.col("unresolved_reason").isNotNull(), F.col("unresolved_reason")),
        (F.col("name").isNull(), "missing name"),
        (_invalid("raw_quantity", "quantity"), "invalid quantity"),
        (_invalid("raw_percent", "percent"), "invalid weight"),
        (_invalid("raw_value", "market_value"), "invalid market value"),
        (F.col("quantity") < 0, F.concat(F.lit("quantity is negative: "), F.col("quantity").cast("string"))),
        *([(F.col("market_value") < 0, "market value is negative")] if negative_value else []),
        (F.col("percent") < 0, "weight is negative"),
        (F.col("percent") > 100, "weight exceeds 1.0"),
        (F.col("percent").isNull() & F.col("market_value").isNull(), "neither weight nor market value"),
        (F.col("percent").isNull() & F.col("total").isNull(), "document total unknown"),
        (F.col("percent").isNull() & (F.col("total") <= 0), "document total is not positive"),
    ]
    rows = rows.withColumn("weight", weight).withColumn("weight_source", F.when(F.col("percent").isNotNull(), WEIGHT_SOURCES[0]).otherwise(WEIGHT_SOURCES[1]))
    return rows.withColumn("reason", quality.first_reason(*checks))


def normalise_filings(positions: DataFrame, mapping: DataFrame) -> DataFrame:
    """Positions of filings (see ``landed.filings_xml``), resolved and weighed against the strict total of their document."""
    rows = positions.select("*", S.number(F.col("balance")).alias("quantity"), S.number(F.col("percent")).alias("pct"), S.number(F.col("value")).alias("market_value"), F.lit("cusip").alias("key_type"))
    rows = rows.select("document", "report_date", F.col("position").alias("row"), "name", "isin", "key_type", F.col("cusip").alias("key"), F.col("balance").alias("raw_quantity"), "quantity", F.col("percent").alias("raw_percent"), F.col("pct").alias("percent"), F.col("value").alias("raw_value"), "market_value", "currency")
    total = quality.document_totals(rows, "document", "market_value", strict=True)
    return _sorted_out(identity.resolve(rows, mapping, "isin", "key_type", "key").join(total, "document"), negative_value=False)


def normalise_baskets(rows: DataFrame, mapping: DataFrame) -> DataFrame:
    """Rows of baskets (see ``landed.basket_csv``), weighed against the positive total; KRW where only a value is stated."""
    n = S.percent_number
    out = rows.select("document", S.multi_date(F.col("as_of")).alias("report_date"), F.col("row_number").alias("row"), "name", F.col("source_isin").alias("isin"), F.lit("krx_code").alias("key_type"), F.col("krx_code").alias("key"), F.col("quantity").alias("raw_quantity"), n(F.col("quantity")).alias("quantity"), F.col("weight_pct").alias("raw_percent"), n(F.col("weight_pct")).alias("percent"), F.col("market_value").alias("raw_value"), n(F.col("market_value")).alias("market_value"), F.col("currency").alias("stated_currency"))
    out = out.withColumn("currency", F.coalesce(F.upper("stated_currency"), F.when(F.col("market_value").isNotNull(), "KRW"))).drop("stated_currency")
    total = quality.document_totals(out, "document", "market_value", strict=False)
    return _sorted_out(identity.resolve(out, mapping, "isin", "key_type", "key").join(total, "document"), negative_value=True)


def reject_other_days(rows: DataFrame, target_day: Column, required: bool, day: Column | None = None) -> DataFrame:
    """Rows of the documents that state no other day than their target's; if ``required``, a day must be stated.

    ``day`` is what a row states, its report_date by default: rows are best rejected as they are read, before they are normalised.
    """
    other = (F.col("report_date") if day is None else day) != target_day
    return quality.reject_documents(rows, "document", F.coalesce(other, F.lit(required)))


def contract(rows: DataFrame) -> Column:
    """The names of the record rules that a row breaks."""
    finite = lambda c: F.col(c).isNull() | (~F.isnan(c) & (F.abs(c) < float("inf")))
    return quality.violations({
        "fund_isin": S.is_isin(F.col("fund_isin")), "constituent_isin": S.is_isin(F.col("constituent_isin")), "constituent_name": S.text(F.col("constituent_name")).isNotNull(),
        "weight": F.col("weight").between(0, 1) & ~F.isnan("weight"), "as_of": F.col("as_of").isNotNull(), "source_quantity": finite("source_quantity"), "source_market_value": finite("source_market_value"),
        "weight_source": F.col("weight_source").isin(WEIGHT_SOURCES), "identifier_method": F.col("identifier_method").isin(IDENTIFIER_METHODS), "evidence_basis": F.col("evidence_basis").isin(EVIDENCE_BASES),
        "source_document_id": S.text(F.col("source_document_id")).isNotNull(), "source_url": S.text(F.col("source_url")).isNotNull(), "source_row_id": S.text(F.col("source_row_id")).isNotNull(),
    })


def to_graph(records: DataFrame, run: Column | None = None) -> dict[str, DataFrame]:
    """Snapshots, positions and edges of records. A position keeps the published name; product names aren't touched.

    With a ``run``, the same for all records, what it wrote and what artifact each position comes from are edges too.
    Edges are many and long, and each follows from a few columns of its record, so these are made distinct, and the edges from
    them. Only edges that lack an end are made distinct as they are.
    """
    uris = {
        "fund_uri": S.uri("isin", F.col("fund_isin")), "security_uri": S.uri("isin", F.col("constituent_isin")),
        "snapshot_uri": S.uri("snapshot", F.col("fund_isin"), F.col("as_of").cast("string"), F.col("source_document_id")),
        "position_uri": S.uri("position", F.col("fund_isin"), F.col("constituent_isin"), F.col("as_of").cast("string"), F.col("source_document_id"), F.col("source_row_id")),
    }
    r = records.withColumns(uris)
    holds, dated = ["fund_isin", "constituent_isin"], ["fund_isin", "as_of", "source_document_id"]
    placed = ["fund_isin", "constituent_isin", "as_of", "source_document_id", "source_row_id"]
    ties = [(holds, "fund_uri", "HOLDS", "security_uri"), (dated, "fund_uri", "HAS_SNAPSHOT", "snapshot_uri"), (placed, "snapshot_uri", "HAS_POSITION", "position_uri"), (placed, "position_uri", "OF_SECURITY", "security_uri")]
    snapshots = r.select(F.col("snapshot_uri").alias("uri"), "fund_uri", "as_of", "source_document_id").distinct()
    positions = r.select(F.col("position_uri").alias("uri"), "snapshot_uri", "security_uri", "constituent_name", "weight", "source_quantity", "source_market_value", "source_currency")
    if run is not None:
        uris |= {"_artifact_uri": S.uri("artifact", F.col("source_document_id")), "_run_uri": S.uri("run", F.col("_run"))}
        records = records.withColumn("_run", run)
        holds, dated, placed = (keys + ["_run"] for keys in (holds, dated, placed))
        ties = [(keys + ["_run"], *tie) for keys, *tie in ties]
        ties += [(placed, "snapshot_uri", "HAS_HOLDING", "position_uri"), (placed, "position_uri", "DERIVED_FROM", "_artifact_uri"), (dated, "_run_uri", "UPSERTED", "snapshot_uri"), (placed, "_run_uri", "UPSERTED", "position_uri")]

    def made(rows: DataFrame, own: list, more: list | None = None) -> DataFrame:
        """The edges ``own`` of each row, and ``more`` of the rows marked ``_first``."""
        rows = rows.withColumns({u: uris[u] for u in dict.fromkeys(x for _, a, _, b in own + (more or []) for x in (a, b))})
        of = lambda ties: F.array(*[F.struct(F.col(a).alias("src"), F.lit(rel).alias("rel"), F.col(b).alias("dst")) for _, a, rel, b in ties])
        found = F.concat(of(own), F.when(F.col("_first"), of(more)).otherwise(F.array())) if more else of(own)
        return rows.select(F.explode(found).alias("e")).select("e.*")

    def whole(keys: list) -> DataFrame:
        return records.where(" and ".join(f"{k} is not null" for k in keys if k != "_run"))

    # dealt without the run: a constant among the keys of a shuffle isn't known again in those of an aggregation, which then shuffles anew.
    # A snapshot's records come together, so one shuffle does for its own edges, made at its first record, and for those of its positions
    tied = stages.spread(whole(holds).select(*holds), "fund_isin", "constituent_isin").distinct()
    day = ["fund_isin", "as_of", "source_document_id"]
    first = F.row_number().over(Window.partitionBy(*day).orderBy("constituent_isin")) == 1
    laid = stages.spread(whole(dated).select(*placed), *day).distinct().withColumn("_first", first)
    parts = [made(rows, own, more).where("src is not null and dst is not null") for rows, own, more in ((tied, [t for t in ties if t[0] == holds], None), (laid, [t for t in ties if t[0] == placed], [t for t in ties if t[0] == dated]))]
    lacking = records.where(" or ".join(f"{k} is null" for k in placed))
    parts.append(made(lacking, ties).where("src is null or dst is null").distinct())
    return {"snapshots": snapshots, "positions": positions.dropDuplicates(["uri"]), "edges": reduce(DataFrame.unionByName, parts)}


def exposures(positions: DataFrame, snapshots: DataFrame) -> DataFrame:
    """(security_uri, fund_uri, as_of, weight, market_value): who holds each security."""
    held = positions.select("security_uri", F.col("snapshot_uri").alias("uri"), "weight", "source_market_value")
    return held.join(snapshots.select("uri", "fund_uri", "as_of"), "uri").groupBy("security_uri", "fund_uri", "as_of").agg(F.sum("weight").alias("weight"), F.sum("source_market_value").alias("market_value"))


def exposure(positions: DataFrame, snapshots: DataFrame, security: Column) -> DataFrame:
    """(fund_uri, as_of, weight, market_value): who holds a security."""
    return exposures(positions.where(F.col("security_uri") == security), snapshots).drop("security_uri")


def shares(rows: DataFrame, value: str) -> DataFrame:
    """(fund, security, weight): each security's share in what its fund holds, by one shuffle of the rows."""
    own = stages.spread(rows.select("fund", "security", value), "fund").groupBy("fund", "security").agg(F.sum(value).alias("_own"))
    return own.select("fund", "security", (F.col("_own") / F.sum("_own").over(Window.partitionBy("fund"))).alias("weight"))


def _on_cycles(held: DataFrame, funds: DataFrame, rounds: int) -> DataFrame:
    """(fund): all funds on cycles of fund-in-fund holdings and some between them: ends that nothing goes on from or leads to are taken off.

    At first only those that nothing leads to, as that shuffles no holdings but the funds that are reached; where these rounds
    leave none, there is no cycle.
    """
    left, n = funds, None
    for _ in range(rounds):
        reached = held.join(left, "fund", "left_semi").select(F.col("security").alias("fund")).distinct()
        left = stages.bucketed(left.join(reached, "fund", "left_semi"), "look-through-reached", "fund")
        before, n = n, left.count()
        if n in (0, before):
            break
    if n == 0:
        return left
    left, n = held.join(left, "fund", "left_semi").join(left.select(F.col("fund").alias("security")), "security", "left_semi"), None
    for _ in range(rounds):
        left = left.join(left.select(F.col("security").alias("fund")).distinct(), "fund", "left_semi")
        left = left.join(left.select(F.col("fund").alias("security")).distinct(), "security", "left_semi")
        left = stages.written(left.select("fund", "security"), "look-through-cycles")
        before, n = n, left.count()
        if n in (0, before):
            break
    return left.select("fund").distinct()


#: So many rows of holdings are broadcast at most.
_FEW = 200_000


class _Rounds:
    """What the rounds of ``look_through`` have in common: holdings in buckets by fund, and how a round's sums meet them.

    A round's sums are two tables: ``even``, in buckets by fund, and ``wide``, those of the securities that more than ``per`` products
    add up to, which lie anyhow.
    """

    def __init__(self, held: DataFrame, depth: int, per: int):
        self.per, self.spark = per, held.sparkSession
        self.held = stages.bucketed(held, "look-through-held", "fund")
        self.funds = stages.bucketed(self.held.select("fund").distinct(), "look-through-funds", "fund")
        self.on_cycle = stages.written(_on_cycles(self.held, self.funds, depth), "look-through-tracked")
        self.passed = [] if self.on_cycle.isEmpty() else ["through"]
        self.steps = self.held.withColumnRenamed("weight", "_share")
        self.marks = ["_tracked"] if self.passed else []
        if self.passed:
            marks = self.on_cycle.select(F.col("fund").alias("security"), F.lit(True).alias("_tracked"))
            steps = self.steps.join(marks, "security", "left").select("fund", "security", "_share", F.coalesce("_tracked", F.lit(False)).alias("_tracked"))
            self.steps = stages.bucketed(stages.spread(steps, "fund"), "look-through-steps", "fund")
        many = stages.written(skew.hot(self.held.groupBy("fund").agg(F.count("*").alias("n")), ["fund"], per), "look-through-large")
        self.many = None if many.isEmpty() else many
        self.even = self.wide = None

    def start(self, roots: DataFrame) -> None:
        start = roots.select("root").where("root is not null").distinct().join(self.on_cycle.select(F.col("fund").alias("root"), F.lit(True).alias("_on")), "root", "left")
        none = F.array().cast(f"array<{dict(self.held.dtypes)['fund']}>")
        through = F.when(F.col("_on"), F.array("root")).otherwise(none).alias("through")
        start = start.select("root", F.col("root").alias("fund"), through, F.lit(1.0).alias("weight")).select("root", "fund", *self.passed, "weight")
        self.even = stages.bucketed(stages.spread(start, "fund"), "look-through-round", "fund")
        # the work of few roots is dealt by what they hold too
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.deals = 1 if self.even.count() >= 10 * n else n

    def _met(self, steps: DataFrame, large: bool, only: Column | None = None) -> DataFrame:
        """The last sums beside the holdings of their funds; ``large``: those of funds with more than ``per`` holdings are dealt over salts."""
        def own(df):
            return df.where(only) if only is not None else df

        many = F.broadcast(self.many) if large and self.many is not None else None
        few = steps.join(many, "fund", "left_anti") if many is not None else steps
        met = [own(self.even).join(few, "fund")]
        if self.wide is not None:
            beside = steps.join(F.broadcast(self.wide.select("fund").distinct()), "fund", "left_semi")
            beside = stages.written(beside, "look-through-beside")
            met.append(own(self.wide).join(F.broadcast(beside) if beside.count() <= _FEW else beside, "fund").select(*met[0].columns))
        if many is not None:
            dealt = skew.dealt(steps.join(many, "fund", "left_semi"), ["fund"], self.many, F.col("security"))
            met.append(skew.copied(own(self.even).join(many, "fund", "left_semi"), ["fund"], self.many).join(dealt, ["fund", "_salt"]).select(*met[0].columns))
        return reduce(DataFrame.unionByName, met)

    def _products(self, met: DataFrame, *more: str) -> DataFrame:
        if self.passed:
            through = F.when(F.col("_tracked"), F.array_sort(F.array_append("through", F.col("security")))).otherwise(F.col("through"))
            met = met.where(~F.array_contains("through", F.col("security"))).withColumn("through", through)
        return met.select("root", F.col("security").alias("fund"), *self.passed, *more, (F.col("weight") * F.col("_share")).alias("weight"))

    def go_on(self) -> None:
        keys = ["root", "fund", *self.passed]
        counts = [df.groupBy("fund").agg(F.count("*").alias("n")) for df in (self.even, self.wide) if df is not None]
        counts = counts[0] if len(counts) == 1 else counts[0].unionByName(counts[1]).groupBy("fund").agg(F.sum("n").alias("n"))
        hot = stages.written(skew.hot(counts.join(self.steps, "fund").groupBy("security").agg(F.sum("n").alias("n")), ["security"], self.per), "look-through-hot")
        n_hot = hot.agg(F.sum("salts")).first()[0] or 0
        apart = F.broadcast(hot.select("security"))
        mark = self.funds.withColumn("is_fund", F.lit(True))
        wide = None
        if n_hot:
            wide = []
            cols = ["security", "_share", *self.marks]
            lists = self.steps.join(apart, "security").groupBy("fund").agg(F.sort_array(F.collect_list(F.struct(*cols))).alias("l"))
            # one row for each sum and fund is shuffled, not one for each product
            lists = stages.bucketed(lists.select("fund", *[F.col(f"l.{x}").alias(x) for x in cols]), "look-through-lists", "fund")
            known = stages.written(hot.select(F.col("security").alias("fund")).join(mark, "fund", "left"), "look-through-known")
            slices = -(-n_hot * self.per // _AT_ONCE)
            for k in range(slices):
                met = self._met(lists, False, F.pmod(F.xxhash64("root"), F.lit(slices)) == k if slices > 1 else None)
                met = stages.spread(met.select("root", *self.passed, "weight", *cols, F.pmod(F.xxhash64("fund"), F.lit(self.deals)).alias("_deal")), "root", "_deal")
                met = met.select("root", *self.passed, "weight", "_deal", F.inline(F.arrays_zip(*cols)))
                sums = self._products(met, "_deal").groupBy(*keys, "_deal").agg(F.sum("weight").alias("weight"))
                sums = sums.drop("_deal") if self.deals == 1 else sums.groupBy(*keys).agg(F.sum("weight").alias("weight"))
                wide.append(stages.written(sums.join(F.broadcast(known), "fund"), "look-through-wide"))
            wide = reduce(DataFrame.unionByName, wide)
        steps = self.steps.join(apart, "security", "left_anti") if n_hot else self.steps
        sums = stages.spread(self._products(self._met(steps, True)), "fund").groupBy(*keys).agg(F.sum("weight").alias("weight"))
        self.even, self.wide = stages.bucketed(sums.join(mark, "fund", "left"), "look-through-round", "fund"), wide

    def sums(self) -> list[DataFrame]:
        return [df.select("root", F.col("fund").alias("security"), "weight", F.coalesce("is_fund", F.lit(False)).alias("is_fund")) for df in (self.even, self.wide) if df is not None]


#: So many products to large securities are on their way at once; more take turns by their roots.
_AT_ONCE = 500_000_000


def look_through(roots: DataFrame, held: DataFrame, depth: int, per: int = 1_000_000, value: str | None = None) -> DataFrame:
    """(root, security, depth, weight, is_fund): what each root holds, through the funds that it holds, in up to ``depth`` steps.

    ``held``: (fund, security, weight), where a security may be a fund itself; with ``value``, a weight is the ``shares`` of that column. Weights multiply along a chain and add up over
    chains; depth is the least. A chain stops where it would come back to a fund that it went through. Each round carries on
    the sums of the last one by (root, security) alone; only funds that may lie on a cycle are remembered beside them, and nothing is
    where no fund may. Holdings are written in buckets by fund, and so are a round's sums, which the next one reads without a
    shuffle. Of securities that more than ``per`` products add up to, all of a fund's are shuffled as one row, dealt by their root, some of the roots at a time, so that the disk
    doesn't hold all products. A fund with more than ``per`` holdings is split over salts. Shuffles are freed as each round is written.
    """
    whole = held.where("fund is not null and security is not null and weight is not null") if value is None else held.where("fund is not null")
    if value is None:
        whole = stages.spread(whole.select("fund", "security", "weight"), "fund").groupBy("fund", "security").agg(F.sum("weight").alias("weight"))
    else:
        whole = shares(whole, value).where("security is not null and weight is not null")
    found = []
    with stages.shuffles_freed(held.sparkSession):
        rounds = _Rounds(whole, depth, per)
        rounds.start(roots)
        for i in range(1, depth + 1):
            rounds.go_on()
            found += [df.withColumn("depth", F.lit(i)) for df in rounds.sums()]
            if rounds.wide is None and rounds.even.isEmpty():
                break
    return reduce(DataFrame.unionByName, found).groupBy("root", "security").agg(F.min("depth").alias("depth"), F.sum("weight").alias("weight"), F.max("is_fund").alias("is_fund"))
