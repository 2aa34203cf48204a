"""Product feeds: each wide row becomes an entity with its lists (identifiers, organisations, classifications, listings,
observations), which explode into tables and edges. A missing column reads as null, so a feed may lack some.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions import scalars as S
from holdfast.operators import mappings as M
from holdfast.operators import stages


def col(rows: DataFrame, name: str) -> Column:
    return rows[name].cast("string") if name in rows.columns else F.lit(None).cast("string")


def source_records(rows: DataFrame, dataset: str, stamp: Column) -> DataFrame:
    """(uri, dataset, snapshot_date, row_number, raw): the cleaned non-blank cells of each row by column name."""
    names = [c for c in rows.columns if c != "row_number"]
    cells = F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*[S.text(rows[c].cast("string")) for c in names]))
    return rows.select(S.source_uri(F.lit(dataset), stamp, rows["row_number"]).alias("uri"), F.lit(dataset).alias("dataset"), stamp.alias("snapshot_date"), "row_number", F.map_filter(cells, lambda _, v: v.isNotNull()).alias("raw"))


def cleaned(rows: DataFrame) -> DataFrame:
    """The rows with each cell's text cleaned, so that what follows reads cells once cleaned and doesn't clean again."""
    return rows.select("row_number", *[S.text(rows[c].cast("string")).alias(c) for c in rows.columns if c != "row_number"])


def properties(rows: DataFrame, texts: dict, numbers: dict = {}, flags: dict = {}, dates: dict = {}) -> list[Column]:  # noqa: B006
    kinds = ((texts, lambda t: t), (numbers, S.number_of), (flags, S.boolean_of), (dates, S.date_of))
    return [read(col(rows, c)).alias(p) for mapping, read in kinds for c, p in mapping.items()]


def classification_list(rows: DataFrame, schemes: dict[str, list[str]]) -> Column:
    """(uri, scheme, code) of the schemes that the row has a code for."""
    def one(scheme: str, columns: list[str]) -> Column:
        code = F.coalesce(*[col(rows, c) for c in columns])
        return F.when(code.isNotNull(), F.struct(S.classification_uri_of(scheme, code).alias("uri"), F.lit(scheme).alias("scheme"), code.alias("code")))
    return F.array_compact(F.array(*[one(s, c) for s, c in schemes.items() if any(x in rows.columns for x in c)])).cast("array<struct<uri: string, scheme: string, code: string>>")


def identifier_list(pairs: list[tuple[str, Column]]) -> Column:
    def one(scheme: str, value: Column) -> Column:
        return F.when(~S.is_placeholder_of(value), F.struct(S.identifier_uri_of(scheme, value).alias("uri"), F.lit(scheme).alias("scheme"), value.alias("value")))
    return F.array_compact(F.array(*[one(s, v) for s, v in pairs]))


def metrics(rows: DataFrame, mapping: dict[str, str]) -> Column:
    """property -> number of the metrics that the row has."""
    there = {c: p for c, p in mapping.items() if c in rows.columns}
    m = F.map_from_arrays(F.array(*map(F.lit, there.values())).cast("array<string>"), F.array(*[S.number_of(col(rows, c)) for c in there]).cast("array<double>"))
    return F.map_filter(m, lambda _, v: v.isNotNull())


def bonds(rows: DataFrame, stamp: Column, dataset: str = "bonds") -> DataFrame:
    """One row each: issue_code (null if sound), uri, source_uri, kind, classes, properties, identifiers, issuer_uri, classifications, as_of, metrics.

    A bond that is traded on the exchange is listed on its bond market.
    """
    rows = cleaned(rows)
    number, isin = F.col("PD_NO"), S.is_isin_of(F.col("PD_NO"))
    rows = rows.withColumns({"_uri": S.security_uri_of(number, S.uri("bond", number)), "_as_of": F.coalesce(S.date_of(col(rows, "PD_STD_INFO_UPDATE")), stamp), "_listed": F.coalesce(col(rows, "PD_EXG_MKT") == M.LISTED_BOND_MARKET, F.lit(False))})
    uri, as_of, listed = F.col("_uri"), F.col("_as_of"), F.col("_listed")
    code, name = M.BOND_MARKET
    return rows.select(
        "row_number", F.when(number.isNull(), F.lit("missing_product_number")).alias("issue_code"), uri.alias("uri"), F.lit("bond").alias("kind"),
        S.source_uri(F.lit(dataset), stamp, F.col("row_number")).alias("source_uri"), F.array(F.lit("Bond")).alias("classes"),
        *properties(rows, M.BOND_PROPERTIES, M.BOND_NUMBERS, dates=M.BOND_DATES), identifier_list([("ISIN", F.when(isin, number)), ("PD_NO", F.when(~isin, number))]).alias("identifiers"),
        S.organization_uri_of("name", col(rows, "PD_PBCM")).alias("issuer_uri"), classification_list(rows, M.BOND_CLASSIFICATIONS).alias("classifications"),
        listed.alias("listed"), F.when(listed, S.uri("listing", F.lit(dataset), F.lit("krx-bond"), number)).alias("listing_uri"), F.when(listed, S.uri("market", F.lit("krx-bond"))).alias("market_uri"),
        F.when(listed, F.lit(code)).alias("market_code"), F.when(listed, F.lit(name)).alias("market_name"), as_of.alias("as_of"),
        S.observation_uri(uri, as_of).alias("observation_uri"), metrics(rows, M.BOND_METRICS).alias("metrics"), col(rows, "CRD_GRD").alias("creditGrade"),
    )


def exchange_products(rows: DataFrame, dataset: str, stamp: Column, isin_column: str) -> DataFrame:
    """One row each of an exchange-product feed; kind is note or fund, and a fund has a unit, which is what is held and traded.

    A listing needs a ticker and a market; it, its market and its observation are those of the dataset.
    """
    rows = cleaned(rows)
    read = lambda *names: F.coalesce(*[col(rows, n) for n in names])
    day = lambda *names: F.coalesce(*[S.date_of(col(rows, n)) for n in names], stamp)
    note = (F.upper(col(rows, "pd_grp_no")) == "ETN") | S.boolean_of(col(rows, "cu_etn_yn"))
    rows = rows.withColumns({
        "_ticker": read("pd_itm_no_ma", "pd_itm_no"), "_market": read("pd_exg_mkt_cd", "pd_mkt_id"), "_note": F.coalesce(note, F.lit(False)),
        "_market_day": day("du_clpr_base_dt", "du_upt_dt"), "_fund_day": day("du_upt_dt", "cu_upt_dt"), "_offered": S.boolean_of(col(rows, "pd_sale_yn")),
    })
    item, ticker, market, isin = col(rows, "pd_itm_no"), F.col("_ticker"), F.col("_market"), col(rows, isin_column)
    fallback = S.uri(dataset, F.coalesce(col(rows, "pd_exg_mkt_cd"), F.lit("unknown-market")), ticker)
    rows = rows.withColumns({"_uri": S.security_uri_of(isin, fallback), "_listing": F.when(ticker.isNotNull() & market.isNotNull(), S.uri("listing", F.lit(dataset), market, ticker))})
    uri, listing, note, market_day, fund_day, offered = (F.col(c) for c in ("_uri", "_listing", "_note", "_market_day", "_fund_day", "_offered"))
    if_listed = lambda c: F.when(listing.isNotNull(), c)
    return rows.select(
        "row_number", F.when(item.isNull(), F.lit("missing_item_number")).alias("issue_code"), uri.alias("uri"), F.when(note, "note").otherwise("fund").alias("kind"),
        S.source_uri(F.lit(dataset), stamp, F.col("row_number")).alias("source_uri"), F.when(~note, F.concat(uri, F.lit(":unit"))).alias("unit_uri"), F.array(F.when(note, "ETN").otherwise("ETF")).alias("classes"),
        F.when(~note, F.array(*map(F.lit, M.EXCHANGE_UNIT_CLASSES))).alias("unit_classes"),
        F.when(offered.isNotNull() & item.isNotNull(), S.uri("offering", F.lit(dataset), item)).alias("offering_uri"), if_listed(S.uri("market", F.lit(dataset), market)).alias("market_uri"),
        if_listed(S.observation_uri(listing, market_day)).alias("market_observation_uri"), if_listed(S.date_of(col(rows, "pd_lstg_dt"))).alias("listing_date"),
        if_listed(S.number_of(col(rows, "pd_lst_price"))).alias("listing_price"), if_listed(S.number_of(col(rows, "pd_lst_stk_cnt"))).alias("listed_share_count"),
        if_listed(col(rows, "du_clpr_src")).alias("close_price_source"),
        *properties(rows, M.EXCHANGE_PROPERTIES, M.EXCHANGE_NUMBERS, M.EXCHANGE_FLAGS), read("pd_curr_cd", "pd_trd_ccy").alias("currency"),
        F.upper(col(rows, "pd_grp_no")).alias("productGroup"), identifier_list([("ISIN", F.when(S.is_isin_of(isin), isin)), ("SOURCE_ITEM", item), ("LISTING_TICKER", ticker)]).alias("identifiers"),
        S.organization_uri_of("name", col(rows, "cu_fund_mgmt_co")).alias("organization_uri"), S.benchmark_uri_of(col(rows, "cu_base_index"), F.lit(None).cast("string")).alias("benchmark_uri"),
        classification_list(rows, M.EXCHANGE_CLASSIFICATIONS).alias("classifications"), listing.alias("listing_uri"), ticker.alias("ticker"), market.alias("market_code"),
        read("pd_mkt_nm", "pd_mkt_id", "_market").alias("market_name"), if_listed(market_day).alias("market_as_of"),
        if_listed(metrics(rows, M.MARKET_METRICS)).alias("market_metrics"), fund_day.alias("as_of"), S.observation_uri(uri, fund_day).alias("observation_uri"),
        metrics(rows, M.FUND_METRICS).alias("metrics"), offered.alias("availableForSale"), S.boolean_of(col(rows, "pd_tr_yn")).alias("tradingHalted"),
    )


def public_funds(rows: DataFrame, stamp: Column, dataset: str = "public-funds", firm_item: str | None = None) -> DataFrame:
    """One row each of the public-fund feed: a fund, its unit, its offering, and a listing if it is exchange-traded.

    Item numbers have the shape of an ISIN, and only such make a fund, but they are never asserted as ISINs. What is exchange-traded is told by its
    name or short name, and its venue isn't known. ``firm_item`` names the column of the distributor's own item number.
    """
    rows = cleaned(rows)
    item, short = col(rows, "itm_no"), col(rows, "itm_abrv_nm")
    name = F.coalesce(col(rows, "itm_nm"), item)
    local, latin = M.NAME_HEURISTIC
    etf = F.contains(name, F.lit(local)) | F.contains(F.upper(name), F.lit(latin)) | F.coalesce(F.contains(F.upper(short), F.lit(latin)), F.lit(False))
    rows = rows.withColumns({"_name": name, "_etf": F.coalesce(etf, F.lit(False)), "_uri": S.uri("public-fund", item), "_item": S.uri_component(item)})
    uri, etf = F.col("_uri"), F.col("_etf")
    of_item = lambda kind: F.concat(F.lit(f"{S.URN}:{kind}:{dataset}:"), F.col("_item"))
    listing = F.when(etf, F.concat(F.lit(f"{S.URN}:listing:{dataset}:krx-unspecified:"), F.col("_item")))
    code, venue = M.UNKNOWN_VENUE
    numbers = [("SOURCE_ITEM", "itm_no"), ("STD_ITEM", "std_itm_no"), ("KSD_ITEM", "ksd_itm_no"), ("REPRESENTATIVE_KSD_ITEM", "rptt_ksd_itm_no"), ("FSS_ITEM", "fss_itm_no"), ("FIRM_ITEM", firm_item)]
    unit = {k: F.array(*map(F.lit, v)) for k, v in M.PUBLIC_UNIT_CLASSES.items()}
    return rows.select(
        "row_number", F.when(~S.is_source_key_of(item), F.lit("malformed_item_number")).alias("issue_code"), uri.alias("uri"), F.lit("fund").alias("kind"), F.concat(uri, F.lit(":unit")).alias("unit_uri"),
        S.source_uri(F.lit(dataset), stamp, F.col("row_number")).alias("source_uri"), item.alias("sourceItemNumber"), F.col("_name").alias("name"),
        *properties(rows, M.PUBLIC_PROPERTIES, flags=M.PUBLIC_FLAGS), col(rows, "rptt_ksd_itm_no").alias("representativeKsdItemNumber"), F.when(etf, F.lit("name heuristic")).alias("exchangeTradedClassification"),
        F.when(etf, F.array(F.lit("ETF"), F.lit("PublicFund"))).otherwise(F.array(F.lit("MutualFund"), F.lit("PublicFund"))).alias("classes"), F.when(etf, unit[True]).otherwise(unit[False]).alias("unit_classes"),
        identifier_list([(s, col(rows, c)) for s, c in numbers if c in rows.columns]).alias("identifiers"), S.organization_uri_of("source-code", col(rows, "or_co_xtn_itt_cd")).alias("organization_uri"),
        S.benchmark_uri_of(col(rows, "bmrk_nm"), col(rows, "bmrk_eng_nm")).alias("benchmark_uri"), classification_list(rows, M.PUBLIC_CLASSIFICATIONS).alias("classifications"),
        listing.alias("listing_uri"), F.when(etf, S.uri("market", F.lit("krx-unspecified"))).alias("market_uri"), F.when(etf, F.lit(code)).alias("market_code"), F.when(etf, F.lit(venue)).alias("market_name"),
        F.when(etf, F.lit(True)).alias("listingInferredFromName"), F.when(etf, S.observation_uri(listing, stamp)).alias("market_observation_uri"), F.when(etf, stamp).alias("market_as_of"),
        stamp.alias("as_of"), S.observation_uri(uri, stamp).alias("observation_uri"), metrics(rows, M.PUBLIC_FUND_METRICS).alias("metrics"), of_item("offering").alias("offering_uri"),
        col(rows, "sale_yn").alias("saleStatus"), S.boolean_of(col(rows, "sale_yn")).alias("availableForSale"), S.boolean_of(col(rows, "thco_sale_yn")).alias("availableThroughFirm"), col(rows, "pfiv_sale_cntl_tcd").alias("saleControlType"),
    )


def unpivot(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(keys, metric, value): one row for each value that is there."""
    return rows.unpivot(keys, columns, "metric", "value").where("value is not null")


def edges(entities: DataFrame) -> DataFrame:
    """Distinct (src, rel, dst) from entities' lists and links, in one pass; only sound rows make edges.

    What is held and traded hangs on a fund's unit where there is one, what is run on the fund itself.
    """
    have = set(entities.columns)
    column = lambda name: F.col(name) if name in have else F.lit(None).cast("string")
    edge = lambda src, rel, dst: F.struct(src.alias("src"), rel.alias("rel"), dst.alias("dst"))
    item = F.coalesce(column("unit_uri"), F.col("uri"))
    of = lambda name, rel, src=item: edge(src, F.lit(rel), column(name))
    each = lambda name, rel: F.transform(F.col(f"{name}.uri"), lambda u: edge(item, F.lit(rel), u))
    lists = [each(name, rel) for name, rel in (("identifiers", "HAS_IDENTIFIER"), ("classifications", "CLASSIFIED_AS")) if name in have]
    if "classes" in have:
        lists.append(F.transform("classes", lambda x: edge(F.col("uri"), F.lit("INSTANCE_OF"), F.concat(F.lit(f"{S.URN}:class:"), x))))
    if "unit_classes" in have:
        lists.append(F.coalesce(F.transform("unit_classes", lambda x: edge(F.col("unit_uri"), F.lit("INSTANCE_OF"), F.concat(F.lit(f"{S.URN}:class:"), x))), F.array()))
    runs = F.when(F.col("kind") == "note", "ISSUED_BY").otherwise("MANAGED_BY")
    links = [
        of("issuer_uri", "ISSUED_BY"), edge(F.col("uri"), runs, column("organization_uri")), of("benchmark_uri", "TRACKS", F.col("uri")), of("unit_uri", "HAS_UNIT", F.col("uri")),
        of("observation_uri", "HAS_OBSERVATION"), of("listing_uri", "LISTED_AS"), edge(column("listing_uri"), F.lit("ON_MARKET"), column("market_uri")),
        edge(column("listing_uri"), F.lit("HAS_OBSERVATION"), column("market_observation_uri")), edge(column("offering_uri"), F.lit("OFFERS"), item),
        edge(column("source_uri"), F.lit("DESCRIBES"), F.col("uri")), edge(column("source_uri"), F.lit("DESCRIBES"), column("unit_uri")),
    ]
    found = entities.where("issue_code is null").select(F.explode(F.concat(*lists, F.array(*links))).alias("e")).select("e.*")
    # edges are many times their feed and hardly ever repeat: none are gathered in the task that reads the feed
    return stages.spread(found.where("src is not null and dst is not null"), "src", "rel", "dst").distinct()
