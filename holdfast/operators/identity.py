"""Identity resolution through reviewed identifiers only; names never join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.functions import scalars as S

#: Most crosswalk rows that are broadcast; more are joined by a shuffle.
SMALL_CROSSWALK = 100_000
# Fixed values
CASELESS_KEYS = ["isin", "cusip", "krx_code", "ticker", "figi", "lei"]


def mapping_key(kind: Column, value: Column) -> Column:
    """Identifier-like keys are compared in upper case, others as they are."""
    return F.when(F.lower(kind).isin(CASELESS_KEYS), F.upper(S.text(value))).otherwise(S.text(value))


def index(crosswalk: DataFrame) -> DataFrame:
    """(kind, key, isin) of the reviewed rows that map to an ISIN; mappings that conflict are left out (see ``conflicts``)."""
    rows = crosswalk.where(S.text(F.col("reviewed_by")).isNotNull() & (F.lower("standard_id_type") == "isin") & S.is_isin(F.col("standard_id")))
    keyed = rows.select(F.lower("local_key_type").alias("kind"), F.upper(S.text(F.col("local_key"))).alias("key"), F.upper(S.text(F.col("standard_id"))).alias("isin"))
    return keyed.groupBy("kind", "key").agg(F.min("isin").alias("isin"), F.max("isin").alias("_other")).where("isin = _other").drop("_other")


def conflicts(rows: DataFrame, keys: list[str], standard: str) -> DataFrame:
    """Keys that map to more than one standard identifier."""
    return rows.groupBy(*keys).agg(F.countDistinct(standard).alias("n_ids")).where("n_ids > 1")


def listings(rows: DataFrame, security: str, venue: str, most: int = 50) -> DataFrame:
    """(security, n_venues, venues): securities on more than one venue, with the first ``most`` venues in order.

    Distinct pairs are ranked by a window of a security's venues only, so no list grows beyond ``most``; n_venues counts all.
    """
    pairs = rows.select(security, venue).where(F.col(venue).isNotNull()).distinct()
    many = pairs.groupBy(security).agg(F.count("*").alias("n_venues")).where("n_venues > 1")
    shown = pairs.withColumn("_k", F.row_number().over(Window.partitionBy(security).orderBy(venue))).where(F.col("_k") <= most)
    return many.join(shown.groupBy(security).agg(F.array_sort(F.collect_list(venue)).alias("venues")), security)


def resolve(rows: DataFrame, mapping: DataFrame, isin: str, kind: str, key: str) -> DataFrame:
    """Adds constituent_isin, identifier_method and unresolved_reason.

    A source ISIN counts if well-formed; if it is there but isn't, nothing else is tried. Otherwise the mapping decides.
    """
    small = mapping.limit(SMALL_CROSSWALK + 1).count() <= SMALL_CROSSWALK
    side = mapping.select(F.col("kind").alias("_kind"), F.col("key").alias("_key"), F.col("isin").alias("_isin"))
    # each cell is read once, below the join; above it all is decided from what was read
    read = rows.withColumns({"_stated": S.usable_identifier(rows[isin]), "_k": F.lower(rows[kind]), "_v": F.upper(S.text(rows[key]))})
    read = read.withColumns({"_stated": F.upper("_stated"), "_good": F.upper("_stated").rlike(S.ISIN_SHAPE)})
    j = read.join(F.broadcast(side) if small else side, (F.col("_k") == F.col("_kind")) & (F.col("_v") == F.col("_key")), "left")
    stated, good = F.col("_stated").isNotNull(), F.coalesce("_good", F.lit(False))
    found = F.when(good, F.col("_stated")).when(~stated, F.col("_isin"))
    method = F.when(good, "source_isin").when(~stated & F.col("_isin").isNotNull(), "crosswalk").otherwise("unresolved")
    reason = F.when(~good & (stated | F.col("_isin").isNull()), F.when(stated, "malformed source ISIN").when(F.col(key).isNull(), "no identifier").otherwise("no reviewed ISIN crosswalk entry"))
    return j.withColumns({"constituent_isin": found, "identifier_method": method, "unresolved_reason": reason}).drop("_kind", "_key", "_isin", "_stated", "_good", "_k", "_v")


def by_standard_id(rows: DataFrame, standard: str, member: str) -> DataFrame:
    return rows.groupBy(standard).agg(F.count("*").alias("n_rows"), F.array_sort(F.collect_set(member)).alias("members"))


def name_only_merges(rows: DataFrame, name: str, standard: str) -> DataFrame:
    """(name, id_a, id_b): the least identifier under a name, whatever its case, with each other one.

    These pairs tie the same identifiers together as all pairs would, and grow with the table, not with a name's square.
    """
    named = rows.select(F.lower(name).alias("name"), F.col(standard).alias("id_b")).where("name is not null and id_b is not null").distinct()
    return named.join(named.groupBy("name").agg(F.min("id_b").alias("id_a")), "name").where("id_a < id_b").select("name", "id_a", "id_b")


def upsert_crosswalk(entries: DataFrame, order: Column, run: Column) -> tuple[DataFrame, DataFrame]:
    """(entries, edges): one entry for each kind, key type and key, the last by ``order``; blank optional fields are null; the run that wrote it as an UPSERTED edge."""
    keys = ["entity_kind", "local_key_type", "local_key"]
    rest = [c for c in entries.columns if c not in keys]
    last = entries.groupBy(*[S.text(F.col(k)).alias(k) for k in keys]).agg(F.max_by(F.struct(*rest, run.alias("_run")), order).alias("x"))
    last = last.where(" and ".join(f"{k} is not null" for k in keys))
    uri = S.uri("crosswalk", *[F.col(k) for k in keys]).alias("uri")
    edges = last.select(S.uri("run", F.col("x._run")).alias("src"), F.lit("UPSERTED").alias("rel"), uri.alias("dst"))
    return last.select(uri, *keys, *[S.text(F.col(f"x.{c}")).alias(c) for c in rest]), edges


def name_groups(rows: DataFrame, name: str, standard: str) -> DataFrame:
    """(name, id, n_ids): the members of each name that several identifiers have, whatever its case; the same groups as of name_only_merges."""
    named = rows.select(F.lower(name).alias("name"), F.col(standard).alias("id")).where("id is not null").distinct()
    return named.join(named.groupBy("name").agg(F.count("*").alias("n_ids")).where("n_ids > 1"), "name").select("name", "id", "n_ids")
