"""Routing of bad rows, validation of a load, coverage of fields."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.operators import stages


def first_reason(*checks: tuple[Column, str | Column]) -> Column:
    """The reason of the first check that holds, null if none does."""
    return F.coalesce(*[F.when(c, F.lit(r) if isinstance(r, str) else r) for c, r in checks])


def route(rows: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """(rows without a reason, rows with theirs)."""
    marked = rows.withColumn("reason", reason)
    return marked.where("reason is null").drop("reason"), marked.where("reason is not null")


def reject_documents(rows: DataFrame, document: str, bad: Column) -> DataFrame:
    """All rows of the documents that have no bad row. The list of bad documents has one row for each."""
    return rows.join(rows.where(bad).select(document).distinct(), document, "left_anti")


def violations(checks: dict[str, Column]) -> Column:
    """The names of the checks that a row breaks, in order."""
    return F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()]))


def document_total(value: Column, document: str, strict: bool) -> Column:
    """A document's total as a window expression. Strict: null unless all values are there and none is negative; else: the
    sum of the positive ones, null without any."""
    w = Window.partitionBy(document)
    if strict:
        bad = F.sum(F.when(value.isNull() | (value < 0), 1).otherwise(0)).over(w)
        return F.when(bad == 0, F.sum(value).over(w))
    return F.sum(F.when(value > 0, value)).over(w)


def with_document_total(rows: DataFrame, document: str, value: str, strict: bool) -> DataFrame:
    """The same total by an aggregation and a join, for documents too large for a window."""
    return rows.join(document_totals(rows, document, value, strict), document)


def document_totals(rows: DataFrame, document: str, value: str, strict: bool) -> DataFrame:
    """(document, document_total): to be made of rows as they are read, so that what is joined to them isn't done twice."""
    v = F.col(value)
    total = F.when(F.sum(F.when(v.isNull() | (v < 0), 1).otherwise(0)) == 0, F.sum(v)) if strict else F.sum(F.when(v > 0, v))
    return rows.groupBy(document).agg(total.alias("document_total"))


def unlinked(records: DataFrame, links: DataFrame, key: str, of: str) -> DataFrame:
    """The records that no link names."""
    return records.join(links.select(F.col(of).alias(key)).distinct(), key, "left_anti")


def label_counts(rows: DataFrame, labels: Column) -> DataFrame:
    """(label, n) over rows that each have a list of labels."""
    return rows.select(F.explode(labels).alias("label")).groupBy("label").agg(F.count("*").alias("n"))


def duplicates(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def profile(rows: DataFrame, dataset: str, kind: str) -> DataFrame:
    """Rows for each dataset and kind, and with kind null for each dataset."""
    by_kind = rows.groupBy(F.col(dataset).alias("dataset"), F.col(kind).alias("kind")).agg(F.count("*").alias("n"))
    return by_kind.unionByName(by_kind.groupBy("dataset").agg(F.sum("n").alias("n")).select("dataset", F.lit(None).cast("string").alias("kind"), "n"))


def coverage(rows: DataFrame, fields: list[str]) -> DataFrame:
    """(field, total, populated, non_zero, constant_zero) of numeric fields, in one pass."""
    aggs = [x for f in fields for x in (F.count(f).alias(f"{f}__p"), F.count_if(F.col(f) != 0).alias(f"{f}__z"))]
    one = rows.agg(F.count("*").alias("total"), *aggs)
    each = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"{f}__p").alias("populated"), F.col(f"{f}__z").alias("non_zero")) for f in fields])
    out = one.select("total", F.explode(each).alias("x")).select("x.field", "total", "x.populated", "x.non_zero")
    return out.withColumn("constant_zero", (F.col("populated") > 0) & (F.col("non_zero") == 0))


def validation_totals(records: DataFrame, entities: DataFrame, edges: DataFrame) -> DataFrame:
    """One row of counts: records (uri), rejected ones, entities by kind, units, listings, observations, records that
    neither describe anything nor are rejected, and identifiers of more than one entity row."""
    sound = entities.where("issue_code is null")
    uris = lambda name: F.count_distinct(name).alias({"unit_uri": "n_units", "listing_uri": "n_listings"}[name])
    of_kind = lambda kind: F.count_distinct(F.when(F.col("kind") == kind, F.col("uri"))).alias(f"n_{kind}s")
    rejected = entities.where("issue_code is not null").select("source_uri").distinct()
    described = edges.where("rel = 'DESCRIBES'").select(F.col("src").alias("source_uri")).distinct()
    rest = records.select(F.col("uri").alias("source_uri")).join(described, "source_uri", "left_anti").join(rejected, "source_uri", "left_anti")
    one = [
        records.agg(F.count("*").alias("n_records")), rejected.agg(F.count("*").alias("n_rejected")),
        sound.agg(of_kind("bond"), of_kind("fund"), of_kind("note"), uris("unit_uri"), uris("listing_uri")),
        edges.where("rel = 'HAS_OBSERVATION'").agg(F.count_distinct("dst").alias("n_observations")),
        rest.agg(F.count("*").alias("n_unlinked")), duplicates(sound, "uri").agg(F.count("*").alias("n_duplicate_uris")),
    ]
    return reduce(lambda a, b: a.join(F.broadcast(b)), one)


def document_breaks(rows: DataFrame, document: str, broken: Column) -> DataFrame:
    """(document, n_broken, n) of every document, in one pass: those with n_broken above 0 fail. Records are dealt by document first, so the reading tasks gather none."""
    return stages.spread(rows.select(F.col(document), (F.size(broken) > 0).alias("_bad")), document).groupBy(document).agg(F.count_if("_bad").alias("n_broken"), F.count("*").alias("n"))


def reject_broken_documents(rows: DataFrame, document: str, broken: Column) -> tuple[DataFrame, DataFrame]:
    """(rows of documents whose records all keep the rules, (document, n_broken) of the others): one broken record fails its document."""
    bad = document_breaks(rows, document, broken).where("n_broken > 0").drop("n")
    return rows.join(bad.select(document), document, "left_anti"), bad


def link_report(records: DataFrame, linked: DataFrame, rejected: DataFrame, key: str, dataset: str) -> DataFrame:
    """(dataset, n_records, n_linked, n_rejected, n_unlinked)."""
    mark = lambda df, name: df.select(key).distinct().withColumn(name, F.lit(True))
    r = records.join(mark(linked, "_l"), key, "left").join(mark(rejected, "_r"), key, "left")
    has = lambda c: F.count_if(F.col(c).isNotNull())
    return r.groupBy(F.col(dataset).alias("dataset")).agg(F.count("*").alias("n_records"), has("_l").alias("n_linked"), has("_r").alias("n_rejected"), F.count_if(F.col("_l").isNull() & F.col("_r").isNull()).alias("n_unlinked"))
