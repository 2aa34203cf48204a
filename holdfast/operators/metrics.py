"""Which metrics can be compared: a registry, eligibility with reasons, denominators, ranking within cohorts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: (family, metric, supported, zero_excluded, negative_excluded, currency)
REGISTRY = "family string, metric string, source_field string, supported boolean, zero_excluded boolean, negative_excluded boolean, denominator string, as_of string, unit string, currency string, cohort string"


def registry(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """The known metrics: of each family and metric the field it comes from, what excludes a value, the denominator it is
    shown with, its date's field, its unit and currency, and the cohort in which it may be ranked. Supported, with nothing excluded, unless told."""
    usual = {"supported": True, "zero_excluded": False, "negative_excluded": False, "denominator": "populated"}
    names = [x.split()[0] for x in REGISTRY.split(", ")]
    return spark.createDataFrame([tuple((usual | r).get(n) for n in names) for r in rows], REGISTRY)


def eligibility(values: DataFrame, registry: DataFrame) -> DataFrame:
    """Adds eligible and exclusion. ``values`` has family, metric, value; the registry has one row for each pair that is known."""
    j = values.join(registry, ["family", "metric"], "left")
    reason = F.coalesce(
        F.when(F.col("supported").isNull() | ~F.col("supported"), F.lit("unsupported")),
        F.when(F.col("value").isNull(), F.lit("missing")),
        F.when(F.col("zero_excluded") & (F.col("value") == 0), F.lit("zero")),
        F.when(F.col("negative_excluded") & (F.col("value") < 0), F.lit("negative")),
    )
    return j.withColumn("exclusion", reason).withColumn("eligible", F.col("exclusion").isNull())


def denominators(judged: DataFrame) -> DataFrame:
    """(family, metric, total, populated, eligible, excluded) counts."""
    return judged.groupBy("family", "metric").agg(F.count("*").alias("total"), F.count("value").alias("populated"), F.count_if("eligible").alias("n_eligible"), F.count_if(~F.col("eligible")).alias("excluded"))


def ranked(judged: DataFrame, key: str, k: int, cohort: list[str]) -> DataFrame:
    """The k greatest eligible values of each cohort (metric and currency never mix); ties by key."""
    w = Window.partitionBy(*cohort).orderBy(F.desc("value"), key)
    return judged.where("eligible").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def top(judged: DataFrame, key: str, k: int) -> DataFrame:
    """The k greatest eligible values over all families of a compatible cohort; ties by key."""
    return judged.where("eligible").orderBy(F.desc("value"), key).limit(k)


def scaled(values: DataFrame, scale: DataFrame, code: str, at_least: str) -> DataFrame:
    """Adds meets: whether a code is at least another on a supplied scale (code, place); codes off it are unsupported (null)."""
    least = scale.where(F.col("code") == at_least).select(F.col("place").alias("_least"))
    s = scale.select(F.col("code").alias(code), F.col("place").alias("_place"))
    return values.join(s, code, "left").join(F.broadcast(least), how="left").withColumn("meets", F.col("_place") >= F.col("_least")).drop("_place", "_least")


def outcome(status: Column, required_missing: Column) -> Column:
    """The outcome of a request from its status and whether required evidence is missing."""
    s = F.when(required_missing & (status == "ok"), F.lit("insufficient_evidence")).otherwise(status)
    return F.when(s == "ok", "answered").when(s == "empty", "empty").when(s == "insufficient_evidence", "partial").when(s == "unsupported", "unsupported").otherwise("error")
