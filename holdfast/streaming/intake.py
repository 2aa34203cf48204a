"""Incremental intake of evidence: a phase log, skipping what is loaded, gaps, and a file stream that can be replayed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# Fixed values, in the order a target goes through them
PHASES = ["DISCOVERED", "FETCHED", "NORMALIZED", "READY", "LOADED", "VALIDATED", "FAILED"]


def state(log: DataFrame, target: str, order: Column, *columns: str) -> DataFrame:
    """The latest entry of each target."""
    return log.groupBy(target).agg(*[F.max_by(c, order).alias(c) for c in columns])


def skip_loaded(batches: DataFrame, log: DataFrame, keys: list[str]) -> DataFrame:
    """The batches that the log doesn't hold as loaded."""
    return batches.join(log.where("phase = 'LOADED'").select(*keys).distinct(), keys, "left_anti")


def missing(expected: DataFrame, loaded: DataFrame, keys: list[str]) -> DataFrame:
    return expected.select(*keys).distinct().join(loaded.select(*keys).distinct(), keys, "left_anti")


def completion(shards: DataFrame, target: str, done: Column) -> DataFrame:
    """(target, n_shards, complete): complete when all of a target's shards are done."""
    return shards.groupBy(target).agg(F.count("*").alias("n_shards"), F.bool_and(F.coalesce(done, F.lit(False))).alias("complete"))


def ready_conflicts(log: DataFrame, identity: list[str], evidence: str) -> DataFrame:
    """Identities that stand in the log with different evidence; equal evidence collapses."""
    return log.groupBy(*identity).agg(F.countDistinct(evidence).alias("n_evidence")).where("n_evidence > 1")


def replay(log: DataFrame, phase: str, target: str) -> DataFrame:
    """(phase, n, targets): what a log holds of each phase."""
    return log.groupBy(phase).agg(F.count("*").alias("n"), F.countDistinct(target).alias("targets"))


def target_summary(documents: DataFrame, day: Column) -> DataFrame:
    """(n_days, n_documents, first_day, last_day) of a list of targets."""
    return documents.agg(F.countDistinct(day).alias("n_days"), F.count("*").alias("n_documents"), F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def run_summary(log: DataFrame, run: str, phase: str) -> DataFrame:
    """(run, and a count of each phase)."""
    return log.groupBy(run).agg(*[F.count_if(F.col(phase) == p).alias(p.lower()) for p in PHASES])


def catch_up(targets: DataFrame, log: DataFrame, target: str, source: str) -> DataFrame:
    """(source, n_targets, n_missing): targets without a READY entry; ``not_ready`` has them as rows."""
    ready = log.where("phase = 'READY'").select(target).distinct().withColumn("_ready", F.lit(True))
    return targets.join(ready, target, "left").groupBy(source).agg(F.count("*").alias("n_targets"), F.count_if(F.col("_ready").isNull()).alias("n_missing"))


def not_ready(targets: DataFrame, log: DataFrame, target: str) -> DataFrame:
    """The targets without a READY entry."""
    return targets.join(log.where("phase = 'READY'").select(target).distinct(), target, "left_anti")


def audit(entries: DataFrame, artifacts: DataFrame, key: str, identity: tuple[str, ...] = ()) -> DataFrame:
    """(key, problems): manifest entries against the files' recomputed digests, sizes and counts, and the ``identity`` columns that its records state."""
    columns = ("sha256", "size", "n_records", *identity)
    a = artifacts.select(F.col(key), *[F.col(c).alias(f"_{c}") for c in columns])
    j = entries.join(a, key, "left")
    absent = F.col("_sha256").isNull()
    checks = [(absent, "missing"), *[(~absent & ~F.col(c).eqNullSafe(F.col(f"_{c}")), f"{c} differs") for c in columns]]
    return j.select(key, F.array_compact(F.array(*[F.when(c, F.lit(r)) for c, r in checks])).alias("problems"))


def outcomes(rows: DataFrame, target: str, reason: Column) -> tuple[DataFrame, DataFrame]:
    """(rows of the targets that may be loaded, log (target, phase, message, n_records)).

    A target with any row that has a reason fails, with the least of its reasons as the message; the others go on.
    """
    log = rows.groupBy(target).agg(F.min(reason).alias("message"), F.count("*").alias("n_records"))
    log = log.select(target, F.when(F.col("message").isNull(), "LOADED").otherwise("FAILED").alias("phase"), "message", "n_records")
    return rows.join(log.where("phase = 'FAILED'").select(target), target, "left_anti"), log


def dedupe_batches(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key, as a rerun of the same input would load it."""
    first = rows.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.min_by(F.struct(*rows.columns), F.struct(*order)).alias("_row"))
    return first.select("_row.*")


def stream_intake(spark: SparkSession, source: str, schema: str, checkpoint: str, sink: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Take in all files that are new since the checkpoint and stop; ``sink`` gets each batch and must be idempotent."""
    files = spark.readStream.schema(schema).option("maxFilesPerTrigger", 100).parquet(source)
    return files.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
