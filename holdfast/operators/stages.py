"""Tables that cut the lineage between rounds, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession

_OWN_DIR: list[str] = []


def shared_place(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share; a temporary one in a local session without the setting."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        if not _OWN_DIR:
            _OWN_DIR.append(tempfile.mkdtemp(prefix="holdfast-"))
        base = f"file://{_OWN_DIR[0]}"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table of the shared folder: what follows starts from its files, also when executors are lost."""
    place = shared_place(df.sparkSession, name)
    df.write.parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


def bucketed(df: DataFrame, name: str, *by: str) -> DataFrame:
    """``df`` as a table of the shared folder in as many buckets as the session has shuffle partitions: joins and aggregations by ``by`` read it without a shuffle.

    Rows are best dealt by ``by`` already (see ``spread``), so that a task writes one file.
    """
    spark, table = df.sparkSession, f"holdfast_{uuid.uuid4().hex}"
    df.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), *by).sortBy(*by).option("path", shared_place(spark, name)).saveAsTable(table)
    return spark.table(table)


@contextmanager
def shuffles_freed(spark: SparkSession):
    """In it, a query's shuffle files are deleted as soon as it has ended: for rounds that are written."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def spread(df: DataFrame, *by: str | Column) -> DataFrame:
    """``df`` dealt by ``by`` over all the session's shuffle partitions, however few bytes it has: for rows that become many, or large, in the same task."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)
