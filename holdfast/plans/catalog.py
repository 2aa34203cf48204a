"""The registered queries over the given tables, each with the SQL that states it.

Stand-ins: events are observations (owner user_id, day of ts, value) and a log (phase event_type, target user_id); part is a
product; customer a fund, its orders dated snapshots and lineitem their positions; nation and region a class tree.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from holdfast.operators.stages import shared_place  # noqa: F401

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


class Tables:
    """The given tables, read when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def query(sql: str | None = None, name: str | None = None) -> Callable:
    def register(f: Callable[[Tables], DataFrame]) -> Callable:
        key = name or f.__name__
        assert key not in _QUERIES, key
        _QUERIES[key] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            _SQL[key] = sql
        return f

    return register


def queries() -> dict[str, Query]:
    from holdfast.plans import entities, evidence, functions, intake, landing  # noqa: F401

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(_SQL)
