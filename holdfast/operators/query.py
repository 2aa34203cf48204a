"""Logical queries over product tables: find, aggregate, neighbours, provenance, as plain functions of DataFrames."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.operators import predicates, stages

MOST_ROWS, MOST_OFFSET = 100, 10_000
_AGGREGATES: dict[str, Callable[[str], Column]] = {"count": F.count, "count_distinct": F.countDistinct, "min": F.min, "max": F.max, "avg": F.avg, "sum": F.sum}


def ordered(rows: DataFrame, keys: list[tuple[str, str, str]], final: str) -> DataFrame:
    """Sort by (column, asc or desc, first or last for nulls), and by ``final`` in the end."""
    how = {("asc", "last"): Column.asc_nulls_last, ("asc", "first"): Column.asc_nulls_first, ("desc", "last"): Column.desc_nulls_last, ("desc", "first"): Column.desc_nulls_first}
    return rows.orderBy(*[how[d, n](F.col(c)) for c, d, n in keys], F.col(final).asc())


def page(rows: DataFrame, limit: int = 20, offset: int = 0) -> DataFrame:
    if not (1 <= limit <= MOST_ROWS and 0 <= offset <= MOST_OFFSET):
        raise ValueError(f"invalid_request: limit {limit}, offset {offset}")
    return rows.offset(offset).limit(limit)


def aggregate(rows: DataFrame, by: list[str], measures: dict[str, tuple[str, str]], kinds: dict[str, str] | None = None) -> DataFrame:
    """alias -> (function, column); nulls are ignored. avg and sum need a numeric kind."""
    for alias, (f, c) in measures.items():
        if f in ("avg", "sum") and (kinds or {}).get(c, "number") != "number":
            raise ValueError(f"unsupported_operator: {f} on {c} ({alias})")
    return rows.groupBy(*by).agg(*[_AGGREGATES[f](c).alias(a) for a, (f, c) in measures.items()])


def without_fanout(roots: DataFrame, many: DataFrame, key: str, *aggregates: Column) -> DataFrame:
    """Roots with aggregates of a many-valued relation, which is reduced to one row a root before it is joined."""
    return roots.join(many.groupBy(key).agg(*aggregates), key, "left")


def evidence_summary(results: DataFrame, evidence: DataFrame, key: str, record: str) -> DataFrame:
    """Adds n_evidence and outcome: a result without evidence is insufficient."""
    n = evidence.groupBy(key).agg(F.countDistinct(record).alias("n_evidence"))
    out = results.join(n, key, "left").withColumn("n_evidence", F.coalesce("n_evidence", F.lit(0)))
    return out.withColumn("outcome", F.when(F.col("n_evidence") > 0, "ok").otherwise("insufficient_evidence"))


def union_kinds(*families: tuple[str, DataFrame, str, str]) -> DataFrame:
    """(kind, id, name) of several entity tables: (kind, rows, identifier, name)."""
    parts = [rows.select(F.lit(kind).alias("kind"), F.col(k).alias("id"), F.col(n).alias("name")) for kind, rows, k, n in families]
    return reduce(DataFrame.unionByName, parts)


def related(rows: DataFrame, relation: DataFrame, key: str, of: str, required: bool) -> DataFrame:
    """Rows with a relation's columns; a row without it stays, with nulls, unless the relation is required."""
    return rows.join(relation, rows[key] == relation[of], "inner" if required else "left")


def evidence_sources(evidence: DataFrame, key: str, record: str, dataset: str, file: str, snapshot: str, sha: str) -> DataFrame:
    """(key, dataset, file, snapshot, sha, n_evidence): where each result's evidence comes from, one row for each source.

    Records are dealt by source and record before they are made distinct, so neither the reading tasks nor a result of many records gathers them.
    """
    source = {"key": key, "dataset": dataset, "file": file, "snapshot": snapshot, "sha": sha}
    once = stages.spread(evidence.select(*[F.col(c).alias(n) for n, c in source.items()], F.col(record).alias("_record")), *source, "_record").distinct()
    return once.groupBy(*source).agg(F.count("_record").alias("n_evidence"))


def evidence_rows(evidence: DataFrame, key: str, order: list[str], most: int) -> DataFrame:
    """At most so many rows of evidence for each result."""
    return evidence.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("_n") <= most).drop("_n")


def find_all(rows: DataFrame, key: str, where: dict | Column, fields: dict[str, tuple[Column, str]], select: dict[str, Column], order: list[tuple[str, str, str]], *, search: Callable[[DataFrame], DataFrame] | None = None, observations: DataFrame | None = None, scopes: tuple[DataFrame, ...] = (), evidence: tuple[DataFrame, str] | None = None, required: bool = False, limit: int = 20, offset: int = 0) -> DataFrame:
    """A whole find: search among ``rows``, join the selected observation of each (one row a key), filter, keep the keys
    that every scope holds, project, deduplicate, add the evidence (rows, record column) with its outcome, sort, page.

    Time is selected before filters see values, so a filter never reaches for an older observation that fits. With
    ``required``, results without evidence are left out.
    """
    out = search(rows) if search else rows
    if observations is not None:
        out = out.join(observations, key, "left")
    for scope in scopes:
        out = out.join(scope.select(key).distinct(), key, "left_semi")
    out = out.where(predicates.tree(where, _column_of(fields))).select(F.col(key), *[c.alias(a) for a, c in select.items() if a != key]).distinct()
    if evidence is not None:
        out = evidence_summary(out, evidence[0], key, evidence[1])
        out = out.where("n_evidence > 0") if required else out
    return page(ordered(out, order, key), limit, offset)


def _column_of(fields: dict[str, tuple[Column, str]]) -> Callable[[str], tuple[Column, str]]:
    def look(name: str) -> tuple[Column, str]:
        if name not in fields:
            raise ValueError(f"unknown_field: {name}")
        return fields[name]

    return look


def find(rows: DataFrame, where: dict | Column, fields: dict[str, tuple[Column, str]], select: dict[str, Column], order: list[tuple[str, str, str]], final: str, limit: int = 20, offset: int = 0, distinct: bool = True) -> DataFrame:
    """Filter, project, deduplicate, sort, page: in that order."""
    out = rows.where(predicates.tree(where, _column_of(fields))).select(*[c.alias(a) for a, c in select.items()])
    return page(ordered(out.distinct() if distinct else out, order, final), limit, offset)
