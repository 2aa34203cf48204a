"""Folding repeated rows of an entity into one, under a rule for each column.

``last_value``: the last value that isn't null. ``last_row``: the last row's, null or not. ``first_value``: the first
that isn't null. One aggregation does all columns; partial results combine before the shuffle, so a key with many
rows doesn't load one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RULES = ("last_value", "last_row", "first_value")


def folded(column: str | Column, order: Column, rule: str) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    if rule == "last_row":
        return F.max_by(c, order)
    if rule == "last_value":
        return F.max_by(c, F.when(c.isNotNull(), order))
    if rule == "first_value":
        return F.min_by(c, F.when(c.isNotNull(), order))
    raise ValueError(f"no such rule: {rule}")


def fold(rows: DataFrame, keys: list[str], order: Column, rules: dict[str, str]) -> DataFrame:
    """One row for each key, each column by its rule; ``order`` must tell all rows of a key apart."""
    return rows.groupBy(*keys).agg(*[folded(c, order, rule).alias(c) for c, rule in rules.items()])


def partial(rows: DataFrame, keys: list[str], order: Column, rules: dict[str, str]) -> DataFrame:
    """One row for each key, where each column is (at, v): the value that the rule takes and its place in the order."""

    def one(c: str, rule: str) -> Column:
        pair = F.struct(order.alias("at"), F.col(c).alias("v"))
        if rule == "last_row":
            return F.max(pair)
        if rule not in RULES:
            raise ValueError(f"no such rule: {rule}")
        return (F.max if rule == "last_value" else F.min)(F.when(F.col(c).isNotNull(), pair))

    return rows.groupBy(*keys).agg(*[one(c, rule).alias(c) for c, rule in rules.items()])


def together(partials: DataFrame, keys: list[str], rules: dict[str, str]) -> DataFrame:
    """Partial folds as one, whatever their order and however often one is there."""
    return partials.groupBy(*keys).agg(*[(F.min if rule == "first_value" else F.max)(c).alias(c) for c, rule in rules.items()])


def finished(partials: DataFrame, keys: list[str], rules: dict[str, str]) -> DataFrame:
    """The values of partial folds."""
    return partials.select(*keys, *[F.col(c)["v"].alias(c) for c in rules])


def collected(rows: DataFrame, keys: list[str], column: str) -> DataFrame:
    """The distinct values of an attribute of each key, in order. Meant for attributes of few values."""
    return rows.groupBy(*keys).agg(F.array_sort(F.collect_set(column)).alias(column))


def load_order(dataset: Column, row_number: Column, kind: Column, item: Column, batch: int = 500) -> Column:
    """The order in which a load writes: dataset, batch, kind within the batch, row, item of the row."""
    return F.struct(dataset, F.floor((row_number - 2) / batch), kind, row_number, item)
