"""Predicates of queries as column expressions: leaves, Boolean trees, relations.

Missing is unknown: no comparison with an absent value holds, nor does its negation (SQL's three-valued logic).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ORDERED = {"gt": Column.__gt__, "gte": Column.__ge__, "lt": Column.__lt__, "lte": Column.__le__}
_WORDS: dict[str, Callable[[Column, Column], Column]] = {"contains": F.contains, "starts_with": F.startswith, "ends_with": F.endswith}


def leaf(column: Column, op: str, value: Any = None, kind: str = "string") -> Column:
    """One of fourteen comparisons. String ones are literal and ignore case; ``between`` includes both ends.

    Raises ValueError ``unsupported_operator`` for an operator that doesn't exist or doesn't fit the kind.
    """
    if op in ("exists", "not_exists"):
        return column.isNotNull() if op == "exists" else column.isNull()
    if op in ("gt", "gte", "lt", "lte", "between") and kind not in ("number", "date", "datetime"):
        raise ValueError(f"unsupported_operator: {op} on {kind}")
    if op in _WORDS:
        if kind != "string":
            raise ValueError(f"unsupported_operator: {op} on {kind}")
        return _WORDS[op](F.lower(column), F.lower(F.lit(value)))
    if op == "between":
        return column.between(*value)
    if op in _ORDERED:
        return _ORDERED[op](column, value)
    if op in ("eq", "neq"):
        return column == value if op == "eq" else column != value
    if op in ("in", "not_in"):
        return column.isin(list(value)) if op == "in" else ~column.isin(list(value))
    raise ValueError(f"unsupported_operator: {op}")


# Fixed values
OPERATORS = ["eq", "neq", "gt", "gte", "lt", "lte", "between", "in", "not_in", "contains", "starts_with", "ends_with", "exists", "not_exists"]


def answers(rows: DataFrame, kinds: dict[str, str], values: dict[str, Any]) -> DataFrame:
    """(field, op, n, problem): how many rows each operator holds for with each field's value, or why it can't be asked. One pass over the rows.

    ``kinds`` gives the fields' kinds, ``values`` what they are compared with; ``between`` and lists take it as both ends and only member.
    """
    found = []
    for field, kind in kinds.items():
        for op in OPERATORS:
            value = values[field]
            operand = (value, value) if op == "between" else [value] if op in ("in", "not_in") else value
            try:
                n, problem = F.count_if(leaf(F.col(field), op, operand, kind)), F.lit(None).cast("string")
            except ValueError as e:
                n, problem = F.lit(None).cast("long"), F.lit(str(e).split(":")[0])
            found.append(F.struct(F.lit(field).alias("field"), F.lit(op).alias("op"), n.alias("n"), problem.alias("problem")))
    return rows.agg(F.array(*found).alias("a")).select(F.explode("a").alias("x")).select("x.*")


def tree(node: dict | Column, column_of: Callable[[str], tuple[Column, str]]) -> Column:
    """A nested predicate: {"all": [..]}, {"any": [..]}, {"not": ..} or {"field", "op", "value"}.

    ``column_of`` gives the column and kind of a field, and raises for unknown ones.
    """
    if isinstance(node, Column):
        return node
    if "all" in node:
        return reduce(lambda a, b: a & b, [tree(x, column_of) for x in node["all"]], F.lit(True))
    if "any" in node:
        return reduce(lambda a, b: a | b, [tree(x, column_of) for x in node["any"]], F.lit(False))
    if "not" in node:
        return ~tree(node["not"], column_of)
    unknown = set(node) - {"field", "op", "value"}
    if unknown:
        raise ValueError(f"invalid_request: {sorted(unknown)}")
    column, kind = column_of(node["field"])
    return leaf(column, node["op"], node.get("value"), kind)


def having_related(roots: DataFrame, related: DataFrame, keys: list[str], *conditions: Column) -> DataFrame:
    """Roots with at least one related row on which all conditions hold together; one call for each binding."""
    return roots.join(related.where(reduce(lambda a, b: a & b, conditions, F.lit(True))), keys, "left_semi")
