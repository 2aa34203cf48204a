"""Columns of vectors: which rows take part, and their values as matrices inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def finite(rows: DataFrame, scale: float) -> tuple[DataFrame, int, float]:
    """(rows that take part, their vectors' length, largest absolute component).

    Vectors (column ``vector``) that are null, empty, of another length than most (of the shortest such) or hold a
    component that is null or whose ``scale``-fold isn't finite take no part.
    """
    wide = F.transform("vector", lambda x: F.abs(x.cast("double") * scale))
    ok = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (x < float("inf")))
    rows = rows.where(F.coalesce((F.size("vector") > 0) & ok, F.lit(False)))
    most = F.max(F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double")))))
    sizes = rows.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n"), most.alias("most")).orderBy(F.desc("n"), "d").first()
    d, top = (sizes["d"], sizes["most"]) if sizes else (0, 0.0)
    return rows.where(F.size("vector") == d), d, top


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Equally long lists as rows of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
