"""Exact sums of whole numbers of any size across Spark: numbers travel as limbs, which sum without overflow."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a limb. Sums of 2**31 limbs fit a decimal of 20 digits with ease.
LIMB = 48


def limbs_for(bound: int) -> int:
    """How many limbs hold whole numbers of absolute value up to ``bound``; the last one carries the sign."""
    return max(1, -(-(bound.bit_length() + 1) // LIMB))


def to_limbs(values: np.ndarray, limbs: int) -> np.ndarray:
    """[..., limbs] of whole numbers (int64 or Python ints), lowest first."""
    if limbs == 1:
        return values.astype(np.int64)[..., None]
    out, rest = [], values.astype(object)
    for _ in range(limbs - 1):
        out.append(rest & ((1 << LIMB) - 1))
        rest = rest >> LIMB
    return np.stack([*out, rest], axis=-1).astype(np.int64)


def from_limbs(limbs: list) -> int:
    return sum(int(v) << (LIMB * i) for i, v in enumerate(limbs))


def sum_arrays(rows: DataFrame, keys: list[str], column: str, width: int) -> DataFrame:
    """(keys, column) with arrays of up to ``width`` items summed place by place."""
    summed: list[Column] = [F.sum(F.get(column, F.lit(i)).cast("decimal(20,0)")) for i in range(width)]
    return rows.groupBy(*keys).agg(F.array(*summed).alias(column))
