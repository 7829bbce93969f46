"""Set operations, applied strictly from left to right."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

UNION, UNION_ALL, INTERSECT, EXCEPT = "union", "union all", "intersect", "except"
OPERATIONS = (UNION, UNION_ALL, INTERSECT, EXCEPT)
_TAG = "_branches"
_MAX_BRANCHES = 62


def _distinct_fold(first: DataFrame, steps: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """A run of set operations that ends in a distinct one, as a single aggregation.

    Every branch sets its own bit; one group-by over the row collects the bits, and the chain becomes a condition on
    them. Equal rows meet map-side, so a row repeated a billion times is shuffled once per task, and the chain needs
    one shuffle however long it is. Grouping treats nulls as equal, as set operations do.
    """
    names = first.columns
    plain = [f"c{i}" for i in range(len(names))]
    branches = [first, *[df for _, df in steps]]
    tagged = [df.toDF(*plain).withColumn(_TAG, F.lit(1 << i).cast("long")) for i, df in enumerate(branches)]
    rows = reduce(lambda a, b: a.union(b), tagged).groupBy(*plain).agg(F.bit_or(_TAG).alias(_TAG))

    def present(i: int) -> Column:
        return F.col(_TAG).bitwiseAND(F.lit(1 << i).cast("long")) != 0

    keep = present(0)
    for i, (operation, _) in enumerate(steps, start=1):
        if operation in (UNION, UNION_ALL):
            keep = keep | present(i)
        elif operation == INTERSECT:
            keep = keep & present(i)
        else:
            keep = keep & ~present(i)
    return rows.where(keep).drop(_TAG).toDF(*names)


def combine(first: DataFrame, steps: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """``((first op1 df1) op2 df2) …``; columns pair by position and take the first frame's names."""
    for operation, df in steps:
        if operation not in OPERATIONS:
            raise ValueError(f"unknown set operation {operation!r}; known are {', '.join(OPERATIONS)}")
        if len(df.columns) != len(first.columns):
            raise ValueError(f"{operation} pairs {len(first.columns)} columns with {len(df.columns)}")
    steps = list(steps)
    while len(steps) > _MAX_BRANCHES:
        first, steps = combine(first, steps[:_MAX_BRANCHES]), steps[_MAX_BRANCHES:]
    distinct_steps = [i for i, (operation, _) in enumerate(steps) if operation != UNION_ALL]
    cut = distinct_steps[-1] + 1 if distinct_steps else 0
    out = _distinct_fold(first, steps[:cut]) if cut else first
    for _, df in steps[cut:]:
        out = out.union(df)
    return out
