"""Small helpers for building columns."""

from __future__ import annotations

import uuid
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, functions as F


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def fresh(prefix: str) -> str:
    """A column name no table has."""
    return f"_{prefix}_{uuid.uuid4().hex[:8]}"


def let(value: Column, body) -> Column:
    """body(value) with value computed once a row, however often body uses it: lambdas are not generated code, in which
    Spark would find common parts by itself."""
    return F.get(F.transform(F.array(value), body), 0)
