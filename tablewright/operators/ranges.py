"""Splitting rows into ordered ranges by their sort keys.

Paging far into a sorted table, numbering the rows of a hot group and joining on an inequality all need the same thing:
an ordered bucket number per row, the same every time it is evaluated, spreading even one huge key over many tasks.
``split_points`` samples a bounded number of key values; ``range_bucket`` compares rows with them as literals. The
buckets are exact whatever the sample was; the sample only decides how even they are.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.columns import all_of
from ..functions.literals import column_type

SAMPLES_PER_SPLIT = 20
MOST_SPLITS = 4096


def default_splits(df: DataFrame) -> int:
    """As many ranges as the session has shuffle partitions, within 128 and 4096."""
    return min(MOST_SPLITS, max(128, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


@dataclass(frozen=True)
class SortKey:
    """Nulls count as the smallest value: first when ascending, last when descending."""

    name: str
    ascending: bool = True

    @property
    def order(self) -> Column:
        column = F.col(self.name)
        return column.asc_nulls_first() if self.ascending else column.desc_nulls_last()


def sort_keys(keys: Sequence[str | tuple[str, bool] | SortKey]) -> list[SortKey]:
    made = []
    for key in keys:
        if isinstance(key, SortKey):
            made.append(key)
        elif isinstance(key, str):
            made.append(SortKey(key))
        else:
            made.append(SortKey(*key))
    return made


@dataclass(frozen=True)
class Splits:
    keys: tuple[SortKey, ...]
    types: tuple[T.DataType, ...]
    points: tuple[tuple[str | None, ...], ...]


def split_points(df: DataFrame, keys: Sequence[SortKey], splits: int, seed: int = 17, count: int | None = None) -> Splits:
    """At most ``splits - 1`` points that cut the rows, in sort order, into about equal ranges.

    Runs two jobs over the key columns alone, a count (unless given) and a draw. What reaches the driver is bounded by
    ``splits``, not by the data.
    """
    keys = list(keys)
    types = tuple(column_type(df, k.name) for k in keys)
    names = [f"p{i}" for i in range(len(keys))]
    renamed = df.select(*[F.col(k.name).alias(n) for k, n in zip(keys, names)])
    # each row is drawn by itself, so no task gathers candidates for a draw
    wanted, count = SAMPLES_PER_SPLIT * splits, renamed.count() if count is None else count
    picked = renamed if count <= wanted else renamed.where(F.rand(seed) < wanted / count)
    orders = [SortKey(n, k.ascending).order for k, n in zip(keys, names)]
    # the points travel as text, so that no time zone and no rounding on the driver can move them
    rows = [tuple(r) for r in picked.orderBy(*orders).select(*[F.col(n).cast("string") for n in names]).collect()]
    points: list[tuple[str | None, ...]] = []
    for i in range(1, splits):
        if rows and (point := rows[min(i * len(rows) // splits, len(rows) - 1)]) not in points[-1:]:
            points.append(point)
    return Splits(tuple(keys), types, tuple(points))


def _at_or_after(columns: Sequence[Column], keys: Sequence[SortKey], point: Column) -> Column:
    """True unless the row sorts strictly before the point; nulls are smallest."""
    if len({k.ascending for k in keys}) == 1:
        row = F.struct(*[c.alias(f"p{i}") for i, c in enumerate(columns)])
        return row >= point if keys[0].ascending else row <= point
    before = F.lit(False)
    for i, (column, key) in reversed(list(enumerate(zip(columns, keys)))):
        value = point[f"p{i}"]
        smaller = (column.isNull() & value.isNotNull()) | (column < value)
        larger = (column.isNotNull() & value.isNull()) | (column > value)
        first = smaller if key.ascending else larger
        before = F.coalesce(first, F.lit(False)) | (column.eqNullSafe(value) & before)
    return ~before


def range_bucket(splits: Splits, columns: Sequence[str] | None = None) -> Column:
    """Number of the range a row falls into, 0 first.

    The points are one constant array searched by halving: the expression stays small however many points there are,
    and a row costs log(splits) comparisons.
    """
    count = len(splits.points)
    if count == 0:
        return F.lit(0)
    columns = [F.col(n) for n in (columns or [k.name for k in splits.keys])]
    names = [f"p{i}" for i in range(len(columns))]
    text = json.dumps([dict(zip(names, point)) for point in splits.points])
    plain = ", ".join(f"{n}: string" for n in names)
    typed = ", ".join(f"{n}: {t.simpleString()}" for n, t in zip(names, splits.types))
    points = F.from_json(F.lit(text), f"array<struct<{plain}>>").cast(f"array<struct<{typed}>>")
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(count.bit_length()))])

    def advance(passed: Column, step: Column) -> Column:
        point = F.get(points, passed + step - 1)
        further = (passed + step <= count) & _at_or_after(columns, splits.keys, point)
        return F.when(further, passed + step).otherwise(passed)

    return F.aggregate(steps, F.lit(0), advance)


def in_ranges(splits: Splits, first: int, last: int) -> Column:
    """Rows of the ranges ``first`` to ``last``, with bounds on the leading key that a scan can skip row groups by."""
    lead, dtype = splits.keys[0], splits.types[0]
    column = F.col(lead.name)
    bounds = [range_bucket(splits).between(first, last)]
    start = splits.points[first - 1][0] if first > 0 else None
    stop = splits.points[last][0] if last < len(splits.points) else None
    low, high = (start, stop) if lead.ascending else (stop, start)
    if low is not None:
        bounds.append(column >= F.lit(low).cast(dtype))
    if high is not None:
        beyond = column <= F.lit(high).cast(dtype)
        bounds.append(beyond if low is not None else beyond | column.isNull())
    return all_of(bounds)
