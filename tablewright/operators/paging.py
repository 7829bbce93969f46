"""Sorting, pages, totals and the single-row read."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any, Sequence

from pyspark.sql import DataFrame, Row, functions as F, types as T

from ..functions.columns import all_of
from ..functions.literals import column_type
from .ranges import SortKey, in_ranges, range_bucket, sort_keys, split_points

Keys = Sequence[str | tuple[str, bool] | SortKey]

# A deep page is cut down until about so many rows are left to sort.
NEAR_ROWS = 200_000
DEEP_SPLITS = 256
# Steps of the sketch that finds a deep page's surroundings, and its accuracy (rows / accuracy is the error of a rank).
SKETCH_STEPS, SKETCH_ACCURACY = 2000, 20_000


def sort_rows(df: DataFrame, *keys: str | tuple[str, bool] | SortKey) -> DataFrame:
    """Sort by (column, ascending) keys; nulls are smallest. The keys need not survive a later projection."""
    return df.orderBy(*[k.order for k in sort_keys(keys)])


def _check(num: int, size: int) -> None:
    if num < 1 or size < 1:
        raise ValueError(f"page number and size start at 1, got {num} and {size}")


def page(df: DataFrame, keys: Keys, num: int, size: int) -> DataFrame:
    """Page ``num`` (from 1) of ``size`` rows, one lazy top-k. The keys should order the rows totally.

    Every task keeps offset + size rows and one task sees them all; far from the front use :func:`deep_page`.
    """
    _check(num, size)
    return sort_rows(df, *keys).offset((num - 1) * size).limit(size)


def deep_page(df: DataFrame, keys: Keys, num: int, size: int, splits: int = DEEP_SPLITS, near: int = NEAR_ROWS) -> DataFrame:
    """The same page, for any depth. Jobs run when the frame is built.

    Where the leading key is a number, a date or a time, one job sketches its quantiles and counts rows and nulls, and a second
    counts exactly what lies before and between the values around the page; only what lies between is sorted, if that is
    at most ``near`` rows. Otherwise, as for text or a key with few values, rows are counted per sort-key range (one aggregation whose result has ``splits`` rows) and the ranges before the page
    are skipped by their exact counts; what is left is cut again until it holds at most ``near`` rows, or equal keys that
    nothing can cut. Only then is anything sorted.
    """
    _check(num, size)
    keys, offset = sort_keys(keys), (num - 1) * size
    df, offset, done = _surroundings(df, keys[0], offset, size, max(near, 2 * size))
    while not done:
        points = split_points(df, keys, splits)
        counted = df.groupBy(range_bucket(points).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()
        counts, before, first, skipped = {r["b"]: r["n"] for r in counted}, 0, None, 0
        last = len(points.points)
        for b in range(len(points.points) + 1):
            if first is None and before + counts.get(b, 0) > offset:
                first, skipped = b, before
            before += counts.get(b, 0)
            if first is not None and before >= offset + size:
                last = b
                break
        held = before - skipped
        if first is None:
            return df.where(F.lit(False))
        narrowed = (first, last) != (0, len(points.points))
        if narrowed:
            df, offset = df.where(in_ranges(points, first, last)), offset - skipped
        done = held <= max(near, 2 * size) or not narrowed
    return sort_rows(df, *keys).offset(offset).limit(size)


def _surroundings(df: DataFrame, lead: SortKey, offset: int, size: int, near: int) -> tuple[DataFrame, int, bool]:
    """The rows around a page by the leading key, the page's offset in them, and whether they are near enough to be sorted."""
    dtype = column_type(df, lead.name)
    if not isinstance(dtype, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return df, offset, False
    value = F.col(lead.name)
    steps = [i / SKETCH_STEPS for i in range(SKETCH_STEPS + 1)]
    cuts = F.percentile_approx(value, steps, SKETCH_ACCURACY).cast("array<string>")
    sketch = df.agg(F.count(F.lit(1)).alias("rows"), F.count(value).alias("filled"), cuts.alias("cuts")).first()
    if sketch.rows <= near:
        return df, offset, True
    nulls, filled = sketch.rows - sketch.filled, sketch.filled
    # ranks among the values, from the smallest; the page's rows come from the other end if the key falls
    low = offset - nulls if lead.ascending else filled - offset - size
    slack = 2 * sketch.rows // SKETCH_ACCURACY + 1
    at = lambda rank: sketch.cuts[min(max(rank * SKETCH_STEPS // max(filled, 1), 0), SKETCH_STEPS)]
    first = None if low - slack <= 0 else at(low - slack)
    last = None if low + size + slack >= filled else at(low + size + slack + filled // SKETCH_STEPS + 1)
    if not filled or (first is None and last is None):
        return df, offset, False
    # text keeps the values as they are; nulls are the smallest
    above = F.lit(True) if first is None else F.coalesce(value >= F.lit(first).cast(dtype), F.lit(False))
    below = F.lit(True) if last is None else F.coalesce(value <= F.lit(last).cast(dtype), F.lit(True))
    before = ~above if lead.ascending else ~below
    found = df.agg(F.count_if(before).alias("before"), F.count_if(above & below).alias("held")).first()
    if not found.before <= offset or offset + size > found.before + found.held and found.before + found.held < sketch.rows:
        return df, offset, False
    bounds = [value >= F.lit(first).cast(dtype)] if first is not None else []
    if last is not None:
        bounds.append(value <= F.lit(last).cast(dtype) if bounds else (value <= F.lit(last).cast(dtype)) | value.isNull())
    return df.where(all_of(bounds)), offset - found.before, found.held <= near


def total_count(df: DataFrame, alias: str = "total") -> DataFrame:
    """One row with the number of rows of any frame, as a long."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def total_pages(total: int, size: int) -> int:
    return 0 if total == 0 else 1 + (total - 1) // size


def page_with_total(df: DataFrame, keys: Keys, num: int, size: int) -> DataFrame:
    """The page with ``total_results`` and ``total_pages`` on every row; the total ignores the page.

    A page past the end is one row of nulls with the totals.
    """
    rows, total = page(df, keys, num, size), total_count(df)
    pages = lambda n: F.when(n == 0, F.lit(0)).otherwise(F.floor((n - 1) / size) + 1).cast("long")
    number = total.scalar()
    found = rows.select("*", number.alias("total_results"), pages(number).alias("total_pages"))
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields]
    past = total.where(F.col("total") <= (num - 1) * size)
    return found.unionAll(past.select(*nulls, F.col("total").alias("total_results"), pages(F.col("total")).alias("total_pages")))


@dataclass(frozen=True)
class Page:
    """A page brought to the driver: at most ``size`` rows, with the totals even when the page is empty."""

    num: int
    size: int
    rows: list[Row]
    total_results: int | None = None
    total_pages: int | None = None


def fetch_page(df: DataFrame, keys: Keys, num: int, size: int, with_total: bool = False) -> Page:
    rows = page(df, keys, num, size).collect()
    if not with_total:
        return Page(num, size, rows)
    total = df.count()
    return Page(num, size, rows, total, total_pages(total, size))


def single_row(df: DataFrame) -> Row | None:
    """None for no row, the row for one, an error for more. Never reads past the second row."""
    rows: list[Any] = df.limit(2).collect()
    if len(rows) > 1:
        raise ValueError("more than one row where a single one was asked for")
    return rows[0] if rows else None


def single_row_frame(df: DataFrame) -> DataFrame:
    """:func:`single_row` as a frame of at most one row; the check runs as part of the query."""
    counted = df.limit(2).groupBy().agg(F.collect_list(F.struct("*")).alias("rows"))
    checked = F.when(
        F.size("rows") > 1, F.raise_error(F.lit("more than one row where a single one was asked for"))
    ).otherwise(F.col("rows"))
    return counted.select(F.inline(checked.cast(counted.schema["rows"].dataType)))
