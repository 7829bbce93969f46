"""Insert, update and delete as copy-on-write: a frame in, a new frame out, and a count of the rows touched.

Nothing here writes files. :mod:`tablewright.sources.tables` runs the same writes against stored tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from typing import Any, Callable, Mapping, Sequence, Union

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.columns import fresh
from ..functions.literals import stored_literal
from ..functions.predicates import Node, Term, as_group, flag_sub_selects, where, without_matches

Tables = Mapping[str, DataFrame]
Terms = Union[Sequence[Node], Callable[[Tables], Sequence[Node]]]
Query = Union[DataFrame, Callable[[Tables], DataFrame]]


# ---------------------------------------------------------------- single writes on a frame


def _column_names(df: DataFrame, names: Sequence[str]) -> dict[str, str]:
    """Given names to the frame's own, in any case; an unknown one is an error."""
    own = {name.lower(): name for name in df.columns}
    unknown = [n for n in names if n.lower() not in own]
    if unknown:
        raise ValueError(f"no column {', '.join(unknown)}; the table has {', '.join(df.columns)}")
    return {n: own[n.lower()] for n in names}


#: Rows of one literal array; a longer insert is a union of such arrays.
_ROWS_AT_ONCE = 500


def literal_rows(df: DataFrame, rows: Sequence[Mapping[str, Any]]) -> DataFrame:
    """Rows given as values, in the types of ``df``. Unnamed columns are null; values adapt, ``"1"`` fits an int."""
    if not rows:
        raise ValueError("an insert needs at least one row")
    own = _column_names(df, [n for row in rows for n in row])
    rows = [{own[n]: value for n, value in row.items()} for row in rows]
    fields = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])
    made = [stored_literal(row, fields) for row in rows]
    one = df.sparkSession.range(1)
    parts = [one.select(F.inline(F.array(*made[i : i + _ROWS_AT_ONCE]))) for i in range(0, len(made), _ROWS_AT_ONCE)]
    return reduce(lambda a, b: a.unionAll(b), parts)


def selected_rows(df: DataFrame, query: DataFrame) -> DataFrame:
    """Rows of a query, matched to the columns of ``df`` by name; columns it lacks are null."""
    own = _column_names(df, query.columns)
    given = {own[n]: F.col(f"`{n}`") for n in query.columns}
    return query.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in df.schema.fields])


def insert_rows(df: DataFrame, rows: Sequence[Mapping[str, Any]]) -> DataFrame:
    return df.unionByName(literal_rows(df, rows))


def insert_select(df: DataFrame, query: DataFrame) -> DataFrame:
    return df.unionByName(selected_rows(df, query))


def _matching(df: DataFrame, terms: Sequence[Node]) -> tuple[DataFrame, Column, list[str]]:
    """The frame with a true/false condition for "this row is touched", and columns to drop afterwards.

    A condition that is unknown touches nothing; no condition touches every row.
    """
    flagged = flag_sub_selects(df, as_group(terms) if terms else as_group(()))
    cond = flagged.condition
    return flagged.frame, F.lit(True) if cond is None else F.coalesce(cond, F.lit(False)), flagged.flags


def _changed(df: DataFrame, values: Mapping[str, Any], touched: str, columns: Sequence[str]) -> dict[str, Column]:
    """The named columns with their new values where the column ``touched`` is true."""
    own = {name: made for name, made in _column_names(df.select(*[F.col(f"`{c}`") for c in columns]), list(values)).items()}
    return {
        own[name]: F.when(F.col(touched), stored_literal(value, df.schema[own[name]].dataType, name)).otherwise(F.col(f"`{own[name]}`"))
        for name, value in values.items()
    }


def update_where(df: DataFrame, values: Mapping[str, Any], *terms: Node) -> DataFrame:
    """Literal values for the rows the chain is true for; every row without a chain."""
    if not values:
        raise ValueError("an update needs at least one value")
    _column_names(df, list(values))
    frame, cond, flags = _matching(df, terms)
    touched = fresh("touched")
    frame = frame.withColumn(touched, cond)
    return frame.withColumns(_changed(frame, values, touched, df.columns)).drop(touched, *flags)


def delete_where(df: DataFrame, *terms: Node) -> DataFrame:
    """The rows the chain is false or unknown for; none without a chain."""
    only = terms[0] if len(terms) == 1 and isinstance(terms[0], Term) else None
    if only is not None and only.sub is not None and not only.negated:
        # what the sub-select answers yes for goes; an unknown answer matches no key and stays
        return without_matches(df, only)
    frame, cond, flags = _matching(df, terms)
    return frame.where(~cond).drop(*flags)


def affected(df: DataFrame, *terms: Node) -> DataFrame:
    """One row: how many rows the chain is true for."""
    return where(df, *terms).agg(F.count(F.lit(1)).alias("affected"))


# ---------------------------------------------------------------- writes as values, and batches


@dataclass(frozen=True)
class Insert:
    """Literal ``rows``, or a ``query`` (a frame, or a function of the batch's tables), which wins over rows."""

    table: str
    rows: Sequence[Mapping[str, Any]] = ()
    query: Query | None = None


@dataclass(frozen=True)
class Update:
    table: str
    values: Mapping[str, Any] = field(default_factory=dict)
    where: Terms = ()


@dataclass(frozen=True)
class Delete:
    table: str
    where: Terms = ()


Write = Union[Insert, Update, Delete]


def terms_of(write: Update | Delete, tables: Tables) -> list[Node]:
    """The write's chain; sub-selects in it may be built from the tables as they stand at that point of the batch."""
    found = write.where(tables) if callable(write.where) else write.where
    return list(found)


def new_rows(write: Insert, df: DataFrame, tables: Tables) -> DataFrame:
    if write.query is None:
        return literal_rows(df, write.rows)
    return selected_rows(df, write.query(tables) if callable(write.query) else write.query)


@dataclass(frozen=True)
class Watched:
    """A table with a mark for each write so far on the rows it touched; deleted rows stay, no longer alive.

    So all counts of a table, and what is left of it, come from one pass over one frame.
    """

    frame: DataFrame
    columns: tuple[str, ...]
    alive: str
    marks: dict[int, str]

    @property
    def rows(self) -> DataFrame:
        """What the table holds after the writes."""
        return self.frame.where(F.col(self.alive)).select(*[F.col(f"`{c}`") for c in self.columns])

    @property
    def counts(self) -> list[Column]:
        """An aggregate for each write: how many rows it touched."""
        return [F.count(F.when(F.col(mark), 1)).alias(f"write_{i}") for i, mark in self.marks.items()]


def _watch(df: DataFrame) -> Watched:
    alive = fresh("alive")
    return Watched(df.withColumn(alive, F.lit(True)), tuple(df.columns), alive, {})


def _inserted(watched: Watched, number: int, rows: DataFrame) -> Watched:
    mark, old = fresh("touched"), {m: F.lit(False) for m in watched.marks.values()}
    new = rows.withColumns({watched.alive: F.lit(True), **old, mark: F.lit(True)})
    return Watched(watched.frame.withColumn(mark, F.lit(False)).unionByName(new), watched.columns, watched.alive, {**watched.marks, number: mark})


def _touched(watched: Watched, number: int, write: Update | Delete, terms: Sequence[Node]) -> Watched:
    mark, alive = fresh("touched"), F.col(watched.alive)
    frame, cond, flags = _matching(watched.frame, terms)
    frame = frame.withColumn(mark, alive & cond)
    if isinstance(write, Update):
        frame = frame.withColumns(_changed(frame, write.values, mark, watched.columns))
    else:
        frame = frame.withColumn(watched.alive, alive & ~F.col(mark))
    return Watched(frame.drop(*flags), watched.columns, watched.alive, {**watched.marks, number: mark})


@dataclass(frozen=True)
class Batch:
    """The tables after the batch, the count of each write, and the tables with their marks, from which both can be had at once."""

    tables: dict[str, DataFrame]
    counts: DataFrame
    watched: dict[str, Watched]


def apply_batch(tables: Tables, writes: Sequence[Write]) -> Batch:
    """All writes in order over named frames, each seeing what the earlier ones did.

    ``counts`` has one row (write, affected) per write, numbered from 0; all counts of a table are one pass over it. Frames
    are values, so nothing is changed unless the caller stores the result; a write that is refused leaves the given frames
    as they were.
    """
    if not writes:
        raise ValueError("a batch needs at least one write")
    now, watched = dict(tables), {}
    for i, write in enumerate(writes):
        if write.table not in now:
            raise ValueError(f"no table {write.table}")
        df = now[write.table]
        before = watched.get(write.table) or _watch(df)
        if isinstance(write, Insert):
            rows = new_rows(write, df, now)
            now[write.table], watched[write.table] = df.unionByName(rows), _inserted(before, i, rows)
            continue
        terms = terms_of(write, now)
        watched[write.table] = _touched(before, i, write, terms)
        now[write.table] = update_where(df, write.values, *terms) if isinstance(write, Update) else delete_where(df, *terms)
    counts = []
    for table in watched.values():
        each = [F.struct(F.lit(i).alias("write"), F.col(f"write_{i}").alias("affected")) for i in table.marks]
        counts.append(table.frame.agg(*table.counts).select(F.inline(F.array(*each))))
    return Batch(now, reduce(lambda a, b: a.union(b), counts), watched)
