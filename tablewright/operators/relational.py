"""Projection, joins and grouping."""

from __future__ import annotations

from typing import Any, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import all_of, any_of
from ..functions.predicates import (
    AND_NOT,
    OR,
    OR_NOT,
    COMPARISONS,
    Group,
    Node,
    Term,
    as_group,
    condition,
    split_at_or,
    where,
)
from .pairs import pair_join

JOIN_TYPES = ("inner", "left")


# ---------------------------------------------------------------- projection


def column(name: str, alias: str | None = None) -> Column:
    return F.col(name) if alias is None else F.col(name).alias(alias)


def expression(text: str, alias: str) -> Column:
    if not alias:
        raise ValueError(f"expression {text!r} needs an alias")
    return F.expr(text).alias(alias)


def constant(value: Any, alias: str) -> Column:
    if not alias:
        raise ValueError(f"constant {value!r} needs an alias")
    return F.lit(value).alias(alias)


def project(df: DataFrame, *fields: Column | str | tuple[str, str]) -> DataFrame:
    """The named columns; all of them when none is named."""
    if not fields:
        return df
    return df.select(*[column(*f) if isinstance(f, tuple) else f for f in fields])


def raw_query(df_by_name: dict[str, DataFrame], text: str) -> DataFrame:
    """A sub-select given as SQL text over ``{name}`` placeholders."""
    if not df_by_name:
        raise ValueError("a raw sub-select reads at least one frame")
    spark = next(iter(df_by_name.values())).sparkSession
    return spark.sql(text, **df_by_name)


# ---------------------------------------------------------------- joins


def on_columns(left: str, right: str, relation: str = "=") -> Column:
    if relation not in COMPARISONS:
        raise ValueError(f"a join compares columns with one of {', '.join(COMPARISONS)}, not {relation!r}")
    return COMPARISONS[relation](F.col(left), F.col(right))


def _extra_conditions(frames: Sequence[DataFrame], terms: Sequence[Term]) -> list[tuple[bool, Column]]:
    """(starts a new Or branch, condition) per extra term; the first one counts as first in its own chain."""
    parts = []
    for i, term in enumerate(terms):
        starts = i > 0 and term.link in (OR, OR_NOT)
        alone = Term(term.relation, term.column, term.value, AND_NOT if term.negated else "and", term.case_sensitive)
        parts.append((starts, condition(frames, alone)))
    return parts


def join_on(
    left: DataFrame,
    right: DataFrame,
    on: tuple[str, str] | tuple[str, str, str],
    *terms: Term,
    how: str = "inner",
) -> DataFrame:
    """Join two aliased frames on (left column, right column[, relation]) plus further ON terms.

    The terms follow the chain rules of predicates, and stay in ON: a left join keeps its unmatched rows. With an Or
    among them, ``on AND t1 OR t2`` means ``(on AND t1) OR t2``. How the sides meet follows from the analysed condition, raw
    text included (see ``pairs``): where an equality links them it is Spark's choice, by size; where none does they meet
    by ranges, whose split points are sampled when the frame is built.
    """
    if how not in JOIN_TYPES:
        raise ValueError(f"unknown join type {how!r}; known are {', '.join(JOIN_TYPES)}")
    parts = [(False, on_columns(*on)), *_extra_conditions((left, right), terms)]
    return pair_join(left, right, any_of([all_of(run) for run in split_at_or(parts)]), how)


def inequality_join(
    left: DataFrame, right: DataFrame, on: tuple[str, str, str], *terms: Term, how: str = "inner", splits: int | None = None
) -> DataFrame:
    """A join whose only link is an inequality between two columns, without a nested loop over both tables.

    ``splits`` is about the number of cells in which rows meet; each side is repeated about twice its square root at most.
    """
    if how not in JOIN_TYPES:
        raise ValueError(f"unknown join type {how!r}; known are {', '.join(JOIN_TYPES)}")
    if on[2] not in (">", ">=", "<", "<="):
        raise ValueError(f"an inequality join uses > >= < or <=, not {on[2]!r}")
    parts = [(False, on_columns(*on)), *_extra_conditions((left, right), terms)]
    if any(starts for starts, _ in parts):
        raise ValueError("an Or among the further terms is for join_on")
    return pair_join(left, right, all_of([cond for _, cond in parts]), how, splits)


# ---------------------------------------------------------------- grouping


def _hidden(tree: Group, made: list[Column]) -> Group:
    """The tree with every raw term replaced by a hidden aggregate column that holds its answer."""
    terms = []
    for term in tree.terms:
        if term.relation == "raw":
            name = f"_having_{len(made)}"
            made.append(condition([], term).alias(name))
            term = Term("flag", name, link=term.link)
        terms.append(term)
    return Group(tuple(terms), tuple(_hidden(g, made) for g in tree.groups), tree.link)


def aggregate(
    df: DataFrame, keys: Sequence[Column | str], aggs: Sequence[Column], having: Sequence[Node] | Node = ()
) -> DataFrame:
    """Group, aggregate, and keep the groups for which ``having`` is true.

    Raw having terms may hold aggregates that are not in the result; other terms name result columns.
    """
    nodes = [having] if isinstance(having, (Term, Group)) else list(having)
    hidden: list[Column] = []
    tree = _hidden(as_group(nodes), hidden) if nodes else None
    grouped = df.groupBy(*keys) if keys else df
    if not [*aggs, *hidden]:
        out = df.select(*keys).distinct()
    else:
        out = grouped.agg(*aggs, *hidden)
    if tree is None:
        return out
    return where(out, tree).drop(*[f"_having_{i}" for i in range(len(hidden))])


def resolves(df: DataFrame, name: str) -> bool:
    """Whether a frame has a column of this (possibly alias-qualified) name."""
    if name.rsplit(".", 1)[-1].strip("`").lower() not in [c.lower() for c in df.columns]:
        return False
    try:
        df.select(F.col(name)).schema
        return True
    except AnalysisException:
        return False
