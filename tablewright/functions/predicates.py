"""Predicate terms, chains and groups.

A *term* compares one column with a literal (or, wrapped in :func:`other`, with another column), asks a question about
a sub-select, or is raw boolean text. Terms form a flat chain in which each one says how it relates to the term before
it (``and_``, ``or_``, ``and_not``, ``or_not``). No parentheses are implied, so AND binds tighter than OR exactly as in
SQL: ``a OR b AND c`` is ``a OR (b AND c)``. A *group* is a parenthesised chain that may hold further groups; the groups
inside it are linked by the link of the group that holds them.

:func:`where` filters a frame by such a tree; :func:`condition` gives the bare ``Column``. Sub-selects never reach the
optimizer as ``NOT IN``: that plan broadcasts the sub-select whatever its size. They become semi and anti joins where
the tree is a conjunction, and joined true/false/unknown columns elsewhere.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace
from decimal import Decimal
from functools import reduce
from typing import Any, Callable, Iterable, Sequence, Union

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..operators.pairs import match_flag, semi_join
from .columns import all_of, any_of, fresh
from .literals import bind, column_type, typed_literal

AND, OR, AND_NOT, OR_NOT = "and", "or", "and not", "or not"
LINKS = (AND, OR, AND_NOT, OR_NOT)

COMPARISONS: dict[str, Callable[[Column, Any], Column]] = {
    "=": lambda a, b: a == b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
}
PATTERNS = {"starts": "{}%", "ends": "%{}", "contains": "%{}%"}
RELATIONS = (*COMPARISONS, *PATTERNS, "in", "null", "true", "exists", "raw", "flag")
_IN_TYPES_ERROR = "an In list holds strings, numbers, booleans or dates, not {}"


@dataclass(frozen=True)
class ColumnRef:
    """Right-hand side of a term that is a column instead of a literal."""

    name: str


@dataclass(frozen=True)
class SubSelect:
    """A sub-select and the equality pairs or text that tie it to the outer row."""

    frame: DataFrame
    on: Any = None


@dataclass(frozen=True)
class Term:
    relation: str
    column: str | None = None
    value: Any = None
    link: str = AND
    case_sensitive: bool = False

    def __post_init__(self) -> None:
        if self.relation not in RELATIONS:
            raise ValueError(f"unknown relation {self.relation!r}; known are {', '.join(RELATIONS)}")
        if self.link not in LINKS:
            raise ValueError(f"unknown link {self.link!r}; known are {', '.join(LINKS)}")

    @property
    def negated(self) -> bool:
        return self.link in (AND_NOT, OR_NOT)

    @property
    def sub(self) -> SubSelect | None:
        return self.value if isinstance(self.value, SubSelect) else None


@dataclass(frozen=True)
class Group:
    """Terms first, then groups; ``link`` says how *its* groups are linked to what stands before them."""

    terms: tuple[Term, ...] = ()
    groups: tuple["Group", ...] = ()
    link: str = AND

    def __post_init__(self) -> None:
        if self.link not in LINKS:
            raise ValueError(f"unknown link {self.link!r}; known are {', '.join(LINKS)}")


Node = Union[Term, Group]


# ---------------------------------------------------------------- building terms


def other(name: str) -> ColumnRef:
    return ColumnRef(name)


def eq(column: str, value: Any) -> Term:
    return Term("=", column, value)


def gt(column: str, value: Any) -> Term:
    return Term(">", column, value)


def ge(column: str, value: Any) -> Term:
    return Term(">=", column, value)


def lt(column: str, value: Any) -> Term:
    return Term("<", column, value)


def le(column: str, value: Any) -> Term:
    return Term("<=", column, value)


def in_list(column: str, values: Iterable[Any]) -> Term:
    if isinstance(values, (str, bytes)) or not hasattr(values, "__iter__"):
        raise ValueError(_IN_TYPES_ERROR.format(type(values).__name__))
    return Term("in", column, tuple(values))


def in_query(column: str, sub: DataFrame) -> Term:
    if len(sub.columns) != 1:
        raise ValueError(f"the sub-select of an In has one column, not {len(sub.columns)}")
    return Term("in", column, SubSelect(sub))


def exists(sub: DataFrame, on: Sequence[tuple[str, str]] | str | None = None) -> Term:
    """``on`` holds (outer column, inner column) equality pairs, or text over both sides, or nothing."""
    if on is not None and not isinstance(on, str):
        on = tuple((outer, inner) for outer, inner in on)
    return Term("exists", None, SubSelect(sub, on))


def is_null(column: str) -> Term:
    return Term("null", column)


def is_true(column: str) -> Term:
    return Term("true", column)


def starts_with(column: str, value: str, case_sensitive: bool = False) -> Term:
    return Term("starts", column, value, case_sensitive=case_sensitive)


def ends_with(column: str, value: str, case_sensitive: bool = False) -> Term:
    return Term("ends", column, value, case_sensitive=case_sensitive)


def contains(column: str, value: str, case_sensitive: bool = False) -> Term:
    return Term("contains", column, value, case_sensitive=case_sensitive)


def raw(text: str, *bindings: Any) -> Term:
    return Term("raw", text, bindings)


def and_(term: Term) -> Term:
    return replace(term, link=AND)


def or_(term: Term) -> Term:
    return replace(term, link=OR)


def and_not(term: Term) -> Term:
    return replace(term, link=AND_NOT)


def or_not(term: Term) -> Term:
    return replace(term, link=OR_NOT)


def group(*nodes: Node, link: str = AND) -> Group:
    return Group(
        tuple(n for n in nodes if isinstance(n, Term)),
        tuple(n for n in nodes if isinstance(n, Group)),
        link,
    )


def as_group(nodes: Sequence[Node]) -> Group:
    return nodes[0] if len(nodes) == 1 and isinstance(nodes[0], Group) else group(*nodes)


# ---------------------------------------------------------------- from terms to columns


def combine(parts: Sequence[tuple[str, Column]]) -> Column:
    """Join linked conditions without parentheses: runs of And, split at every Or."""
    runs = split_at_or([(link in (OR, OR_NOT), cond) for link, cond in parts])
    return any_of([all_of(run) for run in runs])


def split_at_or(parts: Sequence[tuple[bool, Any]]) -> list[list[Any]]:
    runs: list[list[Any]] = []
    for starts_run, item in parts:
        if starts_run or not runs:
            runs.append([])
        runs[-1].append(item)
    return runs


class _Types:
    """Column types by name, looked up once each over the frames a condition may read."""

    def __init__(self, frames: Sequence[DataFrame]):
        # joined only to look names up: nothing of this plan ever runs
        self.scope = reduce(lambda a, b: a.join(b, F.lit(True)), frames) if frames else None
        self.seen: dict[str, T.DataType] = {}

    def __call__(self, name: str) -> T.DataType:
        if name not in self.seen:
            self.seen[name] = column_type(self.scope, name)
        return self.seen[name]


def _like(term: Term) -> Column:
    if not isinstance(term.value, str):
        raise ValueError(f"{term.relation} needs text, not {term.value!r}")
    column = F.col(term.column)
    if term.case_sensitive and not any(ch in term.value for ch in "%_"):
        exact = {"starts": column.startswith, "ends": column.endswith, "contains": column.contains}
        return exact[term.relation](term.value)
    pattern = PATTERNS[term.relation].format(term.value.replace("\\", "\\\\"))
    return column.like(pattern) if term.case_sensitive else column.ilike(pattern)


def _in_values(term: Term, types: _Types) -> Column:
    for v in term.value:
        if v is not None and not isinstance(v, (str, int, float, bool, Decimal, dt.date)):
            raise ValueError(_IN_TYPES_ERROR.format(type(v).__name__))
    dtype = types(term.column)
    values = [F.lit(None).cast(dtype) if v is None else typed_literal(v, dtype, term.column) for v in term.value]
    return F.col(term.column).isin(*values)


def term_column(term: Term, types: _Types) -> Column:
    """The condition of one term, negation included."""
    relation, negated = term.relation, term.negated
    if relation == "raw":
        if negated:
            raise ValueError("a raw term cannot be negated; write the negation into its text")
        return bind(term.column, term.value)
    if relation == "true":
        return F.col(term.column) == typed_literal(not negated, types(term.column), term.column)
    if relation == "null" or (relation == "=" and term.value is None):
        return F.col(term.column).isNotNull() if negated else F.col(term.column).isNull()
    if relation == "flag":
        positive = F.col(term.column)
    elif relation in COMPARISONS:
        if term.value is None:
            raise ValueError(f"{term.column} {relation} null has no meaning")
        right = (
            F.col(term.value.name)
            if isinstance(term.value, ColumnRef)
            else typed_literal(term.value, types(term.column), term.column)
        )
        positive = COMPARISONS[relation](F.col(term.column), right)
    elif relation in PATTERNS:
        positive = _like(term)
    elif term.sub is not None:
        raise ValueError("a sub-select term belongs in where(), not in a bare condition")
    else:
        positive = _in_values(term, types)
    return ~positive if negated else positive


def _tree_column(tree: Group, types: _Types) -> Column | None:
    parts = [(term.link, term_column(term, types)) for term in tree.terms]
    for inner in tree.groups:
        cond = _tree_column(inner, types)
        if cond is None:
            continue
        negate = bool(parts) and tree.link in (AND_NOT, OR_NOT)
        parts.append((tree.link, ~cond if negate else cond))
    return combine(parts) if parts else None


def condition(frames: DataFrame | Sequence[DataFrame], *nodes: Node) -> Column | None:
    """The tree as one ``Column``; None when the tree is empty. ``frames`` supply the column types."""
    frames = [frames] if isinstance(frames, DataFrame) else list(frames)
    return _tree_column(as_group(nodes), _Types(frames))


# ---------------------------------------------------------------- sub-selects


def _keys(sub: DataFrame, names: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The distinct non-null keys of a sub-select. A hot key collapses map-side, before the shuffle."""
    made = [fresh("key") for _ in names]
    keys = sub.select(*[F.col(n).alias(k) for n, k in zip(names, made)])
    return keys.where(all_of([F.col(k).isNotNull() for k in made])).distinct(), made


@dataclass(frozen=True)
class _Members:
    """The distinct values of a one-column sub-select, nulls under a default value, and what is known of it as a whole.

    ``keys`` (key, real: whether the value itself occurs) and the counts are made of the same aggregate, in which no key is
    null, so Spark reads and shuffles the sub-select once for both.
    """

    keys: DataFrame
    key: str
    real: str
    stand_in: Column
    empty: Column
    has_null: Column


def _members(sub: DataFrame) -> _Members | None:
    """None for a type without a default value."""
    dtype = sub.schema.fields[0].dataType
    plain = {T.StringType: "", T.BooleanType: "false", T.DateType: "1970-01-01", T.TimestampType: "1970-01-01", T.TimestampNTZType: "1970-01-01"}
    default = "0" if isinstance(dtype, T.NumericType) else plain.get(type(dtype))
    if default is None:
        return None
    key, real, rows, nulls = (fresh(n) for n in ("key", "real", "rows", "nulls"))
    column, stand_in = F.col(_in_column(sub)), F.lit(default).cast(dtype)
    keys = sub.select(F.coalesce(column, stand_in).alias(key), column.isNull().alias("_null")).groupBy(key)
    # always true, but both counts are read by whoever reads a key
    keys = keys.agg(F.count(F.lit(1)).alias(rows), F.count_if("_null").alias(nulls)).where((F.col(rows) > 0) & (F.col(nulls) >= 0))
    whole = keys.agg(F.struct(F.count(F.lit(1)).alias("keys"), F.coalesce(F.sum(nulls), F.lit(0)).alias("nulls"))).scalar()
    return _Members(keys.select(key, (F.col(rows) > F.col(nulls)).alias(real)), key, real, stand_in, whole["keys"] == 0, whole["nulls"] > 0)


def _pairs_match(pairs: Sequence[tuple[str, str]], names: Sequence[str]) -> Column:
    return all_of([F.col(outer) == F.col(k) for (outer, _), k in zip(pairs, names)])


def _in_column(sub: DataFrame) -> str:
    return f"`{sub.columns[0]}`"


def _counts(sub: DataFrame) -> Column:
    """One-row scalar: all rows and non-null rows of a one-column sub-select."""
    inner = sub.toDF("k")
    return inner.agg(F.struct(F.count(F.lit(1)).alias("n"), F.count("k").alias("filled"))).scalar()


def _join_sub(df: DataFrame, term: Term) -> DataFrame:
    """A sub-select term that must hold, as a semi or anti join."""
    sub, negated = term.sub, term.negated
    how = "left_anti" if negated else "left_semi"
    if term.relation == "in":
        column, members = F.col(term.column), _members(sub.frame) if negated else None
        if members is not None:
            # one case that reads the column, and a key that isn't the bare column: else what is asked of the column
            # is asked of the keys as well, and the sub-select would be read once with that and once without
            df = df.where(F.when(column.isNull(), members.empty).otherwise(members.empty | ~members.has_null))
            return df.join(members.keys, F.coalesce(column, members.stand_in) == F.col(members.key), how)
        keys, names = _keys(sub.frame, [_in_column(sub.frame)])
        if negated:
            counts = _counts(sub.frame)
            empty = counts["n"] == 0
            df = df.where(empty | (column.isNotNull() & (counts["n"] == counts["filled"])))
        return df.join(keys, F.col(term.column) == F.col(names[0]), how)
    if sub.on is None:
        return df.where(~sub.frame.exists() if negated else sub.frame.exists())
    if isinstance(sub.on, str):
        return semi_join(df, sub.frame, F.expr(sub.on), anti=negated)
    keys, names = _keys(sub.frame, [inner for _, inner in sub.on])
    return df.join(keys, _pairs_match(sub.on, names), how)


def without_matches(df: DataFrame, term: Term) -> DataFrame:
    """The rows for which a sub-select term is not true: false and unknown stay."""
    sub = term.sub
    if term.relation == "in":
        pairs = [(term.column, _in_column(sub.frame))]
    elif sub.on is None:
        return df.where(~sub.frame.exists())
    elif isinstance(sub.on, str):
        return semi_join(df, sub.frame, F.expr(sub.on), anti=True)
    else:
        pairs = sub.on
    keys, names = _keys(sub.frame, [inner for _, inner in pairs])
    return df.join(keys, _pairs_match(pairs, names), "left_anti")


def _flag_sub(df: DataFrame, term: Term, unknown_matters: bool) -> tuple[DataFrame, Term, list[str]]:
    """The same question as a true/false/unknown column, for use under Or and inside groups.

    The keys are distinct, so the left join never multiplies rows.
    """
    sub, flag, mark = term.sub, fresh("flag"), fresh("mark")
    if term.relation == "exists" and isinstance(sub.on, str):
        flagged = match_flag(df, sub.frame, F.expr(sub.on), flag)
        if flagged is not None:
            return flagged, replace(term, relation="flag", column=flag, value=None), [flag]
    if term.relation == "exists" and (sub.on is None or isinstance(sub.on, str)):
        inner = sub.frame if sub.on is None else sub.frame.where(F.expr(sub.on).outer())
        return df.withColumn(flag, inner.exists()), replace(term, relation="flag", column=flag, value=None), [flag]
    # only under a negation do false and unknown differ; telling them apart takes counts of the sub-select
    members = _members(sub.frame) if term.relation == "in" and unknown_matters else None
    if members is not None:
        column = F.col(term.column)
        unknown = ~members.empty & (column.isNull() | members.has_null)
        answer = F.when(column.isNotNull() & F.col(members.real), True).when(unknown, F.lit(None).cast("boolean")).otherwise(False)
        joined = df.join(members.keys, F.coalesce(column, members.stand_in) == F.col(members.key), "left").withColumn(flag, answer)
        return joined.drop(members.key, members.real), replace(term, relation="flag", column=flag, value=None), [flag]
    if term.relation == "in":
        keys, names = _keys(sub.frame, [_in_column(sub.frame)])
        pairs, answer = [(term.column, "")], F.coalesce(F.col(mark), F.lit(False))
        if unknown_matters:
            column, counts = F.col(term.column), _counts(sub.frame)
            unknown = (counts["n"] > 0) & (column.isNull() | (counts["n"] > counts["filled"]))
            answer = F.when(F.col(mark), True).when(unknown, F.lit(None).cast("boolean")).otherwise(False)
    else:
        keys, names = _keys(sub.frame, [inner for _, inner in sub.on])
        pairs, answer = sub.on, F.coalesce(F.col(mark), F.lit(False))
    joined = df.join(keys.withColumn(mark, F.lit(True)), _pairs_match(pairs, names), "left").withColumn(flag, answer)
    return joined.drop(*names, mark), replace(term, relation="flag", column=flag, value=None), [flag]


@dataclass
class Flagged:
    """A frame with its sub-select answers joined on, the tree that reads them, and the columns to drop afterwards."""

    frame: DataFrame
    tree: Group
    flags: list[str] = field(default_factory=list)

    @property
    def condition(self) -> Column | None:
        return condition(self.frame, self.tree)


def flag_sub_selects(df: DataFrame, tree: Group, negated: bool = False) -> Flagged:
    terms, flags = [], []
    for term in tree.terms:
        if term.sub is not None:
            df, term, added = _flag_sub(df, term, negated or term.negated)
            flags += added
        terms.append(term)
    groups = []
    for inner in tree.groups:
        done = flag_sub_selects(df, inner, negated or tree.link in (AND_NOT, OR_NOT))
        df, flags = done.frame, flags + done.flags
        groups.append(done.tree)
    return Flagged(df, Group(tuple(terms), tuple(groups), tree.link), flags)


def _is_conjunction(tree: Group) -> bool:
    links = [t.link for t in tree.terms[1:]] + ([tree.link] if tree.groups and tree.terms else [])
    links += [tree.link] if len(tree.groups) > 1 else []
    return all(link in (AND, AND_NOT) for link in links)


def where(df: DataFrame, *nodes: Node) -> DataFrame:
    """Rows for which the tree is true. An empty tree keeps every row."""
    tree, joins = as_group(nodes), []
    if _is_conjunction(tree):
        joins = [t for t in tree.terms if t.sub is not None]
        rest = tuple(t for t in tree.terms if t.sub is None)
        if rest or tree.link == AND or not tree.groups:
            tree = replace(tree, terms=rest)
        else:
            joins = []
    flagged = flag_sub_selects(df, tree)
    cond = flagged.condition
    out = flagged.frame if cond is None else flagged.frame.where(cond)
    out = out.drop(*flagged.flags) if flagged.flags else out
    for term in joins:
        out = _join_sub(out, term)
    return out
