"""What a join condition says about both sides at once, read from the analysed condition, not from how it was written.

A link is a comparison of an expression over one side with an expression over the other. An equality lets Spark hash or sort
both sides; an inequality lets them meet by ranges. Terms and raw text give the same links. Links are implied by the condition,
which is still checked where rows meet.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Iterator

from pyspark.sql import Column, DataFrame

_NAMES = {"EqualTo": "=", "GreaterThan": ">", "GreaterThanOrEqual": ">=", "LessThan": "<", "LessThanOrEqual": "<="}
MIRRORED = {"=": "=", ">": "<", ">=": "<=", "<": ">", "<=": ">="}
_DENIED = {">": "<=", ">=": "<", "<": ">=", "<=": ">"}


@dataclass(frozen=True)
class Link:
    """``left relation right``, each side SQL text over the columns of its own frame."""

    left: str
    relation: str
    right: str


@dataclass(frozen=True)
class Condition:
    """A condition's Or branches, each with its text, its links and its one-sided conjuncts, and the left columns it reads."""

    branches: tuple["Branch", ...]
    left_reads: tuple[str, ...] = ()


@dataclass(frozen=True)
class Branch:
    text: str
    links: tuple[Link, ...]
    left_only: tuple[str, ...]
    right_only: tuple[str, ...]
    others: int

    @property
    def equal(self) -> bool:
        return any(link.relation == "=" for link in self.links)


def _children(expression) -> list:
    found = expression.children()
    return [found.apply(i) for i in range(found.size())]


def _kind(expression) -> str:
    return expression.getClass().getSimpleName()


def _split(expression, name: str) -> Iterator:
    if _kind(expression) == name:
        for child in _children(expression):
            yield from _split(child, name)
    else:
        yield expression


class _Sides:
    def __init__(self, node):
        self.left, self.right = node.left().outputSet(), node.right().outputSet()

    def of(self, expression) -> str:
        """left, right, both, or none for a constant."""
        read = expression.references()
        if read.isEmpty():
            return "none"
        if read.subsetOf(self.left):
            return "left"
        return "right" if read.subsetOf(self.right) else "both"

    def compared(self, one, relation: str, two) -> Link | None:
        sides = (self.of(one), self.of(two))
        if sides == ("left", "right"):
            return Link(one.sql(), relation, two.sql())
        if sides == ("right", "left"):
            return Link(two.sql(), MIRRORED[relation], one.sql())
        return None

    def near(self, one, relation: str, two) -> Link | None:
        """What a bounded difference of doubles of two sides implies: ``x - y < c`` gives ``y >= x - c``.

        Rounding keeps order, so no pair is lost. Only upper bounds: a difference that is not a number is above any other.
        """
        if _kind(two) == "Subtract":
            one, relation, two = two, MIRRORED[relation], one
        if _kind(one) != "Subtract" or relation not in ("<", "<=") or self.of(two) != "none" or not two.foldable():
            return None
        if any(e.dataType().typeName() != "double" for e in (one, two)):
            return None
        most = two.eval(None)
        if most is None or not math.isfinite(most):
            return None
        most = most if relation == "<" else math.nextafter(most, math.inf)
        x, y, sides = one.left(), one.right(), (self.of(one.left()), self.of(one.right()))
        if not math.isfinite(most) or sides not in (("left", "right"), ("right", "left")):
            return None
        least = f"({x.sql()} - ({most!r}D))"
        return Link(least, "<=", y.sql()) if sides[0] == "left" else Link(y.sql(), ">=", least)

    def branch(self, expression) -> Branch:
        links, sides, others = [], {"left": [], "right": []}, 0
        for part in _split(expression, "And"):
            kind, found = _kind(part), []
            side = self.of(part)
            if kind == "Between":
                given = part.parameters()
                value, low, high = (given.apply(i) for i in range(3))
                found = [self.compared(value, ">=", low), self.compared(value, "<=", high)]
            elif kind == "Not" and _NAMES.get(_kind(part.child())) in _DENIED:
                inner = part.child()
                found = [self.compared(inner.left(), _DENIED[_NAMES[_kind(inner)]], inner.right())]
            elif kind in _NAMES:
                found = [self.compared(part.left(), _NAMES[kind], part.right())]
            known = [link for link in found if link]
            links += known
            if side in sides:
                sides[side].append(part.sql())
            elif side == "both" and (not found or len(known) < len(found)):
                others += 1
                implied = self.near(part.left(), _NAMES[kind], part.right()) if kind in _NAMES else None
                links += [implied] if implied else []
        return Branch(expression.sql(), tuple(links), tuple(sides["left"]), tuple(sides["right"]), others)


def condition_of(left: DataFrame, right: DataFrame, on: Column) -> Condition:
    """The branches of a join condition; nothing runs."""
    node = left.join(right, on)._jdf.queryExecution().analyzed()
    expression, sides = node.condition().get(), _Sides(node)
    read = expression.references().toSeq()
    reads = {a.sql(): None for a in (read.apply(i) for i in range(read.size())) if a.references().subsetOf(sides.left)}
    return Condition(tuple(sides.branch(part) for part in _split(expression, "Or")), tuple(reads))


def in_lambda(left: DataFrame, right: DataFrame, on: Column) -> tuple[str, tuple[str, ...], str] | None:
    """The condition as SQL text in which a right row is a lambda's variable: its name, the right columns read, the text.

    The variable is called as the right frame is, so that ``p.price`` is a field of it. None where a name would be ambiguous
    or text can't say the condition.
    """
    node = left.join(right, on)._jdf.queryExecution().analyzed()
    expression, sides = node.condition().get(), _Sides(node)
    pending = [expression]
    while pending:
        part = pending.pop()
        if _kind(part) == "LambdaFunction" or _kind(part).endswith(("Subquery", "Exists", "ListQuery")):
            return None
        pending += _children(part)
    read = expression.references().toSeq()
    owners, names, others = set(), [], set()
    for attribute in (read.apply(i) for i in range(read.size())):
        qualifier = attribute.qualifier()
        if attribute.references().subsetOf(sides.left):
            others.add((qualifier.apply(0) if qualifier.size() else attribute.name()).lower())
        else:
            owners.add(qualifier.apply(0) if qualifier.size() == 1 else "")
            names.append(attribute.name())
    if len(owners) != 1 or "" in owners or not expression.deterministic() or len({n.lower() for n in names}) != len(names):
        return None
    (owner,) = owners
    return None if owner.lower() in others else (owner, tuple(names), expression.sql())
