"""Which rows of one side the values of another can reach by a condition's inequalities, told by least and largest values.

Values are cut into ranges, a few for each core, and a row of the other side goes, once, to each range that holds a value it may
match. Then all that a value meets is in its range: nothing needs a row for each pair. That pays where most rows of a range
are met by most of its values, which a sample tells; finer ranges are taken where it doesn't, and None where they don't help.
"""

from __future__ import annotations

import json
from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.columns import all_of, any_of, fresh
from ..functions.links import MIRRORED, Link, condition_of
from .ranges import MOST_SPLITS, SortKey, Splits, range_bucket, split_points

RANGES_PER_CORE = 4
VALUES_PER_RANGE = 2
FINER = 4
#: Candidates that match, of a sample: with so many ranges are fine enough, with fewer at last it doesn't pay.
ENOUGH, LEAST = 0.5, 0.125
SAMPLE = 2048
#: Of types whose text is the value itself.
_EXACT = (T.IntegralType, T.FloatType, T.DoubleType, T.DecimalType, T.DateType, T.BooleanType)


def _possible(relation: str, own: Column, least: Column, most: Column) -> Column:
    """Whether ``own relation x`` can hold for a value x from ``least`` to ``most``."""
    if relation == "=":
        return (own >= least) & (own <= most)
    return {">": own > least, ">=": own >= least, "<": own < most, "<=": own <= most}[relation]


def _sampled(df: DataFrame, count: int, seed: int) -> DataFrame:
    return df if count <= SAMPLE else df.where(F.rand(seed) < SAMPLE / count)


class Reach:
    """``values`` are different rows with the columns ``keys``, ``other`` the rows that ``on`` holds them against.

    ``reach_of`` makes one. ``placed`` gives rows that have the keys their range, ``reached`` the other side's rows once for
    each range that may need them.
    """

    def __init__(self, values: DataFrame, keys: Sequence[str], other: DataFrame, on: Column):
        self._values, self._keys, self._other, self._on = values, list(keys), other, on
        self._branches = condition_of(values, other, on).branches
        self._kinds: dict[Link, T.DataType] = {}
        for link in dict.fromkeys(link for branch in self._branches for link in branch.links):
            kind, right = values.select(F.expr(link.left)).schema[0].dataType, other.select(F.expr(link.right)).schema[0].dataType
            if kind == right and isinstance(kind, _EXACT):
                self._kinds[link] = kind
        self._links = list(self._kinds)
        self.range, self.hash = fresh("range"), fresh("hash")

    @property
    def useful(self) -> bool:
        """Each branch has an inequality or equality that can be told, and one of them no equality."""
        told = all(any(link in self._kinds for link in branch.links) for branch in self._branches)
        return told and not all(branch.equal for branch in self._branches)

    def _ends(self, df: DataFrame, texts: Sequence[str], *more: Column, by: str | None = None) -> list:
        found = [f(F.expr(text)).cast("string").alias(f"{name}{i}") for i, text in enumerate(texts) for f, name in ((F.min, "least"), (F.max, "most"))]
        return (df.rollup(by) if by else df).agg(*found, *more).collect()

    def _holds(self, mirrored: bool, ends, sides: bool, own: Sequence[Column]) -> Column:
        """Whether a row can match any of the other side; ``ends`` gives the other side's least and largest of link i."""
        ways = []
        for branch in self._branches:
            parts = []
            for i, link in enumerate(self._links):
                if link in branch.links:
                    parts.append(_possible(MIRRORED[link.relation] if mirrored else link.relation, own[i], *ends(i)))
            if sides:
                parts += [F.expr(text) for text in (branch.right_only if mirrored else branch.left_only)]
            ways.append(all_of(parts))
        return F.coalesce(any_of(ways), F.lit(False))

    def _literal(self, row):
        return lambda i: [F.lit(row[f"{end}{i}"]).cast(self._kinds[self._links[i]]) for end in ("least", "most")]

    def _with_hash(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.hash, F.xxhash64(*self._keys))

    def _bucket(self, cut: Splits) -> Column:
        return range_bucket(cut, [self._lead, self.hash])

    def prepare(self) -> bool:
        """Chooses the ranges; False where rows for each pair are as good."""
        lefts, rights = [F.expr(link.left) for link in self._links], [F.expr(link.right) for link in self._links]
        (all_other,) = self._ends(self._other, [link.right for link in self._links])
        self._able = self._holds(False, self._literal(all_other), True, lefts)
        lead = next(link for branch in self._branches if not branch.equal for link in branch.links if link in self._kinds)
        self._lead, self._lead_text = fresh("lead"), lead.left
        able = self._with_hash(self._values).where(self._able).withColumn(self._lead, F.expr(lead.left))
        count = able.count()
        few = RANGES_PER_CORE * self._values.sparkSession.sparkContext.defaultParallelism
        most = max(1, min(MOST_SPLITS, -(-count // VALUES_PER_RANGE)))
        keys = [SortKey(self._lead), SortKey(self.hash)]
        finest = split_points(able.select(self._lead, self.hash), keys, most, count=count)
        wanted = min(few, most)
        while True:
            step = max(1, most // wanted)
            cut = Splits(finest.keys, finest.types, finest.points[step - 1 :: step] if step > 1 else finest.points)
            ranged = able.withColumn(self.range, self._bucket(cut))
            ends = self._ends(ranged, [link.left for link in self._links], by=self.range)
            total = next((r for r in ends if r[self.range] is None), None)
            self._cut, self._bounds = cut, [r for r in ends if r[self.range] is not None]
            self._near = self._holds(True, self._literal(total), True, rights) if total and self._bounds else F.lit(False)
            if wanted <= few:
                self.count = self.near.count()
            self.parts = RANGES_PER_CORE * max(few, len(self._bounds))
            if not self.count or not self._bounds:
                return True
            share = self._share(ranged, count)
            if share >= ENOUGH or wanted * FINER > most:
                return share >= LEAST
            wanted *= FINER

    def _share(self, ranged: DataFrame, count: int) -> float:
        """Of the rows that a sample of values would be held against, those they match."""
        range_2 = fresh("range")
        rows = self.reached(_sampled(self.near, self.count, 7), range_2)
        met = _sampled(ranged, count, 11).join(rows, F.col(self.range) == F.col(range_2))
        tried, matched = met.agg(F.count(F.lit(1)), F.count_if(self._on)).first()
        return matched / tried if tried else 1.0

    def reached(self, rows: DataFrame, name: str) -> DataFrame:
        """Rows of ``near`` once for each range that may need them, whose number is the column ``name``."""
        own = [fresh("own") for _ in self._links]
        rows = rows.withColumns({n: F.expr(link.right) for n, link in zip(own, self._links)})
        names = [f"{end}{i}" for i in range(len(self._links)) for end in ("least", "most")]
        text = json.dumps([{"range": r[self.range], **{n: r[n] for n in names}} for r in self._bounds])
        plain = ", ".join(f"{n}: string" for n in names)
        typed = ", ".join(f"{n}: {self._kinds[self._links[i // 2]].simpleString()}" for i, n in enumerate(names))
        bounds = F.from_json(F.lit(text), f"array<struct<range: int, {plain}>>").cast(f"array<struct<range: int, {typed}>>")

        def holds(bound: Column) -> Column:
            return self._holds(True, lambda i: [bound[f"least{i}"], bound[f"most{i}"]], False, [F.col(n) for n in own])

        return rows.withColumn(name, F.explode(F.filter(bounds, holds)["range"])).drop(*own)

    @property
    def near(self) -> DataFrame:
        """The other side's rows that may match anything."""
        return self._other.where(self._near)

    def placed(self, df: DataFrame) -> DataFrame:
        """Rows that have the keys, with their range and the hash of their keys; those that can't match are dealt by the hash."""
        rows = self._with_hash(df).withColumn(self._lead, F.expr(self._lead_text))
        elsewhere = F.lit(len(self._cut.points) + 1) + F.pmod(self.hash, F.lit(self.parts)).cast("int")
        return rows.withColumn(self.range, F.when(self._able, self._bucket(self._cut)).otherwise(elsewhere)).drop(self._lead)


def reach_of(values: DataFrame, keys: Sequence[str], other: DataFrame, on: Column) -> Reach | None:
    reach = Reach(values, keys, other, on)
    return reach if reach.useful and reach.prepare() else None
