"""Joins whose condition gives Spark nothing to hash on, without a nested loop over both tables.

``pair_join`` looks at the analysed condition. With an equality it is a plain join. An interval (a value of one side between
two of the other, or a bounded difference) meets by bins: the value lies in one, the interval is sent to those it touches.
So does a lone inequality where one side is much smaller: its rows are intervals without an end. Sides of like sizes meet in
a matrix: both are cut into the same ranges, rows of one go by range to the matrix's rows, of the other to its columns, and
only cells where the inequality can hold get both. With k ranges there are about k * k / 2 cells and no row is repeated more
than k times. Conditions that compare nothing meet in a matrix of hashes. A condition with Or is taken branch by branch,
where a pair found by an earlier branch is left out.

Ties are cut too: ranges are of (value, hash of the row), so a value that a third of all rows have spreads over many.

Small tables can make many pairs, so the number of tasks that join does not follow from the bytes they read: the sides are dealt
to a fixed number of them.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.columns import all_of, fresh
from ..functions.links import MIRRORED, Branch, Link, condition_of
from .ranges import MOST_SPLITS, SortKey, Splits, default_splits, range_bucket, split_points

_LEAST, _MOST = -(2**63), 2**63 - 1
ROWS_PER_BIN = 256
MATRIX_RATIO = 4


def _hashable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return all(_hashable(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _hashable(dtype.elementType)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def row_hash(df: DataFrame, seed: int = 17) -> Column:
    """64 bits of a row's content, the same whenever it is computed; maps and variants don't count."""
    names = [F.col(f"`{c}`") for c, f in zip(df.columns, df.schema.fields) if _hashable(f.dataType) and df.columns.count(c) == 1]
    return F.xxhash64(F.lit(seed), *names)


def side_of(splits: int) -> int:
    """Ranges to a side so that about ``splits`` cells of the matrix are used."""
    return max(2, math.ceil(math.sqrt(2 * splits)))


def _common_type(*columns: tuple[DataFrame, str]) -> T.DataType:
    """The type in which these texts over frames are compared."""
    return reduce(lambda x, y: x.unionAll(y), [df.select(F.expr(text).alias("v")) for df, text in columns]).schema[0].dataType


class _Cut:
    """Both sides of a link cut at the same points of (value, hash); nulls, which match nothing, have no range."""

    def __init__(self, left: DataFrame, right: DataFrame, link: Link, splits: int):
        self.value, self.hash = fresh("value"), fresh("hash")
        kind = _common_type((left, link.left), (right, link.right))
        values = [(df, F.expr(text).cast(kind)) for df, text in ((left, link.left), (right, link.right))]
        self.left, self.right = (df.withColumns({self.value: value, self.hash: row_hash(df)}) for df, value in values)
        # hashes are even, so for the points any even numbers do and the sample reads the values alone
        drawn = F.xxhash64(F.rand(5)).alias(self.hash)
        sample = reduce(lambda x, y: x.unionAll(y), [df.select(value.alias(self.value), drawn) for df, value in values])
        self.points: Splits = split_points(sample.where(F.col(self.value).isNotNull()), [SortKey(self.value), SortKey(self.hash)], splits)
        self.last = len(self.points.points)

    @property
    def own(self) -> Column:
        return range_bucket(self.points, [self.value, self.hash])

    def reach(self, df: DataFrame, upwards: bool, name: str) -> DataFrame:
        """The rows once for each range from the first their value has to the last of all, or from 0 to the last it has."""
        edge = fresh("edge")
        df = df.where(F.col(self.value).isNotNull()).withColumn(edge, F.lit(_LEAST if upwards else _MOST))
        end = range_bucket(self.points, [self.value, edge])
        ranges = F.sequence(end, F.lit(self.last)) if upwards else F.sequence(F.lit(0), end)
        return df.withColumn(name, F.explode(ranges)).drop(edge)


def _unmatched(right: DataFrame, lonely: DataFrame) -> DataFrame:
    """Left rows without a match, with the right side's columns null."""
    return lonely.join(right.where(F.lit(False)), F.lit(True), "left")


def matrix_join(left: DataFrame, right: DataFrame, link: Link, on: Column, splits: int | None = None) -> DataFrame:
    """The pairs for which ``on`` holds, the inequality ``link`` among its conjuncts.

    About ``splits`` cells are used, and no row is repeated more than ``side_of(splits)`` times.
    """
    cut = _Cut(left, right, link, side_of(splits or default_splits(left)))
    row, column, row_2, column_2 = (fresh(n) for n in ("row", "column", "row", "column"))
    down = link.relation in (">", ">=")
    one = cut.reach(cut.left.withColumn(row, cut.own), not down, column).drop(cut.value, cut.hash)
    two = cut.reach(cut.right.withColumn(column_2, cut.own), down, row_2).drop(cut.value, cut.hash)
    same, parts = (F.col(row) == F.col(row_2)) & (F.col(column) == F.col(column_2)), default_splits(left)
    one, two = one.repartition(parts, row, column), two.repartition(parts, row_2, column_2)
    return one.join(two, same & on, "inner").drop(row, column, row_2, column_2)


def one_sided_join(left: DataFrame, right: DataFrame, link: Link, on: Column, how: str, splits: int | None = None) -> DataFrame:
    """As ``matrix_join``, but left rows are never repeated, so that outer, semi and anti joins work; right rows are."""
    cut = _Cut(left, right, link, splits or default_splits(left))
    row, row_2 = fresh("row"), fresh("row")
    one = cut.left.withColumn(row, F.when(F.col(cut.value).isNotNull(), cut.own)).drop(cut.value, cut.hash)
    two = cut.reach(cut.right, link.relation in (">", ">="), row_2).drop(cut.value, cut.hash)
    return one.join(two, (F.col(row) == F.col(row_2)) & on, how).drop(row, row_2)


def tagged_join(left: DataFrame, right: DataFrame, branches: tuple[Branch, ...], how: str = "inner") -> DataFrame:
    """A join on an Or of which each branch has an equality, as one join in one shuffle of each side.

    Each row goes under one key for each branch. A pair is taken from the first branch that holds for it. In a left join
    the rows without a match are told by their content: equal rows match alike.
    """
    tag, key, ways = (fresh(n) for n in ("tag", "key", "ways"))
    tag_2, key_2 = fresh("tag"), fresh("key")
    hashes: list[tuple[Column, Column]] = []
    for branch in branches:
        equal = [link for link in branch.links if link.relation == "="]
        kinds = [_common_type((left, e.left), (right, e.right)) for e in equal]
        # a null equals nothing, so its row has no key
        made = []
        for texts in ([e.left for e in equal], [e.right for e in equal]):
            values = [F.expr(t).cast(k) for t, k in zip(texts, kinds)]
            made.append(F.when(all_of([v.isNotNull() for v in values]), F.xxhash64(*values)))
        hashes.append((made[0], made[1]))

    def spread(df: DataFrame, columns: list[Column], tag: str, key: str) -> DataFrame:
        each = F.array(*[F.struct(F.lit(i).alias("tag"), c.alias("key")) for i, c in enumerate(columns)])
        rows = df.withColumn(ways, F.explode(each))
        return rows.withColumns({tag: F.col(f"{ways}.tag"), key: F.col(f"{ways}.key")}).drop(ways)

    one, two = spread(left, [h[0] for h in hashes], tag, key), spread(right, [h[1] for h in hashes], tag_2, key_2)
    texts = [F.expr(b.text) for b in branches]
    first = [(F.col(tag) == i) & t & all_of([F.lit(True), *[~F.coalesce(e, F.lit(False)) for e in texts[:i]]]) for i, t in enumerate(texts)]
    met = (F.col(tag) == F.col(tag_2)) & (F.col(key) == F.col(key_2)) & reduce(lambda x, y: x | y, first)
    two = two.where(F.col(key_2).isNotNull())
    if how == "inner":
        return one.where(F.col(key).isNotNull()).join(two, met, "inner").drop(tag, key, tag_2, key_2)
    a, b, any_match = fresh("a"), fresh("b"), fresh("any")
    one = one.withColumns({a: row_hash(left), b: row_hash(left, 23)})
    joined = one.join(two, met, "left")
    found = F.col(tag_2).isNotNull()
    joined = joined.withColumn(any_match, F.max(found).over(Window.partitionBy(a, b)))
    return joined.where(found | (~F.col(any_match) & (F.col(tag) == 0))).drop(tag, key, tag_2, key_2, a, b, any_match)


def grid_join(left: DataFrame, right: DataFrame, on: Column, splits: int | None = None) -> DataFrame:
    """The pairs for which ``on`` holds, whatever it says: every pair meets in one cell of a square of hashes."""
    side = math.ceil(math.sqrt(splits or default_splits(left)))
    row, column, row_2, column_2 = (fresh(n) for n in ("row", "column", "row", "column"))
    every = F.explode(F.sequence(F.lit(0), F.lit(side - 1)))
    one = left.withColumns({row: F.pmod(row_hash(left), F.lit(side)).cast("int"), column: every})
    two = right.withColumns({column_2: F.pmod(row_hash(right), F.lit(side)).cast("int"), row_2: every})
    same = (F.col(row) == F.col(row_2)) & (F.col(column) == F.col(column_2))
    return one.join(two, same & on, "inner").drop(row, column, row_2, column_2)


@dataclass(frozen=True)
class Span:
    """A value of one side that is at least ``low`` and at most ``high`` of the other; None where there is no such bound."""

    point: str
    low: str | None
    high: str | None
    point_left: bool


def interval_of(branch: Branch) -> Span | None:
    """A value between two of the other side, else None."""
    for point_left in (True, False):
        bounds: dict[str, dict[str, str]] = {}
        for link in branch.links:
            point, relation, end = (link.left, link.relation, link.right) if point_left else (link.right, MIRRORED[link.relation], link.left)
            which = "low" if relation in (">", ">=") else "high" if relation in ("<", "<=") else None
            if which:
                bounds.setdefault(point, {}).setdefault(which, end)
        for point, ends in bounds.items():
            if len(ends) == 2:
                return Span(point, ends["low"], ends["high"], point_left)
    return None


class _Bins:
    """A value of one side that lies above, below or between values of the other: equality on the bin, the condition inside it.

    The value's row has one bin; a span's row is sent to each bin it touches. Bins are even ranges of (value, hash) of those
    values that a span can reach, so that a value that many rows have is cut too; the hash is left out where none has many.
    """

    def __init__(self, points: DataFrame, spans: DataFrame, span: Span, splits: int | None = None, keep: bool = False):
        """``keep`` is for points that stay without a match."""
        kind = _common_type((points, span.point), *[(spans, text) for text in (span.low, span.high) if text])
        value, hashed, first, last, least, most = (fresh(n) for n in ("value", "hash", "first", "last", "least", "most"))
        self.own, self.each, self.parts = fresh("bin"), fresh("bin"), default_splits(points)
        at = points.withColumn(value, F.expr(span.point).cast(kind))
        ends = {name: F.expr(text).cast(kind) for name, text in ((first, span.low), (last, span.high)) if text}
        touched = spans.withColumns(ends).where(all_of([F.col(name).isNotNull() for name in ends]))
        if len(ends) == 2:
            touched = touched.where(F.col(first) <= F.col(last))

        near = at.where(F.col(value).isNotNull())
        bounded = isinstance(kind, (T.NumericType, T.DateType))
        if bounded:
            low, high = touched.agg(*[f(n).cast("string") for f, n in ((F.min, [*ends][0]), (F.max, [*ends][-1]))]).first()
            near = near.where(F.col(value) >= F.lit(low).cast(kind)) if span.low else near
            near = near.where(F.col(value) <= F.lit(high).cast(kind)) if span.high else near
        count, low, high = near.agg(F.count(F.lit(1)), F.min(value).cast("string"), F.max(value).cast("string")).first()
        if bounded:
            touched = touched.where(F.col(first) <= F.lit(high).cast(kind)) if span.low else touched
            touched = touched.where(F.col(last) >= F.lit(low).cast(kind)) if span.high else touched

        wanted = splits or min(MOST_SPLITS, max(self.parts, count // ROWS_PER_BIN))
        sample = near.select(value, F.xxhash64(F.rand(5)).alias(hashed))
        cut = split_points(sample, [SortKey(value), SortKey(hashed)], wanted, count=count)
        # a value with less than a quarter of what a task gets is not cut: that needs the whole row
        often = Counter(point[0] for point in cut.points)
        tied = max(often.values(), default=0) > max(1, wanted // (4 * self.parts))
        if not tied:
            cut = Splits(cut.keys[:1], cut.types[:1], tuple((found,) for found in often))
        at = at if keep else near
        at = at.withColumn(hashed, row_hash(points)) if tied else at
        touched = touched.withColumns({least: F.lit(_LEAST), most: F.lit(_MOST)})
        start = range_bucket(cut, [first, least] if tied else [first]) if span.low else F.lit(0)
        stop = range_bucket(cut, [last, most] if tied else [last]) if span.high else F.lit(len(cut.points))
        bin_of = range_bucket(cut, [value, hashed] if tied else [value])
        self.at = at.withColumn(self.own, F.when(F.col(value).isNotNull(), bin_of)).drop(value, hashed)
        self.touched = touched.withColumn(self.each, F.explode(F.sequence(start, stop))).drop(*ends, least, most)

    def join(self, on: Column, how: str, points_left: bool) -> DataFrame:
        at, touched = self.at.repartition(self.parts, self.own), self.touched.repartition(self.parts, self.each)
        one, two = (at, touched) if points_left else (touched, at)
        return one.join(two, (F.col(self.own) == F.col(self.each)) & on, how).drop(self.own, self.each)


def interval_join(left: DataFrame, right: DataFrame, branch: Branch, on: Column, how: str = "inner", splits: int | None = None) -> DataFrame:
    """A join on a value between two of the other side.

    Inner, left, semi and anti joins work unchanged where the value is the left side's, whose rows are in one bin each; where
    the intervals are, the left rows with a match are told by the values that the condition reads.
    """
    span = interval_of(branch)
    if span.point_left:  # type: ignore[union-attr]
        return _Bins(left, right, span, splits, keep=how != "inner").join(on, how, True)
    bins = _Bins(right, left, span, splits)
    if how == "inner":
        return bins.join(on, how, False)
    columns = [F.expr(text) for text in condition_of(left, right, on).left_reads]
    keys = [fresh("key") for _ in columns]
    found = bins.join(on, "left_semi", False).select(*[c.alias(k) for c, k in zip(columns, keys)]).distinct()
    same = all_of([c.eqNullSafe(F.col(k)) for c, k in zip(columns, keys)])
    if how != "left":
        return left.join(found, same, how)
    return bins.join(on, "inner", False).unionAll(_unmatched(right, left.join(found, same, "left_anti")))


def half_line_join(left: DataFrame, right: DataFrame, link: Link, on: Column, splits: int | None = None) -> DataFrame:
    """The pairs for which ``on`` holds, the inequality ``link`` among its conjuncts.

    Where one side is much smaller, all its rows may lie in one range of both: its rows go to each bin of the larger side
    that they reach. Sides of like sizes meet in a matrix.
    """
    sizes = left.count(), right.count()
    if max(sizes) < MATRIX_RATIO * min(sizes):
        return matrix_join(left, right, link, on, splits)
    points_left = sizes[0] > sizes[1]
    points, spans = (left, right) if points_left else (right, left)
    point, relation, end = (link.left, link.relation, link.right) if points_left else (link.right, MIRRORED[link.relation], link.left)
    span = Span(point, end, None, points_left) if relation in (">", ">=") else Span(point, None, end, points_left)
    return _Bins(points, spans, span, splits).join(on, "inner", points_left)


def _bounded(left: DataFrame, right: DataFrame, branch: Branch) -> Column | None:
    """Whether a left row has a match, by the right side's largest or smallest value alone; None where that can't tell."""
    if len(branch.links) != 1 or branch.others or branch.links[0].relation == "=":
        return None
    link = branch.links[0]
    inner = right.where(all_of([F.expr(t) for t in branch.right_only])) if branch.right_only else right
    best = (F.min if link.relation in (">", ">=") else F.max)(F.expr(link.right))
    bound = inner.agg(best.alias("bound")).scalar()
    here = F.expr(link.left)
    passes = {">": here > bound, ">=": here >= bound, "<": here < bound, "<=": here <= bound}[link.relation]
    return F.coalesce(all_of([passes, *[F.expr(t) for t in branch.left_only]]), F.lit(False))


def has_match(left: DataFrame, right: DataFrame, on: Column) -> Column | None:
    """A Column that is true where a left row has a match, if one aggregate of the right side per Or branch tells; else None."""
    answers = [_bounded(left, right, branch) for branch in condition_of(left, right, on).branches]
    if any(answer is None for answer in answers):
        return None
    return reduce(lambda a, b: a | b, answers)


def semi_join(left: DataFrame, right: DataFrame, on: Column, anti: bool = False) -> DataFrame:
    """Left rows with a match (without one, if anti), without a nested loop where an equality, an interval or an inequality links."""
    flag = has_match(left, right, on)
    if flag is not None:
        return left.where(~flag if anti else flag)
    branches = condition_of(left, right, on).branches
    how = "left_anti" if anti else "left_semi"
    if len(branches) > 1 and anti:
        return reduce(lambda rows, b: semi_join(rows, right, F.expr(b.text), anti=True), branches, left)
    if len(branches) > 1 or branches[0].equal or not branches[0].links:
        return left.join(right, on, how)
    if interval_of(branches[0]) is not None:
        return interval_join(left, right, branches[0], on, how)
    return one_sided_join(left, right, branches[0].links[0], on, how)


def match_flag(left: DataFrame, right: DataFrame, on: Column, flag: str) -> DataFrame | None:
    """The left rows with a column that is true where they have a match, else false, where inequalities link; None elsewhere.

    Where one aggregate can't tell, the different values that the condition reads find their matches, and are joined back.
    """
    found = has_match(left, right, on)
    if found is not None:
        return left.withColumn(flag, found)
    condition = condition_of(left, right, on)
    if all(b.equal for b in condition.branches) or not all(b.links for b in condition.branches):
        return None
    columns, mark = [F.expr(text) for text in condition.left_reads], fresh("mark")
    keys = [fresh("key") for _ in columns]
    matched = semi_join(left.select(*columns).distinct(), right, on)
    matched = matched.select(*[c.alias(k) for c, k in zip(columns, keys)], F.lit(True).alias(mark))
    same = all_of([c.eqNullSafe(F.col(k)) for c, k in zip(columns, keys)])
    return left.join(matched, same, "left").withColumn(flag, F.coalesce(mark, F.lit(False))).drop(*keys, mark)


def pair_join(left: DataFrame, right: DataFrame, on: Column, how: str = "inner", splits: int | None = None) -> DataFrame:
    """``left.join(right, on, how)`` for an inner or left join, by the way the condition's links allow."""
    branches = condition_of(left, right, on).branches
    if len(branches) > 1 and all(branch.equal for branch in branches):
        whole = all(_hashable(f.dataType) for f in left.schema.fields) and len({c.lower() for c in left.columns}) == len(left.columns)
        if how == "inner" or whole:
            return tagged_join(left, right, branches, how)
    if len(branches) > 1:
        found, earlier = [], []
        for branch in branches:
            holds = F.expr(branch.text)
            found.append(pair_join(left, right, all_of([holds, *earlier]), "inner", splits))
            earlier.append(~F.coalesce(holds, F.lit(False)))
        if how == "left":
            found.append(_unmatched(right, semi_join(left, right, on, anti=True)))
        return reduce(lambda a, b: a.unionAll(b), found)
    branch = branches[0]
    if branch.equal:
        return left.join(right, on, how)
    if interval_of(branch) is not None:
        return interval_join(left, right, branch, on, how, splits)
    if not branch.links:
        if how == "left":
            return left.join(right, on, how)  # nothing bounds what a left row must be held against
        return grid_join(left, right, on, splits)
    found = half_line_join(left, right, branch.links[0], on, splits)
    if how == "inner":
        return found
    return found.unionAll(_unmatched(right, semi_join(left, right, on, anti=True)))
