"""Joins without an equality against a plain loop, and how often rows are repeated."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tablewright.functions import predicates as P
from tablewright.functions.links import Link, condition_of
from tablewright.operators import pairs
from tablewright.operators.nested import nested_list
from tablewright.operators.relational import inequality_join, join_on


@pytest.fixture(scope="module")
def sides(spark):
    draw = random.Random(5)
    some = lambda: draw.choice([None, *range(-4, 9)])
    # ties, nulls, rows that repeat, and different number types
    left = [(i // 2, some(), some(), draw.choice(["a", "b", None])) for i in range(90)]
    right = [(i, draw.choice([None, -1.5, 0.0, 2.0, 2.0, 2.5, 7.0]), draw.choice([None, 3.0, 4.5, 8.0]), draw.choice(["a", "b"])) for i in range(60)]
    one = spark.createDataFrame(left, "id int, x int, y long, s string").repartition(5).alias("l")
    two = spark.createDataFrame(right, "id int, lo double, hi double, s string").repartition(3).alias("r")
    return one, two, left, right


def number(*values):
    return None not in values


CASES = {
    "l.x > r.lo": lambda a, b: number(a[1], b[1]) and a[1] > b[1],
    "l.x <= r.lo": lambda a, b: number(a[1], b[1]) and a[1] <= b[1],
    "NOT (r.lo < l.x)": lambda a, b: number(a[1], b[1]) and not b[1] < a[1],
    "l.x >= r.lo AND l.id <> r.id": lambda a, b: number(a[1], b[1]) and a[1] >= b[1] and a[0] != b[0],
    "l.x BETWEEN r.lo AND r.hi": lambda a, b: number(a[1], b[1], b[2]) and b[1] <= a[1] <= b[2],
    "r.lo > l.x AND r.lo < l.y + 1 AND l.s = 'a'": lambda a, b: number(a[1], a[2], b[1]) and a[1] < b[1] < a[2] + 1 and a[3] == "a",
    "l.x < r.lo OR l.y > r.hi": lambda a, b: number(a[1], b[1]) and a[1] < b[1] or number(a[2], b[2]) and a[2] > b[2],
    "l.x = r.lo OR l.y = r.hi OR l.id = r.id AND l.s = r.s": lambda a, b: number(a[1], b[1]) and a[1] == b[1] or number(a[2], b[2]) and a[2] == b[2] or a[0] == b[0] and a[3] == b[3],
    "l.x = r.lo OR l.y < r.lo": lambda a, b: number(a[1], b[1]) and a[1] == b[1] or number(a[2], b[1]) and a[2] < b[1],
    "(l.id + r.id) % 7 = 3": lambda a, b: (a[0] + b[0]) % 7 == 3,
}


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("text", CASES)
def test_pair_join(sides, text, how):
    one, two, left, right = sides
    got = pairs.pair_join(one, two, F.expr(text), how, splits=9)
    assert got.columns == [*one.columns, *two.columns]
    want = []
    for a in left:
        met = [(*a, *b) for b in right if CASES[text](a, b)]
        want += met or ([(*a, None, None, None, None)] if how == "left" else [])
    key = lambda row: tuple((v is not None, v) for v in row)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("anti", [False, True])
@pytest.mark.parametrize("text", CASES)
def test_exists(sides, text, anti):
    one, two, left, right = sides
    term = P.exists(two, text)
    got = P.where(one, P.and_not(term) if anti else term)
    want = [a for a in left if any(CASES[text](a, b) for b in right) != anti]
    key = lambda row: tuple((v is not None, v) for v in row)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("text", CASES)
def test_exists_under_or(sides, text):
    one, two, left, right = sides
    got = P.where(one, P.eq("l.s", "b"), P.or_not(P.exists(two, text)))
    assert got.columns == one.columns
    want = [a for a in left if a[3] == "b" or not any(CASES[text](a, b) for b in right)]
    key = lambda row: tuple((v is not None, v) for v in row)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


def test_exists_against_nothing(sides):
    one, two, left, _ = sides
    none = two.where("id < 0").alias("r")
    assert P.where(one, P.exists(none, "l.x > r.lo")).count() == 0
    assert P.where(one, P.and_not(P.exists(none, "l.x > r.lo"))).count() == len(left)
    assert P.where(one, P.eq("l.s", "zzz"), P.or_not(P.exists(none, "l.x > r.lo"))).count() == len(left)


@pytest.mark.parametrize("relation", [">", ">=", "<", "<="])
def test_rows_are_repeated_by_the_root_of_the_cells(spark, relation):
    """One value has most rows on both sides; neither side is repeated more often than the matrix has ranges."""
    one = spark.range(3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN id ELSE 100 END AS x").alias("l")
    two = spark.range(3000).selectExpr("id AS k", "CASE WHEN id % 4 = 0 THEN id ELSE 100 END AS y").alias("r")
    link, side = Link("l.x", relation, "r.y"), pairs.side_of(64)
    cut = pairs._Cut(one, two, link, side)
    down = relation in (">", ">=")
    for frame, upwards in ((cut.left, not down), (cut.right, down)):
        repeated = cut.reach(frame, upwards, "cell").groupBy(*frame.columns[:1]).count()
        assert repeated.agg(F.max("count")).first()[0] <= side
    # the value that most rows have is cut into many ranges
    assert cut.left.where("x = 100").select(cut.own.alias("b")).distinct().count() > side // 3


def test_links_are_read_from_the_condition(sides):
    one, two, _, _ = sides
    (branch,) = condition_of(one, two, F.expr("r.id = l.id AND l.x > r.lo AND l.s = 'a' AND l.x < l.y AND l.x + r.lo > 3")).branches
    assert branch.equal and {(x.relation) for x in branch.links} == {"=", ">"} and branch.others == 1 and len(branch.left_only) == 2
    (branch,) = condition_of(one, two, F.expr("l.x = l.y AND r.lo > l.x")).branches
    assert not branch.equal and [x.relation for x in branch.links] == ["<"]


def test_equality_in_raw_text_needs_no_ranges(sides):
    one, two, _, _ = sides
    plan = join_on(one, two, ("l.x", "r.lo", ">"), P.raw("l.id = r.id"))._jdf.queryExecution().executedPlan().toString()
    assert "explode" not in plan and "Generate" not in plan
    with pytest.raises(ValueError):
        inequality_join(one, two, ("l.x", "r.lo", "="))


def test_or_of_equalities_reads_each_table_once(spark, tmp_path):
    for name in ("a", "b"):
        spark.range(200).selectExpr("id", "id % 7 AS x").write.parquet(str(tmp_path / name))
    one, two = (spark.read.parquet(str(tmp_path / n)).alias(n) for n in ("a", "b"))
    for how in ("inner", "left"):
        joined = join_on(one, two, ("a.id", "b.x"), P.or_(P.eq("b.x", 1)), P.or_(P.raw("a.x = b.id")), how=how)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 2 and "NestedLoop" not in plan and "Cartesian" not in plan


def test_nested_list_by_either_range(sides):
    one, two, left, right = sides
    lists = nested_list(one, two, [P.lt("r.lo", P.other("l.x")), P.or_(P.gt("r.hi", P.other("l.y")))], [("r.id", "k")], "found", ["r.id"])
    for row in lists.collect():
        met = [b[0] for b in right if number(b[1], row.x) and b[1] < row.x or number(b[2], row.y) and b[2] > row.y]
        assert [e.k for e in row.found] == sorted(met)
