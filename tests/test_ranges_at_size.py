"""Joins by ranges where one side's rows lie close together, and lists that many parents share."""

from __future__ import annotations

import json
import math
import re

import pytest
from pyspark.sql import functions as F

from tablewright.functions import predicates as P
from tablewright.functions.links import condition_of
from tablewright.operators import nested, pairs
from tablewright.operators.nested import nested_list, to_json_list


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def bands(spark):
    spans = spark.createDataFrame([(i, float(i % 7), float(i % 7 + i % 3)) for i in range(40)] + [(40, None, 3.0), (41, 5.0, 1.0)], "id int, lo double, hi double")
    points = spark.createDataFrame([(i, i / 4, i % 5) for i in range(30)] + [(30, None, 1), (31, math.nan, 1)], "k int, x double, m int")
    return spans.alias("l"), points.alias("r")


@pytest.mark.parametrize("how", ["left", "left_anti"])
def test_points_are_not_repeated_to_find_spans_without_one(bands, how):
    """the values were sent to every range above them, and each span was held against half of all values."""
    spans, points = bands
    on = F.expr("r.x BETWEEN l.lo AND l.hi AND r.m < 3")
    found = pairs.pair_join(spans, points, on, how) if how == "left" else pairs.semi_join(spans, points, on, anti=True)
    generates = [line for line in plan_of(found).splitlines() if re.match(r"[\s:+\-]*\(?\d*\)?\s*Generate", line)]
    assert generates and not any("x#" in line or "m#" in line for line in generates)
    rows, values = spans.collect(), [r for r in points.collect() if r.x is not None]
    met = {s.id: [p.k for p in values if None not in (s.lo, s.hi) and s.lo <= p.x <= s.hi and p.m < 3] for s in rows}
    if how == "left":
        assert sorted((r.id, r.k or -1) for r in found.collect()) == sorted((i, k or -1) for i, ks in met.items() for k in (ks or [None]))
    else:
        assert sorted(r.id for r in found.collect()) == sorted(i for i, ks in met.items() if not ks)


def tasks_of(frame) -> int:
    return frame.groupBy(F.spark_partition_id()).count().count()


def test_small_tables_meet_in_many_tasks(spark):
    """what is small in bytes was merged into one task, which then made all pairs."""
    one = spark.range(4000).selectExpr("id", "double(id) AS x").alias("l")
    two = spark.range(500).selectExpr("id AS k", "double(id * 8) AS lo", "double(id * 8 + 20) AS hi").alias("r")
    joined = pairs.pair_join(one, two, F.expr("l.x >= r.lo AND l.x < r.hi"), "left")
    assert joined.count() == sum(max(1, sum(8 * k <= x < 8 * k + 20 for k in range(max(0, x // 8 - 3), min(499, x // 8) + 1))) for x in range(4000))
    assert tasks_of(joined) > 60


def test_a_small_side_in_one_place_meets_in_many_tasks(spark):
    """both sides were cut at the same few points, so that a few close values met all they reach in a cell or two."""
    one = spark.range(30).selectExpr("id", "int(48 + id % 3) AS top").alias("l")
    two = spark.range(20000).selectExpr("id AS k", "int(id % 50 + 1) AS size").alias("r")
    for on, first in (("r.size > l.top", True), ("l.top < r.size", False)):
        joined = pairs.pair_join(*((one, two) if first else (two, one)), F.expr(on))
        assert joined.count() == 400 * (10 * 2 + 10)
        assert tasks_of(joined) >= 4
    joined = pairs.pair_join(one, two, F.expr("r.size < l.top"))
    assert joined.count() == 400 * 10 * (47 + 48 + 49)
    assert tasks_of(joined) > 60


def test_a_bounded_difference_is_an_interval(spark):
    """every value met every smaller one. No pair is lost by rounding, infinities or what is not a number."""
    special = [None, math.nan, math.inf, -math.inf, 0.0, -0.0, 1e300, -1e300, 1e16, 1e16 + 2, 0.1, 0.3, 1.3, 1.1, 2.1, 0.30000000000000004]
    one = spark.createDataFrame([(i, x) for i, x in enumerate(special)], "id int, x double").alias("l")
    two = spark.createDataFrame([(i, y) for i, y in enumerate(special)], "k int, y double").alias("r")
    for text in ("l.x > r.y AND l.x - r.y < 1", "l.x > r.y AND l.x - r.y <= 1", "l.x > r.y AND 1 >= l.x - r.y", "l.x < r.y AND r.y - l.x <= 0.2D"):
        (branch,) = condition_of(one, two, F.expr(text)).branches
        assert pairs.interval_of(branch) is not None
        want = one.crossJoin(two).where(text).select("id", "k").collect()
        assert len(want) > 4
        assert sorted(pairs.pair_join(one, two, F.expr(text)).select("id", "k").collect()) == sorted(want)
    for text in ("l.x > r.y AND l.x - r.y > 1", "l.x > r.y AND l.x - r.y < r.k", "l.x > r.y AND l.x - r.y < double('NaN')"):
        (branch,) = condition_of(one, two, F.expr(text)).branches
        assert pairs.interval_of(branch) is None
        want = one.crossJoin(two).where(text).select("id", "k").collect()
        assert sorted(pairs.pair_join(one, two, F.expr(text)).select("id", "k").collect()) == sorted(want)


def test_intervals_of_text_and_dates(spark):
    one = spark.createDataFrame([(i, chr(97 + i % 9)) for i in range(20)] + [(20, None)], "id int, s string")
    one = one.withColumn("d", F.date_add(F.lit("2020-01-01").cast("date"), F.col("id"))).alias("l")
    two = one.selectExpr("id AS k", "s AS a", "char(ascii(s) + 2) AS z", "d AS b", "d + 3 AS e").alias("r")
    for text in ("l.s BETWEEN r.a AND r.z", "l.d > r.b AND l.d < r.e"):
        for how in ("inner", "left"):
            want = one.join(two, F.expr(text), how).select("id", "k")
            got = pairs.pair_join(one, two, F.expr(text), how).select("id", "k")
            assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_a_shared_list_is_written_once(spark):
    """each of the parents with equal values wrote the same list as text again."""
    parents = spark.range(60).selectExpr("id", "double(id % 4) AS low", "double(id % 4 + 2) AS top").alias("p")
    children = spark.range(50).selectExpr("id AS k", "double(id % 9) AS v").alias("c")
    within = [P.ge("c.v", P.other("p.low")), P.and_(P.le("c.v", P.other("p.top")))]
    text = nested_list(parents, children, within, [("c.k", "key")], "found", ["c.k"], as_json=True)
    plan = text._jdf.queryExecution().analyzed().toString()
    assert plan.index("Join") < plan.index("to_json")
    plain = nested_list(parents, children, within, [("c.k", "key")], "found", ["c.k"]).withColumn("found", to_json_list("found"))
    assert sorted(text.collect()) == sorted(plain.collect())
    none = nested_list(parents, children.where("k < 0").alias("c"), within, [("c.k", "key")], "found", ["c.k"], as_json=True)
    assert {r.found for r in none.collect()} == {"[]"}


@pytest.mark.parametrize("ascending", [True, False])
def test_items_that_begin_with_their_sort_keys(spark, ascending):
    rows = [(i % 3, (i * 7) % 5 if i % 4 else None, -i) for i in range(40)]
    children = spark.createDataFrame(rows, "p int, a int, b int").alias("c")
    parents = spark.range(3).selectExpr("int(id) AS id").alias("p")
    lists = nested_list(parents, children, P.eq("c.p", P.other("p.id")), ["c.a", "c.b"], "found", [("c.a", ascending), ("c.b", ascending)])
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    for row in lists.collect():
        assert [tuple(e) for e in row.found] == sorted(((a, b) for p, a, b in rows if p == row.id), key=key, reverse=not ascending)


def test_pairs_of_a_range_are_not_shuffled(spark, tmp_path):
    """each pair of parent and child was shuffled, and each list again as text."""
    spark.range(300).selectExpr("id AS k", "double(id % 100) AS price", "int(id % 10) AS size").write.parquet(str(tmp_path / "child"))
    spark.range(60).selectExpr("id", "double(id % 20 * 5) AS low", "double(id % 20 * 5 + 30) AS high", "int(7 + id % 3) AS top").write.parquet(str(tmp_path / "parent"))
    parents, children = (spark.read.parquet(str(tmp_path / n)) for n in ("parent", "child"))
    p, c = parents.alias("p"), children.alias("c")
    trees = {
        "price < low OR size > top": [P.lt("c.price", P.other("p.low")), P.or_(P.gt("c.size", P.other("p.top")))],
        "price >= low AND price <= high": [P.ge("c.price", P.other("p.low")), P.and_(P.le("c.price", P.other("p.high")))],
        "price BETWEEN low - 9 AND low": [P.raw("c.price BETWEEN p.low - ? AND p.low", 9)],
    }
    for text, tree in trees.items():
        found = nested_list(p, c, tree, [("c.k", "key"), "c.size"], "found", ["c.k"], as_json=True)
        plan = plan_of(found)
        # the parents once and the children once; nothing is shuffled or sorted after they meet
        assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2
        assert len(re.findall(r"[+:]- \*?(?:\(\d+\) )?Sort \[", plan)) == 1 and "SortMergeJoin" not in plan
        plain = nested_list(p, c, tree, [("c.k", "key"), "c.size"], "found", ["c.k"])
        met = parents.join(children, F.expr(text), "left").groupBy("id").agg(F.sort_array(F.collect_list(F.when(F.expr("k IS NOT NULL"), F.struct("k", "size")))).alias("l"))
        want = {r.id: [tuple(e) for e in r.l] for r in met.collect()}
        assert {r.id: [tuple(e) for e in r.found] for r in plain.collect()} == want
        assert {r.id: [(e["key"], e["size"]) for e in json.loads(r.found)] for r in found.collect()} == want


@pytest.mark.parametrize("sort", [["c.v", "c.k"], [("c.v", False), "c.k"], [("c.k", False)], []])
def test_lists_of_ranges_in_several_blocks(spark, monkeypatch, sort):
    """Nulls, not a number, parents that repeat, qualified names, and children cut into blocks by their sort keys."""
    monkeypatch.setattr(nested, "BLOCK_ROWS", 7)
    rows = [(i, None if i % 11 == 0 else math.nan if i % 13 == 0 else float(i % 17), i % 5 if i % 4 else None, None if i % 3 else "a'\"\\]") for i in range(90)]
    children = spark.createDataFrame(rows, "k int, x double, v int, s string").alias("c")
    some = [None, math.nan, -0.0, 0.0, 3.0, 3.0, 8.0, 16.0, 99.0]
    parents = spark.createDataFrame([(i // 2, x, y) for i, (x, y) in enumerate((a, b) for a in some for b in (4, None, 4))], "id int, lo double, n int").alias("p")
    tree = [P.ge("c.x", P.other("p.lo")), P.or_(P.lt("c.v", P.other("p.n")))]
    lists = nested_list(parents, children, tree, [("c.k", "key"), "c.s"], "found", sort)
    number = lambda v: v is not None
    above = lambda x, lo: math.isnan(x) or not math.isnan(lo) and x >= lo

    got = sorted((r.id, str(r.lo), r.n, len(r.found)) for r in lists.select("p.id", "p.lo", F.coalesce("p.n", F.lit(-1)).alias("n"), "found").collect())
    met = lambda lo, n: [r for r in rows if number(r[1]) and number(lo) and above(r[1], lo) or number(r[2]) and number(n) and r[2] < n]
    assert got == sorted((r.id, str(r.lo), -1 if r.n is None else r.n, len(met(r.lo, r.n))) for r in parents.collect())
    for r in lists.collect():
        want = met(r.lo, r.n)
        for name, up in reversed([s if isinstance(s, tuple) else (s, True) for s in sort]):
            at = {"c.k": 0, "c.v": 2}[name]
            want = sorted(want, key=lambda row: (row[at] is not None, row[at] or 0), reverse=not up)
        found = [tuple(e) for e in r.found]
        assert (found if sort else sorted(found)) == [(w[0], w[3]) for w in want]
    text = nested_list(parents, children, tree, [("c.k", "key"), "c.s"], "found", sort, as_json=True)
    if sort:
        plain = lists.withColumn("found", to_json_list("found"))
        key = lambda r: (r.id, str(r.lo), str(r.n))
        assert [r.found for r in sorted(text.collect(), key=key)] == [r.found for r in sorted(plain.collect(), key=key)]


def test_short_spans_stay_with_pairs(spark):
    """Where hardly any child of a range matches a value of it, rows for pairs are fewer."""
    parents = spark.range(4000).selectExpr("id", "double((id * 7919) % 4000) AS x").alias("p")
    children = spark.range(4000).selectExpr("id AS k", "double(id) AS y").alias("c")
    near = [P.ge("c.y", P.other("p.x")), P.and_(P.raw("c.y <= p.x + 0.5"))]
    lists = nested_list(parents, children, near, ["c.k"], "found", ["c.k"], reads=["p.x"])
    assert sorted((r.id, [e.k for e in r.found]) for r in lists.collect()) == [(i, [i * 7919 % 4000]) for i in range(4000)]
