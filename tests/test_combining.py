from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from fixtures import canvas, ids, metadata, nulls, three
from tablewright.functions import predicates as P
from tablewright.functions.predicates import and_, or_, where
from tablewright.operators import paging, ranges, setops
from tablewright.operators.relational import (
    aggregate,
    constant,
    expression,
    inequality_join,
    join_on,
    project,
    raw_query,
)


def rows(df) -> Counter:
    return Counter(tuple(r) for r in df.collect())


# ---------------------------------------------------------------- projection, joins, grouping


def test_projection(spark):
    df = three(spark)
    out = project(df, ("id", "Id"), expression("ordering + 1", "next"), constant("x", "tag"))
    assert out.columns == ["Id", "next", "tag"]
    assert project(df) is df
    for make in (lambda: expression("1", None), lambda: constant(1, "")):
        with pytest.raises(ValueError):
            make()
    assert raw_query({"t": df}, "select count(*) as n from {t}").first()["n"] == 3


def test_joins_of_the_three_rows(spark):
    c, m = three(spark).alias("c"), metadata(spark).alias("m")
    assert join_on(c, m, ("c.id", "m.id")).count() == 1
    assert join_on(c, m, ("c.id", "m.id"), how="left").count() == 3
    kept = join_on(c, m, ("c.id", "m.id"), P.eq("c.color", "red"), how="left")
    assert kept.count() == 3 and kept.where("m.id is not null").count() == 1
    assert join_on(c, m, ("c.id", "m.id"), P.eq("c.color", "blue"), how="left").where("m.id is not null").count() == 0
    for bad in ("right", "full", "cross"):
        with pytest.raises(ValueError):
            join_on(c, m, ("c.id", "m.id"), how=bad)
    with pytest.raises(ValueError):
        join_on(c, m, ("c.id", "m.id", "<>"))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_with_or_agrees_with_the_single_condition(spark, how):
    left = spark.createDataFrame([(i % 7, i % 3 or None, i) for i in range(40)], "a int, b int, i int").alias("l")
    right = spark.createDataFrame([(j % 5, j % 4 or None, j) for j in range(30)], "a int, b int, j int").alias("r")
    ours = join_on(left, right, ("l.a", "r.a"), or_(P.lt("r.j", 9)), or_(P.raw("l.b = r.b")), and_(P.gt("l.i", 20)), how=how)
    plain = left.join(right, F.expr("(l.a = r.a and r.j < 9) or (l.b = r.b and l.i > 20)"), how)
    assert rows(ours) == rows(plain)
    assert ours.select("l.i", "r.j").count() == plain.count()


@pytest.mark.parametrize("relation", [">", ">=", "<", "<="])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_inequality_join_agrees_with_a_nested_loop(spark, relation, how):
    left = spark.createDataFrame([(i, None if i % 11 == 0 else (i * 7) % 50) for i in range(120)], "i int, x int").alias("l")
    right = spark.createDataFrame([(j, None if j % 9 == 0 else (j * 13) % 70 - 10) for j in range(60)], "j int, y int").alias("r")
    extra = P.raw("l.i % 2 = r.j % 2")
    ours = inequality_join(left, right, ("l.x", "r.y", relation), extra, how=how, splits=8)
    assert rows(ours) == rows(left.join(right, F.expr(f"l.x {relation} r.y and l.i % 2 = r.j % 2"), how))


def test_inequality_join_refuses(spark):
    df = three(spark)
    for call in (
        lambda: inequality_join(df.alias("a"), df.alias("b"), ("a.ordering", "b.ordering", "=")),
        lambda: inequality_join(df.alias("a"), df.alias("b"), ("a.ordering", "b.ordering", ">"), how="full"),
    ):
        with pytest.raises(ValueError):
            call()


def test_grouping_of_the_batch(spark):
    start = expression("substr(id, 1, 6)", "start")
    count = [expression("count(color)", "n")]
    assert aggregate(canvas(spark), [start], count).count() == 10
    assert aggregate(canvas(spark), [start], count, having=P.raw("count(color) = 1")).count() == 1
    shorter = canvas(spark, 11)
    assert aggregate(shorter, [start], count, having=P.eq("n", 1)).count() == 9
    either = [P.raw("max(ordering) = 31010"), or_(P.raw("substr(id, 1, 6) = 'uuid-3'"))]
    assert ids(aggregate(shorter, [start], count, having=either), "start") == ["uuid-1", "uuid-3"]
    assert aggregate(shorter, [], [expression("count(*)", "n")]).first()["n"] == 11
    assert aggregate(three(spark), ["color"], []).count() == 2


# ---------------------------------------------------------------- sort and pages


def test_third_page_of_thirty(spark):
    chosen = where(canvas(spark), P.ge("id", "uuid-211"), and_(P.lt("id", "uuid-910")))
    page = paging.page(chosen, ["id"], 3, 30).collect()
    assert len(page) == 30 and page[4]["id"] == "uuid-27"
    assert paging.sort_rows(canvas(spark), "id").collect()[32]["id"] == "uuid-127"


def test_nulls_are_smallest(spark):
    df = nulls(spark)
    assert [r["id"] for r in paging.sort_rows(df, "a", "id").collect()] == [3, 6, 1, 2, 5, 4, 7]
    assert [r["id"] for r in paging.sort_rows(df, ("a", False), "id").select("id").collect()] == [7, 4, 2, 5, 1, 3, 6]


def test_totals(spark):
    df = canvas(spark, 95)
    page = paging.fetch_page(df, ["id"], 10, 10, with_total=True)
    assert (len(page.rows), page.total_results, page.total_pages) == (5, 95, 10)
    beyond = paging.fetch_page(df, ["id"], 11, 10, with_total=True)
    assert (beyond.rows, beyond.total_results, beyond.total_pages) == ([], 95, 10)
    assert paging.fetch_page(df, ["id"], 1, 10).total_results is None
    row = paging.page_with_total(df, ["id"], 2, 10).first()
    assert (row["total_results"], row["total_pages"]) == (95, 10)
    assert [paging.total_pages(n, 10) for n in (0, 1, 10, 11)] == [0, 1, 1, 2]
    assert paging.total_count(df).first()["total"] == 95
    for num, size in ((0, 10), (1, 0), (-1, 5)):
        with pytest.raises(ValueError):
            paging.page(df, ["id"], num, size)


def test_single_row(spark):
    df = three(spark)
    assert paging.single_row(df.where("id = 'x'")) is None
    assert paging.single_row(df.where("id = '123'"))["color"] == "green"
    with pytest.raises(ValueError):
        paging.single_row(df)
    assert paging.single_row_frame(df.where("id = '123'")).collect() == df.where("id = '123'").collect()
    assert paging.single_row_frame(df.where("id = 'x'")).count() == 0
    with pytest.raises(Exception, match="more than one row"):
        paging.single_row_frame(df).collect()


@pytest.mark.parametrize("keys", [["a", "b", "id"], [("a", False), "b", "id"], [("b", False), ("a", False), ("id", False)]])
def test_deep_pages_equal_plain_ones(spark, keys):
    df = spark.range(600).selectExpr(
        "id", "if(id % 5 = 0, null, id % 3) as a", "if(id % 7 = 0, null, concat('s', id % 4)) as b"
    )
    whole = [tuple(r) for r in paging.sort_rows(df, *keys).collect()]
    for num, size in ((1, 50), (7, 50), (12, 50), (13, 50), (3, 177), (4, 177)):
        page = paging.deep_page(df, keys, num, size, splits=6, near=20)
        assert [tuple(r) for r in page.collect()] == whole[(num - 1) * size : num * size]


def test_deep_page_with_one_value_for_a_third_of_the_rows(spark):
    df = spark.range(900).selectExpr("id", "if(id < 300, 5, id) as v")
    whole = [r["id"] for r in paging.sort_rows(df, "v", "id").collect()]
    page = paging.deep_page(df, ["v", "id"], 12, 20, splits=9, near=10)
    assert [r["id"] for r in page.collect()] == whole[220:240]


def test_range_buckets_follow_the_sort_order(spark):
    df = spark.range(500).selectExpr(
        "id",
        "timestampadd(MINUTE, cast(id * 37 % 400 as int), timestamp_ntz'2024-03-10 00:00:00') as t",
        "cast(id % 13 as decimal(6,2)) as d",
    )
    keys = ranges.sort_keys([("t", False), "d"])
    points = ranges.split_points(df, keys, 10)
    ordered = [r["b"] for r in df.withColumn("b", ranges.range_bucket(points)).orderBy(*[k.order for k in keys]).collect()]
    assert ordered == sorted(ordered) and len(set(ordered)) == len(points.points) + 1
    assert ranges.range_bucket(ranges.split_points(df.where("false"), keys, 10)) is not None


# ---------------------------------------------------------------- set operations


def test_set_operations_on_the_three_rows(spark):
    green, rest = three(spark).where("color = 'green'"), three(spark).where("color = 'red'")
    assert setops.combine(green, [(setops.UNION, rest)]).count() == 3
    assert setops.combine(green, [(setops.UNION_ALL, rest)]).count() == 3
    assert setops.combine(three(spark), [(setops.EXCEPT, green)]).count() == 1
    assert setops.combine(three(spark), [(setops.INTERSECT, rest)]).count() == 1


def test_set_operations_run_left_to_right(spark):
    def k(*values):
        return spark.createDataFrame([(v,) for v in values], "k int")

    chain = [(setops.UNION, k(3)), (setops.INTERSECT, k(3))]
    assert ids(setops.combine(k(1, 2), chain), "k") == [3]


def test_set_operation_errors(spark):
    for steps in ([("minus", three(spark))], [(setops.UNION, three(spark).select("id"))]):
        with pytest.raises(ValueError):
            setops.combine(three(spark), steps)


def _fold(first, steps):
    """What the chain means, on Python lists."""
    result = list(first)
    for operation, other in steps:
        if operation == setops.UNION_ALL:
            result = result + other
        elif operation == setops.UNION:
            result = list(set(result) | set(other))
        elif operation == setops.INTERSECT:
            result = list(set(result) & set(other))
        else:
            result = list(set(result) - set(other))
    return Counter(result)


_ROWS = st.lists(st.tuples(st.sampled_from([1, 2, 3, None]), st.sampled_from(["a", None])), max_size=6)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(first=_ROWS, steps=st.lists(st.tuples(st.sampled_from(setops.OPERATIONS), _ROWS), min_size=1, max_size=4))
def test_random_chains(spark, first, steps):
    def frame(data):
        return spark.createDataFrame(data, "k int, s string")

    ours = setops.combine(frame(first), [(operation, frame(data)) for operation, data in steps])
    assert rows(ours) == _fold(first, steps)


def test_a_long_chain_is_cut_into_pieces(spark):
    one = spark.createDataFrame([(0,)], "k int")
    steps = [(setops.UNION, one.select((F.col("k") + i).alias("k"))) for i in range(1, 70)]
    assert setops.combine(one, steps).count() == 70


def test_a_chain_takes_one_shuffle(spark):
    df = three(spark)
    chain = setops.combine(df, [(setops.UNION, df), (setops.INTERSECT, df), (setops.EXCEPT, df)])
    assert chain._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


@pytest.mark.parametrize("key", ["i", "d", "t", "z", "x"])
@pytest.mark.parametrize("ascending", [True, False])
def test_deep_pages_by_the_sketch(spark, key, ascending):
    """Numbers, dates and times with ties and nulls, not-a-number among them; the page is Spark's own."""
    df = spark.range(6000).selectExpr(
        "id", "CASE WHEN id % 50 = 0 THEN NULL WHEN id % 3 = 0 THEN 700 ELSE cast(id * 7919 % 5000 AS int) END AS i",
        "date_add(date'2000-01-01', cast(id * 31 % 900 AS int)) AS d", "timestamp_micros(id * 7919 % 6000 - 3000) AS t",
        "timestamp_ntz'2001-01-01 00:00:00' + make_dt_interval(0, 0, 0, id * 7919 % 6000) AS z",
        "CASE WHEN id % 11 = 0 THEN double('nan') WHEN id % 13 = 0 THEN NULL ELSE id * 7919 % 6000 / 8 END AS x",
    )
    for num in (1, 2, 40, 75, 119, 120, 121, 500):
        got = paging.deep_page(df, [(key, ascending), "id"], num, 50, splits=6, near=300)
        want = paging.page(df, [(key, ascending), "id"], num, 50)
        assert [r.id for r in got.collect()] == [r.id for r in want.collect()], num
