from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fixtures import family
from tablewright.functions import predicates as P
from tablewright.functions.predicates import and_, and_not, group, or_, other, where
from tablewright.operators.nested import nested_chunks, nested_list, to_json_list
from tablewright.operators.relational import aggregate, expression

OF_PARENT = P.eq("c.parent_id", other("p.id"))


def lists(df, alias="kids", key="id"):
    return {r[key]: [tuple(x) for x in r[alias]] for r in df.collect()}


def test_children_in_order_and_empty_lists(spark):
    p, c, _ = family(spark)
    out = nested_list(p, c, OF_PARENT, [("c.id", "Id"), "c.label"], "kids", ["c.sort_ord"])
    assert lists(out) == {"p1": [("c1", "first"), ("c2", "second")], "p2": []}
    assert out.schema["kids"].dataType.elementType.fieldNames() == ["Id", "label"]
    down = nested_list(p, c, OF_PARENT, ["c.id"], "kids", [("c.sort_ord", False)])
    assert lists(down) == {"p1": [("c2",), ("c1",)], "p2": []}
    turned = nested_list(p, c, P.eq("p.id", other("c.parent_id")), ["c.id"], "kids", ["c.sort_ord"])
    assert lists(turned) == {"p1": [("c1",), ("c2",)], "p2": []}
    assert lists(nested_list(p, c, OF_PARENT, ["c.id"], "kids", ["c.id"], prune_child=True)) == lists(turned)


def test_filtered_grouped_and_grandchildren(spark):
    p, c, g = family(spark)
    assert lists(nested_list(p, where(c, P.eq("c.label", "first")), OF_PARENT, ["c.id"], "kids"))["p1"] == [("c1",)]
    counts = aggregate(c, ["parent_id"], [expression("count(*)", "n")], having=P.gt("n", 1))
    assert lists(nested_list(p, counts, P.eq("parent_id", other("p.id")), ["n"], "kids")) == {"p1": [(2,)], "p2": []}
    tagged = nested_list(c, g, P.eq("g.child_id", other("c.id")), ["g.tag"], "tags", ["g.tag"])
    deep = nested_list(p, tagged, OF_PARENT, ["c.id", "tags"], "kids", ["c.sort_ord"]).collect()
    kids = next(r for r in deep if r["id"] == "p1")["kids"]
    assert [(k["id"], [t["tag"] for t in k["tags"]]) for k in kids] == [("c1", ["alpha", "beta"]), ("c2", [])]


def test_json_keeps_null_fields(spark):
    p, c, _ = family(spark)
    out = nested_list(p, c, OF_PARENT, ["c.id", "c.note"], "kids", ["c.sort_ord"])
    texts = {r["id"]: r["j"] for r in out.select("id", to_json_list("kids").alias("j")).collect()}
    assert texts["p2"] == "[]" and texts["p1"] == '[{"id":"c1","note":"x"},{"id":"c2","note":null}]'
    assert json.loads(texts["p1"])[1]["note"] is None


def test_two_lists_do_not_multiply(spark):
    p, c, g = family(spark)
    both = nested_list(p, c, OF_PARENT, ["c.id"], "kids", ["c.id"])
    both = nested_list(both, c.alias("d"), P.eq("d.parent_id", other("p.id")), ["d.label"], "labels", ["d.label"])
    assert lists(both)["p1"] == [("c1",), ("c2",)] and lists(both, "labels")["p1"] == [("first",), ("second",)]


@pytest.mark.parametrize(
    "tree, text",
    [
        (group(P.eq("d.k", other("m.k")), or_(P.eq("d.v", other("m.v")))), "d.k = m.k or d.v = m.v"),
        (group(P.eq("d.k", other("m.k")), and_(P.ge("d.v", other("m.v")))), "d.k = m.k and d.v >= m.v"),
        (group(P.eq("d.k", other("m.k")), and_not(P.lt("d.v", other("m.v")))), "d.k = m.k and d.v >= m.v"),
        (group(P.lt("m.v", other("d.v")), and_(P.raw("d.k = m.k"))), "d.v > m.v and d.k = m.k"),
        (group(P.eq("d.k", other("m.k")), P.or_not(P.gt("d.v", other("m.v")))), "d.k = m.k or d.v <= m.v"),
        (
            group(P.gt("d.v", other("m.v")), group(P.eq("d.k", other("m.k")), or_(P.raw("d.k = m.v + 1")))),
            "d.v > m.v and (d.k = m.k or d.k = m.v + 1)",
        ),
        (
            group(P.eq("d.k", other("m.k")), group(P.eq("d.v", other("m.v"))), group(P.raw("d.i = m.i")), link=P.OR),
            "d.k = m.k or d.v = m.v or d.i = m.i",
        ),
        (group(group(P.eq("d.k", other("m.k")), or_(P.eq("d.v", other("m.v"))))), "d.k = m.k or d.v = m.v"),
        (
            group(P.eq("d.k", other("m.k")), group(P.eq("d.v", other("m.v"))), link=P.OR_NOT),
            "d.k = m.k or not d.v = m.v",
        ),
    ],
)
def test_correlates_agree_with_a_plain_join(spark, tree, text):
    m = spark.createDataFrame([(i, i % 4, (i % 5) or None) for i in range(12)], "i int, k int, v int").alias("m")
    d = spark.createDataFrame([(j, j % 6, (j % 7) or None) for j in range(25)], "i int, k int, v int").alias("d")
    ours = nested_list(m, d, tree, ["d.i"], "kids", ["d.i"])
    plain = m.join(d, F.expr(text)).groupBy("m.i").agg(F.sort_array(F.collect_list("d.i")).alias("l"))
    wanted = {i: [] for i in range(12)} | {r[0]: [(x,) for x in r["l"]] for r in plain.collect()}
    assert lists(ours, key="i") == wanted


def test_parents_that_repeat_keep_their_rows(spark):
    p, c, _ = family(spark)
    out = nested_list(p.union(p).alias("p"), c, OF_PARENT, ["c.id"], "kids", ["c.id"])
    assert out.count() == 4


def test_refusals(spark):
    p, c, _ = family(spark)
    for call in (
        lambda: nested_list(p, c, [], ["c.id"], "kids"),
        lambda: nested_list(p, c, P.group(), ["c.id"], "kids"),
        lambda: nested_list(p, c, OF_PARENT, [], "kids"),
        lambda: nested_list(p, c, OF_PARENT, ["c.id"], " "),
        lambda: nested_list(p, c, OF_PARENT, [("c.id", "a'b")], "kids"),
        lambda: nested_list(p, c, P.is_null("c.id"), ["c.id"], "kids"),
        lambda: nested_list(p, c, P.in_list("c.id", ["x"]), ["c.id"], "kids"),
        lambda: nested_list(p, c, P.eq("c.id", "x"), ["c.id"], "kids"),
        lambda: nested_chunks(p, c, P.gt("c.id", other("p.id")), ["c.id"], "kids", ["c.id"]),
        lambda: nested_chunks(p, c, OF_PARENT, ["c.id"], "kids", []),
        lambda: nested_chunks(p, c, OF_PARENT, ["c.id"], "kids", ["c.id"], chunk_rows=0),
    ):
        with pytest.raises(ValueError):
            call()


def test_a_very_long_list_is_whole(spark):
    m = spark.createDataFrame([(1,), (2,)], "k int").alias("m")
    d = spark.range(1_200_000).selectExpr("id as i", "cast(1 as int) as k").alias("d")
    for options in ({}, {"ranges": 16}):
        made = nested_list(m, d, P.eq("d.k", other("m.k")), ["d.i"], "items", [("d.i", False)], **options)
        got = made.selectExpr("k", "size(items) n", "get(items, 0).i a", "get(items, 1199999).i z").orderBy("k").collect()
        assert [tuple(r) for r in got] == [(1, 1_200_000, 1_199_999, 0), (2, 0, None, None)]


@pytest.mark.parametrize("sort", [["d.v", "d.i"], [("d.v", False), ("d.i", False)], [("d.v", False), "d.i"]])
def test_map_fields_and_ranges_keep_the_order(spark, sort):
    m = spark.createDataFrame([(1,), (2,)], "k int").alias("m")
    d = spark.range(200).selectExpr("id as i", "cast(1 + id % 2 as int) as k", "if(id % 7 = 0, null, id % 5) as v", "map('a', id) as x").alias("d")
    plain = {}
    for r in d.collect():
        plain.setdefault(r.k, []).append(r)
    for k, rows in plain.items():
        for name, ascending in reversed([s if isinstance(s, tuple) else (s, True) for s in sort]):
            field = name.split(".")[1]
            rows.sort(key=lambda r: (r[field] is not None, r[field] or 0), reverse=not ascending)
    for options in ({}, {"ranges": 5}):
        made = nested_list(m, d, P.eq("d.k", other("m.k")), ["d.i", "d.x"], "items", sort, **options)
        for r in made.collect():
            assert [(e.i, e.x) for e in r["items"]] == [(e.i, e.x) for e in plain[r.k]]


@pytest.mark.parametrize("sort", [["d.v", "d.i"], [("d.v", False), "d.i"], [("d.i", False)]])
def test_chunks_put_together_are_the_list(spark, sort):
    m = spark.createDataFrame([(k,) for k in range(4)], "k int").alias("m")
    # key 1 holds a third of the rows, key 3 none
    d = spark.range(900).selectExpr("id as i", "cast(if(id % 3 = 0, 1, if(id % 2 = 0, 0, 2)) as int) as k",
                                    "if(id % 10 = 0, null, cast(id * 31 % 17 as int)) as v").alias("d")
    match = P.eq("d.k", other("m.k"))
    pieces = nested_chunks(m, d, match, ["d.i"], "kids", sort, chunk_rows=70, splits=11).orderBy("k", "chunk").collect()
    whole = lists(nested_list(m, d, match, ["d.i"], "kids", sort), key="k")
    for k in range(4):
        mine = [r for r in pieces if r["k"] == k]
        assert [r["chunk"] for r in mine] == list(range(len(mine)))
        assert all(len(r["kids"]) == 70 for r in mine[:-1])
        assert [tuple(x) for r in mine for x in r["kids"]] == whole[k]
    assert [len(r["kids"]) for r in pieces if r["k"] == 3] == [0]


def test_one_shuffle_per_side(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        m, d = spark.range(100).toDF("k").alias("m"), spark.range(100).selectExpr("id", "id % 10 as k").alias("d")
        plan = nested_list(m, d, P.eq("d.k", other("m.k")), ["d.id"], "kids", ["d.id"])
        assert plan._jdf.queryExecution().executedPlan().toString().count("Exchange") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize(
    "kind, values",
    [
        ("int", [3, -(2**31), 2**31 - 1, 0, None]), ("bigint", [-(2**63), 2**63 - 1, 5, None]), ("double", [float("nan"), float("inf"), -1.5, 0.0, None]),
        ("string", ["a", "ab", "", "b", "\u00e9", "a\x00", None]), ("boolean", [True, False, None]), ("decimal(6,2)", [Decimal("1.50"), Decimal("-3"), None]),
        ("date", [dt.date(1960, 1, 1), dt.date(2024, 5, 6), None]), ("timestamp", [dt.datetime(1960, 1, 1, 1), dt.datetime(2024, 5, 6, 7, 8, 9, 10), None]),
        ("struct<x:int>", [(2,), (1,), (None,)]),
    ],
)
def test_mixed_directions_of_every_type(spark, kind, values):
    """A rising and a falling key; where a type has no reverse, rows are numbered. The reference is Spark's own sort."""
    rows = [(i % 3, v, j) for i, v in enumerate(values * 3) for j in (1, 0)]
    child = spark.createDataFrame(rows, f"r int, v {kind}, j int").withColumn("n", F.monotonically_increasing_id()).alias("d")
    child = spark.createDataFrame(child.collect(), child.schema).alias("d")
    parent = spark.createDataFrame([(1,)], "one int").alias("p")
    order = [("d.v", False), "d.r", ("d.j", False), "d.n"]
    child = child.withColumn("one", F.lit(1)).alias("d")
    made = nested_list(parent, child, P.eq("d.one", other("p.one")), ["d.n"], "found", order)
    got = [e.n for e in made.first().found]
    want = [r.n for r in child.orderBy(F.col("v").desc_nulls_last(), "r", F.col("j").desc(), "n").collect()]
    assert got == want
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert ("Window" in plan) == kind.startswith("struct")
