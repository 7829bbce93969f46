from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fixtures import canvas, ids, nulls, three
from tablewright.functions import predicates as P
from tablewright.functions.predicates import and_, and_not, or_, where
from tablewright.operators import writes
from tablewright.operators.writes import Delete, Insert, Update, apply_batch
from tablewright.sources.tables import store_batch


def test_insert_adapts_values_and_fills_with_null(spark):
    out = writes.insert_rows(three(spark), [{"ID": "new", "ordering": "7"}, {"id": "other", "color": 5}])
    assert sorted(tuple(r) for r in out.where("id in ('new', 'other')").collect()) == [("new", None, 7), ("other", "5", None)]
    assert out.schema == three(spark).schema
    typed = spark.sql("select date'2024-01-01' d, timestamp_ntz'2024-01-01 01:02:03' t, true b, cast(1 as decimal(5,2)) x, array(1) l")
    row = {"d": dt.date(2025, 2, 3), "t": dt.datetime(2025, 2, 3, 4, 5, 6), "b": False, "x": "2.50", "l": [4, 5]}
    assert writes.insert_rows(typed, [row]).where("d = '2025-02-03'").first().asDict() | {"x": "2.50"} == row


def test_insert_refusals(spark):
    for rows in ([], [{"nope": 1}]):
        with pytest.raises(ValueError):
            writes.insert_rows(three(spark), rows)
    with pytest.raises(Exception):
        writes.insert_rows(three(spark), [{"ordering": "seven"}]).collect()


def test_insert_from_the_same_table(spark):
    df = three(spark)
    copy = df.select(F.concat(F.lit("copy-"), "id").alias("id"), "ordering")
    out = writes.insert_select(df, copy)
    assert out.count() == 6 and out.where("color is null").count() == 3
    with pytest.raises(ValueError):
        writes.insert_select(df, df.select(F.lit(1).alias("nope")))


def test_unknown_conditions_touch_nothing(spark):
    df = nulls(spark)
    assert ids(writes.delete_where(df, P.gt("a", 1))) == [1, 3, 6]
    assert ids(writes.delete_where(df, and_not(P.gt("a", 1)))) == [2, 3, 4, 5, 6, 7]
    assert writes.affected(df, P.gt("a", 1)).first()["affected"] == 4
    updated = writes.update_where(df, {"b": "X", "a": "9"}, P.is_true("f"), or_(P.eq("a", 7)))
    assert ids(updated.where("b = 'X' and a = 9")) == [1, 4, 7]
    assert writes.update_where(df, {"b": None}).where("b is null").count() == 7
    assert writes.update_where(df, {"b": "X"}, P.eq("id", 99)).collect() == df.collect()
    assert writes.delete_where(df).count() == 0
    with pytest.raises(ValueError):
        writes.update_where(df, {})


def test_update_reads_the_values_from_before(spark):
    out = writes.update_where(nulls(spark), {"a": 100, "b": "big"}, P.lt("a", 3))
    assert ids(out.where("a = 100 and b = 'big'")) == [1, 2, 5]


def test_batch_sees_earlier_writes(spark):
    batch = apply_batch(
        {"c": three(spark)},
        [
            Insert("c", [{"id": "x", "color": "green"}]),
            Update("c", {"color": "blue"}, [P.eq("color", "green")]),
            Delete("c", lambda now: [P.in_query("id", now["c"].where("color = 'red'").select("id"))]),
        ],
    )
    assert [(r["write"], r["affected"]) for r in batch.counts.orderBy("write").collect()] == [(0, 1), (1, 3), (2, 1)]
    assert {r["color"] for r in batch.tables["c"].collect()} == {"blue"}
    for bad in ([], [Delete("nope")]):
        with pytest.raises(ValueError):
            apply_batch({"c": three(spark)}, bad)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_stored_values_are_read_like_predicates(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql("select 1 i, cast(null as binary) b, array('x') l, timestamp'2020-01-01 00:00:00Z' t, named_struct('a', 1, 'b', 'x') s, map('k', 1) m, 1.5D d")
        row = {"i": 3.0, "b": b"abc", "l": ["p", "q"], "t": "2020-01-02 00:00:00", "s": {"b": 5, "a": "7"}, "m": {"z": "4"}, "d": "2.5"}
        for out in (writes.insert_rows(df, [row]).where("i = 3"), writes.update_where(df, row)):
            got = where(out, P.eq("t", "2020-01-02 00:00:00")).collect()
            assert len(got) == 1
            assert (got[0].i, bytes(got[0].b), got[0].l, tuple(got[0].s), got[0].m, got[0].d) == (3, b"abc", ["p", "q"], (7, "5"), {"z": 4}, 2.5)
        assert writes.update_where(df, {"i": True}).first().i == 1
        for bad in ({"i": 2.5}, {"i": "x"}, {"l": "text"}):
            with pytest.raises(ValueError):
                writes.update_where(df, bad)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_many_literal_rows(spark):
    rows = [{"id": f"n{i}", "ordering": str(i)} for i in range(1100)]
    assert writes.insert_rows(three(spark), rows).where("id like 'n%'").count() == 1100


def test_delete_by_sub_select_is_one_anti_join(spark):
    df = nulls(spark)
    plan = writes.delete_where(df, P.in_query("a", df.where("id < 4").select("a")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("LeftAnti") == 1 and "LeftOuter" not in plan


# ---------------------------------------------------------------- stored batches


def folders(root):
    return sorted(str(p) for p in root.rglob("*") if p.is_dir())


def test_stored_batch(spark, tmp_path):
    tables = {"canvas": canvas(spark, 100), "three": three(spark), "other": nulls(spark)}
    done = store_batch(
        tables,
        [
            Insert("canvas", [{"id": "new", "ordering": "1"}]),
            Update("canvas", {"color": "X"}, [P.lt("ordering", 31002)]),
            Insert("canvas", query=lambda now: where(now["canvas"], P.eq("color", "X")).select("id")),
            Delete("canvas", lambda now: [P.in_query("id", now["three"].select(F.lit("uuid-5").alias("id")))]),
            Delete("three", [P.eq("color", "green"), and_(P.gt("ordering", 1))]),
        ],
        str(tmp_path / "a folder"),
    )
    assert done.counts == [1, 3, 3, 1, 1] and set(done.folders) == {"canvas", "three"}
    assert spark.read.parquet(done.folders["canvas"]).count() == 100 + 1 + 3 - 1
    assert spark.read.parquet(done.folders["three"]).count() == 2


def test_a_failed_batch_leaves_the_old_folders(spark, tmp_path):
    old = store_batch({"three": three(spark)}, [Delete("three", [P.eq("color", "green")])], str(tmp_path))
    before = folders(tmp_path)
    tables = {"three": spark.read.parquet(old.folders["three"]), "canvas": canvas(spark, 5)}
    broken = Update("three", {"color": "X"}, [P.raw("raise_error('no') is null")])
    for last in (Insert("three", [{"nope": 1}]), Delete("missing"), broken):
        with pytest.raises(Exception):
            store_batch(tables, [Delete("canvas"), last], str(tmp_path))
        assert [f for f in folders(tmp_path) if not f.endswith("canvas")] == before
    assert spark.read.parquet(old.folders["three"]).count() == 1
