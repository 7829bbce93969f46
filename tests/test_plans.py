from __future__ import annotations

import re

import pytest

import __spark_entry__ as driver
from check_oracle import difference, duck
from tablewright import plans

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


@pytest.fixture
def no_broadcast(spark):
    """What the plans look like when no table is small."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", list(plans.runnable()))
def test_agrees_with_sql(spark, connection, name):
    assert difference(spark, connection, FOLDER, name) is None


def test_every_query_has_sql():
    assert set(plans.runnable()) == set(plans.sql())
    assert set(plans.runnable()) <= set(driver.queries()) and set(driver.oracle_sql()) <= set(driver.queries())


def test_flagship(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(plans.runnable()))
def test_no_join_without_keys(no_broadcast, name):
    plan = driver.queries()[name](no_broadcast, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "BroadcastExchange" not in plan


def shuffles(spark, name) -> int:
    plan = driver.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"Exchange (?:hash|range)partitioning", plan))


@pytest.mark.parametrize(
    "name, most",
    [
        ("filter_eq", 0),
        ("chain_precedence", 0),
        ("update_where", 0),
        ("delete_where", 0),
        ("insert_rows", 0),
        ("to_timestamp_utc", 0),
        ("json_list", 0),
        ("join_inner", 2),
        ("in_subquery", 2),
        ("exists_subquery", 2),
        ("nested_list_json", 2),
        ("nested_list_filtered", 2),
        # customers, orders by order, lines by order, orders with lines by customer
        ("nested_list_deep", 4),
        # each further list adds its child's shuffle only: the parents stay where they are
        ("nested_list_two", 3),
        ("setop_chain", 1),
        ("intersect", 1),
    ],
)
def test_number_of_shuffles(no_broadcast, name, most):
    assert shuffles(no_broadcast, name) <= most


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("filter_eq", "EqualTo(o_orderstatus,F)"),
        ("filter_ge", "GreaterThanOrEqual(o_orderdate"),
        ("filter_lt", "LessThan(o_custkey,700)"),
        ("filter_in", "In(o_custkey"),
        ("filter_starts_case_sensitive", "StringStartsWith(p_brand,Brand#1)"),
        ("join_left_on_literal", "EqualTo(l_returnflag,R)"),
        ("nested_list_filtered", "EqualTo(l_returnflag,R)"),
        ("chain_and", "GreaterThan(o_totalprice,100000.0)"),
    ],
)
def test_predicates_reach_the_scan(spark, name, pushed):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = driver.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert pushed in plan


def test_only_needed_columns_are_read(spark):
    plan = driver.queries()["nested_list_deep"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan and "o_totalprice" not in plan


def scans(frame) -> int:
    return frame._jdf.queryExecution().executedPlan().toString().count("FileScan")


def test_sub_selects_and_counts_read_their_table_once(spark):
    from tablewright.functions.predicates import and_, eq, gt, in_query, or_not
    from tablewright.operators.writes import Delete, Insert, Update, apply_batch

    t = lambda name: spark.read.parquet(f"{FOLDER}/{name}.parquet")
    keys = t("orders").where("o_totalprice > 100000").select("o_custkey")
    for chain in ([and_not_in(keys)], [eq("c_mktsegment", "BUILDING"), or_not(in_query("c_custkey", keys))]):
        frame = where_of(t("customer"), chain)
        frame.collect()
        plan = frame._jdf.queryExecution().executedPlan().toString()
        final = plan.split("== Initial Plan ==")[0]
        assert "ReusedExchange" in plan, plan
        assert len(set(re.findall(r"FileScan parquet \[o_custkey", final))) <= 1
    writes = [Update("orders", {"o_orderstatus": "X"}, [gt("o_totalprice", 1000)]), Delete("orders", [eq("o_orderstatus", "X"), and_(gt("o_custkey", 100))]),
              Insert("orders", [{"o_orderkey": 1}]), Delete("orders")]
    assert scans(apply_batch({"orders": t("orders")}, writes).counts) == 1


def and_not_in(keys):
    from tablewright.functions.predicates import and_not, in_query

    return and_not(in_query("c_custkey", keys))


def where_of(frame, chain):
    from tablewright.functions.predicates import where

    return where(frame, *chain)


def test_lists_of_mixed_directions_need_no_window(spark):
    plan = driver.queries()["nested_list_sorted_desc"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_deep_page_takes_two_jobs(spark):
    spark.sparkContext.setJobGroup("deep", "deep page")
    try:
        driver.queries()["page_deep"](spark, "/root/testdata/sf0.01")
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("deep")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # one read of the schema, and with adaptive plans a job for each stage
    assert len(jobs) <= 5
