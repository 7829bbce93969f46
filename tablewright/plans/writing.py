"""Writes. Each query returns the table as it stands afterwards, or the counts."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

from ..functions import predicates as P
from ..functions.predicates import and_, and_not, or_, where
from ..operators import writes
from ..operators.relational import aggregate, expression, project
from ..operators.writes import Delete, Insert, Update, apply_batch
from ..sources.tables import store_batch
from .catalogue import Catalogue, Data

catalogue = Catalogue()
query = catalogue.query


@query("""SELECT * FROM customer UNION ALL SELECT 900000001, 'New', 3, 12.5, NULL
          UNION ALL SELECT 900000002, NULL, 4, NULL, 'BUILDING'""")
def insert_rows(t: Data) -> DataFrame:
    return writes.insert_rows(
        t.customer,
        [
            {"c_custkey": "900000001", "c_name": "New", "c_nationkey": "3", "c_acctbal": 12.5},
            {"C_CUSTKEY": 900000002, "c_nationkey": 4, "c_mktsegment": "BUILDING"},
        ],
    )


@query("""SELECT * FROM customer UNION ALL
          SELECT c_custkey + 900000000, c_name, c_nationkey, NULL, c_mktsegment FROM customer WHERE c_acctbal > 5000""")
def insert_select(t: Data) -> DataFrame:
    rich = where(t.customer, P.gt("c_acctbal", 5000))
    copies = project(
        rich, "c_mktsegment", "c_name", "c_nationkey", expression("c_custkey + 900000000", "c_custkey")
    )
    return writes.insert_select(t.customer, copies)


@query("""SELECT * FROM customer UNION ALL
          SELECT DISTINCT o_custkey + 900000000, NULL::VARCHAR, NULL::INTEGER, NULL::DOUBLE, 'ORDERED'
          FROM orders WHERE o_totalprice > 400000""")
def insert_with_cte(t: Data) -> DataFrame:
    big = aggregate(where(t.orders, P.gt("o_totalprice", 400000)), ["o_custkey"], [])
    rows = project(big, expression("o_custkey + 900000000", "c_custkey"), expression("'ORDERED'", "c_mktsegment"))
    return writes.insert_select(t.customer, rows)


_UPDATED = """SELECT o_orderkey, o_custkey, CASE WHEN {0} THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
                     CASE WHEN {0} THEN 0 ELSE o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority FROM orders"""
_MARK = {"o_orderstatus": "X", "o_totalprice": "0"}


@query(_UPDATED.format("o_orderstatus = 'P' OR o_totalprice > 300000 AND o_orderpriority <> '5-LOW'"))
def update_where(t: Data) -> DataFrame:
    chain = [P.eq("o_orderstatus", "P"), or_(P.gt("o_totalprice", 300000)), and_not(P.eq("o_orderpriority", "5-LOW"))]
    return writes.update_where(t.orders, _MARK, *chain)


@query(_UPDATED.format("true"))
def update_all(t: Data) -> DataFrame:
    return writes.update_where(t.orders, _MARK)


@query(_UPDATED.format("o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)"))
def update_with_cte(t: Data) -> DataFrame:
    debtors = project(where(t.customer, P.lt("c_acctbal", 0)), "c_custkey")
    return writes.update_where(t.orders, _MARK, P.in_query("o_custkey", debtors))


@query("""SELECT * FROM (SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS priority FROM orders) AS m
          WHERE NOT coalesce(priority > '2', false)""")
def delete_where(t: Data) -> DataFrame:
    maybe = project(t.orders, "o_orderkey", expression("nullif(o_orderpriority, '5-LOW')", "priority"))
    return writes.delete_where(maybe, P.gt("priority", "2"))


@query("SELECT * FROM orders WHERE false")
def delete_all(t: Data) -> DataFrame:
    return writes.delete_where(t.orders)


@query("""SELECT * FROM orders WHERE NOT (o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 50))""")
def delete_with_cte(t: Data) -> DataFrame:
    full = project(where(t.lineitem, P.ge("l_quantity", 50)), "l_orderkey")
    return writes.delete_where(t.orders, P.in_query("o_orderkey", full))


def _batch_of(t: Data) -> tuple[dict[str, DataFrame], list[writes.Write]]:
    """Later writes see earlier ones: the updated orders are copied, and what the deleted customers ordered goes."""
    return (
        {"orders": t.orders, "customer": t.customer},
        [
            Update("orders", {"o_orderstatus": "X"}, [P.eq("o_orderstatus", "P"), and_(P.gt("o_totalprice", 200000))]),
            Insert(
                "orders",
                query=lambda now: project(
                    where(now["orders"], P.eq("o_orderstatus", "X")),
                    expression("o_orderkey + 900000000", "o_orderkey"),
                    "o_custkey",
                    "o_totalprice",
                ),
            ),
            Delete("customer", [P.lt("c_acctbal", 0)]),
            Delete("orders", lambda now: [and_not(P.in_query("o_custkey", project(now["customer"], "c_custkey")))]),
        ],
    )


def _batch(t: Data) -> writes.Batch:
    return apply_batch(*_batch_of(t))


def _root(spark: SparkSession) -> str:
    """Storage that all machines see: the session's checkpoint folder, or on one machine without it a temporary one."""
    folder, master = spark.conf.get("spark.checkpoint.dir", None), spark.conf.get("spark.master", "")
    if not folder and master != "local" and not master.startswith("local["):
        raise ValueError("spark.checkpoint.dir names no folder that all machines share; set it")
    return f"{folder or tempfile.mkdtemp(prefix='tablewright-')}/stored"


_AFTER_UPDATE = """u AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'P' AND o_totalprice > 200000 THEN 'X'
                           ELSE o_orderstatus END AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders),
                   i AS (SELECT * FROM u UNION ALL SELECT o_orderkey + 900000000, o_custkey, NULL, o_totalprice, NULL, NULL
                         FROM u WHERE o_orderstatus = 'X'),
                   c AS (SELECT * FROM customer WHERE NOT coalesce(c_acctbal < 0, false))"""


@query(f"WITH {_AFTER_UPDATE} SELECT * FROM i WHERE o_custkey IN (SELECT c_custkey FROM c)")
def batch_writes(t: Data) -> DataFrame:
    return _batch(t).tables["orders"]


@query(f"""WITH {_AFTER_UPDATE}
           SELECT 0 AS "write", count(*) AS affected FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 200000
           UNION ALL SELECT 1, count(*) FROM u WHERE o_orderstatus = 'X'
           UNION ALL SELECT 2, count(*) FROM customer WHERE c_acctbal < 0
           UNION ALL SELECT 3, count(*) FROM i WHERE o_custkey NOT IN (SELECT c_custkey FROM c)""")
def write_counts(t: Data) -> DataFrame:
    return _batch(t).counts


@query(f"WITH {_AFTER_UPDATE} SELECT * FROM i WHERE o_custkey IN (SELECT c_custkey FROM c)")
def batch_stored(t: Data) -> DataFrame:
    """The batch written to new folders, and its first table read from there."""
    return t.spark.read.parquet(store_batch(*_batch_of(t), _root(t.spark)).folders["orders"])


@query(f"""WITH {_AFTER_UPDATE}
           SELECT 0 AS "write", count(*) AS affected FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 200000
           UNION ALL SELECT 1, count(*) FROM u WHERE o_orderstatus = 'X'
           UNION ALL SELECT 2, count(*) FROM customer WHERE c_acctbal < 0
           UNION ALL SELECT 3, count(*) FROM i WHERE o_custkey NOT IN (SELECT c_custkey FROM c)""")
def stored_counts(t: Data) -> DataFrame:
    """The counts that were observed while the batch was written."""
    counts = store_batch(*_batch_of(t), _root(t.spark)).counts
    return t.spark.createDataFrame(list(enumerate(counts)), "write int, affected long")
