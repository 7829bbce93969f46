"""Scans, derived tables, projection and predicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import predicates as P
from ..functions.predicates import Node, Term, and_, and_not, group, or_, or_not, where
from ..operators.relational import column, constant, expression, project, raw_query
from .catalogue import Catalogue, Data

catalogue = Catalogue()
query = catalogue.query


# ---------------------------------------------------------------- sources and projection


@query("SELECT * FROM orders")
def scan_all(t: Data) -> DataFrame:
    return project(t.orders)


@query("SELECT v.o_orderkey, v.o_totalprice FROM orders AS v")
def scan_alias(t: Data) -> DataFrame:
    return project(t.orders.alias("v"), "v.o_orderkey", "v.o_totalprice")


@query("""SELECT d.o_orderkey, d.o_custkey FROM (SELECT * FROM orders WHERE o_totalprice > 300000) AS d
          WHERE d.o_orderstatus = 'F'""")
def derived_table(t: Data) -> DataFrame:
    derived = where(t.orders, P.gt("o_totalprice", 300000)).alias("d")
    return project(where(derived, P.eq("d.o_orderstatus", "F")), "d.o_orderkey", "d.o_custkey")


@query("""WITH big AS (SELECT * FROM orders WHERE o_totalprice > 200000),
               done AS (SELECT o_orderkey, o_custkey FROM big WHERE o_orderstatus = 'F')
          SELECT o_orderkey, o_custkey FROM done WHERE o_custkey > 10""")
def cte_select(t: Data) -> DataFrame:
    big = where(t.orders, P.gt("o_totalprice", 200000))
    done = project(where(big, P.eq("o_orderstatus", "F")), "o_orderkey", "o_custkey")
    return where(done, P.gt("o_custkey", 10))


@query("""WITH spend AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey)
          SELECT o_custkey, n FROM spend WHERE n >= 10""")
def cte_raw(t: Data) -> DataFrame:
    spend = raw_query({"o": t.orders}, "select o_custkey, count(*) as n from {o} group by o_custkey")
    return where(spend, P.ge("n", 10))


@query("""WITH a AS (SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus <> 'P'),
               b AS (SELECT o_custkey, o_totalprice FROM a WHERE o_totalprice > 250000)
          SELECT o_custkey, o_totalprice FROM b WHERE o_custkey <= 1000""")
def cte_nested(t: Data) -> DataFrame:
    a = project(where(t.orders, and_not(P.eq("o_orderstatus", "P"))), "o_orderkey", "o_custkey", "o_totalprice")
    b = project(where(a, P.gt("o_totalprice", 250000)), "o_custkey", "o_totalprice").alias("b")
    return where(b, P.le("b.o_custkey", 1000))


@query("SELECT c_custkey AS id, c_name AS name, c_acctbal FROM customer")
def project_alias(t: Data) -> DataFrame:
    return project(t.customer, ("c_custkey", "id"), column("c_name", "name"), "c_acctbal")


@query("""SELECT o_orderkey, upper(o_orderpriority) AS priority, o_totalprice * 2 AS doubled,
                 row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS nth
          FROM orders""")
def project_expr(t: Data) -> DataFrame:
    return project(
        t.orders,
        "o_orderkey",
        expression("upper(o_orderpriority)", "priority"),
        expression("o_totalprice * 2", "doubled"),
        expression("row_number() over (partition by o_custkey order by o_orderkey)", "nth"),
    )


@query("SELECT n_nationkey, n_name, 'nation' AS kind, 1 AS one FROM nation")
def project_const(t: Data) -> DataFrame:
    return project(t.nation, "n_nationkey", "n_name", constant("nation", "kind"), constant(1, "one"))


# ---------------------------------------------------------------- one relation at a time


def _orders_where(name: str, sql: str, *nodes: Node) -> None:
    catalogue.add(name, lambda t: where(t.orders, *nodes), f"SELECT * FROM orders WHERE {sql}")


_orders_where("filter_eq", "o_orderstatus = 'F'", P.eq("o_orderstatus", "F"))
_orders_where("filter_ne", "o_orderstatus <> 'F'", and_not(P.eq("o_orderstatus", "F")))
_orders_where("filter_gt", "o_totalprice > 250000", P.gt("o_totalprice", 250000))
_orders_where("filter_not_gt", "o_totalprice <= 250000", and_not(P.gt("o_totalprice", 250000)))
_orders_where("filter_ge", "o_orderdate >= TIMESTAMP '1997-01-01'", P.ge("o_orderdate", "1997-01-01"))
_orders_where("filter_not_ge", "o_orderdate < TIMESTAMP '1997-01-01'", and_not(P.ge("o_orderdate", "1997-01-01")))
_orders_where("filter_lt", "o_custkey < 700", P.lt("o_custkey", "700"))
_orders_where("filter_not_lt", "o_custkey >= 700", and_not(P.lt("o_custkey", "700")))
_orders_where("filter_le", "o_orderpriority <= '2-HIGH'", P.le("o_orderpriority", "2-HIGH"))
_orders_where("filter_not_le", "o_orderpriority > '2-HIGH'", and_not(P.le("o_orderpriority", "2-HIGH")))
_orders_where("filter_in", "o_custkey IN (1, 5, 8, 13, 21)", P.in_list("o_custkey", [1, 5, 8.0, 13, "21"]))
_orders_where(
    "filter_not_in", "o_orderpriority NOT IN ('1-URGENT', '5-LOW')", and_not(P.in_list("o_orderpriority", ["1-URGENT", "5-LOW"]))
)
_orders_where(
    "filter_raw", "o_totalprice / 1000 > 150 AND o_orderstatus = 'O'", P.raw("o_totalprice / 1000 > ? and o_orderstatus = ?", 150, "O")
)

_MAYBE = "SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS priority FROM orders"


def _priority_or_null(t: Data) -> DataFrame:
    return project(t.orders, "o_orderkey", expression("nullif(o_orderpriority, '5-LOW')", "priority"))


def _maybe_where(name: str, sql: str, term: Term) -> None:
    catalogue.add(name, lambda t: where(_priority_or_null(t), term), f"SELECT * FROM ({_MAYBE}) AS m WHERE {sql}")


_maybe_where("filter_null", "priority IS NULL", P.is_null("priority"))
_maybe_where("filter_not_null", "priority IS NOT NULL", and_not(P.is_null("priority")))
_maybe_where("filter_ne_with_nulls", "priority <> '2-HIGH'", and_not(P.eq("priority", "2-HIGH")))

_FLAGGED = "SELECT d.doc_id, l.toxic = 1 AS toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id"


def _flagged(t: Data) -> DataFrame:
    labels = t.labels.select(F.col("doc_id").alias("labelled"), (F.col("toxic") == 1).alias("toxic"))
    return t.documents.select("doc_id").join(labels, F.expr("doc_id = labelled"), "left").drop("labelled")


def _flagged_where(name: str, sql: str, term: Term) -> None:
    catalogue.add(name, lambda t: where(_flagged(t), term), f"SELECT * FROM ({_FLAGGED}) AS f WHERE {sql}")


_flagged_where("filter_true", "toxic = true", P.is_true("toxic"))
_flagged_where("filter_false", "toxic = false", and_not(P.is_true("toxic")))


def _parts_where(name: str, sql: str, term: Term) -> None:
    catalogue.add(name, lambda t: where(t.part, term), f"SELECT * FROM part WHERE {sql}")


_parts_where("filter_starts", "p_name ILIKE 'RED%'", P.starts_with("p_name", "RED"))
_parts_where("filter_not_starts", "p_name NOT ILIKE 'RED%'", and_not(P.starts_with("p_name", "RED")))
_parts_where("filter_ends", "p_name ILIKE '%Bolt'", P.ends_with("p_name", "Bolt"))
_parts_where("filter_not_ends", "p_name NOT ILIKE '%Bolt'", and_not(P.ends_with("p_name", "Bolt")))
_parts_where("filter_contains", "p_name ILIKE '%E W_D%'", P.contains("p_name", "E W_D"))
_parts_where("filter_not_contains", "p_name NOT ILIKE '%E W_D%'", and_not(P.contains("p_name", "E W_D")))
_parts_where(
    "filter_starts_case_sensitive", "p_brand LIKE 'Brand#1%'", P.starts_with("p_brand", "Brand#1", case_sensitive=True)
)


# ---------------------------------------------------------------- sub-selects


def _big_spenders(t: Data) -> DataFrame:
    return project(where(t.orders, P.gt("o_totalprice", 400000)), "o_custkey")


_BIG = "SELECT o_custkey FROM orders WHERE o_totalprice > 400000"


@query(f"SELECT * FROM customer WHERE c_custkey IN ({_BIG})")
def in_subquery(t: Data) -> DataFrame:
    return where(t.customer, P.in_query("c_custkey", _big_spenders(t)))


@query(f"SELECT * FROM customer WHERE c_custkey NOT IN ({_BIG})")
def not_in_subquery(t: Data) -> DataFrame:
    return where(t.customer, and_not(P.in_query("c_custkey", _big_spenders(t))))


@query(f"SELECT * FROM customer WHERE c_acctbal < 0 OR c_custkey IN ({_BIG})")
def in_subquery_or(t: Data) -> DataFrame:
    return where(t.customer, P.lt("c_acctbal", 0), or_(P.in_query("c_custkey", _big_spenders(t))))


@query("""SELECT * FROM customer WHERE c_acctbal < 0
          OR c_custkey NOT IN (SELECT nullif(o_custkey, 3) FROM orders WHERE o_totalprice > 400000)""")
def not_in_subquery_or_nulls(t: Data) -> DataFrame:
    with_null = project(where(t.orders, P.gt("o_totalprice", 400000)), expression("nullif(o_custkey, 3)", "k"))
    return where(t.customer, P.lt("c_acctbal", 0), or_not(P.in_query("c_custkey", with_null)))


@query("""SELECT * FROM orders WHERE EXISTS (SELECT 1 FROM lineitem
          WHERE l_orderkey = o_orderkey AND l_returnflag = 'R' AND l_quantity > 45)""")
def exists_subquery(t: Data) -> DataFrame:
    returned = where(t.lineitem, P.eq("l_returnflag", "R"), and_(P.gt("l_quantity", 45)))
    return where(t.orders, P.exists(returned, [("o_orderkey", "l_orderkey")]))


@query("""SELECT * FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem
          WHERE l_orderkey = o_orderkey AND l_shipdate < o_orderdate)""")
def not_exists_subquery(t: Data) -> DataFrame:
    return where(t.orders, and_not(P.exists(t.lineitem, "l_orderkey = o_orderkey and l_shipdate < o_orderdate")))


@query("""SELECT * FROM orders WHERE o_totalprice > 450000 OR NOT EXISTS (SELECT 1 FROM lineitem
          WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')""")
def exists_subquery_or(t: Data) -> DataFrame:
    returned = where(t.lineitem, P.eq("l_returnflag", "R"))
    return where(t.orders, P.gt("o_totalprice", 450000), or_not(P.exists(returned, [("o_orderkey", "l_orderkey")])))


@query("""SELECT * FROM customer WHERE c_nationkey < 20
          AND EXISTS (SELECT 1 FROM supplier WHERE s_nationkey < 10 AND s_acctbal - 500 > c_acctbal)""")
def exists_inequality(t: Data) -> DataFrame:
    richer = P.exists(t.supplier, "s_nationkey < 10 AND s_acctbal - 500 > c_acctbal")
    return where(t.customer, P.lt("c_nationkey", 20), and_(richer))


@query("""SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'
          OR NOT EXISTS (SELECT 1 FROM supplier WHERE s_acctbal >= c_acctbal + 300 OR s_nationkey = 3 AND s_acctbal > c_acctbal)""")
def exists_inequality_or(t: Data) -> DataFrame:
    richer = P.exists(t.supplier, "s_acctbal >= c_acctbal + 300 OR s_nationkey = 3 AND s_acctbal > c_acctbal")
    return where(t.customer, P.eq("c_mktsegment", "BUILDING"), or_not(richer))


@query("""SELECT * FROM customer WHERE NOT EXISTS
          (SELECT 1 FROM supplier WHERE s_acctbal > c_acctbal AND s_acctbal < c_acctbal + 50 AND s_nationkey <> c_nationkey)""")
def not_exists_between(t: Data) -> DataFrame:
    near = P.exists(t.supplier, "s_acctbal > c_acctbal AND s_acctbal < c_acctbal + 50 AND s_nationkey <> c_nationkey")
    return where(t.customer, and_not(near))


@query("""SELECT * FROM customer WHERE c_mktsegment = 'BUILDING' OR NOT EXISTS
          (SELECT 1 FROM supplier WHERE s_acctbal > c_acctbal AND s_acctbal < c_acctbal + 50 AND s_nationkey <> c_nationkey)""")
def not_exists_between_or(t: Data) -> DataFrame:
    near = P.exists(t.supplier, "s_acctbal > c_acctbal AND s_acctbal < c_acctbal + 50 AND s_nationkey <> c_nationkey")
    return where(t.customer, P.eq("c_mktsegment", "BUILDING"), or_not(near))


# ---------------------------------------------------------------- chains and groups

_orders_where(
    "chain_and",
    "o_orderstatus = 'F' AND o_totalprice > 100000 AND NOT o_custkey < 100",
    P.eq("o_orderstatus", "F"),
    and_(P.gt("o_totalprice", 100000)),
    and_not(P.lt("o_custkey", 100)),
)
_orders_where(
    "chain_or",
    "o_orderstatus = 'P' OR o_totalprice > 450000 OR NOT o_custkey >= 50",
    P.eq("o_orderstatus", "P"),
    or_(P.gt("o_totalprice", 450000)),
    or_not(P.ge("o_custkey", 50)),
)
_orders_where(
    "chain_precedence",
    "o_orderstatus = 'P' OR o_totalprice > 300000 AND o_orderpriority = '1-URGENT' OR o_custkey = 7 AND o_orderstatus <> 'O'",
    P.eq("o_orderstatus", "P"),
    or_(P.gt("o_totalprice", 300000)),
    and_(P.eq("o_orderpriority", "1-URGENT")),
    or_(P.eq("o_custkey", 7)),
    and_not(P.eq("o_orderstatus", "O")),
)
_orders_where(
    "chain_first_not",
    "o_orderstatus <> 'F' AND o_totalprice > 200000",
    or_not(P.eq("o_orderstatus", "F")),
    and_(P.gt("o_totalprice", 200000)),
)

_URGENT_OR_BIG = (P.eq("o_orderpriority", "1-URGENT"), or_(P.gt("o_totalprice", 400000)))
_LOW_OR_SMALL = (P.eq("o_orderpriority", "5-LOW"), or_(P.lt("o_totalprice", 50000)))
_G1 = "(o_orderpriority = '1-URGENT' OR o_totalprice > 400000)"
_G2 = "(o_orderpriority = '5-LOW' OR o_totalprice < 50000)"
_FIRST = P.eq("o_orderstatus", "F")

_orders_where(
    "group_and", f"o_orderstatus = 'F' AND {_G1} AND {_G2}", group(group(*_URGENT_OR_BIG), group(*_LOW_OR_SMALL), _FIRST)
)
_orders_where(
    "group_or", f"o_orderstatus = 'F' OR {_G1} OR {_G2}", group(_FIRST, group(*_URGENT_OR_BIG), group(*_LOW_OR_SMALL), link=P.OR)
)
_orders_where(
    "group_and_not",
    f"o_orderstatus = 'F' AND NOT {_G1} AND NOT {_G2}",
    group(_FIRST, group(*_URGENT_OR_BIG), group(*_LOW_OR_SMALL), link=P.AND_NOT),
)
_orders_where(
    "group_or_not",
    f"{_G1} OR NOT {_G2}",
    group(group(*_URGENT_OR_BIG, link=P.OR), group(*_LOW_OR_SMALL, link=P.AND), link=P.OR_NOT),
)
