"""Joins, grouping, sorting, paging and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions import predicates as P
from ..functions.predicates import and_, and_not, or_, where
from ..operators import setops
from ..operators.paging import deep_page, page, page_with_total, single_row_frame, sort_rows, total_count
from ..operators.relational import aggregate, expression, inequality_join, join_on, project
from .catalogue import Catalogue, Data

catalogue = Catalogue()
query = catalogue.query


# ---------------------------------------------------------------- joins


@query("""SELECT o.o_orderkey, c.c_name, o.o_totalprice FROM orders o INNER JOIN customer c
          ON o.o_custkey = c.c_custkey""")
def join_inner(t: Data) -> DataFrame:
    joined = join_on(t.orders.alias("o"), t.customer.alias("c"), ("o.o_custkey", "c.c_custkey"))
    return project(joined, "o.o_orderkey", "c.c_name", "o.o_totalprice")


@query("""SELECT d.doc_id, d.lang, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def join_left(t: Data) -> DataFrame:
    joined = join_on(t.documents.alias("d"), t.labels.alias("l"), ("d.doc_id", "l.doc_id"), how="left")
    return project(joined, "d.doc_id", "d.lang", "l.quality")


@query("""SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, o.o_orderdate FROM lineitem l
          INNER JOIN orders o ON l.l_shipdate > o.o_orderdate AND l.l_orderkey = o.o_orderkey""")
def join_theta(t: Data) -> DataFrame:
    joined = join_on(
        t.lineitem.alias("l"),
        t.orders.alias("o"),
        ("l.l_shipdate", "o.o_orderdate", ">"),
        P.raw("l.l_orderkey = o.o_orderkey"),
    )
    return project(joined, "l.l_orderkey", "l.l_linenumber", "l.l_partkey", "l.l_suppkey", "o.o_orderdate")


@query("""SELECT c.c_custkey, s.s_nationkey, s.best FROM customer c LEFT JOIN
            (SELECT s_nationkey, max(s_acctbal) AS best FROM supplier GROUP BY s_nationkey) s
          ON c.c_acctbal > s.best""")
def join_inequality(t: Data) -> DataFrame:
    best = aggregate(t.supplier, ["s_nationkey"], [expression("max(s_acctbal)", "best")]).alias("s")
    joined = inequality_join(t.customer.alias("c"), best, ("c.c_acctbal", "s.best", ">"), how="left")
    return project(joined, "c.c_custkey", "s.s_nationkey", "s.best")


@query("""SELECT s.s_suppkey, l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_extendedprice FROM supplier s JOIN lineitem l
          ON s.s_acctbal > l.l_extendedprice AND s.s_acctbal - l.l_extendedprice < 1""")
def join_theta_large(t: Data) -> DataFrame:
    """No equality, and the larger table on the right."""
    near = P.raw("s.s_acctbal - l.l_extendedprice < ?", 1)
    joined = join_on(t.supplier.alias("s"), t.lineitem.alias("l"), ("s.s_acctbal", "l.l_extendedprice", ">"), near)
    return project(joined, "s.s_suppkey", "l.l_orderkey", "l.l_linenumber", "l.l_partkey", "l.l_extendedprice")


_BANDS = "(SELECT s_suppkey, s_acctbal AS low, s_acctbal + 20 AS high FROM supplier) b"


def _bands(t: Data) -> DataFrame:
    return project(t.supplier, "s_suppkey", ("s_acctbal", "low"), expression("s_acctbal + 20", "high")).alias("b")


@query(f"""SELECT c.c_custkey, b.s_suppkey FROM customer c LEFT JOIN {_BANDS} ON c.c_acctbal >= b.low AND c.c_acctbal < b.high
           AND b.s_suppkey <> c.c_custkey""")
def join_between(t: Data) -> DataFrame:
    joined = join_on(
        t.customer.alias("c"),
        _bands(t),
        ("c.c_acctbal", "b.low", ">="),
        and_(P.raw("c.c_acctbal < b.high AND b.s_suppkey <> c.c_custkey")),
        how="left",
    )
    return project(joined, "c.c_custkey", "b.s_suppkey")


@query(f"SELECT b.s_suppkey, c.c_custkey FROM {_BANDS} LEFT JOIN customer c ON c.c_acctbal BETWEEN b.low AND b.high AND c.c_nationkey < 12")
def join_between_left(t: Data) -> DataFrame:
    """The intervals on the left, some without a value."""
    within = P.raw("c.c_acctbal BETWEEN b.low AND b.high AND c.c_nationkey < ?", 12)
    joined = join_on(_bands(t), t.customer.alias("c"), ("b.high", "c.c_acctbal", ">="), within, how="left")
    return project(joined, "b.s_suppkey", "c.c_custkey")


@query("""SELECT o.o_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey FROM orders o LEFT JOIN lineitem l
          ON o.o_orderkey = l.l_orderkey AND l.l_returnflag = 'R' AND l.l_quantity > 30""")
def join_left_on_literal(t: Data) -> DataFrame:
    joined = join_on(
        t.orders.alias("o"),
        t.lineitem.alias("l"),
        ("o.o_orderkey", "l.l_orderkey"),
        P.eq("l.l_returnflag", "R"),
        and_(P.gt("l.l_quantity", 30)),
        how="left",
    )
    return project(joined, "o.o_orderkey", "l.l_linenumber", "l.l_partkey", "l.l_suppkey")


@query("""SELECT o.o_orderkey, c.c_custkey, c.c_mktsegment FROM orders o LEFT JOIN customer c
          ON (o.o_custkey = c.c_custkey AND c.c_mktsegment = 'BUILDING') OR o.o_orderkey = c.c_custkey""")
def join_on_or(t: Data) -> DataFrame:
    joined = join_on(
        t.orders.alias("o"),
        t.customer.alias("c"),
        ("o.o_custkey", "c.c_custkey"),
        or_(P.eq("c.c_mktsegment", "BUILDING")),
        or_(P.raw("o.o_orderkey = c.c_custkey")),
        how="left",
    )
    return project(joined, "o.o_orderkey", "c.c_custkey", "c.c_mktsegment")


def _order_counts(t: Data) -> DataFrame:
    big = where(t.orders, P.gt("o_totalprice", 300000))
    return aggregate(big, ["o_custkey"], [expression("count(*)", "n")]).alias("spend")


_COUNTS = "WITH spend AS (SELECT o_custkey, count(*) AS n FROM orders WHERE o_totalprice > 300000 GROUP BY o_custkey)"


@query(f"{_COUNTS} SELECT c.c_custkey, spend.n FROM customer c INNER JOIN spend ON c.c_custkey = spend.o_custkey")
def join_cte(t: Data) -> DataFrame:
    joined = join_on(t.customer.alias("c"), _order_counts(t), ("c.c_custkey", "spend.o_custkey"))
    return project(joined, "c.c_custkey", "spend.n")


@query(f"{_COUNTS} SELECT c.c_custkey, spend.n FROM customer c LEFT JOIN spend ON c.c_custkey = spend.o_custkey")
def join_cte_left(t: Data) -> DataFrame:
    joined = join_on(t.customer.alias("c"), _order_counts(t), ("c.c_custkey", "spend.o_custkey"), how="left")
    return project(joined, "c.c_custkey", "spend.n")


@query("""SELECT o.o_orderkey, c.c_name, n.n_name, l.l_partkey, l.l_suppkey, l.l_linenumber FROM orders o
          INNER JOIN customer c ON o.o_custkey = c.c_custkey
          INNER JOIN nation n ON c.c_nationkey = n.n_nationkey
          LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey AND l.l_discount > 0.05""")
def join_multi(t: Data) -> DataFrame:
    joined = join_on(t.orders.alias("o"), t.customer.alias("c"), ("o.o_custkey", "c.c_custkey"))
    joined = join_on(joined, t.nation.alias("n"), ("c.c_nationkey", "n.n_nationkey"))
    lines = ("o.o_orderkey", "l.l_orderkey")
    joined = join_on(joined, t.lineitem.alias("l"), lines, P.gt("l.l_discount", 0.05), how="left")
    return project(joined, "o.o_orderkey", "c.c_name", "n.n_name", "l.l_partkey", "l.l_suppkey", "l.l_linenumber")


# ---------------------------------------------------------------- grouping


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderstatus, o_orderpriority")
def group_by(t: Data) -> DataFrame:
    return aggregate(t.orders, ["o_orderstatus", "o_orderpriority"], [expression("count(*)", "n")])


@query("SELECT substr(p_name, 1, 3) AS start, count(p_name) AS n FROM part GROUP BY substr(p_name, 1, 3)")
def group_by_expr(t: Data) -> DataFrame:
    return aggregate(t.part, [expression("substr(p_name, 1, 3)", "start")], [expression("count(p_name)", "n")])


@query("SELECT segment, count(*) AS n FROM (SELECT lower(c_mktsegment) AS segment FROM customer) AS s GROUP BY segment")
def group_by_alias(t: Data) -> DataFrame:
    named = project(t.customer, expression("lower(c_mktsegment)", "segment"))
    return aggregate(named, ["segment"], [expression("count(*)", "n")])


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n, count(DISTINCT l_suppkey) AS suppliers,
                 min(l_quantity) AS least, max(l_extendedprice) AS most,
                 CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS total,
                 CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2)) * (1 - CAST(l_discount AS DECIMAL(18, 2)))) AS DOUBLE)
                   AS net
          FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def agg_functions(t: Data) -> DataFrame:
    price, discount = "cast(l_extendedprice as decimal(18,2))", "cast(l_discount as decimal(18,2))"
    return aggregate(
        t.lineitem,
        ["l_returnflag", "l_linestatus"],
        [
            expression("count(*)", "n"),
            expression("count(distinct l_suppkey)", "suppliers"),
            expression("min(l_quantity)", "least"),
            expression("max(l_extendedprice)", "most"),
            expression(f"cast(sum({price}) as double)", "total"),
            expression(f"cast(sum({price} * (1 - {discount})) as double)", "net"),
        ],
    )


@query("SELECT count(*) AS n, count(DISTINCT o_custkey) AS customers, max(o_totalprice) AS most FROM orders")
def agg_global(t: Data) -> DataFrame:
    aggs = [("count(*)", "n"), ("count(distinct o_custkey)", "customers"), ("max(o_totalprice)", "most")]
    return aggregate(t.orders, [], [expression(text, alias) for text, alias in aggs])


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) >= 12 AND max(o_totalprice) > 300000")
def having(t: Data) -> DataFrame:
    kept = [P.ge("n", 12), and_(P.raw("max(o_totalprice) > ?", 300000))]
    return aggregate(t.orders, ["o_custkey"], [expression("count(*)", "n")], having=kept)


@query("""SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey
          HAVING count(*) > 16 OR min(o_totalprice) > 100000 AND o_custkey < 500 OR NOT o_custkey > 20""")
def having_or(t: Data) -> DataFrame:
    kept = [
        P.raw("count(*) > 16"),
        or_(P.raw("min(o_totalprice) > 100000")),
        and_(P.lt("o_custkey", 500)),
        P.or_not(P.gt("o_custkey", 20)),
    ]
    return aggregate(t.orders, ["o_custkey"], [expression("count(*)", "n")], having=kept)


@query("SELECT count(*) AS total FROM (SELECT l_suppkey, l_returnflag FROM lineitem GROUP BY l_suppkey, l_returnflag) AS g")
def total_count_of_groups(t: Data) -> DataFrame:
    return total_count(aggregate(t.lineitem, ["l_suppkey", "l_returnflag"], []))


catalogue.add(
    "total_count",
    lambda t: total_count(where(t.lineitem, P.eq("l_returnflag", "R"))),
    "SELECT count(*) AS total FROM lineitem WHERE l_returnflag = 'R'",
)


# ---------------------------------------------------------------- sort, page, single row


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderstatus, o_totalprice DESC, o_orderkey")
def sort_multi(t: Data) -> DataFrame:
    ordered = sort_rows(t.orders, "o_orderstatus", ("o_totalprice", False), "o_orderkey")
    return project(ordered, "o_orderkey", "o_totalprice")


_BY_PRICE = [("o_totalprice", False), "o_orderkey"]

catalogue.add(
    "page",
    lambda t: page(where(t.orders, P.eq("o_orderstatus", "F")), _BY_PRICE, 3, 30),
    "SELECT * FROM orders WHERE o_orderstatus = 'F' ORDER BY o_totalprice DESC, o_orderkey LIMIT 30 OFFSET 60",
)
catalogue.add(
    "page_deep",
    lambda t: deep_page(t.orders, ["o_orderdate", ("o_totalprice", False), "o_orderkey"], 33, 40, near=1000),
    "SELECT * FROM orders ORDER BY o_orderdate, o_totalprice DESC, o_orderkey LIMIT 40 OFFSET 1280",
)
catalogue.add(
    "page_with_total",
    lambda t: page_with_total(where(t.orders, P.eq("o_orderstatus", "P")), _BY_PRICE, 2, 25),
    """SELECT p.*, c.total_results, CASE WHEN c.total_results = 0 THEN 0 ELSE 1 + (c.total_results - 1) // 25 END
         AS total_pages
       FROM (SELECT * FROM orders WHERE o_orderstatus = 'P' ORDER BY o_totalprice DESC, o_orderkey LIMIT 25 OFFSET 25) p,
            (SELECT count(*) AS total_results FROM orders WHERE o_orderstatus = 'P') c""",
)
catalogue.add(
    "page_with_total_empty",
    lambda t: page_with_total(where(t.region, P.gt("r_regionkey", 1)), ["r_regionkey"], 9, 2),
    """SELECT NULL::INTEGER AS r_regionkey, NULL::VARCHAR AS r_name, count(*) AS total_results,
         CASE WHEN count(*) = 0 THEN 0 ELSE 1 + (count(*) - 1) // 2 END AS total_pages FROM region WHERE r_regionkey > 1""",
)


@query("SELECT * FROM customer WHERE c_custkey = (SELECT max(o_custkey) FROM orders)")
def single_row(t: Data) -> DataFrame:
    newest = aggregate(t.orders, [], [expression("max(o_custkey)", "k")])
    return single_row_frame(where(t.customer, P.in_query("c_custkey", newest)))


@query("""SELECT s_suppkey, n_nationkey FROM supplier JOIN nation ON s_nationkey < n_nationkey AND n_name <> 'JAPAN'""")
def join_theta_only(t: Data) -> DataFrame:
    found = join_on(t.supplier.alias("s"), t.nation.alias("n"), ("s.s_nationkey", "n.n_nationkey", "<"), and_not(P.eq("n.n_name", "JAPAN")))
    return found.select("s_suppkey", "n_nationkey")


# ---------------------------------------------------------------- set operations

_FINISHED = "SELECT o_custkey AS k, o_orderstatus AS s FROM orders WHERE o_orderstatus = 'F'"
_URGENT = "SELECT o_custkey AS k, o_orderstatus AS s FROM orders WHERE o_orderpriority = '1-URGENT'"
_COSTLY = "SELECT o_custkey AS k, o_orderstatus AS s FROM orders WHERE o_totalprice > 350000"
_KEY_AND_STATUS = [("o_custkey", "k"), ("o_orderstatus", "s")]


def _finished(t: Data) -> DataFrame:
    return project(where(t.orders, P.eq("o_orderstatus", "F")), *_KEY_AND_STATUS)


def _urgent(t: Data) -> DataFrame:
    return project(where(t.orders, P.eq("o_orderpriority", "1-URGENT")), *_KEY_AND_STATUS)


def _costly(t: Data) -> DataFrame:
    return project(where(t.orders, P.gt("o_totalprice", 350000)), *_KEY_AND_STATUS)


def _pairwise(name: str, operation: str) -> None:
    catalogue.add(
        name,
        lambda t: setops.combine(_finished(t), [(operation, _urgent(t))]),
        f"{_FINISHED} {operation.upper()} {_URGENT}",
    )


_pairwise("union_distinct", setops.UNION)
_pairwise("union_all", setops.UNION_ALL)
_pairwise("intersect", setops.INTERSECT)
_pairwise("except", setops.EXCEPT)


@query(f"((({_FINISHED}) UNION ({_URGENT})) INTERSECT ({_COSTLY})) UNION ALL ({_URGENT})")
def setop_chain(t: Data) -> DataFrame:
    steps = [(setops.UNION, _urgent(t)), (setops.INTERSECT, _costly(t)), (setops.UNION_ALL, _urgent(t))]
    return setops.combine(_finished(t), steps)


@query(f"((({_FINISHED}) UNION ALL ({_URGENT})) EXCEPT ({_COSTLY})) UNION ({_COSTLY})")
def setop_chain_except(t: Data) -> DataFrame:
    steps = [(setops.UNION_ALL, _urgent(t)), (setops.EXCEPT, _costly(t)), (setops.UNION, _costly(t))]
    return setops.combine(_finished(t), steps)
