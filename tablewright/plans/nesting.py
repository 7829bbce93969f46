"""Nested lists. Lists are returned as JSON text, which compares like any other column."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import predicates as P
from ..functions.predicates import and_, group, or_, other, where
from ..operators import nested
from ..operators.nested import nested_chunks, to_json_list
from ..operators.paging import page
from ..operators.relational import aggregate, column, expression, join_on, project
from .catalogue import Catalogue, Data

catalogue = Catalogue()
query = catalogue.query

_OF_CUSTOMER = P.eq("o.o_custkey", other("c.c_custkey"))
_OF_ORDER = P.eq("l.l_orderkey", other("o.o_orderkey"))
_LINE_FIELDS = [("l.l_linenumber", "line"), ("l.l_partkey", "part"), ("l.l_suppkey", "supplier")]
_LINE_SORT = ["l.l_linenumber", "l.l_partkey", "l.l_suppkey"]
_LINE = "{'line': l_linenumber, 'part': l_partkey, 'supplier': l_suppkey} ORDER BY l_linenumber, l_partkey, l_suppkey"


def _as_json(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: to_json_list(name) for name in names})


@query("""SELECT c.c_custkey, c.c_name, coalesce(to_json(k.l), '[]')::VARCHAR AS orders FROM customer c LEFT JOIN
            (SELECT o_custkey, list({'key': o_orderkey, 'status': o_orderstatus} ORDER BY o_orderkey) AS l
             FROM orders GROUP BY o_custkey) k ON k.o_custkey = c.c_custkey""")
def nested_list_json(t: Data) -> DataFrame:
    parents = project(t.customer.alias("c"), "c.c_custkey", "c.c_name")
    fields = [("o.o_orderkey", "key"), column("o.o_orderstatus", "status")]
    return _as_json(nested.nested_list(parents, t.orders.alias("o"), _OF_CUSTOMER, fields, "orders", ["o.o_orderkey"]), "orders")


@query("""SELECT c_custkey, coalesce(k.n, 0) AS n, k.first_key, k.last_key FROM customer LEFT JOIN
            (SELECT o_custkey, count(*) AS n, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
             FROM orders GROUP BY o_custkey) k ON o_custkey = c_custkey""")
def nested_list_typed(t: Data) -> DataFrame:
    parents = project(t.customer.alias("c"), "c.c_custkey")
    lists = nested.nested_list(parents, t.orders.alias("o"), _OF_CUSTOMER, ["o.o_orderkey"], "orders", ["o.o_orderkey"])
    ends = [F.get("orders", F.lit(0)), F.try_element_at("orders", F.lit(-1))]
    return lists.select(
        "c_custkey",
        F.size("orders").cast("long").alias("n"),
        ends[0]["o_orderkey"].alias("first_key"),
        ends[1]["o_orderkey"].alias("last_key"),
    )


@query("""SELECT c_custkey, item.o_orderkey AS o_orderkey FROM
            (SELECT c_custkey, unnest(l) AS item FROM customer JOIN
              (SELECT o_custkey, list({'o_orderkey': o_orderkey}) AS l FROM orders GROUP BY o_custkey)
             ON o_custkey = c_custkey)""")
def nested_list(t: Data) -> DataFrame:
    parents = project(t.customer.alias("c"), "c.c_custkey")
    lists = nested.nested_list(parents, t.orders.alias("o"), _OF_CUSTOMER, ["o.o_orderkey"], "orders")
    return lists.select("c_custkey", F.inline("orders"))


@query("""SELECT c.c_custkey, coalesce(to_json(k.l), '[]')::VARCHAR AS orders FROM customer c LEFT JOIN
            (SELECT o_custkey, list({'key': o_orderkey, 'priority': o_orderpriority}
                                    ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey) AS l
             FROM orders GROUP BY o_custkey) k ON k.o_custkey = c.c_custkey""")
def nested_list_sorted_desc(t: Data) -> DataFrame:
    parents = project(t.customer.alias("c"), "c.c_custkey")
    order = ["o.o_orderpriority", ("o.o_totalprice", False), "o.o_orderkey"]
    fields = [("o.o_orderkey", "key"), ("o.o_orderpriority", "priority")]
    return _as_json(nested.nested_list(parents, t.orders.alias("o"), _OF_CUSTOMER, fields, "orders", order), "orders")


@query(f"""SELECT o.o_orderkey, coalesce(to_json(k.l), '[]')::VARCHAR AS returned FROM orders o LEFT JOIN
            (SELECT l_orderkey, list({_LINE}) AS l FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 20
             GROUP BY l_orderkey) k ON k.l_orderkey = o.o_orderkey""")
def nested_list_filtered(t: Data) -> DataFrame:
    returned = where(t.lineitem.alias("l"), P.eq("l.l_returnflag", "R"), and_(P.gt("l.l_quantity", 20)))
    parents = project(t.orders.alias("o"), "o.o_orderkey")
    return _as_json(nested.nested_list(parents, returned, _OF_ORDER, _LINE_FIELDS, "returned", _LINE_SORT), "returned")


@query("""SELECT o.o_orderkey, coalesce(to_json(k.l), '[]')::VARCHAR AS parts FROM orders o LEFT JOIN
            (SELECT l_orderkey, list({'brand': p_brand, 'part': p_partkey, 'supplier': l_suppkey}
                                     ORDER BY p_brand, p_partkey, l_suppkey, l_linenumber) AS l
             FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_size <= 25 GROUP BY l_orderkey) k
          ON k.l_orderkey = o.o_orderkey""")
def nested_list_join(t: Data) -> DataFrame:
    small = where(t.part.alias("p"), P.le("p.p_size", 25))
    lines = join_on(t.lineitem.alias("l"), small, ("l.l_partkey", "p.p_partkey"))
    parents = project(t.orders.alias("o"), "o.o_orderkey")
    fields = [("p.p_brand", "brand"), ("p.p_partkey", "part"), ("l.l_suppkey", "supplier")]
    order = ["p.p_brand", "p.p_partkey", "l.l_suppkey", "l.l_linenumber"]
    return _as_json(nested.nested_list(parents, lines, _OF_ORDER, fields, "parts", order), "parts")


@query("""SELECT c.c_custkey, coalesce(to_json(k.l), '[]')::VARCHAR AS by_status FROM customer c LEFT JOIN
            (SELECT o_custkey, list({'status': o_orderstatus, 'n': n} ORDER BY o_orderstatus) AS l FROM
              (SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL HAVING count(*) >= 4)
             GROUP BY o_custkey) k ON k.o_custkey = c.c_custkey""")
def nested_list_grouped(t: Data) -> DataFrame:
    counts = aggregate(
        t.orders.alias("o"),
        ["o_custkey", "o_orderstatus"],
        [expression("count(*)", "n")],
        having=P.ge("n", 4),
    )
    parents = project(t.customer.alias("c"), "c.c_custkey")
    match = P.eq("o_custkey", other("c.c_custkey"))
    fields = [("o_orderstatus", "status"), "n"]
    return _as_json(nested.nested_list(parents, counts, match, fields, "by_status", ["o_orderstatus"]), "by_status")


@query("""SELECT c.c_custkey, coalesce(to_json(k.l), '[]')::VARCHAR AS orders FROM customer c LEFT JOIN
            (SELECT c_custkey, list({'key': o_orderkey, 'customer': o_custkey} ORDER BY o_orderkey) AS l FROM
              (SELECT * FROM customer JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'P'
               UNION ALL
               SELECT * FROM customer JOIN orders ON o_orderkey = c_custkey
               WHERE NOT (o_custkey = c_custkey AND o_orderstatus = 'P'))
             GROUP BY c_custkey) k ON k.c_custkey = c.c_custkey""")
def nested_list_or(t: Data) -> DataFrame:
    either = group(_OF_CUSTOMER, and_(P.raw("o.o_orderstatus = 'P'")), or_(P.eq("o.o_orderkey", other("c.c_custkey"))))
    parents = project(t.customer.alias("c"), "c.c_custkey")
    fields = [("o.o_orderkey", "key"), ("o.o_custkey", "customer")]
    lists = nested.nested_list(parents, t.orders.alias("o"), either, fields, "orders", ["o.o_orderkey"], reads=[])
    return _as_json(lists, "orders")


@query("""SELECT c.c_custkey, c.c_acctbal, coalesce(to_json(k.l), '[]')::VARCHAR AS orders FROM customer c LEFT JOIN
            (SELECT c_custkey, list({'key': o_orderkey} ORDER BY o_orderkey) AS l FROM customer JOIN orders
               ON o_custkey = c_custkey AND o_totalprice >= c_acctbal AND o_totalprice < c_acctbal * 40
             GROUP BY c_custkey) k ON k.c_custkey = c.c_custkey""")
def nested_list_range(t: Data) -> DataFrame:
    within = [
        _OF_CUSTOMER,
        and_(P.ge("o.o_totalprice", other("c.c_acctbal"))),
        and_(P.raw("o.o_totalprice < c.c_acctbal * ?", 40)),
    ]
    parents = project(t.customer.alias("c"), "c.c_custkey", "c.c_acctbal")
    fields = [("o.o_orderkey", "key")]
    return nested.nested_list(
        parents, t.orders.alias("o"), within, fields, "orders", ["o.o_orderkey"], reads=["c.c_acctbal"], as_json=True
    )


@query("""SELECT s.s_suppkey, coalesce(to_json(k.l), '[]')::VARCHAR AS parts FROM supplier s LEFT JOIN
            (SELECT s_acctbal, list({'key': p_partkey} ORDER BY p_partkey) AS l FROM (SELECT DISTINCT s_acctbal FROM supplier) x
               JOIN part ON p_retailprice >= s_acctbal AND p_retailprice <= s_acctbal + 50 GROUP BY s_acctbal) k
            ON k.s_acctbal = s.s_acctbal""")
def nested_list_range_only(t: Data) -> DataFrame:
    within = [P.ge("p.p_retailprice", other("s.s_acctbal")), and_(P.le("p.p_retailprice", other("s.top")))]
    parents = t.supplier.selectExpr("s_suppkey", "s_acctbal", "s_acctbal + 50 AS top").alias("s")
    lists = nested.nested_list(parents, t.part.alias("p"), within, [("p.p_partkey", "key")], "parts", ["p.p_partkey"], as_json=True)
    return lists.select("s_suppkey", "parts")


_CHOICE = "(SELECT s_suppkey, 905 + s_acctbal / 1000 AS low, 48 + s_suppkey % 3 AS top FROM supplier) s"


@query(f"""SELECT s.s_suppkey, coalesce(to_json(k.l), '[]')::VARCHAR AS parts FROM {_CHOICE} LEFT JOIN
            (SELECT s_suppkey, list({{'key': p_partkey}} ORDER BY p_partkey) AS l FROM {_CHOICE}
               JOIN part ON p_retailprice < low OR p_size > top GROUP BY s_suppkey) k ON k.s_suppkey = s.s_suppkey""")
def nested_list_range_or(t: Data) -> DataFrame:
    """Two inequalities on different columns, either of which links."""
    either = [P.lt("p.p_retailprice", other("s.low")), or_(P.gt("p.p_size", other("s.top")))]
    parents = t.supplier.selectExpr("s_suppkey", "905 + s_acctbal / 1000 AS low", "48 + s_suppkey % 3 AS top").alias("s")
    lists = nested.nested_list(parents, t.part.alias("p"), either, [("p.p_partkey", "key")], "parts", ["p.p_partkey"], as_json=True)
    return lists.select("s_suppkey", "parts")


@query(f"""SELECT s.s_suppkey, coalesce(to_json(k.l), '[]')::VARCHAR AS parts FROM {_CHOICE} LEFT JOIN
            (SELECT s_suppkey, list({{'key': p_partkey}} ORDER BY p_partkey) AS l FROM {_CHOICE}
               JOIN part ON p_retailprice BETWEEN low - 3 AND low GROUP BY s_suppkey) k ON k.s_suppkey = s.s_suppkey""")
def nested_list_range_raw(t: Data) -> DataFrame:
    """An interval given as text."""
    parents = t.supplier.selectExpr("s_suppkey", "905 + s_acctbal / 1000 AS low").alias("s")
    within = P.raw("p.p_retailprice BETWEEN s.low - ? AND s.low", 3)
    lists = nested.nested_list(
        parents, t.part.alias("p"), within, [("p.p_partkey", "key")], "parts", ["p.p_partkey"], reads=["s.low"], as_json=True
    )
    return lists.select("s_suppkey", "parts")


@query(f"""SELECT c.c_custkey, c.c_name, coalesce(to_json(k.l), '[]')::VARCHAR AS orders FROM customer c LEFT JOIN
            (SELECT o_custkey, list({{'key': o_orderkey, 'status': o_orderstatus, 'lines': coalesce(i.l, [])}}
                                    ORDER BY o_orderkey) AS l
             FROM orders LEFT JOIN (SELECT l_orderkey, list({_LINE}) AS l FROM lineitem GROUP BY l_orderkey) i
               ON i.l_orderkey = o_orderkey
             GROUP BY o_custkey) k ON k.o_custkey = c.c_custkey
          WHERE c.c_mktsegment = 'BUILDING' OR c.c_acctbal > 5000 AND c.c_nationkey < 10""")
def nested_list_deep(t: Data) -> DataFrame:
    """Customers with their orders with their lines: the flagship."""
    chosen = where(
        t.customer.alias("c"),
        P.eq("c.c_mktsegment", "BUILDING"),
        or_(P.gt("c.c_acctbal", 5000)),
        and_(P.lt("c.c_nationkey", 10)),
    )
    orders = nested.nested_list(t.orders.alias("o"), t.lineitem.alias("l"), _OF_ORDER, _LINE_FIELDS, "lines", _LINE_SORT)
    fields = [("o.o_orderkey", "key"), ("o.o_orderstatus", "status"), "lines"]
    parents = project(chosen, "c.c_custkey", "c.c_name")
    return _as_json(nested.nested_list(parents, orders, _OF_CUSTOMER, fields, "orders", ["o.o_orderkey"]), "orders")


@query("""SELECT c.c_custkey, coalesce(to_json(a.l), '[]')::VARCHAR AS orders,
                 coalesce(to_json(b.l), '[]')::VARCHAR AS events FROM customer c
          LEFT JOIN (SELECT o_custkey, list({'key': o_orderkey} ORDER BY o_orderkey) AS l FROM orders
                     GROUP BY o_custkey) a ON a.o_custkey = c.c_custkey
          LEFT JOIN (SELECT user_id, list({'id': event_id, 'type': event_type} ORDER BY event_id) AS l FROM events
                     GROUP BY user_id) b ON b.user_id = c.c_custkey""")
def nested_list_two(t: Data) -> DataFrame:
    parents = project(t.customer.alias("c"), "c.c_custkey")
    orders = [("o.o_orderkey", "key")]
    both = nested.nested_list(parents, t.orders.alias("o"), _OF_CUSTOMER, orders, "orders", ["o.o_orderkey"])
    events = [("e.event_id", "id"), ("e.event_type", "type")]
    match = P.eq("e.user_id", other("c.c_custkey"))
    both = nested.nested_list(both, t.events.alias("e"), match, events, "events", ["e.event_id"])
    return _as_json(both, "orders", "events")


@query("""SELECT c.c_custkey, c.c_acctbal, coalesce(to_json(k.l), '[]')::VARCHAR AS orders FROM
            (SELECT * FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 20 OFFSET 20) c LEFT JOIN
            (SELECT o_custkey, list({'key': o_orderkey} ORDER BY o_orderkey) AS l FROM orders GROUP BY o_custkey) k
          ON k.o_custkey = c.c_custkey""")
def nested_list_page(t: Data) -> DataFrame:
    parents = page(t.customer.alias("c"), [("c_acctbal", False), "c_custkey"], 2, 20)
    parents = project(parents, "c.c_custkey", "c.c_acctbal")
    fields = [("o.o_orderkey", "key")]
    lists = nested.nested_list(parents, t.orders.alias("o"), _OF_CUSTOMER, fields, "orders", ["o.o_orderkey"], prune_child=True)
    return _as_json(lists, "orders")


@query(f"""SELECT c.c_custkey, coalesce(to_json(k.l), '[]')::VARCHAR AS orders FROM
             (SELECT * FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 25 OFFSET 50) c LEFT JOIN
             (SELECT o_custkey, list({{'key': o_orderkey, 'lines': coalesce(i.l, [])}} ORDER BY o_orderkey) AS l
              FROM orders LEFT JOIN (SELECT l_orderkey, list({_LINE}) AS l FROM lineitem GROUP BY l_orderkey) i
                ON i.l_orderkey = o_orderkey
              GROUP BY o_custkey) k ON k.o_custkey = c.c_custkey""")
def nested_list_page_deep(t: Data) -> DataFrame:
    """Cut down from the top, nest from the bottom: only the page's orders and their lines are shuffled."""
    parents = page(t.customer.alias("c"), [("c_acctbal", False), "c_custkey"], 3, 25)
    parents = project(parents, "c.c_custkey")
    orders = where(t.orders.alias("o"), P.in_query("o.o_custkey", parents))
    orders = nested.nested_list(
        orders, t.lineitem.alias("l"), _OF_ORDER, _LINE_FIELDS, "lines", _LINE_SORT, prune_child=True
    )
    fields = [("o.o_orderkey", "key"), "lines"]
    return _as_json(nested.nested_list(parents, orders, _OF_CUSTOMER, fields, "orders", ["o.o_orderkey"]), "orders")


@query("""SELECT n.n_nationkey, coalesce(k.chunk, 0) AS chunk, coalesce(to_json(k.l), '[]')::VARCHAR AS customers
          FROM nation n LEFT JOIN
            (SELECT c_nationkey, chunk, list({'key': c_custkey, 'name': c_name} ORDER BY c_acctbal, c_custkey) AS l FROM
              (SELECT *, (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal, c_custkey) - 1) // 40 AS chunk
               FROM customer WHERE c_nationkey <> 5)
             GROUP BY c_nationkey, chunk) k ON k.c_nationkey = n.n_nationkey""")
def nested_list_chunks(t: Data) -> DataFrame:
    children = where(t.customer.alias("c"), P.and_not(P.eq("c.c_nationkey", 5)))
    lists = nested_chunks(
        project(t.nation.alias("n"), "n.n_nationkey"),
        children,
        P.eq("c.c_nationkey", other("n.n_nationkey")),
        [("c.c_custkey", "key"), ("c.c_name", "name")],
        "customers",
        ["c.c_acctbal", "c.c_custkey"],
        chunk_rows=40,
        splits=32,
    )
    return _as_json(lists, "customers")
