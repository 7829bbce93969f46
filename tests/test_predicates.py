from __future__ import annotations

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from fixtures import NULL_ROWS, canvas, ids, nulls, precedence
from tablewright.functions import predicates as P
from tablewright.functions.predicates import Group, Term, and_, and_not, condition, group, or_, or_not, where


@pytest.fixture(scope="module")
def board(spark):
    return canvas(spark).cache()


@pytest.mark.parametrize(
    "term, rows",
    [
        (P.eq("id", "uuid-32"), 1),
        (and_not(P.eq("id", "uuid-32")), 999),
        (P.gt("id", "uuid-32"), 753),
        (and_not(P.gt("id", "uuid-32")), 247),
        (P.ge("id", "uuid-32"), 754),
        (and_not(P.ge("id", "uuid-32")), 246),
        (P.lt("id", "uuid-32"), 246),
        (and_not(P.lt("id", "uuid-32")), 754),
        (P.le("id", "uuid-32"), 247),
        (and_not(P.le("id", "uuid-32")), 753),
        (P.in_list("id", ["uuid-13", "uuid-336"]), 2),
        (and_not(P.in_list("id", ["uuid-13", "uuid-336"])), 998),
        (P.is_null("id"), 0),
        (and_not(P.is_null("id")), 1000),
        (P.starts_with("id", "uuid-1"), 111),
        (P.starts_with("id", "UUID-1"), 111),
        (P.starts_with("id", "UUID-1", case_sensitive=True), 0),
        (and_not(P.starts_with("id", "uuid-1")), 889),
        (P.ends_with("id", "1"), 100),
        (and_not(P.ends_with("id", "1")), 900),
        (P.contains("id", "d-1"), 111),
        (and_not(P.contains("id", "d-1")), 889),
        (P.contains("id", "d-_1"), 110 - 10),
        (P.raw("ordering > ? and id <> '?'", 31989), 10),
        (P.in_list("id", []), 0),
        (and_not(P.in_list("id", [])), 1000),
        (P.eq("ordering", "31005"), 1),
        (P.in_list("ordering", ["31001", 31002, 31003.0]), 3),
    ],
)
def test_one_relation(board, term, rows):
    if term.value == "d-_1":
        rows = sum(1 for i in range(1000) if len(str(i)) >= 2 and str(i)[1] == "1")
    assert where(board, term).count() == rows


def test_sub_selects(board):
    found = where(board, P.eq("id", "uuid-32")).select("id")
    assert where(board, P.in_query("id", found)).count() == 1
    assert where(board, and_not(P.in_query("id", found))).count() == 999
    assert where(board, P.exists(found)).count() == 1000
    assert where(board, and_not(P.exists(found))).count() == 0
    assert where(board, P.eq("id", "uuid-1"), or_(P.exists(found.where("false")))).count() == 1
    assert where(board, P.eq("id", "uuid-1"), or_not(P.exists(found.where("false")))).count() == 1000


@pytest.mark.parametrize("other_term", [None, P.eq("id", 7)])
@pytest.mark.parametrize("listed", [[1, 2], [1, None], [], [None]])
@pytest.mark.parametrize("negate", [False, True])
def test_in_query_is_null_aware_alone_and_under_or(spark, other_term, listed, negate):
    df = nulls(spark)
    sub = spark.createDataFrame([(v,) for v in listed], "k int")
    term = P.in_query("a", sub)
    chain = [and_not(term) if negate else term] if other_term is None else [other_term, (or_not if negate else or_)(term)]
    connection = duckdb.connect()
    connection.execute("CREATE TABLE t (id INT, a INT, b VARCHAR, f BOOLEAN); CREATE TABLE s (k INT)")
    connection.executemany("INSERT INTO t VALUES (?, ?, ?, ?)", NULL_ROWS)
    for v in listed:
        connection.execute("INSERT INTO s VALUES (?)", [v])
    text = f"a {'NOT ' if negate else ''}IN (SELECT k FROM s)"
    text = text if other_term is None else f"id = 7 OR {text}"
    assert ids(where(df, *chain)) == sorted(r[0] for r in connection.execute(f"SELECT id FROM t WHERE {text}").fetchall())


def test_exists_by_pairs_and_by_text_under_or(spark):
    df = nulls(spark).alias("n")
    sub = spark.createDataFrame([(1,), (5,), (None,)], "k int").alias("s")
    assert ids(where(df, P.exists(sub, [("n.a", "k")]))) == [1, 4]
    assert ids(where(df, and_not(P.exists(sub, [("n.a", "k")])))) == [2, 3, 5, 6, 7]
    assert ids(where(df, P.eq("n.id", 7), or_(P.exists(sub, "s.k = n.a")))) == [1, 4, 7]
    assert ids(where(df, P.eq("n.id", 7), or_not(P.exists(sub, "s.k = n.a")))) == [2, 3, 5, 6, 7]
    assert ids(where(df, P.eq("n.id", 7), or_not(P.exists(sub, [("n.a", "k")])))) == [2, 3, 5, 6, 7]


def test_sub_select_inside_negated_groups(spark):
    df, sub = nulls(spark), spark.createDataFrame([(1,), (2,)], "k int")
    either, both = group(P.in_query("a", sub), or_(P.is_true("f"))), group(P.in_query("a", sub), and_(P.is_true("f")))
    assert ids(where(df, group(P.gt("id", 0), either, link=P.AND_NOT))) == []
    assert ids(where(df, group(P.gt("id", 0), both, link=P.AND_NOT))) == [2, 4, 6, 7]
    assert ids(where(df, group(P.in_query("a", sub), group(P.is_true("f")), link=P.AND_NOT))) == [2]
    # the first group is linked plainly when no term stands before it
    assert ids(where(df, group(both, group(P.eq("id", 2)), link=P.AND_NOT))) == [1]


def test_not_in_never_broadcasts_an_unbounded_list(spark, board):
    sub = board.select("id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for chain in ([and_not(P.in_query("id", sub))], [P.eq("id", "x"), or_not(P.in_query("id", sub))]):
            plan = where(board, *chain)._jdf.queryExecution().executedPlan().toString()
            assert "Broadcast" not in plan and "SortMergeJoin" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_precedence_and_first_link(spark):
    df = precedence(spark)
    x, y, z = P.is_true("x"), P.is_true("y"), P.is_true("z")
    assert ids(where(df, x, or_(y), and_(z))) == ids(df.where("x or (y and z)"))
    assert ids(where(df, or_(x), and_not(y), or_not(z))) == ids(df.where("(x and not y) or not z"))
    assert ids(where(df, or_not(x), and_(y))) == ids(df.where("not x and y"))
    assert ids(where(df, group(group(y), x, group(z), link=P.OR))) == ids(df.where("x or y or z"))
    assert ids(where(df, group(group(x, or_(y)), group(z), link=P.AND_NOT))) == ids(df.where("(x or y) and not z"))
    assert ids(where(df, group(group(x, link=P.OR_NOT), group(z), link=P.AND))) == ids(df.where("x and z"))


def test_like_characters(spark):
    df = nulls(spark)
    assert ids(where(df, P.starts_with("b", "a\\"))) == [5]
    assert ids(where(df, P.ends_with("b", "\\b"))) == [5]
    assert ids(where(df, P.starts_with("b", "red"))) == [1, 2]
    assert ids(where(df, P.contains("b", "%"))) == [1, 2, 3, 5, 7]
    assert ids(where(df, and_not(P.starts_with("b", "red")))) == [3, 5, 7]


def test_null_literals(spark):
    df = nulls(spark)
    assert ids(where(df, P.eq("a", None))) == [3, 6]
    assert ids(where(df, and_not(P.eq("a", None)))) == [1, 2, 4, 5, 7]
    for make in (P.gt, P.ge, P.lt, P.le):
        with pytest.raises(ValueError):
            where(df, make("a", None))


@pytest.mark.parametrize(
    "make",
    [
        lambda: Term("like", "a", 1),
        lambda: Term("=", "a", 1, link="xor"),
        lambda: Group(link="nand"),
        lambda: P.in_list("a", "text"),
        lambda: P.in_list("a", 5),
    ],
)
def test_refused_when_built(make):
    with pytest.raises(ValueError):
        make()


@pytest.mark.parametrize(
    "term",
    [
        and_not(P.raw("a > 1")),
        or_not(P.raw("a > 1")),
        P.eq("a", "abc"),
        P.in_list("a", [object()]),
        P.raw("a > ?"),
        P.raw("a > ? and b = ?", 1),
        P.raw("a > 1", 5),
        P.starts_with("b", None),
    ],
)
def test_refused_when_used(spark, term):
    if term.relation == "raw" and term.column == "a > ?":
        term = P.raw("a > ? and a < ?", 1)
    with pytest.raises(ValueError):
        where(nulls(spark), term)


def test_in_query_needs_one_column(spark):
    with pytest.raises(ValueError):
        P.in_query("a", nulls(spark))


# ---------------------------------------------------------------- random trees against another engine

_LEAVES = st.sampled_from(
    [
        (P.eq("a", 2), "a = 2"),
        (P.gt("a", 1), "a > 1"),
        (P.le("a", 5), "a <= 5"),
        (P.is_null("b"), "b IS NULL"),
        (P.is_true("f"), "f = true"),
        (P.in_list("a", [1, 7]), "a IN (1, 7)"),
        (P.starts_with("b", "re"), "b ILIKE 're%'"),
        (P.contains("b", "D_"), "b ILIKE '%D_%'"),
        (P.eq("a", None), "a IS NULL"),
    ]
)
_LINKS = st.sampled_from([P.AND, P.OR, P.AND_NOT, P.OR_NOT])


def _print(tree: Group, texts: dict) -> str:
    parts = []
    for term in tree.terms:
        text = texts[(term.relation, term.column, str(term.value))]
        # "column is false" is the negation of "is true"; both fail for null, like NOT (f = true)
        text = f"NOT ({text})" if term.negated else f"({text})"
        parts.append((" OR " if term.link in (P.OR, P.OR_NOT) else " AND ", text))
    for inner in tree.groups:
        negate = bool(parts) and tree.link in (P.AND_NOT, P.OR_NOT)
        parts.append((" OR " if tree.link in (P.OR, P.OR_NOT) else " AND ", f"{'NOT ' if negate else ''}({_print(inner, texts)})"))
    return "".join((link if i else "") + text for i, (link, text) in enumerate(parts))


@st.composite
def _trees(draw, depth: int = 2) -> tuple[Group, dict]:
    texts, terms, groups = {}, [], []
    for _ in range(draw(st.integers(0 if depth else 1, 4))):
        term, text = draw(_LEAVES)
        texts[(term.relation, term.column, str(term.value))] = text
        terms.append(Term(term.relation, term.column, term.value, draw(_LINKS), term.case_sensitive))
    for _ in range(draw(st.integers(0 if terms else 1, 2)) if depth else 0):
        inner, more = draw(_trees(depth - 1))
        texts.update(more)
        groups.append(inner)
    return Group(tuple(terms), tuple(groups), draw(_LINKS)), texts


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(trees=st.lists(_trees(), min_size=15, max_size=15))
def test_random_trees(spark, trees):
    df = nulls(spark)
    ours = df.select("id", *[condition(df, tree).alias(f"c{i}") for i, (tree, _) in enumerate(trees)]).orderBy("id").collect()
    connection = duckdb.connect()
    connection.execute("CREATE TABLE t (id INT, a INT, b VARCHAR, f BOOLEAN)")
    connection.executemany("INSERT INTO t VALUES (?, ?, ?, ?)", NULL_ROWS)
    printed = [_print(tree, texts) for tree, texts in trees]
    theirs = connection.execute(f"SELECT id, {', '.join(printed)} FROM t ORDER BY id").fetchall()
    assert [tuple(r) for r in ours] == theirs
