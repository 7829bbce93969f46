"""Nested lists: the child rows of every parent row, in order, as an array of structs on that row.

The correlate is a predicate tree over child and parent columns: ``eq("d.parent_id", other("p.id"))``. Depth comes from
composition, innermost list first: a list column of the child is an ordinary field of the outer list.

Plans
-----
*Equalities only*: the child is grouped by its key on its own and joined to the parent once: one shuffle per side.
*Anything else*: the distinct values the correlate reads from the parent are joined to the child, the pairs are grouped
by those values, and the lists are joined back. Where inequalities link and most of what a value's range reaches matches it,
values filter their range's children instead, and no pair is a row (see ``reach``). How they meet follows from the tree's links, those in raw text included
(see ``pairs``): equalities are hashed on, inequalities meet by ranges, and no branch of an Or is a nested loop.

Size
----
An array is one value in one row, and a list is returned whole whatever its length. Where one parent has a large share of
the children, ``ranges`` sorts its items in many tasks and only puts sorted pieces together in one. ``nested_chunks`` gives
lists that are too large for a row: consecutive pieces of bounded size, one row each.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.columns import all_of, any_of, fresh
from ..functions.links import in_lambda
from ..functions.predicates import (
    AND,
    AND_NOT,
    COMPARISONS,
    OR,
    OR_NOT,
    ColumnRef,
    Group,
    Node,
    Term,
    as_group,
    condition,
    split_at_or,
)
from .ranges import MOST_SPLITS, SortKey, default_splits, range_bucket, sort_keys, split_points
from .pairs import pair_join
from .reach import reach_of
from .relational import resolves

CHUNK_ROWS = 10_000
BLOCK_ROWS = 16_384
MOST_IN_RANGE = 1 << 24
#: A hash table whose key is a whole number holds no row of 256 MB, with a decimal it does.
RANGE_TYPE = "decimal(9,0)"
_MIRRORED = {"=": "=", ">": "<", ">=": "<=", "<": ">", "<=": ">="}

Fields = Sequence[str | tuple[str, str] | Column]
Keys = Sequence[str | tuple[str, bool] | SortKey]


@dataclass(frozen=True)
class _Items:
    """What is carried per child row: flat columns, each once, whether they are element fields, sort keys or both."""

    columns: tuple[Column, ...]
    names: tuple[str, ...]
    fields: tuple[str, ...]
    element: Column
    order: tuple[SortKey, ...]


def _items(child: DataFrame, fields: Fields, sort: Sequence[SortKey]) -> _Items:
    """A field is called by its alias, else by what follows the last dot."""
    if not fields:
        raise ValueError("a nested list needs explicit fields; their aliases name the element's fields")
    made = [F.col(f[0]).alias(f[1]) if isinstance(f, tuple) else F.col(f) if isinstance(f, str) else f for f in fields]
    names = child.select(*made).columns
    for name in names:
        if "'" in name or '"' in name:
            raise ValueError(f"field name {name} contains quotes")
    if len(set(n.lower() for n in names)) != len(names):
        raise ValueError(f"element fields {names} are not distinct")
    carried = [f"_f{i}" for i in range(len(names))]
    columns = [column.alias(c) for column, c in zip(made, carried)]
    element = F.struct(*[F.col(c).alias(name) for c, name in zip(carried, names)])
    place = {f[0] if isinstance(f, tuple) else f: c for f, c in zip(fields, carried) if not isinstance(f, Column)}
    order = []
    for i, key in enumerate(sort):
        if key.name not in place:
            place[key.name] = f"_s{i}"
            columns.append(F.col(key.name).alias(f"_s{i}"))
            carried.append(f"_s{i}")
        order.append(SortKey(place[key.name], key.ascending))
    return _Items(tuple(columns), tuple(carried), tuple(names), element, tuple(order))


def _oriented(tree: Group, child: DataFrame, parent: DataFrame) -> Group:
    """Every column-to-column term with the child's column on the left."""
    terms = []
    for term in tree.terms:
        if term.relation == "raw":
            terms.append(term)
            continue
        if term.relation not in COMPARISONS:
            raise ValueError(f"a correlate compares columns with = > >= < <= or is raw text; {term.relation!r} is neither")
        if not isinstance(term.value, ColumnRef):
            raise ValueError("the right-hand side of a correlate term is a column: other(name)")
        if not resolves(child, term.column) and resolves(child, term.value.name):
            term = Term(_MIRRORED[term.relation], term.value.name, ColumnRef(term.column), term.link)
        terms.append(term)
    return Group(tuple(terms), tuple(_oriented(g, child, parent) for g in tree.groups), tree.link)


def _correlate(nodes: Node | Sequence[Node], child: DataFrame, parent: DataFrame) -> Group:
    nodes = [nodes] if isinstance(nodes, (Term, Group)) else list(nodes)
    tree = as_group(nodes) if nodes else Group()
    if not tree.terms and not tree.groups:
        raise ValueError("a nested list needs a correlate")
    return _oriented(tree, child, parent)


def _equalities(tree: Group) -> list[tuple[str, str]] | None:
    """(child column, parent column) pairs when the tree is a plain conjunction of equalities, else None."""
    plain = not tree.groups and all(t.relation == "=" and not t.negated for t in tree.terms)
    if not plain or any(t.link != AND for t in tree.terms[1:]):
        return None
    return [(t.column, t.value.name) for t in tree.terms]


def _parent_columns(tree: Group) -> tuple[list[str], bool]:
    """Parent columns named by the terms, and whether raw text may read others."""
    names, has_raw = [t.value.name for t in tree.terms if t.relation != "raw"], any(t.relation == "raw" for t in tree.terms)
    for inner in tree.groups:
        more, more_raw = _parent_columns(inner)
        names, has_raw = names + more, has_raw or more_raw
    return list(dict.fromkeys(names)), has_raw


def _branches(tree: Group, frames: Sequence[DataFrame]) -> list[Column]:
    """The tree as conditions of which at least one must hold, split at its Or links."""
    items: list[tuple[bool, Column, Group | None]] = []
    for i, term in enumerate(tree.terms):
        alone = Term(term.relation, term.column, term.value, AND_NOT if term.negated else AND)
        items.append((i > 0 and term.link in (OR, OR_NOT), condition(frames, alone), None))
    for inner in tree.groups:
        first = not items
        negate = not first and tree.link in (AND_NOT, OR_NOT)
        cond = condition(frames, inner)
        items.append((not first and tree.link in (OR, OR_NOT), ~cond if negate else cond, None if negate else inner))
    branches = []
    for run in split_at_or([(starts, (cond, inner)) for starts, cond, inner in items]):
        if len(run) == 1 and run[0][1] is not None:
            branches += _branches(run[0][1], frames)
        else:
            branches.append(all_of([cond for cond, _ in run]))
    return branches


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def _falling(value: Column, dtype: T.DataType) -> Column | None:
    """A value that sorts ascending as this one does descending, nulls last; None for a type that has none."""
    if isinstance(dtype, T.IntegralType):
        turned = F.bitwise_not(value)
    elif isinstance(dtype, T.DecimalType):
        turned = -value
    elif isinstance(dtype, (T.FloatType, T.DoubleType)):
        turned = F.struct(~F.isnan(value), -value)  # not-a-number is the largest
    elif isinstance(dtype, T.BooleanType):
        turned = ~value
    elif isinstance(dtype, T.DateType):
        turned = -F.unix_date(value)
    elif isinstance(dtype, T.TimestampType):
        turned = F.bitwise_not(F.unix_micros(value))
    elif isinstance(dtype, T.TimestampNTZType):
        turned = F.bitwise_not(F.unix_micros(F.to_timestamp_ltz(value)))
    elif type(dtype) in (T.StringType, T.BinaryType) and getattr(dtype, "collation", "UTF8_BINARY") in (None, "UTF8_BINARY"):
        # bytes in reverse order, and an end that comes after any byte, so that a longer text comes before its beginning
        turned = F.concat(F.translate(F.hex(value), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))
    else:
        return None
    return F.struct(value.isNull(), turned)


def _rising(df: DataFrame, order: Sequence[SortKey]) -> list[Column] | None:
    """Columns that, compared ascending one after the other, give the order of keys of mixed directions, where there are."""
    made = []
    for key in order:
        made.append(F.col(key.name) if key.ascending else _falling(F.col(key.name), df.schema[key.name].dataType))
    return None if any(m is None for m in made) else made


def _sorted_values(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], value: Column, ascending: bool) -> DataFrame:
    """One list ``_list`` per key: values by their order columns, which come first in what is compared."""
    pairs = rows.select(*keys, F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)]).alias("_o"), value.alias("_v"))
    gathered = F.collect_list(F.struct("_o", "_v"))
    if _orderable(pairs.schema["_v"].dataType):
        return pairs.groupBy(*keys).agg(F.sort_array(gathered, ascending)["_v"].alias("_list"))
    less, more = (-1, 1) if ascending else (1, -1)
    by_order = lambda x, y: F.when(x["_o"] < y["_o"], less).when(x["_o"] > y["_o"], more).otherwise(0)
    return pairs.groupBy(*keys).agg(F.array_sort(gathered, by_order)["_v"].alias("_list"))


def _joined_pieces(lists: DataFrame, keys: Sequence[str]) -> DataFrame:
    pieces = _sorted_values(lists, keys, [F.col("_range")], F.col("_list"), True)
    return pieces.select(*keys, F.flatten("_list").alias("_list"))


def _ordered(rows: DataFrame, by: Sequence[str], items: _Items, value: Column) -> DataFrame:
    """One list ``_list`` per key: values, which begin with the element's fields, in the items' order."""
    if not items.order:
        return rows.groupBy(*by).agg(F.collect_list(value).alias("_list"))
    directions = {k.ascending for k in items.order}
    leading = [f"_f{i}" for i in range(len(items.order))]
    if len(directions) == 1 and [k.name for k in items.order] == leading and _orderable(rows.select(value).schema):
        # the values, compared field by field, are in this order themselves
        return rows.groupBy(*by).agg(F.sort_array(F.collect_list(value), directions.pop()).alias("_list"))
    if len(directions) == 1:
        order, ascending = [F.col(k.name) for k in items.order], directions.pop()
    elif (rising := _rising(rows, items.order)) is not None:
        order, ascending = rising, True
    else:
        number = F.row_number().over(Window.partitionBy(*by).orderBy(*[k.order for k in items.order]))
        rows, order, ascending = rows.withColumn("_n", number), [F.col("_n")], True
    return _sorted_values(rows, by, order, value, ascending)


def _collected(rows: DataFrame, keys: Sequence[str], items: _Items, alias: str, ranges: int | None) -> DataFrame:
    """Rows grouped into one ordered list per key, in one shuffle on the key.

    Sort keys are compared where the list is made, those that fall by values in reverse order; rows are numbered first only
    where the directions are mixed and a falling key's type (a struct, say) has no reverse. With
    ``ranges``, lists are made for each (key, range of the sort keys) and the sorted pieces are joined, in order.
    """
    if not items.order:
        ranges = None
    by = list(keys)
    if ranges:
        rows, by = rows.withColumn("_range", range_bucket(split_points(rows, items.order, ranges))), [*keys, "_range"]
    lists = _ordered(rows, by, items, items.element)
    return (_joined_pieces(lists, keys) if ranges else lists).withColumnRenamed("_list", alias)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _listed_in_ranges(
    parent: DataFrame, columns: Sequence[Column], child: DataFrame, on: Column, items: _Items, alias: str, as_json: bool
) -> DataFrame | None:
    """The parents with their lists, each made in the task that its parents are in, out of what their range reaches.

    A range's children are put in order once, in blocks, and every different value filters them: there is no row for each pair,
    and neither lists nor pairs are shuffled or sorted. None where the condition doesn't allow it, or it would not pay.
    """
    keys = [fresh("key") for _ in columns]
    parent = parent.withColumns(dict(zip(keys, columns)))
    values = parent.select(*columns, *keys).distinct()
    if not all(_orderable(values.schema[k].dataType) for k in keys):
        return None
    inside = in_lambda(values, child, on)
    if inside is None or not keys or alias.lower() in [c.lower() for c in parent.columns]:
        return None
    row, reads, condition_text = inside
    if {n.lower() for n in reads} & {"_e", *items.names}:
        return None
    reach = reach_of(values, keys, child, on)
    if reach is None or reach.count > MOST_IN_RANGE:
        return None

    group, block, number, piece, pieces, least = (fresh(n) for n in ("group", "block", "number", "piece", "pieces", "least"))
    near = reach.near
    count = -(-reach.count // BLOCK_ROWS) if items.order else 1
    cut = split_points(near, items.order, min(MOST_SPLITS, count), count=reach.count) if count > 1 else None
    rows = reach.reached(near.withColumn(block, range_bucket(cut) if cut else F.lit(0)), group)
    needed = [F.col(f"{_quoted(row)}.{_quoted(name)}").alias(name) for name in reads]
    rows = rows.select(F.col(group).cast(RANGE_TYPE).alias(group), block, *items.names, *needed).repartition(reach.parts, group)
    value = F.struct(*[F.col(f"_f{i}") for i in range(len(items.fields))], *[F.col(_quoted(name)) for name in reads])
    blocks = _ordered(rows, [group, block], items, value)

    def element(value: Column) -> Column:
        made = F.struct(*[value[f"_f{i}"].alias(name) for i, name in enumerate(items.fields)])
        return to_json_list(made) if as_json else made

    # written here, once for a range, not once for each value that it matches
    held = fresh("held")
    written = F.transform("_list", lambda v: F.struct(element(v).alias("_e"), *[v[name].alias(name) for name in reads]))
    blocks = blocks.select(group, block, written.alias(held))

    # parents with the same values stand together, and the first of them is held against the blocks. What follows keeps their
    # order, so that nothing but the parents themselves is sorted
    parent = reach.placed(parent)
    parent = parent.withColumn(reach.range, F.col(reach.range).cast(RANGE_TYPE)).repartition(reach.parts, reach.range)
    alike = Window.partitionBy(reach.range, reach.hash, *keys)
    parent = parent.withColumn(number, F.row_number().over(alike.orderBy(reach.hash)))
    met = parent.join(blocks.hint("shuffle_hash"), (F.col(reach.range) == F.col(group)) & (F.col(number) == 1), "left")
    passing = F.transform(F.expr(f"filter({held}, {_quoted(row)} -> {condition_text})"), lambda v: v["_e"])
    met = met.withColumn(piece, F.concat_ws(",", passing) if as_json else passing).drop(held, group)
    some = F.col(piece) != "" if as_json else F.size(piece) > 0
    each = F.collect_list(F.when(some, F.struct(F.col(block).alias("b"), F.col(piece).alias("p"))))
    met = met.withColumns({pieces: each.over(alike), least: F.min(block).over(alike)})
    met = met.where(F.col(block).isNull() | (F.col(block) == F.col(least)))
    in_order = F.array_sort(pieces, lambda x, y: x["b"] - y["b"])["p"]
    whole = F.concat(F.lit("["), F.concat_ws(",", in_order), F.lit("]")) if as_json else F.flatten(in_order)
    return met.withColumn(alias, whole).drop(reach.range, reach.hash, number, piece, pieces, block, least, *keys)


def _or_empty(df: DataFrame, alias: str) -> DataFrame:
    kind = df.schema[alias].dataType
    return df.withColumn(alias, F.coalesce(F.col(alias), F.lit("[]") if isinstance(kind, T.StringType) else F.array().cast(kind)))


def nested_list(
    parent: DataFrame,
    child: DataFrame,
    correlate: Node | Sequence[Node],
    fields: Fields,
    alias: str,
    sort: Keys = (),
    *,
    reads: Sequence[str] | None = None,
    prune_child: bool = False,
    ranges: int | None = None,
    as_json: bool = False,
) -> DataFrame:
    """The parent rows plus the array column ``alias``; ``[]``, never null, where no child matches.

    ``child`` is any frame: filter, join or group it first (for one list of groups per parent, group by the correlate
    column and the group keys). ``reads`` names the parent columns raw correlate text uses; without it all parent
    columns count. ``prune_child`` drops children of absent parents before they are shuffled: worth it when the parents
    are a page or a narrow filter. ``ranges`` is for a parent with a large share of the children: with sort keys, its
    items are sorted in so many tasks; split points for that are sampled by a job when the frame is built. ``as_json``
    gives the lists as ``to_json_list`` does; what is written as text is written once however many parents have it.
    """
    if not alias or not alias.strip():
        raise ValueError("a nested list needs an alias")
    alias = alias.strip()
    tree, sort = _correlate(correlate, child, parent), sort_keys(sort)
    items, pairs = _items(child, fields, sort), _equalities(tree)
    if pairs is not None:
        keys = [fresh("key") for _ in pairs]
        rows = child.select(*[F.col(c).alias(k) for (c, _), k in zip(pairs, keys)], *items.columns)
        rows = rows.where(all_of([F.col(k).isNotNull() for k in keys]))
        if prune_child:
            wanted = [fresh("key") for _ in pairs]
            present = parent.select(*[F.col(p).alias(w) for (_, p), w in zip(pairs, wanted)]).distinct()
            matches = all_of([F.col(k) == F.col(w) for k, w in zip(keys, wanted)])
            rows = rows.join(present, matches, "left_semi")
        lists = _collected(rows, keys, items, alias, ranges)
        match = all_of([F.col(p) == F.col(k) for (_, p), k in zip(pairs, keys)])
    else:
        names, has_raw = _parent_columns(tree)
        names = list(dict.fromkeys([*names, *(reads or ())]))
        whole_row = has_raw and reads is None
        columns = [F.col(f"`{c}`") for c in parent.columns] if whole_row else [F.col(n) for n in names]
        keys = [fresh("key") for _ in columns]
        values = parent.select(*columns, *[c.alias(k) for c, k in zip(columns, keys)]).distinct()
        # what the list needs is named before the join, where parent and child columns may be called alike
        named = child.select("*", *items.columns)
        on = any_of(_branches(tree, (child, values)))
        if not ranges and (listed := _listed_in_ranges(parent, columns, named, on, items, alias, as_json)) is not None:
            return listed
        joined = pair_join(values, named, on)
        lists = _collected(joined.select(*keys, *items.names), keys, items, alias, ranges)
        match = all_of([c.eqNullSafe(F.col(k)) for c, k in zip(columns, keys)])
    if as_json:
        lists = lists.withColumn(alias, to_json_list(alias))
    return _or_empty(parent.join(lists, match, "left").drop(*keys), alias)


def nested_chunks(
    parent: DataFrame,
    child: DataFrame,
    correlate: Node | Sequence[Node],
    fields: Fields,
    alias: str,
    sort: Keys,
    *,
    chunk_rows: int = CHUNK_ROWS,
    splits: int | None = None,
) -> DataFrame:
    """The parent rows, once per piece of their list: ``chunk`` (from 0) and ``alias`` with up to ``chunk_rows`` items.

    Pieces in ``chunk`` order put together are exactly the list of :func:`nested_list`; a childless parent has one empty
    piece. The correlate is one or more equalities, and the sort keys should order the children totally.

    ``splits`` is the number of ranges, by default the session's shuffle partitions. No task ever holds one parent's
    rows: they are numbered inside (key, range of the sort key) groups, whose sizes are counted map-side and summed up to
    offsets, and are then regrouped by (key, chunk). The parent row is repeated per chunk before the join, so that join
    is even too.
    """
    if chunk_rows < 1:
        raise ValueError(f"a chunk holds at least one row, not {chunk_rows}")
    tree, sort = _correlate(correlate, child, parent), sort_keys(sort)
    pairs = _equalities(tree)
    if pairs is None:
        raise ValueError("nested_chunks needs a correlate made of equalities")
    if not sort:
        raise ValueError("nested_chunks needs sort keys")
    alias = alias.strip()
    keys = [fresh("key") for _ in pairs]
    items = _items(child, fields, sort)
    rows = child.select(*[F.col(c).alias(k) for (c, _), k in zip(pairs, keys)], *items.columns)
    rows = rows.where(all_of([F.col(k).isNotNull() for k in keys]))
    rows = rows.withColumn("_range", range_bucket(split_points(rows, items.order, splits or default_splits(rows))))

    sizes = rows.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_n"))
    per_key = Window.partitionBy(*keys).orderBy("_range")
    offsets = sizes.select(
        *[F.col(k).alias(f"{k}_o") for k in keys],
        F.col("_range").alias("_range_o"),
        (F.sum("_n").over(per_key) - F.col("_n")).alias("_offset"),
    )
    same_range = [F.col(k) == F.col(f"{k}_o") for k in keys] + [F.col("_range") == F.col("_range_o")]
    local = F.row_number().over(Window.partitionBy(*keys, "_range").orderBy(*[k.order for k in items.order]))
    numbered = rows.withColumn("_local", local).join(offsets, all_of(same_range))
    position = F.col("_offset") + F.col("_local") - 1
    pieces = (
        numbered.select(
            *keys,
            F.floor(position / chunk_rows).cast("long").alias("_piece"),
            F.struct(position.alias("n"), items.element.alias("v")).alias("_item"),
        )
        .groupBy(*keys, "_piece")
        .agg(F.sort_array(F.collect_list("_item"))["v"].alias(alias))
    )

    totals = sizes.groupBy(*[F.col(k).alias(f"{k}_t") for k in keys]).agg(F.sum("_n").alias("_total"))
    of_parent = all_of([F.col(p) == F.col(f"{k}_t") for (_, p), k in zip(pairs, keys)])
    last = F.floor((F.coalesce(F.col("_total"), F.lit(1)) - 1) / chunk_rows).cast("long")
    heads = (
        parent.join(totals, of_parent, "left")
        .withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), last)))
        .drop("_total", *[f"{k}_t" for k in keys])
    )
    match = [F.col(p) == F.col(k) for (_, p), k in zip(pairs, keys)] + [F.col("chunk") == F.col("_piece")]
    whole = heads.join(pieces, all_of(match), "left").drop("_piece", *keys)
    return _or_empty(whole, alias)


def to_json_list(column: str | Column) -> Column:
    """A list as compact JSON array text; null fields are kept, an empty list is ``[]``."""
    return F.to_json(F.col(column) if isinstance(column, str) else column, {"ignoreNullFields": "false"})
