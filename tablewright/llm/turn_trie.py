"""The prefix trie of conversations by truncation peeling: from the deepest turn up, one depth after the other.

At each depth the conversations that end there are merged with the nodes left from below; each node then loses its last turn
and falls together with its siblings. So a node is discovered and all that is said of its subtree is summed in the
same aggregation, which combines in every task before it shuffles: a beginning that a third of all conversations share
costs no more than others. A sequence of turns is known by 128 bits, the exclusive or of its turns' hashes with
their places, so cutting off a turn changes two numbers, and no row ever holds a whole conversation.

Few conversations are very long. Where no more than ``few`` turns are left below a depth, equal conversations merged, one task
peels them all; above, each depth is one aggregation written to shared storage. The cost is one row for each turn, and
as many small jobs as there are depths that many conversations reach.
"""

from __future__ import annotations

import hashlib
import uuid
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from .shared import WORD, shared_folder, stored

#: Ids of conversations that end at a node are joined in pieces of so many consecutive numbers before they meet.
PIECE_BITS = 8
_SUMS = ["convs", "children", "leaves", "saved", "ended"]
_NODE = "a long, b long, pa long, pb long, first long, convs long, children long, leaves long, saved long, ended long"


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth from 1, role, digest, words) of a frame with conv_id, turn, role and text.

    Turns are ordered by turn (null first), then role, then the digest of the text; a null role or text is empty. Rows
    without conv_id are left out, repeated rows are turns of their own. Digests stand for texts from here on.
    """
    text = F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.md5(text.cast("binary")).alias("digest"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words")
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "digest")
    return rows.withColumn("depth", F.row_number().over(order)).drop("turn")


def shared_openings(turns: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Conversations that begin like others: c has the first h turns of c - c % every and its own after its first h.

    h is the CRC-32 of c's decimal digits modulo most. Where the other has fewer turns, all are taken; if it's absent, none.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % F.lit(most)
    turns = turns.withColumns({"h": h, "opener": F.col("conv_id") - F.col("conv_id") % every})
    first = turns.where((F.col("conv_id") == F.col("opener")) & (F.col("depth") < most))
    openings = first.select("opener", "depth", "role", "digest", "words")
    lengths = first.groupBy("opener").agg(F.count("*").alias("has"))
    own = turns.where(F.col("depth") > F.col("h")).join(lengths, "opener", "left")
    own = own.withColumn("depth", F.col("depth") - F.col("h") + F.least("h", F.coalesce("has", F.lit(0))))
    heads = turns.select("conv_id", "opener", "h").where("h > 0").distinct()
    given = heads.join(openings, "opener").where(F.col("depth") <= F.col("h"))
    columns = ["conv_id", F.col("depth").cast("int").alias("depth"), "role", "digest", "words"]
    return own.select(*columns).unionAll(given.select(*columns))


def _prefixes(turns: DataFrame) -> DataFrame:
    """Each turn with the keys (a, b) of the sequence up to it and (pa, pb) of the one before, and whether it is the last."""
    here = Window.partitionBy("conv_id").orderBy("depth")
    so_far = here.rowsBetween(Window.unboundedPreceding, 0)
    turns = turns.withColumns({"x": F.xxhash64("depth", "role", "digest"), "y": F.xxhash64("digest", "role", "depth", F.lit("y"))})
    turns = turns.withColumns({"a": F.bit_xor("x").over(so_far), "b": F.bit_xor("y").over(so_far), "last": F.lead("depth").over(here).isNull()})
    return turns.select("conv_id", "depth", "a", "b", F.col("a").bitwiseXOR(F.col("x")).alias("pa"), F.col("b").bitwiseXOR(F.col("y")).alias("pb"), "words", "last")


def _peel_few(rows: list[dict], top: int) -> list[dict]:
    """Nodes deeper than top, from their turns, and as rows of depth top what they add to the nodes there."""
    nodes: dict[int, dict[tuple[int, int], dict]] = defaultdict(dict)
    for row in rows:
        node = nodes[row["depth"]].setdefault((row["a"], row["b"]), row | dict(first=None, children=0, leaves=0, saved=0, ended=0))
        if row["ended"]:
            node["ended"] = row["ended"]
            node["first"] = row["first"]
    for level in nodes.values():
        for node in level.values():
            node["convs"] = node["ended"]
    out = []
    for depth in range(max(nodes, default=top), top, -1):
        for node in nodes[depth].values():
            node["leaves"] = node["leaves"] or 1
            node["saved"] += (node["convs"] - 1) * node["words"]
            out.append(node)
            key = (node["pa"], node["pb"])
            if depth - 1 == top and key not in nodes[top]:
                nodes[top][key] = dict(depth=top, a=key[0], b=key[1], pa=None, pb=None, first=None, convs=0, children=0, leaves=0, saved=0, ended=0)
            parent = nodes[depth - 1][key]
            parent["children"] += 1
            parent["first"] = node["first"] if parent["first"] is None else min(parent["first"], node["first"])
            for name in ("convs", "leaves", "saved"):
                parent[name] += node[name]
    return out + list(nodes[top].values())


def _ends(ended: DataFrame) -> DataFrame:
    """(a, b, ends_sha256): the digest of the comma-joined ids of the conversations that end at each node, ascending.

    One digest is one pass in order, so a node's ids go through one task, in pieces and never held together.
    """
    pieces = ended.groupBy("a", "b", F.shiftright("conv_id", PIECE_BITS).alias("piece")).agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
    pieces = pieces.select("a", "b", "piece", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("ends_sha256", pa.string())])

    def digests(batches):
        node, running = None, None
        for batch in batches:
            done = []
            for a, b, ids in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "ids"))):
                if (a, b) == node:
                    running.update(b"," + ids.encode())
                    continue
                if node is not None:
                    done.append((*node, running.hexdigest()))
                node, running = (a, b), hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done) if done else ([], [], []), schema)], schema=schema)
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((*node, running.hexdigest()), schema)], schema=schema)

    return pieces.repartition("a", "b").sortWithinPartitions("a", "b", "piece").mapInArrow(digests, "a long, b long, ends_sha256 string")


def _where_few(lengths: list[tuple[int, int]], few: int) -> int:
    """The smallest depth below which at most ``few`` turns lie, from (length, number of different conversations)."""
    deeper = turns = 0
    lengths = sorted(lengths, reverse=True)
    for (length, number), (shorter, _) in zip(lengths, [*lengths[1:], (0, 0)]):
        deeper += number
        if turns + deeper * (length - shorter) > few:
            return length - (few - turns) // deeper
        turns += deeper * (length - shorter)
    return 0


def prefix_trie(turns: DataFrame, conversations: DataFrame | None = None, few: int = 16_384) -> DataFrame:
    """A row for each distinct beginning of the conversations whose turns (conv_id, depth, role, digest, words) are given.

    A node of depth d is a sequence of the first d turns' (role, digest); its members are the conversations that begin with it.
    The root (depth 0) has all as members, also those of ``conversations`` (conv_id) without a turn. Columns: conv_id,
    its smallest member; depth; parent_conv_id, the parent's conv_id (root: null); n_convs, members; n_children; n_leaves,
    nodes without children in its subtree, itself included; saved_tokens, over its subtree the sum of (n_convs - 1) times the
    words of the last turn; ends_sha256, of the comma-joined ascending ids of the members that end here. Null ids are left out;
    without conversations there is no node.
    """
    spark = turns.sparkSession
    prefixes = stored(_prefixes(turns), "trie-turns")
    ended = prefixes.where("last").select("conv_id", "depth", "a", "b")
    if conversations is not None:
        ids = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long")).distinct()
        silent = ids.join(ended.select("conv_id"), "conv_id", "left_anti")
        ended = ended.unionAll(silent.select("conv_id", F.lit(0).alias("depth"), F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b")))
    ended = stored(ended, "trie-ends")
    merged = stored(ended.groupBy("a", "b", "depth").agg(F.min("conv_id").alias("first"), F.count("*").alias("ended")), "trie-merged")
    lengths = [(r["depth"], r["count"]) for r in merged.groupBy("depth").count().collect()]
    top = _where_few(lengths, few)

    # of equal conversations the turns of the smallest stand for all
    ends = merged.select(F.col("first").alias("conv_id"), F.col("ended"))
    turn = prefixes.join(ends, "conv_id").select("depth", "a", "b", "pa", "pb", "words", F.when(F.col("last"), F.col("ended")).otherwise(0).alias("ended"), F.when(F.col("last"), F.col("conv_id")).alias("first"))
    turn = stored(turn.sortWithinPartitions("depth"), "trie-kept")
    folder = f"{shared_folder(spark)}/tablewright/trie-nodes-{uuid.uuid4().hex}"
    schema = T.StructType.fromDDL(_NODE)
    names = schema.fieldNames()

    def kept(frame: DataFrame, depth: int) -> DataFrame:
        path = f"{folder}/depth={depth}"
        frame.select(*names).write.parquet(path)
        return spark.read.schema(schema).parquet(path)

    def peel(table: pa.Table) -> pa.Table:
        return pa.Table.from_pylist(_peel_few(table.to_pylist(), top), schema=pa.schema([(n, pa.int64()) for n in ["depth", *names]]))

    below = stored(turn.where(F.col("depth") > top).groupBy().applyInArrow(peel, f"depth long, {_NODE}"), "trie-few")
    left = below.where(F.col("depth") == top).select(*names)
    null, zero = F.lit(None).cast("long"), F.lit(0).cast("long")
    nothing = [zero.alias(n) for n in ("children", "leaves", "saved")]
    for depth in range(top, -1, -1):
        if depth:
            own = turn.where(F.col("depth") == depth).select("a", "b", "pa", "pb", "words", "first", F.col("ended").alias("convs"), *nothing, "ended")
        else:
            own = merged.where("depth = 0").select("a", "b", null.alias("pa"), null.alias("pb"), zero.alias("words"), "first", F.col("ended").alias("convs"), *nothing, "ended")
        both = own.unionByName(left.withColumn("words", null))
        nodes = both.groupBy("a", "b").agg(*(F.max(n).alias(n) for n in ("pa", "pb", "words")), F.min("first").alias("first"), *(F.sum(n).alias(n) for n in _SUMS))
        nodes = nodes.withColumns({"leaves": F.greatest("leaves", F.lit(1)), "saved": F.col("saved") + (F.col("convs") - 1) * F.coalesce("words", F.lit(0))})
        nodes = kept(nodes, depth)
        left = nodes.select(F.col("pa").alias("a"), F.col("pb").alias("b"), null.alias("pa"), null.alias("pb"), "first", "convs", F.lit(1).cast("long").alias("children"), "leaves", "saved", zero.alias("ended"))

    shallow = spark.read.schema(T.StructType.fromDDL(f"{_NODE}, depth long")).option("basePath", folder).parquet(f"{folder}/depth=*")
    nodes = shallow.unionByName(below.where(F.col("depth") > top))
    parents = nodes.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("first").alias("parent_conv_id"))
    found = nodes.join(parents, ["pa", "pb"], "left").join(_ends(ended), ["a", "b"], "left")
    return found.select(
        F.col("first").alias("conv_id"), "depth", "parent_conv_id", F.col("convs").alias("n_convs"), F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
