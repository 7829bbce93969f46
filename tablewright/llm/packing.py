"""Best-fit packing with several sequence lengths: which length to open is chosen by cost, and bins shrink at the end.

Items are dealt at random by a hash of their id and packed in blocks of bounded size, each on its own: a bin never mixes
blocks, which wastes at most a bin's space for each length and block. Only ids and lengths are shuffled, never texts.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from .shared import WORD

CAPACITIES = (512, 1024, 2048, 4096, 8192)


def sequence_cost(capacity: int) -> float:
    """What a sequence costs: its tokens, attention between them, and a fixed part."""
    return capacity + capacity * capacity / 16384 + 32


def best_fit(lengths: list[int], capacities: tuple[int, ...] = CAPACITIES, cost=sequence_cost) -> list[tuple[int, int, int]]:
    """(bin, offset in it, its final capacity) for each length, none beyond the largest capacity.

    The longest item comes first. It goes where it leaves the least space. Where it fits nowhere, a bin is opened of the
    length that costs least for each token it can still be filled with: itself and the items not yet placed. At the end each bin
    gets the smallest length that holds its contents.
    """
    capacities = tuple(sorted(capacities))
    free: list[tuple[int, int]] = []  # (space, bin), ordered
    used: list[int] = []
    places: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    left = sum(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        size = lengths[i]
        at = bisect_left(free, (size, -1))
        if at < len(free):
            space, number = free.pop(at)
        else:
            space = min((c for c in capacities if c >= size), key=lambda c: (cost(c) / min(c, left), c))
            number = len(used)
            used.append(0)
        places[i] = (number, used[number])
        used[number] += size
        left -= size
        if space > size:
            insort(free, (space - size, number))
    final = [next(c for c in capacities if c >= u) for u in used]
    return [(number, offset, final[number]) for number, offset in places]


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sequences(packed: DataFrame, encoded: DataFrame, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """bin_id, capacity, ids, starts: the token sequences that ``pack`` has laid out, from the ids of each document.

    ``packed`` must be of the same ids' lengths, and ids of documents must be unique. ``starts`` has where each document's piece
    begins in the sequence; from its last token to the capacity a sequence is free. A bin is never larger than its
    capacity, so no group is unbounded. Documents without tokens are in no sequence.
    """
    of = encoded.select(F.col(id_column).cast("long").alias("doc_id"), F.col(ids_column).alias("ids"))
    pieces = packed.where("bin_id IS NOT NULL").join(of, "doc_id")
    own = F.slice("ids", (F.col("start") + 1).cast("int"), F.col("n_tokens").cast("int"))
    both = pieces.groupBy("bin_id").agg(F.first("capacity").alias("capacity"), F.sort_array(F.collect_list(F.struct("position", own.alias("ids")))).alias("all"))
    return both.select("bin_id", "capacity", F.flatten("all.ids").alias("ids"), F.col("all.position").alias("starts"))


def pack(
    documents: DataFrame,
    id_column: str = "doc_id",
    length: Column | None = None,
    capacities: tuple[int, ...] = CAPACITIES,
    block: int = 16384,
) -> DataFrame:
    """doc_id, piece, start, n_tokens, bin_id, position, capacity: where each piece of each document lies.

    ``length`` counts a document's tokens, by default the words of ``text``. A document longer than the largest capacity is
    cut into pieces of that capacity and a rest; ``start`` is the piece's first token. ``position`` is the piece's place in
    its bin.

    Defined cases: a document without tokens (null length, null or empty text) takes no place and has one row with no
    bin. Rows that repeat an id are packed each by itself; a null id stays null. Which items share a block depends on how
    Spark splits the table. Extra columns are not read. An empty table gives no rows.
    """
    most = max(capacities)
    count = word_count(F.col("text")) if length is None else F.coalesce(length, F.lit(0)).cast("long")
    items = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.greatest(count, F.lit(0).cast("long")).alias("total"))
    last = F.greatest(F.ceil(F.col("total") / most), F.lit(1)) - 1
    items = items.select("doc_id", "total", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece"))
    start = F.col("piece") * most
    items = items.select("doc_id", F.col("piece").cast("int").alias("piece"), start.alias("start"), F.least(F.col("total") - start, F.lit(most)).alias("n_tokens"))
    schema = pa.schema(
        [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("bin_id", pa.int64()), ("position", pa.int64()), ("capacity", pa.int64())]
    )

    def run(batches):
        number, held, size = TaskContext.get().partitionId() << 40, [], 0

        def packed(number):
            table = pa.Table.from_batches(held).combine_chunks()
            for begin in range(0, table.num_rows, block):
                part = table.slice(begin, block)
                lengths = part.column("n_tokens").to_pylist()
                filled = [i for i, n in enumerate(lengths) if n]
                places = dict(zip(filled, best_fit([lengths[i] for i in filled], capacities)))
                rows = [places.get(i) for i in range(len(lengths))]
                bins = [None if r is None else number + r[0] for r in rows]
                columns = [bins, [r and r[1] for r in rows], [r and r[2] for r in rows]]
                number += 1 + max((r[0] for r in rows if r), default=-1)
                arrays = [*(c.combine_chunks() for c in part.columns), *(pa.array(c, pa.int64()) for c in columns)]
                yield number, pa.RecordBatch.from_arrays(arrays, schema=schema)

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= block:
                for number, made in packed(number):
                    yield made
                held, size = [], 0
        if size:
            for number, made in packed(number):
                yield made

    # a second value keeps the pieces of one long document, and rows of one id, apart
    spread = F.xxhash64("doc_id", "piece", F.spark_partition_id())
    dealt = items.withColumn("spread", spread).repartition("spread").sortWithinPartitions("spread", "doc_id", "piece").drop("spread")
    kinds = "doc_id long, piece int, start long, n_tokens long, bin_id long, position long, capacity long"
    return dealt.mapInArrow(run, kinds)
