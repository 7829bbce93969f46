"""Exact top-k search: query tiles times vector shards as matrix products, a selection per tile, a tree of merges.

Vectors are packed into blocks where they are scanned. Each block meets each query tile once, in groups of bounded size,
and only the k best of a group go on. Scores are integer inner products of scaled, floored components, so they are exact
and ties are real ties.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .shared import partitions

_BLOCK = "deal long, dim int, n int, kind string, ids binary, data binary"
_BEST = "deal long, query_id long, query_row string, best array<struct<loss:long,vec_id:long>>"
_LONG = 2**63 - 1


def _blocks(batch: pa.RecordBatch, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix) for each length of vector in the batch: distinct rows, ordered by id, scaled and floored."""
    ids, vectors = batch.column(0), batch.column(1)
    present = pc.and_(ids.is_valid(), vectors.is_valid())
    ids, vectors = ids.filter(present), vectors.filter(present)
    if not len(ids):
        return
    lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
    values = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # missing components become NaN
    with np.errstate(over="ignore", invalid="ignore"):
        values = np.floor(values * scale)
    ends = np.cumsum(lengths)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    good = bad[ends] == bad[ends - lengths]
    keys = ids.to_numpy(zero_copy_only=False).astype(np.int64)
    for dim in np.unique(lengths[good]):
        rows = np.flatnonzero(good & (lengths == dim))
        matrix = values[(ends[rows] - dim)[:, None] + np.arange(dim)]
        order = np.lexsort((*matrix.T[::-1], keys[rows]))
        part, matrix = keys[rows][order], matrix[order] + 0.0
        new = np.ones(len(part), bool)
        new[1:] = (part[1:] != part[:-1]) | (matrix[1:] != matrix[:-1]).any(axis=1)
        yield part[new], matrix[new]


def _packed(deal: int, ids: np.ndarray, matrix: np.ndarray) -> dict:
    top = np.abs(matrix).max(initial=0)
    kind = "<i2" if top < 2**15 else "<i4" if top < 2**31 else "<f8"
    return dict(deal=deal, dim=matrix.shape[1], n=len(ids), kind=kind, ids=ids.tobytes(), data=matrix.astype(kind).tobytes())


def _unpacked(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for row in table.to_pylist():
        matrix = np.frombuffer(row["data"], row["kind"]).reshape(row["n"], row["dim"]).astype(np.float64)
        yield np.frombuffer(row["ids"], np.int64), matrix


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products; beyond a long's range they stop at its ends."""
    largest = a.shape[1] * float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0))  # may be infinite
    if largest < 2**53:
        return (a @ b.T).astype(np.int64)
    if largest < 2**62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    whole = np.vectorize(int, otypes=[object])
    return np.clip(whole(a) @ whole(b).T, -_LONG, _LONG).astype(np.int64)


def _select(query_ids: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int):
    """(query row, vector row) of the k best of each query; ids ascend, so the earlier column wins a tie."""
    loss = -scores
    own = query_ids[:, None] == ids[None, :]
    loss[own] = _LONG
    bound = np.partition(loss, k - 1, axis=1)[:, k - 1 : k] if loss.shape[1] > k else _LONG
    rows, cols = np.nonzero((loss <= bound) & ~own)
    found = loss[rows, cols]
    order = np.lexsort((cols, found, rows))
    rows, cols, found = rows[order], cols[order], found[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    return rows[place < k], cols[place < k], found[place < k]


def exact_top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: int = 256,
    tile_rows: int = 2048,
    group_rows: int = 16384,
    fan_in: int = 64,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k vectors with the highest inner product for every query vector.

    A component x counts as floor(scale * x). Both frames may have any further columns, they are not read.

    Defined cases: a vector that is null or holds a component that is null or not finite, also only after scaling, takes no
    part, nor does a row without an id. Rows with a query's id are never its results. Only vectors of a query's length are candidates. Rows that repeat
    id and vector count once; a repeated query id with another vector is a query of its own, ranked by itself. Ties go to
    the smaller id; a query with fewer than k candidates gets all of them; with none it has no row. Scores beyond a long
    stop at its ends. Empty input gives no rows.
    """
    spark = vectors.sparkSession
    vectors = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("vector"))
    queries = queries.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("vector"))
    tiles = max(1, math.ceil(queries.count() / tile_rows))
    groups = max(1, math.ceil(vectors.count() / group_rows), math.ceil(2 * partitions(spark) / tiles))

    def pack_vectors(batches):
        part = TaskContext.get().partitionId()
        for i, batch in enumerate(batches):
            # small steps keep a block's share of any group small; the deal depends on nothing but the input's order
            for start in range(0, batch.num_rows, 2048):
                for ids, matrix in _blocks(batch.slice(start, 2048), scale):
                    # a multiplier prime to most counts of groups, so that neighbouring blocks meet different groups
                    deal = (part * 7919 + i * 31 + start // 2048) % groups
                    yield pa.RecordBatch.from_pylist([_packed(deal, ids, matrix)], schema=block_schema)

    def pack_tile(key, table):
        found = []
        for ids, matrix in _blocks(table.select(["id", "vector"]).combine_chunks().to_batches()[0], scale):
            found += [_packed(key[0].as_py(), ids[i : i + tile_rows], matrix[i : i + tile_rows]) for i in range(0, len(ids), tile_rows)]
        return pa.Table.from_pylist(found, schema=block_schema)

    block_schema = pa.schema(
        [("deal", pa.int64()), ("dim", pa.int32()), ("n", pa.int32()), ("kind", pa.string()), ("ids", pa.binary()), ("data", pa.binary())]
    )
    best_item = pa.list_(pa.struct([("loss", pa.int64()), ("vec_id", pa.int64())]))
    best_schema = pa.schema([("deal", pa.int64()), ("query_id", pa.int64()), ("query_row", pa.string()), ("best", best_item)])

    shards = vectors.mapInArrow(pack_vectors, _BLOCK)
    tile = F.pmod(F.xxhash64("id"), F.lit(tiles)).alias("tile")
    tiled = queries.distinct().groupBy(tile).applyInArrow(pack_tile, _BLOCK)
    # every tile meets every group of shards: the tile goes to each group, each shard to each tile
    left = tiled.withColumnRenamed("deal", "tile").withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<long>")))
    right = shards.withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)).cast("array<long>")))

    def meet(key, tile, shard):
        found = []
        blocks = list(_unpacked(shard))
        for query_ids, matrix in _unpacked(tile):
            # rows of a query are known by id and vector, as an id may come with several vectors
            row_keys = [f"{i}:{hashlib.blake2b(row.tobytes(), digest_size=12).hexdigest()}" for i, row in zip(query_ids, matrix)]
            for start in range(0, len(query_ids), 256):
                part = slice(start, start + 256)
                kept: dict[int, list] = {}
                for ids, data in blocks:
                    if data.shape[1] != matrix.shape[1]:
                        continue
                    rows, cols, loss = _select(query_ids[part], _scores(matrix[part], data), ids, k)
                    for r, c, value in zip(rows.tolist(), ids[cols].tolist(), loss.tolist()):
                        kept.setdefault(r, []).append((value, c))
                for r, pairs in kept.items():
                    best = sorted(set(pairs))[:k]
                    found.append(
                        dict(
                            deal=key[1].as_py(),
                            query_id=int(query_ids[start + r]),
                            query_row=row_keys[start + r],
                            best=[dict(loss=value, vec_id=c) for value, c in best],
                        )
                    )
        return pa.Table.from_pylist(found, schema=best_schema)

    best = left.groupBy("tile", "deal").cogroup(right.groupBy("tile", "deal")).applyInArrow(meet, _BEST)

    while True:
        groups = math.ceil(groups / fan_in)
        best = (
            best.withColumn("deal", F.floor(F.col("deal") / fan_in))
            .groupBy("deal", "query_id", "query_row")
            .agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("best")))), 1, k).alias("best"))
        )
        if groups == 1:
            break
    return best.select("query_id", F.posexplode("best").alias("place", "item")).select(
        "query_id",
        (F.col("place") + 1).cast("int").alias("rank"),
        F.col("item.vec_id").alias("vec_id"),
        (-F.col("item.loss")).alias("score"),
    )
