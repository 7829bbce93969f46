"""Exact Jaccard join of documents as a metric-space join: pivots, Voronoi regions, triangle-inequality windows, recursion.

Jaccard distance is a metric, but between word shingles it is 1 for nearly every pair, so the bisectors of pivots drawn
at random would send each document to all regions. Pivots are therefore chosen where documents meet: the documents that
share a token of their prefixes form a region, and the region's pivot is its most central document. A document is dealt
to every region whose window it can lie in; the window follows from its size and the token's position. Each member's
distance to the pivot is measured. Members of one component are done with each other. Where a region has more than
one component, it is joined again: around its next pivot, and in the end pair by pair inside the triangle window, where two
documents whose distances to a common pivot differ by more than the radius cannot be linked. Nothing is sampled or cut off.

Tokens are ordered with the frequent ones last, so a passage that many documents share makes no region unless documents
consist of little else, and exact copies are one document. A large group of near copies costs its size, not its square.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import hashing, rarity
from .components import components
from .marks import mark, mark_of, mark_table, marked
from .shared import discard, shared_folder, stored


#: There are more distinct shingles than words, so a larger table of counts pays.
_CELL_BITS = 23


def _key(tokens: np.ndarray) -> int:
    """64 bits that stand for a set."""
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def _scan(documents: DataFrame, shingle: int) -> DataFrame:
    """A row (doc_id, n, key) for each document, and rows of cell counts for each task."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("key", pa.int64()), *rarity.COUNTS_FIELDS])

    def run(batches):
        counts, recent = rarity.CellCounts(_CELL_BITS), rarity.Recent()
        for batch in batches:
            sizes, keys = [], []
            for tokens in hashing.shingle_sets(batch.column(1), shingle):
                sizes.append(len(tokens))
                keys.append(_key(tokens) if len(tokens) else None)
                if len(tokens) and not recent.again(keys[-1]):
                    counts.add(tokens)
            none = pa.nulls(len(sizes), pa.int32()), pa.nulls(len(sizes), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()), *none], schema=schema)
        for part, blob in counts.rows():
            yield pa.RecordBatch.from_pylist([dict(part=part, counts=blob)], schema=schema)

    return documents.mapInArrow(run, "doc_id long, n long, key long, " + rarity.COUNTS)


def _prefixes(documents: DataFrame, levels, shingle: int, percent: int) -> DataFrame:
    """token, key, n, place, previous, salt: the tokens of which a set shares one with every set it is linked to.

    Two linked sets differ in so few tokens that their first n - ceil(percent * n / 100) + 1 in any common order meet.
    """
    schema = pa.schema([("token", pa.int64()), ("key", pa.int64()), ("n", pa.int32()), ("place", pa.int32()), ("previous", pa.int64()), ("salt", pa.int32())])

    def run(batches):
        recent, table = rarity.Recent(), levels.value
        for batch in batches:
            found: list[tuple[np.ndarray, ...]] = []
            for doc, tokens in zip(batch.column(0).to_pylist(), hashing.shingle_sets(batch.column(1), shingle)):
                n = len(tokens)
                # a set with no room for a difference is only linked to its copies
                if doc is None or n * (100 - percent) < percent or recent.again(key := _key(tokens)):
                    continue
                level = rarity.level_of(table, tokens)
                keep = np.argsort(level, kind="stable")[: n + percent * n // -100 + 1]
                salt = np.where(level[keep] >= rarity.FREQUENT, 1 + key % 64, 0).astype(np.int32)
                kept = tokens[keep].view(np.int64)
                # the token before each one in the set's order, 0 before the first
                previous = np.append(np.int64(0), kept[:-1])
                found.append((kept, np.full(len(keep), key, np.int64), np.full(len(keep), n, np.int32), np.arange(len(keep), dtype=np.int32), previous, salt))
                if len(found) >= 500:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], schema=schema)
                    found = []
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], schema=schema)

    return documents.mapInArrow(run, "token long, key long, n int, place int, previous long, salt int")


def _shared_tokens(rows: DataFrame, percent: int) -> DataFrame:
    """token, key, n, window, fits of the rows whose token other sets may have, told in one pass over sorted rows.

    Two sets can be linked if each size is within the other's window, which narrows with the place of the first common
    token. ``fits`` says that some other row of the token may be in a row's window, and it in that row's, and that the
    token's rows have not all met before: where all have the same token before this one, that token has them too, in wider
    windows.
    """
    schema = pa.schema([("token", pa.int64()), ("key", pa.int64()), ("n", pa.int32()), ("window", pa.int64()), ("fits", pa.bool_())])

    def judged(batch: pa.RecordBatch) -> pa.RecordBatch:
        tokens, keys, n, place, previous, salt = (c.to_numpy() for c in batch.columns)
        fresh = np.ones(len(tokens), bool)  # copies that several tasks have met
        fresh[1:] = (tokens[1:] != tokens[:-1]) | (keys[1:] != keys[:-1])
        tokens, keys, n, place, previous, frequent = (x[fresh] for x in (tokens, keys, n, place, previous, salt > 0))
        window = (100 + percent) * (n.astype(np.int64) - place) // percent - n
        starts = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
        size = np.diff(np.append(starts, len(tokens)))
        fits = (window >= np.repeat(np.minimum.reduceat(n, starts), size)) & (n <= np.repeat(np.maximum.reduceat(window, starts), size))
        met = (np.minimum.reduceat(previous, starts) == np.maximum.reduceat(previous, starts)) & (previous[starts] != 0)
        fits &= ~np.repeat(met, size)
        keep = frequent | (np.repeat(size, size) > 1)
        columns = [x[keep] for x in (tokens, keys, n, window, frequent | fits)]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], schema=schema)

    def run(batches):
        held = None  # the rows of the last token, of which the next batch may have more; a rare token has few
        for batch in batches:
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            if not batch.num_rows:
                continue
            tokens = batch.column(0).to_numpy()
            last = int(np.searchsorted(tokens, tokens[-1]))
            if batch.column(5)[batch.num_rows - 1].as_py():
                last = batch.num_rows  # frequent tokens need not be together
            held = batch.slice(last)
            if last:
                yield judged(batch.slice(0, last))
        if held is not None and held.num_rows:
            yield judged(held)

    # frequent tokens are dealt by document too, and kept unseen
    dealt = rows.repartition("token", "salt").sortWithinPartitions("token", "key")
    return dealt.mapInArrow(run, "token long, key long, n int, window long, fits boolean")


#: Bins of the parities that stand for a set when pairs are told apart.
_BINS = 4096


def _parity(tokens: np.ndarray) -> np.ndarray:
    """For each bin one bit, whether an odd number of the tokens fall in it, as 64-bit numbers: those of two sets differ in no
    more places than the sets in tokens."""
    odd = np.bincount((tokens & np.uint64(_BINS - 1)).astype(np.int64), minlength=_BINS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sets(documents: DataFrame, ids: DataFrame, shingle: int) -> DataFrame:
    """key, n, parity, tokens of the sets of the documents with these ids (and of a few more), read from the texts again."""
    marks = mark_table(ids.select(mark(F.xxhash64("id")).alias("mark")))
    several = pa.list_(pa.int64())
    schema = pa.schema([("key", pa.int64()), ("n", pa.int32()), ("parity", several), ("tokens", several)])

    def run(batches):
        for batch in batches:
            batch = batch.filter(pa.array(marked(marks.value, batch.column(2).to_numpy())))
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                tokens = list(hashing.shingle_sets(part.column(1), shingle))
                columns = [pa.array([_key(x) for x in tokens], pa.int64()), pa.array([len(x) for x in tokens], pa.int32())]
                columns += [pa.array([_parity(x) for x in tokens], several), pa.array([x.view(np.int64) for x in tokens], several)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    known = documents.where("doc_id IS NOT NULL").withColumn("mark", mark(F.xxhash64("doc_id")))
    return known.mapInArrow(run, "key long, n int, parity array<long>, tokens array<long>")


def _ends(pairs: DataFrame) -> DataFrame:
    """The keys of pairs (a, b), each once."""
    return pairs.select(F.col("a").alias("key")).unionAll(pairs.select(F.col("b").alias("key"))).distinct()


def _wanted(sets: DataFrame, keys: DataFrame) -> DataFrame:
    """key, tokens of the sets with these keys (and of a few more), without a shuffle of the others."""
    marks = mark_table(keys.select(mark(F.col("key")).alias("mark")))

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(marked(marks.value, mark_of(batch.column(0).to_numpy().view(np.uint64)))))

    return sets.select("key", "tokens").mapInArrow(run, "key long, tokens array<long>")


class _Join:
    def __init__(self, documents: DataFrame, first: DataFrame, shingle: int, percent: int):
        self.documents, self.first, self.shingle, self.percent = documents, first, shingle, percent

    def least_overlap(self, n, m):
        """The smallest intersection of linked sets of n and m tokens."""
        return F.ceil(self.percent * (F.col(n) + F.col(m)) / (100 + self.percent))

    def pruned(self, prefixes: DataFrame, pairs: DataFrame) -> DataFrame:
        """Those of pairs (a, n_a, b, n_b) that share enough prefix tokens to reach the overlap with all tokens behind."""
        of_a = prefixes.select(F.col("key").alias("a"), F.col("tokens").alias("x"))
        of_b = prefixes.select(F.col("key").alias("b"), F.col("tokens").alias("y"))
        met = pairs.join(of_a, "a").join(of_b, "b").withColumn("met", F.size(F.array_intersect("x", "y")))
        behind = F.ceil(self.percent * F.greatest("n_a", "n_b") / 100) - 1
        return met.where(F.col("met") + behind >= self.least_overlap("n_a", "n_b")).select("a", "b")

    def measured(self, pairs: DataFrame) -> DataFrame:
        """a, b, distance, linked for those of pairs (a, b) that the parities of their tokens don't rule out."""
        pairs = stored(pairs, "pairs")
        ids = self.first.join(_ends(pairs), "key").select(F.col("first").alias("id"))
        sets = stored(_sets(self.documents, ids, self.shingle), "sets")

        def joined(pairs: DataFrame, sets: DataFrame, column: str, size) -> DataFrame:
            of_a = sets.select(F.col("key").alias("a"), F.col(column).alias("x"), size.alias("n_a"))
            of_b = sets.select(F.col("key").alias("b"), F.col(column).alias("y"), size.alias("n_b"))
            return pairs.join(of_a, "a").join(of_b, "b")

        # few pairs need their tokens: sets that differ in more places than linked ones can are not linked
        places = F.zip_with("x", "y", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
        differ = F.aggregate(places, F.lit(0), lambda total, x: total + x)
        near = joined(pairs, sets, "parity", F.col("n")).where(differ <= F.col("n_a") + F.col("n_b") - 2 * self.least_overlap("n_a", "n_b"))
        # a set that is read from several copies gives its pairs as often
        able = stored(near.select("a", "b").distinct(), "able")
        whole = joined(able, _wanted(sets, _ends(able)), "tokens", F.size("tokens"))
        whole = whole.select("a", "b", F.size(F.array_intersect("x", "y")).alias("common"), (F.col("n_a") + F.col("n_b")).alias("sum"))
        united = F.col("sum") - F.col("common")
        found = whole.select("a", "b", (1 - F.col("common") / united).alias("distance"), (100 * F.col("common") >= self.percent * united).alias("linked"))
        found = stored(found.dropDuplicates(["a", "b"]), "distances")
        discard(pairs, sets, able)
        return found


def jaccard_components(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, one row for each document: what documents with Jaccard >= percent / 100 connect.

    A document's set holds its distinct runs of ``shingle`` words, A-Z lower-cased; with fewer words it is the whole
    sequence. component_id is the smallest doc_id that links reach.

    Defined cases: null, empty and blank texts have an empty set and are linked to nothing. A row without an id is linked
    to nothing, its component is null. Rows that repeat an id are one document: what any of them is linked to, all are. Texts
    are taken whole, whatever their length. Extra columns are not read. An empty table gives no rows.
    """
    shared_folder(documents.sparkSession)
    documents = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    scan = stored(_scan(documents, shingle), "scan")
    levels = rarity.cell_levels(scan.where("part IS NOT NULL").select("part", "counts"), bits=_CELL_BITS)
    sized = scan.where("part IS NULL").select("doc_id", "n", "key")
    # copies are one set from here on; an id that comes with several sets links them
    named = sized.where("key IS NOT NULL AND doc_id IS NOT NULL")
    first = stored(named.groupBy("key").agg(F.min("doc_id").alias("first")), "first")
    twice = named.groupBy("doc_id").agg(F.min("key").alias("b"), F.max("key").alias("a")).where("a <> b").select("doc_id", "b")
    links = named.join(twice, "doc_id").select(F.col("key").alias("a"), "b").where("a <> b")
    join = _Join(documents, first, shingle, percent)

    members = stored(_shared_tokens(_prefixes(documents, levels, shingle, percent), percent), "members")
    prefixes = stored(members.groupBy("key").agg(F.collect_set("token").alias("tokens")), "prefixes")
    central = prefixes.select("key", F.size("tokens").alias("met"))
    rows = members.where("fits").drop("fits").join(central, "key")
    rows = rows.withColumn("rank", F.struct((-F.col("met") / F.col("n")).alias("far"), "key")).drop("met")
    regions = held = stored(rows, "regions")
    discard(members)
    known, before = None, None
    while True:
        if known is None:
            regions = regions.withColumn("component", F.col("key"))
        else:
            label = components(links).withColumnRenamed("id", "key")
            regions = regions.drop("component").join(label, "key", "left").withColumn("component", F.coalesce("component", "key"))
        several = regions.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
        regions = stored(regions.join(several.select("token"), "token", "left_semi"), "regions")
        discard(held)
        held = regions
        # pairs of different components, counted without making them
        sizes = regions.groupBy("token", "component").count().groupBy("token").agg(F.sum("count").alias("all"), F.sum(F.col("count") * F.col("count")).alias("own"))
        work = sizes.agg(F.sum(F.col("all") * F.col("all") - F.col("own")), F.sum("all")).first()
        # pivots go on as long as each settles a good part of what there is
        if not work[1] or known is not None and (work[0] <= 64 * work[1] or before is not None and work[0] > 0.8 * before):
            break
        before = work[0]
        # the next pivot of each region: the most central document that has not been one
        fresh = regions if known is None else regions.where("pivot_rank IS NULL OR rank > pivot_rank")
        pivots = fresh.groupBy("token").agg(F.min(F.struct("rank", "n", "component")).alias("p"))
        pivots = pivots.select("token", F.col("p.rank").alias("next_rank"), F.col("p.n").alias("n_b"), F.col("p.component").alias("own"))
        if pivots.isEmpty():
            break
        past = F.col("next_rank") if known is None else F.coalesce("next_rank", "pivot_rank")
        regions = regions.drop("n_b", "own", "next_rank").join(pivots, "token", "left").withColumn("pivot_rank", past)
        regions = stored(regions, "regions")
        discard(held)
        held = regions
        met = regions.where("component <> own AND n_b <= window").select(F.col("key").alias("a"), F.col("n").alias("n_a"), F.col("next_rank.key").alias("b"), "n_b").distinct()
        distances = join.measured(join.pruned(prefixes, met))
        known = distances if known is None else known.unionAll(distances)
        links = links.unionAll(distances.where("linked").select("a", "b"))
    if work[1]:
        # what is left of each region pair by pair, in the windows of size, place and distance to the pivot
        pivot = regions.select("token", F.col("key").alias("a"), F.col("pivot_rank.key").alias("b"))
        near = pivot.join(known.select("a", "b", "distance"), ["a", "b"], "left").select("token", F.col("a").alias("key"), "distance")
        rows = regions.join(near, ["token", "key"]).select("token", "key", "n", "window", "component", "distance")
        x, y = (rows.select("token", *(F.col(c).alias(f"{c}_{side}") for c in rows.columns if c != "token")) for side in "ab")
        fits = "key_a < key_b AND component_a <> component_b AND n_a <= window_b AND n_b <= window_a"
        triangle = F.coalesce(F.abs(F.col("distance_a") - F.col("distance_b")) <= 1 - percent / 100 + 1e-9, F.lit(True))
        left = x.join(y, "token").where(fits).where(triangle).select(F.col("key_a").alias("a"), "n_a", F.col("key_b").alias("b"), "n_b").distinct()
        links = links.unionAll(join.measured(join.pruned(prefixes, left)).where("linked").select("a", "b"))
    # a component is called by its smallest document
    label = stored(first.join(components(links).withColumnRenamed("id", "key"), "key", "left").withColumn("component", F.coalesce("component", "key")), "labels")
    discard(held, prefixes, first)
    smallest = label.groupBy("component").agg(F.min("first").alias("component_id"))
    called = label.join(smallest, "component").select(F.col("key").alias("of"), "component_id")
    done = sized.join(called, F.col("key") == F.col("of"), "left")
    return done.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
