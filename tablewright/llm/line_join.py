"""Line dedup by an exact set-similarity join: lines that are nearly equal to an earlier line of the corpus are removed.

A line's tokens are its distinct words. They are ordered with the rare ones first (counted over the whole corpus in cells, see
``rarity``); two lines with Jaccard >= percent / 100 share a token among their first n - ceil(percent * n / 100) + 1. Rows of
these tokens meet; the length filter, the positional filter and a bound from 64 bits that stand for a line's tokens rule
out nearly all pairs before any set is looked at, and the rest is verified with whole sets.

Equal lines are one class from the start. A frequent token makes no region by itself: linked lines whose first common token
it is have a second one, so its lines meet under pairs of tokens. Only lines of so few tokens that a single common one can
link them (at 80 percent: of one distinct word) meet under it alone. In a region each line is compared with the FEW earlier
ones that its bits say are nearest; only a line that none of them makes late is compared with the others. For that only
the documents are read again in which these stand. A region of more
than MANY classes is first joined against its most copied lines. Nothing is left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from . import hashing, rarity
from .marks import mark, mark_of, mark_table, marked
from .shared import discard, stored
from .unit_dedup import PUNCTUATION, rebuilt

#: Regions of more classes than this are joined in rounds.
MANY = 1024
#: Counts of a word from which it makes regions only with a second one, and from which these are dealt out by class.
OFTEN, ALWAYS = 1024, 1 << 24
#: Earlier lines that a line is compared with before any others.
FEW = 2
#: Rows that meet in one step, if no region has more.
AT_ONCE = 1 << 17
#: Rounds against a region's most copied lines.
ROUNDS = 2
#: A class of equal lines: a hash of its words in order, and the parity of its tokens in 64 bins.
KEY = ["a", "m"]
_KEY_KINDS = "a long, m long"
_KEY_FIELDS = [(k, pa.int64()) for k in KEY]


class _Lines:
    """The lines of a step of texts that have enough words."""

    def __init__(self, raw: np.ndarray, ends: np.ndarray, ids: np.ndarray, min_words: int):
        bounds, first = hashing.lines(raw, ends)
        words, _, _, at = hashing.words(raw, bounds, PUNCTUATION)
        size = np.diff(first)
        self.kept = np.flatnonzero(np.diff(at) >= max(1, min_words))
        self.doc = np.repeat(ids, size)[self.kept]
        self.line = (np.arange(len(bounds) - 1) - np.repeat(first[:-1], size))[self.kept].astype(np.int32)
        a, b = hashing.sequences(words, at)
        self.a, self.b = a[self.kept], b[self.kept]
        count = np.diff(at)
        self.starts, self.count = at[:-1][self.kept], count[self.kept]
        # words of the lines kept, with the number of their line
        self.owner = np.repeat(np.arange(len(self.kept)), self.count)
        inside = np.arange(len(self.owner)) - np.repeat(np.cumsum(self.count) - self.count, self.count)
        self.words = words[self.starts[self.owner] + inside]

    def only(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(words, owner) of some lines, by a mask."""
        keep = chosen[self.owner]
        return self.words[keep], self.owner[keep]


def _steps(batch: pa.RecordBatch, min_words: int):
    raw, offsets = hashing.buffers(batch.column(1))
    ids = batch.column(0).to_numpy()
    for start, stop in hashing.steps(offsets):
        found = _Lines(raw[offsets[start] : offsets[stop]], offsets[start : stop + 1] - offsets[start], ids[start:stop], min_words)
        if len(found.kept):
            yield found


def _new(lines: _Lines, recent: rarity.Recent) -> np.ndarray:
    return np.array([not recent.again(k) for k in zip(lines.a.tolist(), lines.b.tolist())], bool)


def _earlier(lines: _Lines, earliest: rarity.Earliest) -> np.ndarray:
    places = zip(lines.a.tolist(), lines.b.tolist(), lines.doc.tolist(), lines.line.tolist())
    return np.array([earliest.lowers((a, b), (doc << 32) + line) for a, b, doc, line in places], bool)


def _scan(documents: DataFrame, min_words: int) -> DataFrame:
    """A row for each line, and rows of cell counts of their words for each task."""
    fields = [("a", pa.int64()), ("b", pa.int64()), ("doc_id", pa.int64()), ("line", pa.int32())]
    schema = pa.schema([*fields, *rarity.COUNTS_FIELDS])

    def run(batches):
        counts, recent = rarity.CellCounts(), rarity.Recent()
        for batch in batches:
            for lines in _steps(batch, min_words):
                counts.add(lines.only(_new(lines, recent))[0])
                size = len(lines.kept)
                columns = [lines.a.view(np.int64), lines.b.view(np.int64), lines.doc, lines.line]
                yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in columns), pa.nulls(size, pa.int32()), pa.nulls(size, pa.binary())], schema=schema)
        for part, blob in counts.rows():
            yield pa.RecordBatch.from_pylist([dict(part=part, counts=blob)], schema=schema)

    return documents.mapInArrow(run, f"a long, b long, doc_id long, line int, {rarity.COUNTS}")


def _distinct(owner: np.ndarray, words: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, token, level) once each, ordered by owner, level and token; a token is the upper 40 bits of a word's hash."""
    tokens = words >> np.uint64(24)
    if len(owner) and owner[-1] >= 1 << 16:  # owners ascend; one very long text can have more lines than a key has room for
        order = np.lexsort((tokens, level, owner))
        owner, tokens, level = owner[order], tokens[order], level[order]
        new = np.ones(len(owner), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (tokens[1:] != tokens[:-1])
        return owner[new], tokens[new], level[new]
    key = np.sort((owner.astype(np.uint64) << np.uint64(48)) | (level.astype(np.uint64) << np.uint64(40)) | tokens)
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    key = key[new]
    return (key >> np.uint64(48)).astype(np.int64), key & np.uint64((1 << 40) - 1), (key >> np.uint64(40)).astype(np.uint8)


#: Parities of shares of the tokens, one for each value but 0 of further bits of a token. That of the share 0 is what they
#: lack to all tokens' parity, so with k - 1 of them pairs are told apart by 64 * k bins: when they first meet and again.
_SHARES, _SHARES_AGAIN = 2, 8


def _lanes(shares: int) -> list[str]:
    return [f"m{i}" for i in range(1, shares)]


def _parity(owner: np.ndarray, tokens: np.ndarray, lines: int, shares: int = 1, share: int = 0) -> np.ndarray:
    """For each line 64 bits, each whether an odd number of its tokens fall in that bin; two lines' bits differ in no more
    places than their sets in tokens. With shares only the tokens of one share count."""
    found = np.zeros(lines, np.uint64)
    starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.zeros(0, int)
    if len(starts):
        bits = np.uint64(1) << (tokens & np.uint64(63))
        if shares > 1:
            bits[(tokens >> np.uint64(6)) % np.uint64(shares) != share] = 0
        found[owner[starts]] = np.bitwise_xor.reduceat(bits, starts)
    return found


def _prefixes(documents: DataFrame, levels, percent: int, min_words: int, tokens=None) -> DataFrame:
    """token, class, n, place, salt: the first tokens of each line, or pairs of them, that another line may have.

    Parities of _SHARES of the tokens follow. With a table of marks only rows of marked tokens are given, with parities of _SHARES_AGAIN. A task gives a class again where it meets it at a smaller place, so the least place among a class's rows is its first.
    """
    fields = [("doc_id", pa.int64()), ("line", pa.int32()), ("n", pa.int32()), ("place", pa.int32()), ("previous", pa.int64()), ("salt", pa.int32())]
    shares = _SHARES if tokens is None else _SHARES_AGAIN
    fields += [(lane, pa.int64()) for lane in _lanes(shares)]
    schema = pa.schema([("token", pa.int64()), *_KEY_FIELDS, *fields])
    once, often, always = (rarity.code_of(count) for count in (1, OFTEN, ALWAYS))

    def run(batches):
        earliest, table = rarity.Earliest(), levels.value
        for batch in batches:
            ids = batch.column(0).to_numpy()
            if (ids[1:] < ids[:-1]).any():
                batch = batch.take(pa.array(np.argsort(ids, kind="stable")))
            for lines in _steps(batch, min_words):
                words, owner = lines.only(_earlier(lines, earliest))
                owner, words, level = _distinct(owner, words, rarity.level_of(table, words))
                n = np.bincount(owner, minlength=len(lines.kept))
                parity = _parity(owner, words, len(n))
                place = np.arange(len(owner)) - (np.cumsum(n) - n)[owner]
                size = n[owner]
                prefix = size - -(-percent * size // 100) + 1
                # a word counted once in the corpus is no one else's; one common word can be enough for small sets
                alone = np.flatnonzero((place < prefix) & (level > once) & ((level < often) | (percent * size <= 100)))
                # a second common word can lie one place behind the prefix
                first = np.flatnonzero((place < prefix) & (level >= often))
                behind = np.minimum(prefix, size - 1)[first] - place[first]
                one = np.repeat(first, behind)
                two = one + 1 + np.arange(len(one)) - np.repeat(np.cumsum(behind) - behind, behind)
                # both are even over 64 bits, which marks need
                token = np.concatenate([hashing.mixed(words[alone]), hashing.mixed(words[one]) + words[two]])
                # the token before it in the line's order: for pairs before the second, or if that is the first, before this
                before = np.concatenate([alone, np.where(apart := two - 1 > one, two, one)]) - 1
                none = np.concatenate([place[alone] == 0, ~apart & (place[one] == 0)])
                previous = np.where(none, np.uint64(0), words[before] + np.uint64(1)).view(np.int64)
                at = np.concatenate([alone, one])
                salt = np.where(level[at] >= always, 1 + (lines.a[owner[at]] >> np.uint64(58)).astype(np.int32), 0)
                of = owner[at]
                columns = [token.view(np.int64), lines.a[of].view(np.int64), parity[of].view(np.int64), lines.doc[of], lines.line[of], size[at].astype(np.int32), place[at].astype(np.int32), previous, salt.astype(np.int32)]
                columns += [_parity(owner, words, len(n), shares, i)[of].view(np.int64) for i in range(1, shares)]
                if tokens is not None:
                    chosen = marked(tokens.value, mark_of(token))
                    columns = [x[chosen] for x in columns]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], schema=schema)

    return documents.mapInArrow(run, f"token long, {_KEY_KINDS}, doc_id long, line int, n int, place int, previous long, salt int" + "".join(f", {x} long" for x in _lanes(shares)))


def _meet(rows: DataFrame, percent: int, asked=None) -> DataFrame:
    """Pairs of classes that pass all filters, the later one first (token null), and rows of too large regions (a_2 null).

    Of each line in a region only the FEW least different earlier lines are given; ``more`` says that the region has others,
    and ``docs``, in one of the line's rows, where these and the line stand first. With a table of marks, all that the further parities don't rule out are given for the marked classes, and nothing else. A pair is left to the region of its earlier common tokens if the tokens before this one are equal in both, which makes them common.
    """
    fields = [("token", pa.int64()), *_KEY_FIELDS, ("n", pa.int32()), ("window", pa.int64()), ("differ", pa.int32()), ("more", pa.bool_()), ("region", pa.int64())]
    schema = pa.schema([*fields, *((f"{k}_2", kind) for k, kind in _KEY_FIELDS), ("docs", pa.list_(pa.int64()))])

    def judged(batch: pa.RecordBatch):
        columns = [c.to_numpy() for c in batch.columns]
        order = np.lexsort([columns[i] for i in (4, 3, 2, 1, 0)])
        columns = [x[order] for x in columns]
        tokens, a, m = columns[:3]
        # a class that several tasks have seen comes with its earliest place first
        fresh = np.ones(len(tokens), bool)
        fresh[1:] = (tokens[1:] != tokens[:-1]) | (a[1:] != a[:-1]) | (m[1:] != m[:-1])
        tokens, a, m, doc, line, n, place, previous, salt, *lanes = (x[fresh] for x in columns)
        n = n.astype(np.int64)
        window = (100 + percent) * (n - place) // percent - n
        starts = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
        size = np.diff(np.append(starts, len(tokens)))
        large = np.repeat(size > MANY, size) | (salt > 0)
        # pairs by their distance in the region; rows drop out where the region ends
        found = [(np.zeros(0, np.int64),) * 3]
        ends = np.repeat(starts + size, size)
        x = np.flatnonzero(~large & (np.arange(len(tokens)) + 1 < ends))
        gap = 1
        while len(x):
            y = x + gap
            fit = (n[x] <= window[y]) & (n[y] <= window[x]) & ((previous[x] != previous[y]) | (previous[x] == 0))
            i, j = x[fit], y[fit]
            differ = np.bitwise_count((m[i] ^ m[j]).view(np.uint64)).astype(np.int64)
            near = differ * (100 + percent) <= (n[i] + n[j]) * (100 - percent)
            i, j = i[near], j[near]
            rest, differ = m[i] ^ m[j], np.zeros(len(i), np.int64)
            for lane in lanes:
                share = lane[i] ^ lane[j]
                differ += np.bitwise_count(share.view(np.uint64))
                rest ^= share
            differ += np.bitwise_count(rest.view(np.uint64))
            near = differ * (100 + percent) <= (n[i] + n[j]) * (100 - percent)
            i, j, differ = i[near], j[near], differ[near]
            if asked is not None:
                later = np.where((doc[i] > doc[j]) | ((doc[i] == doc[j]) & (line[i] > line[j])), i, j)
                wanted = marked(asked.value, mark_of(a[later].view(np.uint64)))
                i, j, differ = i[wanted], j[wanted], differ[wanted]
            found.append((i, j, differ))
            gap += 1
            x = x[x + gap < ends[x]]
        x, y, differ = (np.concatenate(z) for z in zip(*found))
        x_late = (doc[x] > doc[y]) | ((doc[x] == doc[y]) & (line[x] > line[y]))
        late, early = np.where(x_late, x, y), np.where(x_late, y, x)
        order = np.lexsort((line[early], doc[early], differ, late))
        late, early, differ = late[order], early[order], differ[order]
        number = np.bincount(late, minlength=len(tokens))
        docs, edges = doc[:0], np.zeros(len(late) + 1, np.int64)
        if asked is None:
            rank = np.arange(len(late)) - np.searchsorted(late, late)
            few, others = rank < FEW, number[late] > FEW
            # the line's own document in the place of its first pair
            listed = others & ((rank == 0) | ~few)
            docs = np.where(rank == 0, doc[late], doc[early])[listed]
            sizes = np.where(others & (rank == 0), number[late] - FEW + 1, 0)[few]
            edges = np.concatenate([[0], np.cumsum(sizes)])
            late, early, differ = late[few], early[few], differ[few]
        region = np.flatnonzero(large) if asked is None else []
        if len(region):
            columns = [pa.array(z[region]) for z in (tokens, a, m, n.astype(np.int32), window)]
            columns += [pa.nulls(len(region), pa.int32()), pa.array(large[region]), pa.nulls(len(region), pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.nulls(len(region), schema.field(k).type) for k in (*_KEY_2, "docs"))], schema=schema)
        if len(late):
            one, two = ([k[z] for k in (a, m)] for z in (late, early))
            none = [pa.nulls(len(late), kind) for _, kind in fields]
            more = [pa.array(differ.astype(np.int32)), pa.array(number[late] > FEW), pa.array(tokens[late])]
            docs = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(docs))
            yield pa.RecordBatch.from_arrays([none[0], *map(pa.array, one), *none[3:5], *more, *map(pa.array, two), docs], schema=schema)

    def run(batches):
        held, size = [], 0  # rows that wait: a step's worth, and those of the last token; a token that is not frequent has few
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < AT_ONCE:
                continue
            batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            tokens = batch.column(0).to_numpy()
            last = size if batch.column(8)[size - 1].as_py() else int(np.searchsorted(tokens, tokens[-1]))
            held, size = [batch.slice(last)], size - last
            if last:
                yield from judged(batch.slice(0, last))
        if size:
            yield from judged(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    dealt = rows.repartition("token", "salt").sortWithinPartitions("token")
    return dealt.mapInArrow(run, f"token long, {_KEY_KINDS}, n int, window long, differ int, more boolean, region long, a_2 long, m_2 long, docs array<long>")


def _standing(pairs: DataFrame) -> DataFrame:
    """doc_id of the documents in ``docs``."""
    schema = pa.schema([("doc_id", pa.int64())])

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pc.unique(pc.list_flatten(batch.column(0)))], schema=schema)

    return pairs.select("docs").mapInArrow(run, "doc_id long").distinct()


def _classes(documents: DataFrame, hashes: DataFrame, min_words: int) -> DataFrame:
    """class, tokens, first (doc_id, line), copies of the classes with these hashes (and a few more), from the texts."""
    marks = mark_table(hashes.select(mark(F.col("a")).alias("mark")))
    schema = pa.schema([*_KEY_FIELDS, ("doc_id", pa.int64()), ("line", pa.int32()), ("tokens", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            for lines in _steps(batch, min_words):
                asked = marked(marks.value, mark_of(lines.a))
                if not asked.any():
                    continue
                words, owner = lines.only(asked)
                owner, words, _ = _distinct(owner, words, np.zeros(len(words), np.uint8))
                edges = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(lines.kept))[asked])])
                tokens = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(words.view(np.int64)))
                parity = _parity(owner, words, len(lines.kept))[asked]
                columns = [lines.a[asked].view(np.int64), parity.view(np.int64), lines.doc[asked], lines.line[asked]]
                yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in columns), tokens], schema=schema)

    found = documents.mapInArrow(run, f"{_KEY_KINDS}, doc_id long, line int, tokens array<long>")
    return found.groupBy(*KEY).agg(F.min("tokens").alias("tokens"), F.min(F.struct("doc_id", "line")).alias("first"), F.count("*").alias("copies"))


def _named(frame: DataFrame, suffix: str) -> DataFrame:
    return frame.select(*(F.col(c).alias(c + suffix) for c in frame.columns))


_KEY_2 = [k + "_2" for k in KEY]


def _late(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The classes of linked pairs that come after their partner."""
    x = classes.select(*KEY, "tokens", "first")
    both = pairs.select(*KEY, *_KEY_2).distinct().join(x, KEY).join(_named(x, "_2"), _KEY_2)
    common = F.size(F.array_intersect("tokens", "tokens_2"))
    linked = both.where(100 * common >= percent * (F.size("tokens") + F.size("tokens_2") - common))
    second = F.col("first") > F.col("first_2")
    late = [F.when(second, F.col(k)).otherwise(F.col(k + "_2")).alias(k) for k in KEY]
    return linked.where("first <> first_2").select(*late).distinct()


def _near(percent: int) -> Column:
    """The length, positional and bit filters for a row and one with names ending in _2."""
    differ = F.bit_count(F.col("m").bitwiseXOR(F.col("m_2")))
    fits = (F.col("n") <= F.col("window_2")) & (F.col("n_2") <= F.col("window"))
    return fits & (differ * (100 + percent) <= (F.col("n") + F.col("n_2")) * (100 - percent))


def near_repeats(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = 80, min_words: int = 1) -> DataFrame:
    """doc_id, removed (line numbers from 0, ascending) of the documents that lose lines.

    A line goes if a line before it (in a document with a smaller id, or earlier in its own) has a Jaccard similarity of
    percent / 100 or more on distinct words, whether that line goes itself or not. Words end at white space and ASCII
    punctuation, A-Z count as a-z. Lines without a word, or with fewer than min_words, always stay. Rows without
    id or text are not looked at; rows that repeat an id share their ranks.
    """
    known = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")).where("doc_id IS NOT NULL AND text IS NOT NULL")
    scan = stored(_scan(known, min_words), "lines")
    levels = rarity.cell_levels(scan.where("part IS NOT NULL").select("part", "counts"), logarithmic=True)
    lines = scan.where("part IS NULL").select("a", "b", "doc_id", "line")
    spark = documents.sparkSession
    met = stored(_meet(_prefixes(known, levels, percent, min_words), percent), "met")
    regions = met.where("token IS NOT NULL").select("token", *KEY, "n", "window")
    met_pairs = met.where("token IS NULL")
    # of all regions of a line its nearest earlier lines
    near = F.array_sort(F.collect_set(F.struct("differ", *_KEY_2)))
    near = met_pairs.groupBy(*KEY).agg(near.alias("near"), F.max("more").alias("more"))
    near = near.select(*KEY, (F.col("more") | (F.size("near") > FEW)).alias("more"), F.slice("near", 1, FEW).alias("near"))
    near = stored(near, "near")
    pairs = near.select(*KEY, F.explode("near").alias("of")).select(*KEY, "of.a_2", "of.m_2")
    in_regions = met.select("a").unionAll(met_pairs.select(F.col("a_2").alias("a")))
    classes = stored(_classes(known, in_regions.distinct(), min_words), "classes")
    late = stored(_late(pairs, classes, percent), "late")
    # for lines that these don't make late all others: those given, then those of regions that have more, which are met again
    unsettled = stored(near.where("more").select(*KEY).join(late, KEY, "left_anti"), "unsettled")
    if not unsettled.isEmpty():
        given = met_pairs.join(unsettled, KEY, "left_semi")
        late = stored(late.unionAll(_late(given, classes, percent)).distinct(), "late")
        unsettled = stored(met_pairs.where("more").select(*KEY, "region", "docs").join(unsettled, KEY, "left_semi").join(late, KEY, "left_anti"), "unsettled")
    if not unsettled.isEmpty():
        asked = mark_table(unsettled.select(mark(F.col("a")).alias("mark")).distinct())
        tokens = mark_table(unsettled.select(mark(F.col("region")).alias("mark")).distinct())
        again = stored(known.join(_standing(unsettled), "doc_id", "left_semi"), "again")
        unsettled = unsettled.select(*KEY).distinct()
        others = _meet(_prefixes(again, levels, percent, min_words, tokens=tokens), percent, asked)
        others = stored(others.select(*KEY, *_KEY_2).distinct().join(unsettled, KEY, "left_semi"), "others")
        hashes = others.select("a").unionAll(others.select(F.col("a_2").alias("a"))).distinct()
        # a class that is there by chance can stand in a document before these
        first = lines.join(hashes, "a", "left_semi").groupBy("a").agg(F.min(F.struct("doc_id", "line")).alias("first"))
        more = stored(_classes(again, hashes, min_words).drop("first").join(first, "a").select(*classes.columns), "classes")
        late = stored(late.unionAll(_late(others, more, percent)).distinct(), "late")
        classes = stored(classes.unionByName(more).dropDuplicates(KEY), "classes")
        discard(others, more, again)

    regions = stored(regions.join(classes.select(*KEY, "first", F.struct((-F.col("copies")).alias("few"), "first", *KEY).alias("rank")), KEY), "regions")
    discard(met, near)
    used = None
    for step in range(ROUNDS + 1):
        left = regions.join(late.withColumn("late", F.lit(True)), KEY, "left").withColumn("late", F.coalesce("late", F.lit(False)))
        # a region is done when none of its open lines has an earlier one in it, be that late or not
        ends = left.groupBy("token").agg(F.min("first").alias("earliest"), F.max(F.when(~F.col("late"), F.col("first"))).alias("open"))
        unsettled = ends.where("earliest < open").select("token")
        left = stored(left.join(unsettled, "token", "left_semi"), "left")
        if left.isEmpty():
            break
        if step < ROUNDS:
            fresh = left if used is None else left.join(used, "token", "left").where("pivot IS NULL OR rank > pivot")
            pivots = fresh.groupBy("token").agg(F.min(F.struct("rank", *KEY, "n", "window", "first")).alias("p"))
            used = stored(pivots.select("token", F.col("p.rank").alias("pivot")), "pivots")
            other = pivots.select("token", *(F.col(f"p.{c}").alias(f"{c}_2") for c in [*KEY, "n", "window", "first"]))
            asked = F.col("first") > F.col("first_2")
        else:
            other = _named(left.select("token", *KEY, "n", "window", "first"), "_2").withColumnRenamed("token_2", "token")
            asked = F.col("first") > F.col("first_2")
        more = left.where("NOT late").join(other, "token").where(asked & _near(percent))
        late = stored(late.unionAll(_late(more, classes, percent)).distinct(), "late")

    place = F.struct("doc_id", "line")
    first = lines.groupBy("a", "b").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    # written, so that a line with many places is split in the join: neither of its sides is an aggregate
    first = stored(first.where("first < last").select("a", "b", "first"), "first-lines")
    again = lines.join(first, ["a", "b"]).where(place > F.col("first")).select("doc_id", "line")
    near = classes.join(late, KEY, "left_semi").select("first.doc_id", "first.line")
    removed = stored(again.unionAll(near).groupBy("doc_id").agg(F.array_sort(F.collect_set("line")).alias("removed")), "removed")
    discard(scan, first, classes, regions)
    return removed


def remove_near_repeats(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = 80, min_words: int = 1) -> DataFrame:
    """The documents without the lines that ``near_repeats`` names, with n_units, n_removed and kept (start, end) added.

    Rows, other columns, nulls and the shape of the new text are as at ``unit_dedup.remove_repeated_units``.
    """
    return rebuilt(documents, near_repeats(documents, id_column, text_column, percent, min_words), id_column, text_column)
