"""Spelling variants: words of a corpus, the words one edit away from each, and the commoner one a word is a variant of.

Two words of which the longer has L code points differ by one inserted, deleted or replaced code point exactly if the
lengths of their common prefix and common suffix together reach L - 1. The common prefix ends in the first, second or last third
of the longer word, so the two words share all of the word but that third: words are dealt by (L, third, what lies
before it, what lies behind it), once as the longer word and once as the shorter. Within such a group dense tiles
compare blocks of words: padded code-point matrices, aligned left and right, give all common prefixes and suffixes of a block
pair at once. A pair counts only in the group of the third where its common prefix ends, so it is found once. A group beyond
``tile`` words is cut into blocks whose pairs go to different tasks; no pair of unlike words is ever written.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .shared import stored

#: Runs of letters in text whose A-Z are lower-cased already.
RUN = re.compile("[a-zÀ-ÿ]+")
#: Different words a task counts before it passes its counts on.
HELD = 200_000
#: Words to a side of a dense block, block pairs to one step.
BLOCK, STEP = 48, 32
THIRDS = 3
#: What a group's rows agree in; a word stands in the tile (low, high) of blocks, its own among them.
GROUP = ["longer", "third", "key", "low", "high"]
PAIRS = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("near_n", pa.int64()), ("near", pa.string())])


def word_counts(documents: DataFrame, typo_every: int | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(word, n): how often each longest run of letters a-z and U+00C0 to U+00FF occurs, A-Z lower-cased and nothing else.

    With typo_every, a run loses one code point wherever that number divides the CRC-32 h of ``<id>:<run>`` (a null id is
    empty): the one at h modulo its length. A run of one code point then is no word. A null or empty text has no words;
    repeated rows count each time. Tasks add up before the shuffle.
    """

    def count(batches):
        total: Counter[str] = Counter()

        def out() -> Iterator[pa.RecordBatch]:
            kept = {w: n for w, n in total.items() if n and w}
            yield pa.RecordBatch.from_arrays([pa.array(kept.keys(), pa.string()), pa.array(kept.values(), pa.int64())], names=["word", "n"])
            total.clear()

        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                text = text.as_py()
                if not text:
                    continue
                runs = RUN.findall(text.encode().lower().decode())  # bytes know no letters but ASCII
                total.update(runs)
                if typo_every:
                    key = key.as_py()
                    start, own = zlib.crc32(f"{'' if key is None else key}:".encode()), None
                    for run in set(runs):
                        h = zlib.crc32(run.encode(), start)
                        if not h % typo_every:
                            own = own or Counter(runs)
                            n, at = own[run], h % len(run)
                            total[run] -= n
                            total[run[:at] + run[at + 1 :]] += n
                if len(total) >= HELD:
                    yield from out()
        yield from out()

    return documents.select(id_column, text_column).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _cuts(longer: Column) -> list[Column]:
    return [F.floor(longer * F.lit(i) / F.lit(THIRDS)).cast("int") for i in range(THIRDS + 1)]


def _dealt(words: DataFrame, tile: int) -> DataFrame:
    """Each word under the keys of its groups; of groups beyond ``tile`` words, once for each pair of blocks with its own."""
    ways = [(more, third) for more in (0, 1) for third in range(THIRDS)]
    keyed = words.select("word", "n", F.char_length("word").alias("size"), F.explode(F.array(*(F.struct(F.lit(m).alias("more"), F.lit(t).alias("third")) for m, t in ways))).alias("way"))
    keyed = keyed.select("word", "n", (F.col("size") + F.col("way.more")).alias("longer"), F.col("size"), F.col("way.third").alias("third"))
    cuts = F.array(*_cuts(F.col("longer")))
    before = F.expr("substr(word, 1, before)")
    behind = F.expr("substr(word, size - behind + 1, behind)")
    keyed = keyed.withColumns({"before": cuts[F.col("third")], "behind": F.col("longer") - cuts[F.col("third") + 1]})
    keyed = keyed.select("word", "n", "longer", "third", F.xxhash64("longer", "third", before, F.lit("|"), behind).alias("key"))
    large = keyed.groupBy("key").count().where(F.col("count") > tile).select("key", F.ceil(F.col("count") / tile).cast("int").alias("blocks"))
    keyed = keyed.join(large, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    keyed = keyed.withColumn("block", F.pmod(F.xxhash64("word", F.lit("block")), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    keyed = keyed.select("*", other).withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    return keyed.select("longer", "third", "key", "low", "high", "block", "word", "n")


def _blocks(sizes: list[int]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """(blocks of rows, pairs of blocks to compare) for groups of these sizes that lie behind each other.

    Small groups share a block; one beyond BLOCK has several, all paired.
    """
    blocks, pairs, start, at = [], [], 0, 0
    for size in sizes:
        if at - start + size > BLOCK and at > start:
            blocks.append((start, at))
            pairs.append((len(blocks) - 1, len(blocks) - 1))
            start = at
        at += size
        if size > BLOCK:
            first = len(blocks)
            blocks += [(a, min(a + BLOCK, at)) for a in range(start, at, BLOCK)]
            pairs += [(a, b) for a in range(first, len(blocks)) for b in range(a, len(blocks))]
            start = at
    if at > start:
        blocks.append((start, at))
        pairs.append((len(blocks) - 1, len(blocks) - 1))
    return blocks, pairs


def _matrices(words: list[str], sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words, a row each, aligned left and aligned right (from the last one on); 0 where there is none."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    points = points.astype(np.uint8 if points.max(initial=0) < 256 else np.uint32)
    left, right = (np.zeros((len(words), width), points.dtype) for _ in range(2))
    row = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(points)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    left[row, place] = points
    right[row, sizes[row] - 1 - place] = points
    return left, right


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For stacks of blocks the length of the common beginning of each row of a with each row of b."""
    alive = np.ones((a.shape[0], a.shape[1], b.shape[1]), bool)
    found = np.zeros(alive.shape, np.uint8 if a.shape[2] < 256 else np.uint32)
    for j in range(a.shape[2]):
        alive &= a[:, :, None, j] == b[:, None, :, j]
        found += alive
    return found


def near_pairs(words: list[str], group: np.ndarray, block: np.ndarray, apart: np.ndarray, third: np.ndarray, longer: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows (x, y) of words one edit apart, x before y, in the same of the groups that lie behind each other.

    At least one word has ``longer`` code points. Where ``apart``, only rows of different blocks are paired. A pair is
    returned in the group of the third where its common prefix ends.
    """
    sizes = np.array([len(w) for w in words])
    left, right = _matrices(words, sizes, longer)
    bounds = np.append(np.flatnonzero(np.append(True, group[1:] != group[:-1])), len(words))
    blocks, pairs = _blocks(np.diff(bounds).tolist())
    rows = np.full((len(blocks), max(b - a for a, b in blocks)), -1)
    for i, (a, b) in enumerate(blocks):
        rows[i, : b - a] = np.arange(a, b)
    cuts = np.array([longer * i // THIRDS for i in range(THIRDS + 1)])
    xs, ys = [], []
    step = max(1, STEP * 64 // max(64, longer))
    for k in range(0, len(pairs), step):
        of_a, of_b = np.array(pairs[k : k + step]).T
        a, b = rows[of_a], rows[of_b]
        prefix, suffix = _common(left[a], left[b]), _common(right[a], right[b])
        # where both rows end, equal padding must not count
        s, x, y = np.nonzero((prefix.astype(np.int64) + suffix >= longer - 1) & (a[:, :, None] < b[:, None, :]) & (a[:, :, None] >= 0))
        x, y, prefix, suffix = a[s, x], b[s, y], prefix[s, x, y].astype(np.int64), suffix[s, x, y].astype(np.int64)
        shorter = np.minimum(sizes[x], sizes[y])
        prefix, suffix = np.minimum(prefix, shorter), np.minimum(suffix, shorter)
        ends = np.minimum(prefix, longer - 1)
        good = (group[x] == group[y]) & (np.maximum(sizes[x], sizes[y]) == longer) & (prefix + suffix >= longer - 1)
        good &= (cuts[third[x]] <= ends) & (ends < cuts[third[x] + 1]) & (~apart[x] | (block[x] != block[y]))
        xs.append(x[good])
        ys.append(y[good])
    return np.concatenate(xs), np.concatenate(ys)


def _near_of_groups(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """For the words of whole groups: how many near words each has there, and the best of them."""
    keys = [table.column(c).to_numpy() for c in GROUP]
    changes = np.zeros(table.num_rows, bool)
    changes[0] = True
    for key in keys:
        changes[1:] |= key[1:] != key[:-1]
    group = np.cumsum(changes) - 1
    alone = np.bincount(group)[group] == 1
    table, group, keys = table.filter(pa.array(~alone)), group[~alone], [k[~alone] for k in keys]
    longer, third, _, low, high = keys
    block, n, words = table.column("block").to_numpy(), table.column("n").to_numpy(), table.column("word")
    ends = np.append(np.flatnonzero(np.append(True, longer[1:] != longer[:-1])), len(longer)) if len(longer) else np.zeros(1, int)
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
        own = words.slice(a, b - a).to_pylist()
        x, y = near_pairs(own, group[a:b], block[a:b], (low != high)[a:b], third[a:b], int(longer[a]))
        if not len(x):
            continue
        word, near = np.concatenate([x, y]), np.concatenate([y, x])
        rank = np.empty(b - a, np.int64)
        rank[sorted(range(b - a), key=own.__getitem__)] = np.arange(b - a)
        order = np.lexsort((rank[near], -n[a:b][near], word))
        word, near = word[order], near[order]
        first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        names = words.slice(a, b - a)
        yield pa.RecordBatch.from_arrays(
            [
                names.take(pa.array(word[first])).combine_chunks().cast(pa.string()),
                pa.array(np.diff(np.append(first, len(word))), pa.int64()),
                pa.array(n[a:b][near[first]], pa.int64()),
                names.take(pa.array(near[first])).combine_chunks().cast(pa.string()),
            ],
            schema=PAIRS,
        )


def _tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hands on whole groups; rows come sorted by group, and a group is bounded by two blocks of a tile."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        same = np.ones(batch.num_rows, bool)
        for c in GROUP:
            values = batch.column(c).to_numpy()
            same &= values == values[-1]
        cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0  # where the last group begins
        if cut or held and any(held[-1].column(c)[-1] != batch.column(c)[0] for c in GROUP):
            yield from _near_of_groups(pa.Table.from_batches([*held, batch.slice(0, cut)]))
            held = []
        held.append(batch.slice(cut))
    if held:
        yield from _near_of_groups(pa.Table.from_batches(held))


def near_words(words: DataFrame, tile: int = 4096) -> DataFrame:
    """(word, n_near, near_n, near) for each of the distinct words (word, n) that has a word one edit away.

    n_near counts those words, near is the one of largest n (ties: smallest in code-point order), near_n its n.
    """
    dealt = _dealt(words.select("word", "n"), tile)
    dealt = dealt.repartition("key", "low", "high").sortWithinPartitions(*GROUP)
    found = dealt.mapInArrow(_tiled, "word string, n_near long, near_n long, near string")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", (-F.col("best.less")).alias("near_n"), F.col("best.near").alias("near"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for words with a form: forms followed to the last, twice as far in each round.

    n at least doubles from word to form, so no way is longer than the binary logarithm of the largest n.
    """
    reached = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(reached.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        reached = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return reached


def variant_groups(words: DataFrame, ratio: int = 2, tile: int = 4096) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for a frame of distinct words with their counts n.

    n_near counts the words exactly one inserted, deleted or replaced code point away. form is the near word of largest n
    (ties: smallest in code-point order) if that n is at least ratio times the word's, else null; root is where forms
    lead to in the end, the word itself without a form. A null word is left out; an empty frame gives an empty one.
    """
    if ratio < 2:
        raise ValueError("forms must lead to commoner words: ratio is 2 or more")
    words = stored(words.where("word IS NOT NULL").select("word", "n"), "spelling-words")
    found = words.join(near_words(words, tile), "word", "left")
    has = F.col("near_n") >= ratio * F.col("n")
    judged = stored(found.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(has, F.col("near")).alias("form"), F.when(has, F.col("near_n")).alias("form_n")), "spelling-forms")
    roots = _roots(judged.where("form IS NOT NULL"))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(documents: DataFrame, typo_every: int | None = None, least_points: int = 5, least_n: int = 3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``variant_groups`` of the documents' words with at least least_points code points and least_n occurrences."""
    words = word_counts(documents, typo_every, id_column, text_column)
    return variant_groups(words.where((F.col("n") >= least_n) & (F.char_length("word") >= least_points)))
