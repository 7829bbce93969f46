"""Line join, line hashing and the Jaccard join against brute force, with hot groups and the defined cases."""

from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pytest

from tablewright.llm import hashing, jaccard_join, line_join, rarity, shared, unit_dedup
from tablewright.llm.components import components

LOWER = {i: i + 32 for i in range(65, 91)}
MARKS = re.compile("[" + re.escape(unit_dedup.PUNCTUATION.decode()) + r"\x09-\x0D ]+")


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", 3, 1.5) for i, t in rows], "doc_id long, text string, lang string, n int, token double")


def lines_of(text):
    if not text:
        return [""]
    return text.split("\n")[: -1 if text.endswith("\n") else None]


def paragraphs_of(text):
    found = []
    for line in lines_of(text):
        blank = lambda x: not MARKS.sub(" ", x).strip()
        if not found or (not blank(line) and blank(found[-1][-1])):
            found.append([])
        found[-1].append(line)
    return ["\n".join(x) for x in found]


def words_of(line):
    return tuple(MARKS.sub(" ", line.translate(LOWER)).split())


def some_documents(seed, count=60):
    """Documents of lines from a small vocabulary, with copies, variants, short lines and a line that most share."""
    deal = random.Random(seed)
    vocabulary = [f"w{i}é" if i % 5 == 0 else f"w{i}" for i in range(300)]
    line = lambda: " ".join(deal.choice(vocabulary) for _ in range(deal.randint(1, 30)))
    base = [line() for _ in range(12)]
    hot = "the one line that very many of these documents share, as it stands"

    def variant(text):
        words = text.split()
        for _ in range(deal.randint(0, 3)):
            words[deal.randrange(len(words))] = deal.choice(vocabulary)
        return " ".join(words)

    rows = []
    for i in range(count):
        parts = [line() if deal.random() < 0.4 else variant(deal.choice(base)) for _ in range(deal.randint(1, 6))]
        if deal.random() < 0.7:
            parts.insert(deal.randint(0, len(parts)), hot.upper() if deal.random() < 0.3 else hot + "!" * deal.randint(0, 2))
        rows.append((i, "\n".join(parts) + ("\n" if deal.random() < 0.2 else "")))
    # repeated rows, nulls, blanks, a very long text
    rows += [(3, rows[3][1]), (100, None), (101, ""), (102, " \n\n "), (None, rows[1][1]), (103, "\n".join(base * 40)), (104, "x " * 40000 + "\n" + hot)]
    return rows


def plain_removed(rows, late):
    """{doc: removed} where late(earlier lines, line) tells whether a line goes; ranks are doc and line number."""
    places = sorted({(i, k): line for i, text in rows if i is not None and text is not None for k, line in enumerate(lines_of(text))}.items())
    removed, before = {}, []
    for (i, k), line in places:
        words = words_of(line)
        if words:
            if late(before, words):
                removed.setdefault(i, []).append(k)
            before.append(words)
    return removed


def jaccard_late(before, words):
    one = set(words)
    return any(100 * len(one & set(b)) >= 80 * len(one | set(b)) for b in before)


@pytest.mark.parametrize("seed, small", [(1, False), (2, True)])
def test_near_repeats(spark, monkeypatch, seed, small):
    if small:  # every way of joining takes part
        for name, value in (("MANY", 3), ("OFTEN", 6), ("ALWAYS", 25)):
            monkeypatch.setattr(line_join, name, value)
    rows = some_documents(seed)
    found = {r.doc_id: r.removed for r in line_join.near_repeats(docs(spark, rows).repartition(5)).collect()}
    assert found == plain_removed(rows, jaccard_late)


def test_open_line_after_late_ones(spark, monkeypatch):
    """A large region whose lines are all late by lines outside it, but for one that only its earliest line is similar to."""
    monkeypatch.setattr(line_join, "MANY", 3)
    some = lambda name: " ".join(f"{name}{i}" for i in range(8))
    rows = [(1, f"outside {some('c')}"), (2, f"outside region {some('c')}")]
    rows += [(3 + i, f"twin{i} {some('d')}") for i in range(5)] + [(10 + i, f"twin{i} region {some('d')}") for i in range(5)]
    rows += [(20 + i, f"twin{i} region {some('d')}") for i in range(5)] + [(50, f"open region {some('c')}")]
    # the words of some() are frequent, so they come last
    rows += [(100 + 20 * j + i, f"{name}x{i} {name}y{i} {name}z{i} {some(name)}") for j, name in enumerate("cd") for i in range(20)]
    expected = plain_removed(rows, jaccard_late)
    assert expected[2] == expected[50] == [0]
    assert {r.doc_id: r.removed for r in line_join.near_repeats(docs(spark, rows)).collect()} == expected


def test_places_of_unordered_documents(spark, monkeypatch):
    """A line met late in a task stands early in the corpus; a nearer line makes it late, and it makes another one late."""
    monkeypatch.setattr(line_join, "FEW", 1)
    common = " ".join(f"c{i}" for i in range(9))
    rows = [(500, f"{common} last"), (100, f"{common} other"), (10, f"{common} last"), (5, f"{common} last more")]
    rows += [(600 + i, f"last x{i} y{i} z{i} v{i}") for i in range(6)]  # which comes last in the order of tokens
    expected = {10: [0], 100: [0], 500: [0]}
    assert plain_removed(rows, jaccard_late) == expected
    assert {r.doc_id: r.removed for r in line_join.near_repeats(docs(spark, rows).coalesce(1)).collect()} == expected


def test_second_meeting_reads_few_documents(spark, monkeypatch):
    """Only the documents are read again in which a line's further candidates stand; rows meet in steps of any size."""
    read, prefixes = [], line_join._prefixes

    def counted(documents, *others, **more):
        read.append(documents.count())
        return prefixes(documents, *others, **more)

    for name, value in (("FEW", 1), ("AT_ONCE", 7), ("_prefixes", counted)):
        monkeypatch.setattr(line_join, name, value)
    # lines so long that their bits can't tell them apart, with words that other documents have oftener than theirs in common
    common = " ".join(f"c{i}" for i in range(300))
    own = [[f"v{j}x{i}" for i in range(100)] for j in range(4)]
    rows = [(1 + j, f"{common} {' '.join(own[j])}") for j in range(4)] + [(5, f"{common} {' '.join(own[3][:90])}")]
    rows += [(10 + 50 * k + j, " ".join(own[j // 10][10 * (j % 10) : 10 * (j % 10) + 10] + [f"y{k}x{i}" for i in range(5)])) for j in range(40) for k in range(6)]
    expected = plain_removed(rows, jaccard_late)
    assert {r.doc_id: r.removed for r in line_join.near_repeats(docs(spark, rows).repartition(3)).collect()} == expected
    assert expected == {5: [0]} and len(read) == 2 and read[0] == len(rows) and read[1] <= 5


@pytest.mark.parametrize("size", [10, 1])
def test_earliest_places(spark, monkeypatch, size):
    monkeypatch.setattr(line_join, "FEW", 1)
    rows = sorted(some_documents(5), key=lambda r: -(r[0] or 0))
    monkeypatch.setattr(line_join.rarity.Earliest.__init__, "__defaults__", (size,))
    found = {r.doc_id: r.removed for r in line_join.near_repeats(docs(spark, rows).coalesce(2)).collect()}
    assert found == plain_removed(rows, jaccard_late)


def test_lines_of_one_frequent_word(spark, monkeypatch):
    monkeypatch.setattr(line_join, "OFTEN", 6)
    rows = [(i, " ".join(["na"] * (5 + i))) for i in range(4)] + [(4, "na na na na ba"), (5, "na ba na ba ba na")]
    expected = plain_removed(rows, jaccard_late)
    assert expected == {1: [0], 2: [0], 3: [0], 5: [0]}
    assert {r.doc_id: r.removed for r in line_join.near_repeats(docs(spark, rows)).collect()} == expected
    assert {r.doc_id: r.removed for r in line_join.near_repeats(docs(spark, rows), percent=50).collect()} == expected | {4: [0]}


def test_previous_words_that_look_alike(spark):
    """Two lines whose words before the first common one have hashes equal in the upper 30 bits."""
    names = [f"v{i}" for i in range(200_000)]
    raw = np.frombuffer(" ".join(names).encode(), np.uint8)
    tokens = hashing.words(raw, np.array([0, len(raw)]))[0] >> np.uint64(24)
    order = np.argsort(tokens)
    alike = np.flatnonzero(np.diff(tokens[order] >> np.uint64(10)) == 0)
    one, two = (names[order[alike[0] + i]] for i in (0, 1))
    common = " ".join(f"c{i}" for i in range(8))
    rows = [(1, f"{one} region {common}"), (2, f"{two} region {common}")]
    rows += [(10 + i, f"region x{i} y{i} z{i} v{i}") for i in range(4)] + [(20 + i, f"s{i} t{i} u{i} {common}") for i in range(20)]
    expected = plain_removed(rows, jaccard_late)
    assert expected == {2: [0]}
    assert {r.doc_id: r.removed for r in line_join.near_repeats(docs(spark, rows)).collect()} == expected


def test_equal_lines(spark):
    rows = some_documents(3)
    found = {r.doc_id: r.removed for r in unit_dedup.repeated_units(docs(spark, rows).repartition(5)).collect()}
    assert found == plain_removed(rows, lambda before, words: words in before)


@pytest.mark.parametrize("remove", [unit_dedup.remove_repeated_units, line_join.remove_near_repeats])
def test_spans_are_of_the_original(spark, remove):
    rows = some_documents(4)
    texts = {i: t for i, t in rows if i is not None}
    frame = docs(spark, rows).withColumnRenamed("n", "kept")
    found = remove(frame)
    assert found.columns == [*frame.columns, "n_units", "n_removed", "kept_"]
    result = found.collect()
    assert len(result) == len(rows)
    for r in result:
        if r.doc_id is None:
            assert r.n_removed == 0
            continue
        text = texts[r.doc_id]
        if text is None:
            assert r.text is None and r.kept_ == [] and r.n_units == 0
            continue
        assert r.text == "".join(text[s:e] for s, e in r.kept_) and r.n_units == len(lines_of(text)) and r.kept == 3
    assert remove(frame.limit(0)).count() == 0


def test_paragraphs(spark):
    a, b = "one two three four five six\nand a second line here", "another paragraph, with enough words"
    rows = [(1, a + "\n\n" + b + "\n"), (2, b + "\n \n\n" + a.upper() + "\n\nnew words that nobody has written"), (3, "\n\n" + a)]
    found = {r.doc_id: r for r in unit_dedup.remove_repeated_units(docs(spark, rows), unit="paragraph").collect()}
    assert {i: r.n_units for i, r in found.items()} == {i: len(paragraphs_of(t)) for i, t in rows}
    assert found[1].n_removed == 0 and found[2].text == "new words that nobody has written" and found[3].text == "\n\n"


def shingles(text):
    words = tuple(re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)))
    if len(words) < 5:
        return {words} if words else set()
    return {words[i : i + 5] for i in range(len(words) - 4)}


def plain_components(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (i, x), (j, y) in combinations([s for s in sets if s[0] is not None and s[1]], 2):
        if 100 * len(x & y) >= 80 * len(x | y):
            low, high = sorted((root(i), root(j)))
            parent[high] = low
    return sorted(((i, len(x), None if i is None else root(i)) for i, x in sets), key=repr)


def near_copies(seed, words=60, copies=70):
    """A large group of variants of a text, chains, exact copies, a passage that many share, and odd texts."""
    deal = random.Random(seed)
    word = lambda: f"v{deal.randrange(4000)}"
    text = lambda n: [word() for _ in range(n)]
    base, passage, rows = text(words), text(25), []
    for i in range(copies):
        own = list(base)
        for _ in range(deal.randint(0, 3)):
            own[deal.randrange(len(own))] = word()
        rows.append((10 + i, " ".join(own)))
    chain = text(80)
    for i in range(12):  # each is linked to the next, the ends are far apart
        chain = chain[2:] + text(2)
        rows.append((300 - i, " ".join(chain)))
    rows += [(400 + i, " ".join(text(deal.randint(5, 40)) + passage + text(20))) for i in range(40)]
    rows += [(500 + i, " ".join(base).upper()) for i in range(30)]
    rows += [(600, None), (601, ""), (602, " \n"), (603, "one two"), (604, "One  TWO"), (605, "a b c d e f"), (606, "a b c d e f g h"), (607, "a b c d e f g h i"),
             (None, " ".join(base)), (10, rows[0][1]), (608, "z " * 30000), (609, "y " * 30000 + "x")]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_components(spark, seed):
    rows = near_copies(seed)
    found = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(docs(spark, rows).repartition(6)).collect()), key=repr)
    assert found == plain_components(rows)


def test_jaccard_of_nothing(spark):
    assert jaccard_join.jaccard_components(docs(spark, []).limit(0)).count() == 0
    assert [tuple(r) for r in jaccard_join.jaccard_components(docs(spark, [(1, None)])).collect()] == [(1, 0, 1)]


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (205, 200), (205, 203)]
    found = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {200: 200, 203: 200, 205: 200}


@pytest.mark.parametrize("repeats", [65_535, 65_536, 65_537])
def test_counts_in_one_step_do_not_wrap(spark, repeats):
    """A word that one text repeats more often than 16 bits hold is still frequent, so its lines still meet."""
    rows = [(1, "ab ab ab ab ab"), (2, "ab ab ab ab ab ab"), (3, " ".join(["ab"] * (repeats - 11)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert {r.doc_id for r in line_join.near_repeats(docs).collect()} == {2, 3}


def test_cells_saturate(spark):
    counts = rarity.CellCounts(18)
    cell = np.uint64(5) << np.uint64(64 - 18)
    counts.cells[5] = (1 << 31) + 7
    counts.add(np.array([cell, cell, cell + (np.uint64(1) << np.uint64(46))]))
    assert counts.cells[5] == (1 << 31) + 7 and counts.cells[6] == 1
    # the corpus adds up tasks beyond 32 bits; the level is the highest, not the lowest
    row = [(part, bytearray(blob)) for part, blob in counts.rows()]
    frame = spark.createDataFrame(row * 4, "part int, counts binary")
    levels = rarity.cell_levels(frame, logarithmic=True, bits=18).value
    assert levels[5] == 255 and levels[6] == rarity.code_of(4) and levels[7] == 0 and rarity.code_of(1 << 40) == 255


@pytest.mark.parametrize("few", [1, 2])
def test_lines_that_their_nearest_do_not_settle(spark, monkeypatch, few):
    """Near misses stand nearer by their bits than the line that makes one late; regions with more are met again."""
    monkeypatch.setattr(line_join, "FEW", few)
    draw = random.Random(few)
    words = [f"w{i}" for i in range(14)]
    rows = [(i, " ".join(draw.sample(words, 10))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    sets = [(i, set(t.split())) for i, t in rows]
    late = {i for i, x in sets for j, y in sets if j < i and 100 * len(x & y) >= 80 * len(x | y)}
    assert {r.doc_id for r in line_join.near_repeats(docs).collect()} == late


def test_sentences(spark):
    """Passages broken into lines differently; short sentences stay unless they are a line."""
    one = "Alpha beta gamma delta epsilon. Short one. Zeta eta theta iota kappa!\nOwn words of the first text here."
    two = "Alpha beta gamma\tdelta epsilon. Zeta eta theta iota kappa! Short one.\nNew words of the second text here.\nShort one."
    docs = spark.createDataFrame([(1, one), (2, two), (3, "Short one.\n"), (4, None), (5, "")], "doc_id long, text string")
    made = {r.doc_id: r for r in unit_dedup.remove_repeated_units(docs, unit="sentence").collect()}
    assert made[1].text == one and made[2].text == "Short one.\nNew words of the second text here.\nShort one."
    assert made[3].text == "" and made[4].text is None and made[5].text == ""
    assert made[2].n_removed == 2


def test_no_folder_but_a_shared_one(spark):
    class Conf:
        def __init__(self, master):
            self.master = master

        def get(self, key, default=None):
            return self.master if key == "spark.master" else default

    class Session:
        def __init__(self, master):
            self.conf = Conf(master)

    for master in ("yarn", "local-cluster[2,1,1024]", "spark://host:7077"):
        with pytest.raises(ValueError, match="checkpoint"):
            shared.shared_folder(Session(master))


@pytest.mark.parametrize("remove", [unit_dedup.remove_repeated_units, line_join.remove_near_repeats])
def test_texts_meet_their_removed_units_by_one_plan_at_any_size(spark, remove):
    docs = spark.createDataFrame([(i, "one line of words here\nown " + str(i)) for i in range(40)], "doc_id long, text string")
    plan = remove(docs)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_shares_tell_long_lines_apart():
    """Two sets that lack each other's 20 tokens: 64 bins alone hide more of them than 128 and 512."""
    rng = np.random.default_rng(5)
    shown = {shares: [] for shares in (1, 2, 8)}
    for _ in range(50):
        common, one, two = (rng.integers(0, 1 << 40, k, dtype=np.uint64) for k in (50, 10, 10))
        owner, tokens = np.repeat([0, 1], 60), np.concatenate([common, one, common, two])
        whole = line_join._parity(owner, tokens, 2)
        for shares, found in shown.items():
            parts = [line_join._parity(owner, tokens, 2, shares, i) for i in range(shares)]
            assert (np.bitwise_xor.reduce(parts) == whole).all()
            found.append(sum(int(np.bitwise_count(x[0] ^ x[1])) for x in parts))
            assert found[-1] <= 20
    # linked lines of 60 tokens differ in 13 at most
    assert np.mean(np.array(shown[2]) > 13) > 0.9 > np.mean(np.array(shown[1]) > 13)
    assert min(shown[8]) > 13
    assert line_join._SHARES >= 2 and len(line_join._lanes(line_join._SHARES_AGAIN)) == 7


def test_region_whose_sets_have_all_met(spark):
    """Sets that share the token before this one meet there; the rows stay, as their tokens count for pairs."""
    fields = "token long, key long, n int, place int, previous long, salt int"
    rows = [(7, 1, 50, 0, 0, 0), (7, 2, 50, 0, 0, 0), (8, 1, 50, 1, 7, 0), (8, 2, 50, 1, 7, 0), (9, 1, 50, 2, 8, 0), (9, 2, 50, 2, 8, 0), (9, 3, 50, 1, 5, 0), (5, 3, 50, 0, 0, 0)]
    found = jaccard_join._shared_tokens(spark.createDataFrame(rows, fields), 80).collect()
    assert {(r.token, r.key): r.fits for r in found} == {(7, 1): True, (7, 2): True, (8, 1): False, (8, 2): False, (9, 1): True, (9, 2): True, (9, 3): True}


def test_parities_of_sets():
    rng = np.random.default_rng(6)
    for size, apart in ((800, 100), (800, 400), (5, 2)):
        common, one, two = (rng.integers(0, 1 << 63, k, dtype=np.uint64) for k in (size - apart, apart, apart))
        x, y = (jaccard_join._parity(np.concatenate([common, z])) for z in (one, two))
        differ = int(np.bitwise_count((x ^ y).view(np.uint64)).sum())
        assert 0.8 * 2 * apart < differ <= 2 * apart
