"""The conversation trie, language identification and spelling variants against plain code."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.llm import language, queries, spelling, turn_trie

WORD = re.compile("[^\x20\x09-\x0d]+")


# ---------------------------------------------------------------- trie


def plain_trie(rows, rebuild=True):
    conversations = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            text = text or ""
            conversations[conv].append(((turn is not None, turn or 0, role or "", hashlib.md5(text.encode()).hexdigest()), (role or "", text)))
    own = {c: [t for _, t in sorted(v)] for c, v in conversations.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4 if rebuild else 0
        built[c] = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children, leaves, saved, ends = Counter(), Counter(), Counter(), defaultdict(list)
    for k in members:
        if k:
            children[k[:-1]] += 1
    for k, m in members.items():
        words = len(WORD.findall(k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            leaves[k[:d]] += children[k] == 0
            saved[k[:d]] += (len(m) - 1) * words
    for c, k in built.items():
        ends[k].append(c)
    digest = lambda k: hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest()
    return sorted((min(m), len(k), min(members[k[:-1]]) if k else -1, len(m), children[k], leaves[k], saved[k], digest(k)) for k, m in members.items())


def rows_of(frame):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert frame.columns == names
    return sorted(tuple(-1 if x is None else x for x in r) for r in frame.collect())


def talks():
    """Copies of one conversation by the hundred, ties of turns, nulls, empty texts, one long conversation, absent openers."""
    draw, rows = random.Random(3), []
    for c in range(40, 340):
        kind = c % 3
        for turn in range(draw.randint(1, 6)):
            text = f"turn {turn}" if kind == 0 else draw.choice(["a b", "a  b", "", None, "c", "x " * 300])
            rows.append((c, turn, ["user", "assistant", None][turn % 3], text))
    rows += [(7, t // 2, "user", str(t % 5)) for t in range(60)]  # two turns of each number
    rows += [(33, None, None, None), (33, 1, "user", "later"), (None, 1, "user", "no conversation"), (21, 0, "user", "alone"), (21, 0, "user", "alone")]
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("few", [0, 40, 10**6])
@pytest.mark.parametrize("rebuild", [True, False])
def test_trie(spark, few, rebuild):
    """All depths in Spark, some, and all in one task give the same nodes."""
    rows = talks()
    frame = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", depth string").repartition(7)
    turns = turn_trie.turns_of(frame)
    turns = turn_trie.shared_openings(turns) if rebuild else turns
    assert rows_of(turn_trie.prefix_trie(turns, frame, few)) == plain_trie(rows, rebuild)


def test_trie_of_silent_conversations_and_of_nothing(spark):
    """A conversation whose only turns are dropped with its absent opener ends at the root."""
    silent = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 >= 1)
    rows = [(silent, 0, "user", "hello")]
    frame = spark.createDataFrame(rows, SCHEMA)
    found = rows_of(turn_trie.prefix_trie(turn_trie.shared_openings(turn_trie.turns_of(frame)), frame))
    assert found == plain_trie(rows) and len(found) == 1 and found[0][1] == 0
    nothing = frame.limit(0)
    assert turn_trie.prefix_trie(turn_trie.shared_openings(turn_trie.turns_of(nothing)), nothing).count() == 0


def test_where_few_turns_are_left():
    assert turn_trie._where_few([(3, 10), (5, 2)], 3) == 4  # two of depth 5
    assert turn_trie._where_few([(3, 10), (5, 2)], 4) == 3
    assert turn_trie._where_few([(3, 10), (5, 2)], 0) == 5
    assert turn_trie._where_few([(3, 10), (5, 2)], 10**6) == 0
    assert turn_trie._where_few([], 5) == 0


def test_digests_of_many_ends(spark):
    """More ids than a piece holds, negative ones among them, in numeric order."""
    rows = [(c, 0, "user", "same") for c in range(-400, 900, 3)]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(turn_trie.prefix_trie(turn_trie.turns_of(frame), frame, 0)) == plain_trie(rows, rebuild=False)


# ---------------------------------------------------------------- language


def plain_grams(text):
    if not text:
        return set()
    letters = "".join(c.lower() if c.isalpha() and len(c.lower()) == 1 else c if c.isalpha() else " " for c in text)
    letters = " " + " ".join(letters.split()) + " " if letters.strip() else " "
    return {letters[i : i + n] for n in (1, 2, 3) for i in range(len(letters) - n + 1)} if letters != " " else set()


def number(gram):
    found = 0
    for c in gram:
        found = found << 21 | ord(c)
    return found


TEXTS = ["", None, "a", "Hello, world!", "  12 34 ", "naïve Café — 日本語", "x" * 5000, "ÄÖÜ ß İ", "tab\tand\nline", "a1b2c3"]


@pytest.mark.parametrize("text", TEXTS)
def test_grams(text):
    assert sorted(language.grams_of(text).tolist()) == sorted(number(g) for g in plain_grams(text))


def test_kernel_ridge_regression_is_the_plain_one():
    """With every text a landmark, Nyström features give exactly the kernel ridge regression of the whole matrix."""
    texts = ["the cat sat on the mat", "the dog and the hat", "a cat and a rat that sat", "der Hund und die Katze", "die Ratte und der Hut", "das ist der Hund"]
    labels, ridge = ["en"] * 3 + ["de"] * 3, 1e-3
    sets = [language.grams_of(t) for t in texts]
    model = language.fit(sets, labels, landmarks_of_each=3, ridge=ridge)
    # landmarks stand in the order of languages
    order = [3, 4, 5, 0, 1, 2]
    plain = [plain_grams(t) for t in texts]
    kernel = np.array([[len(a & b) / (len(a) * len(b)) ** 0.5 for b in plain] for a in plain])
    assert np.allclose(np.concatenate(list(language.kernels(model, sets))), kernel[:, order], atol=1e-6)
    # ridge regression with a free constant: the kernel system bordered by ones
    n = len(texts)
    wanted = np.array([[1.0 if lab == lang else -1.0 for lang in model.languages] for lab in labels])
    system = np.block([[kernel + ridge * n * np.eye(n), np.ones((n, 1))], [np.ones((1, n)), np.zeros((1, 1))]])
    solved = np.linalg.solve(system, np.vstack([wanted, np.zeros((1, 2))]))
    values = kernel @ solved[:-1] + solved[-1]
    ours = np.concatenate([k.astype(float) @ model.weights[:-1] + model.weights[-1] for k in language.kernels(model, sets)])
    assert np.allclose(ours, values, atol=1e-3)
    langs, scores = language.predict(model, [*sets, language.grams_of("12 3")])
    assert langs == [*labels, "und"] and all(0 <= s <= 1 for s in scores) and scores[-1] == 0


def test_languages_held_out(spark):
    found = queries.op12_language_kernels(spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", "text")
    rows = found.join(truth, "doc_id").collect()
    assert len(rows) == truth.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out and r.lang and any(c.isalpha() for c in r.text or "")]
    assert len(held) > 200 and sum(r.lang == r.lang_pred for r in held) / len(held) > 0.98


def test_languages_of_odd_tables(spark):
    """Nulls, no letters, repeated rows, clashing names, one language only, none at all."""
    rows = [(1, "the cat", "en", "kept"), (2, "der Hund", "de", "kept"), (2, "der Hund", "de", "kept"), (None, "le chat", None, "kept"), (4, None, "en", "kept"), (5, "12 !", "en", "kept"), (6, "", "de", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    model = language.fit_languages(frame, F.lit(True))
    assert model.languages == ["de", "en"]
    made = language.identify(frame, model)
    assert made.columns == ["doc_id", "text", "lang", "score", "lang_pred", "score_"] and made.count() == len(rows)
    by_text = {r.text: (r.lang_pred, r.score_) for r in made.collect()}
    assert by_text["the cat"][0] == "en" and by_text["der Hund"][0] == "de" and {by_text[t] for t in (None, "12 !", "")} == {("und", 0.0)}
    one = language.fit_languages(frame.where("lang = 'en'"), F.lit(True))
    assert {r.lang_pred for r in language.identify(frame, one).collect()} == {"en", "und"}
    none = language.fit_languages(frame, F.lit(False))
    assert none.languages == [] and {r.lang_pred for r in language.identify(frame, none).collect()} == {"und"}
    assert language.identify(frame.limit(0), model).count() == 0


def test_the_sample_is_bounded(spark):
    rows = [(i, f"text number {i} of " + ("the the" if i % 2 else "und und"), ["de", "en"][i % 2]) for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit_languages(frame, F.lit(True), of_each=5, landmarks_of_each=3)
    assert model.presence.shape[1] == 6
    assert language.fit_languages(frame, F.lit(True), languages=1).languages == ["de"]


# ---------------------------------------------------------------- spelling


def plain_counts(rows, every):
    total = Counter()
    for key, text in rows:
        for run in re.findall("[a-zÀ-ÿ]+", (text or "").translate({i: i + 32 for i in range(65, 91)})):
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if w}


def plain_groups(words):
    """By the definition of one edit, over all pairs."""

    def near(x, y):
        if len(x) > len(y):
            x, y = y, x
        if len(x) == len(y):
            return sum(a != b for a, b in zip(x, y)) == 1
        return len(y) == len(x) + 1 and any(y[:i] + y[i + 1 :] == x for i in range(len(y)))

    near_of = {w: [x for x in words if x != w and near(w, x)] for w in words}
    form = {}
    for w, found in near_of.items():
        best = min(found, key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= 2 * words[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), words[w], len(near_of[w]), words.get(form.get(w))) for w in words}


def made_words():
    draw, words = random.Random(8), {}
    letters = "abéz"
    for _ in range(260):
        words["".join(draw.choice(letters) for _ in range(draw.randint(5, 9)))] = draw.choice([3, 4, 7, 16, 60])
    for i in range(6):  # a chain of forms, and words that repeat a letter
        words["chain" + "x" * i] = 3 * 2**i
        words["aaaaa" + "a" * i] = 3 + i
    words["é" * 300], words["é" * 299 + "z"], words["日本語漢字"], words["日本語漢"], words["日本語漢字x"] = 5, 50, 9, 20, 3
    return words


@pytest.mark.parametrize("tile", [3, 50, 4096])
def test_variant_groups(spark, tile):
    """Groups larger than a tile are dealt out by pairs of blocks; each pair is found once."""
    words = made_words()
    frame = spark.createDataFrame(list(words.items()), "word string, n long").repartition(6)
    found = spelling.variant_groups(frame, tile=tile)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {tuple(r) for r in found.collect()} == plain_groups(words)


def test_a_group_of_many_words(spark):
    """Most words agree in two thirds, more than a dense block and a tile hold."""
    words = {f"stem{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}": 3 + i % 5 for i in range(900)}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    assert {tuple(r) for r in spelling.variant_groups(frame, tile=100).collect()} == plain_groups(words)


@pytest.mark.parametrize("every", [None, 3, 97])
def test_word_counts(spark, every, monkeypatch):
    monkeypatch.setattr(spelling, "HELD", 4)
    rows = [(1, "Straße STRASSE été-ÉTÉ a1b"), (1, "Straße STRASSE été-ÉTÉ a1b"), (2, None), (3, ""), (None, "null id 日本 x"), (4, "word " * 500 + "w" * 20000)]
    frame = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, n int")
    assert {r.word: r.n for r in spelling.word_counts(frame, every).collect()} == plain_counts(rows, every)


def test_variants_of_nothing(spark):
    nothing = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.spelling_variants(nothing, 97).count() == 0
    with pytest.raises(ValueError):
        spelling.variant_groups(spark.createDataFrame([], "word string, n long"), ratio=1)
