"""Base statistics against plain Python, MCD against numpy, and the defined cases."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.llm import quality


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    met = defaultdict(list)
    for i in range(len(words) - 4):
        met[tuple(words[i : i + 5])].append(i)
    covered = {i + k for places in met.values() if len(places) > 1 for i in places for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), len(lines) - len(set(lines)), len(covered))


def some_texts(count=120, seed=5):
    deal = random.Random(seed)
    texts = [None, "", " \n\t ", "a", "a b c d e a b c d e", "x y z w v x y z w v x y z w v", "l\nl\n\n \nl", "é ü # $%", "\n", "w " * 30000]
    for _ in range(count):
        texts.append("".join(deal.choice(["a", "b", "cc", "#", "ü", "<"]) + deal.choice([" ", " ", " ", "\n", "\t", "", "\x0b"]) for _ in range(deal.randint(0, 60))))
    return texts


@pytest.fixture(scope="module")
def judged(spark):
    rows = [(i, t, ["en", "de", None][i % 3], None if i % 7 else "s", "mine", 5) for i, t in enumerate(some_texts())]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words string, v0 int")
    return rows, {r.doc_id: r for r in quality.quality_rules(frame, least_group=20).collect()}


def test_base_statistics(judged):
    rows, found = judged
    assert len(found) == len(rows)
    for i, text, *_ in rows:
        expected = plain(text)
        assert tuple(found[i][name] for name in quality.Base._fields) == expected
        failed = expected[0] < 10 or 100 * expected[5] > 20 * expected[0]
        assert found[i].base_failed == failed and not (failed and found[i].kept)


def test_outliers_go_and_others_stay(spark):
    deal = random.Random(2)
    word = lambda: "".join(deal.choice("abcdefghij") for _ in range(deal.randint(2, 8)))
    rows = [(i, " ".join(word() for _ in range(deal.randint(80, 160))), "en", "hot" if i % 3 else "other") for i in range(400)]
    bad = [(1000 + i, " ".join(word() + "###$$$" for _ in range(100)), "en", "hot") for i in range(40)]
    kept = {r.doc_id for r in quality.quality_rules(spark.createDataFrame(rows + bad, "doc_id long, text string, lang string, source string")).where("kept").collect()}
    assert kept == {r[0] for r in rows}


def numpy_mcd(v, subset, steps):
    """The same estimator with numpy, for one group."""
    floors = np.array(list(quality.PARTS.values())) * quality.UNIT
    middle = np.median(v, axis=0)
    wide = np.maximum(1.4826 * np.median(np.abs(v - middle), axis=0), floors)
    inside = lambda d: np.floor(70 * np.log2(1 + 64 * d))

    def estimate(x):
        m = x.mean(axis=0)
        return m, (x.T @ x / len(x) - np.outer(m, m) + np.diag(floors**2)) / quality.UNIT**2

    def distance(m, c):
        z = (v - m) / quality.UNIT
        return (z @ np.linalg.inv(c) * z).sum(axis=1)

    starts = [(middle, np.diag(wide**2) / quality.UNIT**2), estimate(np.round(middle + wide * np.tanh((v - middle) / wide)))]
    ends = []
    for m, c in starts:
        for _ in range(steps):
            b = inside(distance(m, c))
            m, c = estimate(v[b <= np.quantile(b, subset)])
        ends.append((np.linalg.slogdet(c)[1], m, c))
    _, m, c = min(ends, key=lambda e: e[0])
    d = distance(m, c)
    return d / max(1.0, (2 ** (np.median(inside(d)) / 70) - 1) / 64 / quality.CHI_MIDDLE)


def test_mcd_is_numpys(spark):
    random_ = np.random.default_rng(4)
    v = (random_.multivariate_normal(np.zeros(5), np.diag([1, 0.2, 0.1, 0.3, 0.2]) + 0.1, 500) * quality.UNIT).round().astype(int)
    v[:60] += np.array([9, 3, 3, 3, 3]) * quality.UNIT
    rows = spark.createDataFrame([(*x, "=en", "=s") for x in v.tolist()], ", ".join(f"v{i} long" for i in range(5)) + ", g_lang string, g_source string")
    estimate = quality.mcd(rows, 0.75, 4)
    inverse = [[F.col(f"i{i}{j}") for j in range(i + 1)] for i in range(5)]
    both = rows.join(estimate, ["g_lang", "g_source"]).withColumn("d", quality._distance([F.col(f"m{i}") for i in range(5)], inverse) / F.col("scale"))
    found = {tuple(r[f"v{i}"] for i in range(5)): r.d for r in both.collect()}
    for x, d in zip(v.tolist(), numpy_mcd(v.astype(float), 0.75, 4)):
        assert found[tuple(x)] == pytest.approx(d, rel=1e-6)


def test_empty_table_and_no_python(spark):
    frame = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert quality.quality_rules(frame).count() == 0
    plan = frame.select(quality.base_statistics(F.col("text")))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
