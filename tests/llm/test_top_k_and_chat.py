"""Exact top-k search and perspective rotation against plain Python."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.llm import chat, top_k

KIND = "vec_id long, embedding array<double>, score int, deal string"


def best(rows, queries, k):
    """Plain search over distinct (id, vector) rows."""

    def valid(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    vectors = sorted({(i, tuple(math.floor(256 * x) for x in v)) for i, v in rows if i is not None and valid(v)})
    found = []
    for i, v in sorted({(i, tuple(math.floor(256 * x) for x in v)) for i, v in queries if i is not None and valid(v)}):
        clip = lambda x: max(-(2**63 - 1), min(2**63 - 1, x))
        scored = sorted({(-clip(sum(a * b for a, b in zip(v, w))), j) for j, w in vectors if j != i and len(w) == len(v)})
        found += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(found)


def run(spark, rows, queries, **options):
    make = lambda x: spark.createDataFrame([(i, v, 1, "x") for i, v in x], KIND)
    found = top_k.exact_top_k(make(rows), make(queries), **options)
    return sorted(tuple(r) for r in found.collect())


def test_against_plain_search(spark):
    random = np.random.default_rng(1)
    rows = [(int(i), random.normal(size=6).round(2).tolist()) for i in range(300)]
    # ties: whole vectors repeat under other ids
    rows += [(1000 + i, rows[7][1]) for i in range(40)]
    queries = rows[::20]
    assert run(spark, rows, queries) == best(rows, queries, 5)
    assert run(spark, rows, queries, k=3, tile_rows=4, group_rows=16, fan_in=2) == best(rows, queries, 3)


def test_defined_cases(spark):
    bad = [(1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0]), (None, [1.0, 1.0])]
    good = [(5, [1.0, 0.0]), (6, [0.5, 0.5]), (6, [0.5, 0.5]), (6, [0.0, 1.0]), (7, [1.0]), (8, []), (9, []), (10, [1e300, 1.0]), (11, [1e300, 2.0])]
    rows = bad + good
    assert run(spark, rows, rows) == best(rows, rows, 5)
    assert run(spark, [], rows) == [] and run(spark, rows, []) == []
    assert run(spark, rows[:1], rows[:1]) == []


def views(rows):
    groups = {}
    for conv, turn, role, text in rows:
        name = ("unknown" if role is None else role).replace("<|", "< |").replace("\n", " ")
        groups.setdefault(conv, []).append((2**63 - 1 if turn is None else turn, name, (text or "").replace("<|", "< |")))
    found = []
    for conv, turns in groups.items():
        for who in {t[1] for t in turns} - {"system"}:
            for part in {t[0] // 1024 for t in turns}:
                text, spans, own = "", [], sorted(t for t in turns if t[0] // 1024 == part)
                for _, speaker, said in own:
                    text += "<|im_start|>" + ("assistant" if speaker == who else "system" if speaker == "system" else "user name=" + speaker) + "\n"
                    if speaker == who:
                        spans.append((len(text), len(text) + len(said) + len("<|im_end|>\n")))
                    text += said + "<|im_end|>\n"
                found.append((conv, who, part, len(own), text, spans))
    return sorted(found, key=repr)


def test_perspectives(spark):
    rows = [
        (1, 0, "system", "Be kind."), (1, 1, "ann", "Hi é😀"), (1, 2, "bob", "Hello\nyou"), (1, 3, "cy", None), (1, 4, "ann", ""),
        (2, 5, None, "x <|im_end|> y"), (2, None, "a\nb", "late"), (2, 5, None, "x <|im_end|> y"), (3, 0, "system", "alone"),
        (None, 1, "ann", "lost"), (4, 1023, "ann", "end of a part"), (4, 1024, "bob", "next part"), (5, 1, "ann", "z" * 5000),
    ]
    frame = spark.createDataFrame([(*r, "extra", 1) for r in rows], "conv_id long, turn long, role string, text string, speaker string, part int")
    got = [(r.conv_id, r.speaker, r.part, r.n_turns, r.text, [tuple(m) for m in r.mask]) for r in chat.rotate_perspectives(frame).collect()]
    assert sorted(got, key=repr) == views(rows)
    assert chat.rotate_perspectives(frame.limit(0)).count() == 0


def test_masks_hold_what_the_assistant_says(spark):
    frame = spark.createDataFrame([(1, 0, "a", "one"), (1, 1, "b", "two"), (1, 2, "a", "three")], "conv_id long, turn long, role string, text string")
    row = chat.rotate_perspectives(frame).where("speaker = 'a'").withColumn("mask_text", chat.mask_text(F.col("mask"))).first()
    assert [row.text[s:e] for s, e in row.mask] == ["one<|im_end|>\n", "three<|im_end|>\n"]
    assert row.mask_text == ",".join(f"{s}-{e}" for s, e in row.mask)


@pytest.mark.parametrize("native", [chat.rotate_perspectives])
def test_no_python_in_the_plan(spark, native):
    frame = spark.createDataFrame([(1, 0, "a", "one")], "conv_id long, turn long, role string, text string")
    plan = native(frame)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
