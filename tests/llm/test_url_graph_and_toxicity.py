"""Host graph against plain propagation, and the classifier chain's accuracy on held-out documents."""

from __future__ import annotations

import math
import random
import re

import pyarrow as pa
import pytest

from tablewright.llm import toxicity, url_graph
from tablewright.llm.url_graph import ONE, Rule

RULES = [Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/")]
LOWER = {i: i + 32 for i in range(65, 91)}


def split(url):
    if url is None or "://" not in url:
        return "", ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
    return host.translate(LOWER), path


def rule_of(host, path):
    fit = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fit, key=lambda r: len(r.host + r.path), default=None)
    return (best.host + best.path, best.verdict) if best else (None, None)


def plain(pages, rounds=20, damping=0.85, threshold=0.5):
    rows = [(i, *split(u), h) for i, u, h in pages]
    hosts, links = {}, {}
    for _, host, path, html in rows:
        if host:
            hosts.setdefault(host, []).append(rule_of(host, path)[1])
            for target in re.findall(url_graph.LINK, html or ""):
                target = target.translate(LOWER)
                if target != host:
                    links[host, target] = links.get((host, target), 0) + 1
    out, into = {}, {}
    for (a, b), n in links.items():
        out[a], into[b] = out.get(a, 0) + n, into.get(b, 0) + n
    base = {h: tuple(math.floor((1 - damping) * math.floor(float(ONE) * v.count(w) / len(v))) for w in ("allow", "block")) for h, v in hosts.items()}
    scores = dict(base)
    for _ in range(rounds if links else 0):
        new = {h: list(s) for h, s in base.items()}
        for (a, b), n in links.items():
            if a in scores:
                new.setdefault(b, [0, 0])[0] += math.floor(damping * scores[a][0] * n / out[a])
            if b in scores:
                new.setdefault(a, [0, 0])[1] += math.floor(damping * scores[b][1] * n / into[b])
        scores = {h: tuple(s) for h, s in new.items()}
    limit = int(threshold * (1 - damping) * ONE)
    found = []
    for i, host, path, _ in rows:
        rule, verdict = rule_of(host, path)
        trust, distrust = scores.get(host, (0, 0))
        found.append((i, host, path, rule, verdict or ("block" if distrust - trust >= limit else "allow"), trust, distrust))
    return sorted(found, key=repr)


def judged(spark, pages):
    frame = spark.createDataFrame([(*p, "x", 1) for p in pages], "page_id long, url string, html string, host string, trust int")
    return sorted((tuple(r) for r in url_graph.judge_urls(frame, RULES).collect()), key=repr)


def test_propagation(spark):
    deal = random.Random(1)
    hosts = [f"h{i}.{top}" for i in range(25) for top in ("example.com", "example.org", "spam.net", "else.info")]
    pages = []
    for i in range(400):
        html = "".join(f'<a class="x" href="http://{deal.choice(hosts)}/p">l</a><a href="/own">o</a>' for _ in range(deal.randint(0, 4)))
        pages.append((i, f"https://{deal.choice(hosts)}/{deal.choice(['en', 'de', 'fr'])}/{i}", html))
    # a hot host, and one whose links all lead to blocked hosts
    pages += [(1000 + i, "https://hot.else.info/a", '<A HREF=//H1.Spam.net/x>') for i in range(200)]
    result = judged(spark, pages)
    assert result == plain(pages)
    assert {r[4] for r in result if r[3] is None} == {"allow", "block"}


def test_odd_urls(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://EXAMPLE.NET/en/x?q#f", "http://net", "http://net/", "x://a.net?/en/", "http://xnet/", "http://a.b.org/fr/#x", "http://example.com/de", "http://example.com/de/", "a://b://c", "http://ÄB.org/fr/", "http://x\ny.org/fr/z"]
    pages = [(i, u, None) for i, u in enumerate(urls)] + [(4, urls[4], ""), (None, "http://a.org/fr/", "<a href='http://b.net/'>")]
    assert judged(spark, pages) == plain(pages)
    assert judged(spark, []) == []


def corpus(count, seed):
    deal = random.Random(seed)
    bad, junk = ["stupid", "trash", "idiot"], ["qqqq", "zzzz"]
    rows, labels = [], []
    for i in range(count):
        words = [f"w{deal.randrange(500)}" for _ in range(deal.randint(5, 120))]
        low, toxic = deal.random() < 0.2, deal.random() < 0.3
        for mark, words_of in ((low, junk), (toxic, bad)):
            if mark:
                for _ in range(2):
                    words.insert(deal.randrange(len(words)), deal.choice(words_of).capitalize() + ",")
        rows.append((i, " ".join(words), "en"))
        labels.append((i, int(not low), int(toxic)))
    return rows, labels


CATEGORIES = {"low_quality": "quality = 0", "toxic": "toxic = 1"}
DOCS, LABELS = "doc_id long, text string, p_toxic string", "doc_id long, quality int, toxic int"


def test_held_out_accuracy(spark):
    rows, labels = corpus(900, 1)
    documents = spark.createDataFrame(rows + [(5000, None, "en"), (5001, "", "en"), (5002, "stupid " * 30000, "en"), (None, "trash", "en")], DOCS)
    known = [x for x in labels if x[0] % 3] + [(1, 1, None), (None, 1, 1), (99999, 1, 1), labels[1]]
    chain = toxicity.fit_chain(documents, spark.createDataFrame(known, LABELS), CATEGORIES)
    again = toxicity.fit_chain(documents.repartition(3), spark.createDataFrame(known, LABELS), CATEGORIES)
    assert chain == again and chain.categories == ("low_quality", "toxic") and len(chain.chained[1]) == 1
    scored = toxicity.score(documents, chain)
    assert scored.columns == [*documents.columns, "p_low_quality", "p_toxic_"]
    p = {r.doc_id: r for r in scored.collect()}
    held = [x for x in labels if x[0] % 3 == 0]
    assert sum((p[i].p_toxic_ >= 0.5) == bool(t) for i, _, t in held) >= 0.97 * len(held)
    assert sum((p[i].p_low_quality >= 0.5) == (q == 0) for i, q, _ in held) >= 0.97 * len(held)
    assert p[5000].p_toxic_ == p[5001].p_toxic_ < 0.5 < p[5002].p_toxic_
    kept = toxicity.reject_toxic(documents, chain)
    assert kept.columns == documents.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in p.items() if r.p_toxic_ < 0.5}


@pytest.mark.parametrize("labels", [[], [(0, 1, 0), (1, 1, 0)]])
def test_without_examples_nothing_is_rejected(spark, labels):
    rows, _ = corpus(20, 2)
    documents = spark.createDataFrame(rows, DOCS)
    chain = toxicity.fit_chain(documents, spark.createDataFrame(labels, LABELS), CATEGORIES)
    assert toxicity.reject_toxic(documents, chain).count() == 20
    assert toxicity.score(documents.limit(0), chain).count() == 0


def test_out_of_fold():
    """A category that is only told by the one before it is learned through the chain."""
    import numpy as np

    random_ = np.random.default_rng(1)
    first = random_.random(400) < 0.5
    rows = [np.unique(np.concatenate([random_.integers(10, 2000, 5), np.full(int(f), 3 + random_.integers(0, 3))])) for f in first]
    truth = np.column_stack([first, first]).astype(float)
    chain = toxicity.train_chain(rows, truth, np.arange(400) % 3, ("one", "two"), 3)
    assert chain.chained[1][0] > 0.1


def test_labels_that_repeat_an_id(spark):
    """Of two rows for one document a whole one counts, and a document that comes twice is one example."""
    texts = [(i, f"word{i % 7} " + ("bad stuff here" if i % 2 else "good news today")) for i in range(200)]
    docs = spark.createDataFrame(texts + texts[:150] * 3, "doc_id long, text string")
    rows = [(i, 0, i % 2) for i in range(200)] + [(i, 1, 0) for i in range(50)]
    labels = spark.createDataFrame(rows, "doc_id long, a int, b int")
    both = toxicity.fit_chain(docs, labels, {"a": "a = 1", "b": "b = 1"})
    # as if the mixed row (1, 1) never was
    chosen = {}
    for i, a, b in rows:
        chosen[i] = max(chosen.get(i, (0, 0)), (a, b))
    single = spark.createDataFrame([(i, a, b) for i, (a, b) in chosen.items()], "doc_id long, a int, b int")
    once = spark.createDataFrame(texts, "doc_id long, text string")
    plain = toxicity.fit_chain(once, single, {"a": "a = 1", "b": "b = 1"})
    assert both == plain


def test_fit_and_score_are_the_plain_ones(spark):
    """One category, few words: the weights solve the penalised likelihood's own equations, and scores follow from them."""
    draw = random.Random(2)
    texts = [(i, " ".join(draw.choice(["ill", "vile", "mean"] if i % 2 else ["calm", "kind", "fair"]) if draw.random() < 0.8 else "the" for _ in range(6))) for i in range(300)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 2 and i % 10 != 1 or i % 20 == 0)) for i in range(300)], "doc_id long, y int")
    chain = toxicity.fit_chain(docs, labels, {"y": "y = 1"})
    truth = {r.doc_id: r.y for r in labels.collect()}
    weight = {w: v for w, v in chain.words[0].items()}
    (part,) = toxicity.word_sets(pa.array([t for _, t in texts]))
    _, _, owner, word = part
    sets = [set() for _ in texts]
    for o, w in zip(owner.tolist(), word.tolist()):
        sets[o].add(w)
    odds = [chain.bias[0] + sum(weight.get(w, 0) for w in s) for s in sets]
    p = [1 / (1 + math.exp(-o)) for o in odds]
    # gradient of the log-likelihood less the ridge is nothing in every direction
    for w, v in weight.items():
        assert abs(sum(truth[i] - p[i] for i in range(300) if w in sets[i]) - 0.1 * v) < 1e-3
    assert abs(sum(truth[i] - p[i] for i in range(300)) - 1e-3 * chain.bias[0]) < 1e-3
    scored = {r.doc_id: r.p_y for r in toxicity.score(docs, chain).collect()}
    assert all(abs(scored[i] - p[i]) < 1e-9 for i in range(300))
