"""Toxicity by a classifier chain: categories in order, each a linear model over words and the earlier categories' probabilities.

A later model must see in training what it will see in use, so the earlier probabilities it learns from are out of fold:
a model trained on the other folds gives them. Training reads a bounded sample of labelled documents and runs in one task;
what comes out, a few hundred weights for each category, is small whatever the corpus. Scoring reads each text once.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from . import hashing
from .shared import unused
from .unit_dedup import PUNCTUATION

#: Words are told apart by so many bits of their hash.
WORD_BITS = 22


class Chain(NamedTuple):
    """A trained chain: for each category a bias, weights of earlier categories' log-odds, and weights of words."""

    categories: tuple[str, ...]
    bias: list[float]
    chained: list[list[float]]
    words: list[dict[int, float]]


def word_sets(texts: pa.Array):
    """(owner, word) arrays for texts a step at a time, with the step's first text: each text's distinct words, ordered."""
    raw, offsets = hashing.buffers(texts)
    for start, stop in hashing.steps(offsets):
        part, ends = raw[offsets[start] : offsets[stop]], offsets[start : stop + 1] - offsets[start]
        words, _, _, first = hashing.words(part, ends, PUNCTUATION)
        owner = np.repeat(np.arange(stop - start), np.diff(first))
        yield start, stop, owner, (words >> np.uint64(64 - WORD_BITS)).astype(np.int64)


def _fit(rows: list[np.ndarray], more: np.ndarray, truth: np.ndarray, features: int, ridge: float = 0.1, rounds: int = 12):
    """(bias, weights of more, {word: weight}): a ridge logistic regression by Newton's steps over the most telling words."""
    total, yes = len(truth), truth.sum()
    if not total or yes in (0, total):
        rate = (yes + 0.5) / (total + 1)
        return float(np.log(rate / (1 - rate))) - 3 * (yes == 0), np.zeros(more.shape[1]), {}
    owner = np.repeat(np.arange(total), [len(r) for r in rows])
    word = np.concatenate(rows)
    names, index = np.unique(word, return_inverse=True)
    met = np.bincount(index, minlength=len(names))
    in_yes = np.bincount(index, weights=truth[owner].astype(float), minlength=len(names))
    # the usual chi-square of a word against the category
    a, b = in_yes, met - in_yes
    c, d = yes - a, total - yes - b
    score = total * (a * d - b * c) ** 2 / np.maximum((a + b) * (c + d) * yes * (total - yes), 1)
    score[met < 3] = 0
    chosen = np.sort(np.lexsort((names, -score))[:features])
    chosen = chosen[score[chosen] > 15]
    column = np.full(len(names), -1)
    column[chosen] = np.arange(len(chosen))
    x = np.zeros((total, len(chosen) + more.shape[1] + 1))
    keep = column[index] >= 0
    x[owner[keep], column[index][keep]] = 1
    x[:, len(chosen) : -1] = more
    x[:, -1] = 1
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (truth - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    n = len(chosen)
    return float(w[-1]), w[n:-1], dict(zip(names[chosen].tolist(), w[:n].tolist()))


def _odds(rows: list[np.ndarray], more: np.ndarray, model) -> np.ndarray:
    bias, chained, words = model
    own = np.array([sum(words[k] for k in row.tolist() if k in words) for row in rows])
    return np.clip(bias + more @ chained + own, -30, 30)


def train_chain(rows: list[np.ndarray], truth: np.ndarray, fold: np.ndarray, categories: tuple[str, ...], features: int) -> Chain:
    """The chain for word sets, labels (a column for each category) and fold numbers."""
    earlier = np.zeros((len(rows), 0))
    models = []
    for j in range(len(categories)):
        held = np.zeros(len(rows))
        for k in np.unique(fold):
            on, off = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
            model = _fit([rows[i] for i in on], earlier[on], truth[on, j], features)
            held[off] = _odds([rows[i] for i in off], earlier[off], model)
        models.append(_fit(rows, earlier, truth[:, j], features))
        # log-odds carry a probability without its flat ends
        earlier = np.column_stack([earlier, held])
    return Chain(categories, [m[0] for m in models], [m[1].tolist() for m in models], [m[2] for m in models])


def fit_chain(
    documents: DataFrame,
    labels: DataFrame,
    categories: dict[str, str],
    id_column: str = "doc_id",
    text_column: str = "text",
    rows_of_each: int = 2500,
    folds: int = 3,
    features: int = 400,
) -> Chain:
    """Train on labels (id and what the categories' SQL conditions read), in the order of ``categories``.

    The sample is bounded: at most rows_of_each labelled rows for each combination of categories, those whose ids hash
    lowest. Labels without id or with a null condition, and of documents that are missing or have a null text, are left
    out; of labels that repeat an id the one with the most counts (in the order of the categories), of documents that do
    the one with the smallest text. Without any labelled row every category is judged improbable.
    """
    names = tuple(categories)
    marks = labels.select(F.col(id_column).cast("long").alias("id"), *(F.expr(sql).cast("int").alias(f"is_{k}") for k, sql in enumerate(categories.values())))
    kinds = [f"is_{k}" for k in range(len(names))]
    # a whole row of labels, so that no mix of two rows arises
    marks = marks.na.drop().groupBy("id").agg(F.max(F.struct(*kinds)).alias("of")).select("id", "of.*").withColumn("order", F.xxhash64("id"))
    parts = None
    for combination in range(2 ** len(names)):
        wanted = marks
        for k in range(len(names)):
            wanted = wanted.where(F.col(f"is_{k}") == (combination >> k & 1))
        wanted = wanted.orderBy("order", "id").limit(rows_of_each)
        parts = wanted if parts is None else parts.unionAll(wanted)
    # the sample's size is bounded by its definition, so it may be broadcast
    texts = documents.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text")).where("text IS NOT NULL")
    labelled = texts.join(F.broadcast(parts), "id").groupBy("id", "order", *kinds).agg(F.min("text").alias("text"))
    where = labelled.columns.index("text")
    schema = pa.schema([("id", pa.int64()), ("order", pa.int64()), *((k, pa.int32()) for k in kinds), ("words", pa.list_(pa.int64()))])

    def featurise(batches):
        for batch in batches:
            for start, stop, owner, word in word_sets(batch.column(where)):
                both = np.unique(owner << WORD_BITS | word)
                bounds = np.searchsorted(both, np.arange(stop - start + 1) << WORD_BITS)
                sets = [both[a:b] & ((1 << WORD_BITS) - 1) for a, b in zip(bounds[:-1], bounds[1:])]
                rest = [c.slice(start, stop - start) for c in batch.columns[:where]]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(sets, pa.list_(pa.int64()))], schema=schema)

    def train(table: pa.Table) -> pa.Table:
        table = table.sort_by([("order", "ascending"), ("id", "ascending")])
        rows = [np.array(x, np.int64) for x in table.column("words").to_pylist()]
        truth = np.column_stack([table.column(k).to_numpy() for k in kinds]).astype(float)
        chain = train_chain(rows, truth, table.column("order").to_numpy() % folds, names, features)
        found = [dict(category=j, kind=0, item=0, weight=chain.bias[j]) for j in range(len(names))]
        found += [dict(category=j, kind=1, item=i, weight=w) for j in range(len(names)) for i, w in enumerate(chain.chained[j])]
        found += [dict(category=j, kind=2, item=i, weight=w) for j in range(len(names)) for i, w in chain.words[j].items()]
        return pa.Table.from_pylist(found, schema=pa.schema([("category", pa.int32()), ("kind", pa.int32()), ("item", pa.int64()), ("weight", pa.float64())]))

    kind_list = ", ".join(f"{k} int" for k in kinds)
    sample = labelled.mapInArrow(featurise, f"id long, order long, {kind_list}, words array<long>")
    weights = sample.groupBy().applyInArrow(train, "category int, kind int, item long, weight double").collect()
    pick = lambda j, kind: sorted((w.item, w.weight) for w in weights if w.category == j and w.kind == kind)
    each = range(len(names))
    return Chain(
        names,
        [dict(pick(j, 0)).get(0, -30.0) for j in each],
        [[w for _, w in pick(j, 1)] or [0.0] * j for j in each],
        [dict(pick(j, 2)) for j in each],
    )


def score(documents: DataFrame, chain: Chain, text_column: str = "text") -> DataFrame:
    """The frame with a column p_<category> for each category; a null or empty text gets the probability without words.

    Whole texts are read, each word counts once. Rows and other columns stay; a taken name gets underscores at its end.
    """
    names = [unused(f"p_{c}", documents) for c in chain.categories]
    schema = T.StructType([*documents.schema, *(T.StructField(n, T.DoubleType(), False) for n in names)])
    where = documents.columns.index(text_column)
    known = np.array(sorted({k for words in chain.words for k in words}), np.int64)
    weights = np.array([[words.get(k, 0.0) for words in chain.words] for k in known.tolist()]).reshape(len(known), len(names))

    def run(batches):
        number = np.full(1 << WORD_BITS, -1, np.int32)
        number[known] = np.arange(len(known))
        size = max(1, len(known))
        for batch in batches:
            sums = np.zeros((batch.num_rows, len(names)))
            for start, _, owner, word in word_sets(batch.column(where)):
                which = number[word]
                both = np.unique(owner[which >= 0] * size + which[which >= 0])
                np.add.at(sums, start + both // size, weights[both % size])
            odds = np.zeros((batch.num_rows, 0))
            for j in range(len(names)):
                odds = np.column_stack([odds, np.clip(chain.bias[j] + odds @ np.array(chain.chained[j]) + sums[:, j], -30, 30)])
            found = [pa.array(1 / (1 + np.exp(-odds[:, j]))) for j in range(len(names))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], names=schema.names)

    return documents.mapInArrow(run, schema)


def _probable(names: list[str], threshold: float):
    return F.greatest(*(F.col(n) for n in names), F.lit(0.0)) >= threshold


def reject_toxic(documents: DataFrame, chain: Chain, category: str = "toxic", text_column: str = "text", threshold: float = 0.5) -> DataFrame:
    """The documents whose probability of the category is below the threshold, with their own columns."""
    scored = score(documents, chain, text_column)
    at = len(documents.columns) + chain.categories.index(category)
    return scored.where(~_probable([scored.columns[at]], threshold)).select(*documents.columns)
