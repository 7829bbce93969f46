"""Language identification by string kernels: n-gram presence, Nystroem landmarks, one-versus-rest kernel ridge regression.

The kernel of two texts is the number of character n-grams (n = 1 to 3, all in one spectrum) that both have, divided by
the root of the product of their own numbers. Landmarks, some texts of each language, stand for the whole kernel matrix: a
text is told by its kernel values with them. Training takes a bounded sample of labelled texts in one task; the model has
a row of presence for each landmark. Scoring reads each text once, marks the landmarks' n-grams it has in a matrix of
presence for a batch of texts, and two matrix products give the kernel with all landmarks and the score of each language.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .shared import unused

GRAM = 3
#: Texts to a matrix of presence.
BATCH = 128
UNKNOWN = "und"
#: Code points a letter's number takes.
_BITS = 21


class Model(NamedTuple):
    """languages in order; grams known, ordered; presence of grams in landmarks; the landmarks' own numbers; weights."""

    languages: list[str]
    grams: np.ndarray
    presence: np.ndarray
    sizes: np.ndarray
    weights: np.ndarray


@functools.cache
def _letters() -> np.ndarray:
    """For each code point its lower-case letter, 32 where it's no letter."""
    table = np.full(0x110000, 32, np.int64)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            lower = char.lower()
            table[point] = ord(lower) if len(lower) == 1 else point
    return table


def grams_of(text: str | None) -> np.ndarray:
    """The text's distinct n-grams as ordered numbers; none without a letter.

    Letters are lower-cased, each run of other characters is one space, as are both ends.
    """
    if not text:
        return np.zeros(0, np.int64)
    points = _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    points = np.concatenate([[32], points, [32]])
    points = points[np.append(True, (points[1:] != 32) | (points[:-1] != 32))]
    if len(points) < 2:
        return np.zeros(0, np.int64)
    # an n-gram's number holds its code points one after the other; fewer than GRAM leave the upper ones empty
    found, runs = [np.unique(points)], points
    for n in range(1, GRAM):
        runs = runs[:-1] << _BITS | points[n:]
        if not len(runs):
            break
        found.append(np.unique(runs))
    return np.concatenate(found)


def fit(texts: list[np.ndarray], labels: list[str], landmarks_of_each: int, ridge: float) -> Model:
    """A model from sets of n-grams and their languages; the first landmarks_of_each of a language are its landmarks."""
    languages = sorted(set(labels))
    truth = np.array([languages.index(x) for x in labels], np.int64)
    chosen = np.concatenate([np.flatnonzero(truth == k)[:landmarks_of_each] for k in range(len(languages))]) if languages else np.zeros(0, np.int64)
    grams = np.unique(np.concatenate([texts[i] for i in chosen])) if len(chosen) else np.zeros(0, np.int64)
    presence = np.zeros((len(grams), len(chosen)), np.float32)
    for j, i in enumerate(chosen):
        presence[np.searchsorted(grams, texts[i]), j] = 1
    model = Model(languages, grams, presence, np.array([len(texts[i]) for i in chosen], np.float32), np.zeros((len(chosen) + 1, len(languages))))
    if len(languages) < 2:
        return model
    kernel = np.concatenate([part for part in kernels(model, texts)]).astype(np.float64)
    # Nystroem: landmarks' kernel to the power of -1/2 makes features whose products approach the whole kernel
    values, vectors = np.linalg.eigh(kernel[chosen])
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    features = np.column_stack([kernel @ root, np.ones(len(texts))])
    wanted = np.where(truth[:, None] == np.arange(len(languages)), 1.0, -1.0)
    penalty = np.diag(np.append(np.full(features.shape[1] - 1, ridge * len(texts)), 1e-9))
    solved = np.linalg.solve(features.T @ features + penalty, features.T @ wanted)
    return model._replace(weights=np.vstack([root @ solved[:-1], solved[-1:]]))


def kernels(model: Model, texts: list[np.ndarray]) -> Iterator[np.ndarray]:
    """The kernel of each text with each landmark, BATCH texts at a time."""
    for start in range(0, len(texts), BATCH):
        part = texts[start : start + BATCH]
        marks = np.zeros((len(part), len(model.grams)), np.float32)
        for i, grams in enumerate(part):
            at = np.searchsorted(model.grams, grams)
            at[at == len(model.grams)] = 0
            marks[i, at[model.grams[at] == grams] if len(model.grams) else at] = 1
        sizes = np.array([max(1, len(g)) for g in part], np.float32)
        yield (marks @ model.presence) / np.sqrt(sizes[:, None] * model.sizes)


def predict(model: Model, texts: list[np.ndarray]) -> tuple[list[str], np.ndarray]:
    """(language, score from 0 to 1) of each text: the language of the largest value, ties to the first in order."""
    if not model.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    values = [k.astype(np.float64) @ model.weights[:-1] + model.weights[-1] for k in kernels(model, texts)]
    values = np.concatenate(values) if values else np.zeros((0, len(model.languages)))
    best = values.argmax(axis=1)
    known = np.array([len(t) > 0 for t in texts], bool)
    score = np.clip((values[np.arange(len(texts)), best] + 1) / 2, 0, 1) if len(model.languages) > 1 else np.ones(len(texts))
    return [model.languages[b] if k else UNKNOWN for b, k in zip(best, known)], np.where(known, score, 0.0)


def fit_languages(
    documents: DataFrame, usable: Column, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang", of_each: int = 250, languages: int = 100, landmarks_of_each: int = 24, ridge: float = 1e-4
) -> Model:
    """Learn from the rows where ``usable`` holds, with a letter in the text and a language that isn't null.

    The sample is bounded: of_each rows, those whose ids and texts hash lowest (repeated rows count once), of each of the ``languages`` most frequent
    languages (ties to the smaller name). Whole texts are read, in one task. Without such a row the model knows no language.
    """
    rows = documents.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.col(lang_column).alias("lang"), usable.alias("usable"))
    rows = rows.where("usable AND lang IS NOT NULL AND text IS NOT NULL").where(F.col("text").rlike(r"\p{L}"))
    common = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(languages).select("lang")
    rows = rows.join(F.broadcast(common), "lang").withColumn("order", F.xxhash64("id", "text"))
    # chosen by their hashes alone, of which a task hands on its own lowest of_each of a language; the texts follow
    place = F.row_number().over(Window.partitionBy("lang").orderBy("order"))
    chosen = rows.select("lang", "order").withColumn("place", place).where(F.col("place") <= of_each).select("lang", "order").distinct()
    sample = rows.join(F.broadcast(chosen), ["lang", "order"]).groupBy("lang", "order").agg(F.min("text").alias("text"))
    fields = pa.schema([("name", pa.string()), ("number", pa.int64()), ("value", pa.binary())])

    def train(table: pa.Table) -> pa.Table:
        table = table.sort_by([("lang", "ascending"), ("order", "ascending")])
        model = fit([grams_of(t.as_py()) for t in table.column("text")], table.column("lang").to_pylist(), landmarks_of_each, ridge)
        rows = [("language", i, x.encode()) for i, x in enumerate(model.languages)]
        rows += [("grams", len(model.grams), model.grams.tobytes()), ("presence", 0, np.packbits(model.presence.astype(bool)).tobytes())]
        rows += [("sizes", 0, model.sizes.tobytes()), ("weights", 0, model.weights.tobytes())]
        return pa.Table.from_pylist([dict(zip(fields.names, r)) for r in rows], schema=fields)

    found = sample.groupBy().applyInArrow(train, "name string, number long, value binary").collect()
    names = [bytes(r.value).decode() for r in sorted((r for r in found if r.name == "language"), key=lambda r: r.number)]
    part = {r.name: bytes(r.value) for r in found if r.name != "language"}
    if not names:
        return Model([], np.zeros(0, np.int64), np.zeros((0, 0), np.float32), np.zeros(0, np.float32), np.zeros((1, 0)))
    grams, sizes = np.frombuffer(part["grams"], np.int64), np.frombuffer(part["sizes"], np.float32)
    presence = np.unpackbits(np.frombuffer(part["presence"], np.uint8), count=len(grams) * len(sizes)).reshape(len(grams), len(sizes))
    return Model(names, grams, presence.astype(np.float32), sizes, np.frombuffer(part["weights"], np.float64).reshape(len(sizes) + 1, len(names)))


def identify(documents: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """The frame with lang_pred, a language of the model, and score (0 to 1); ``und`` and 0 where a text has no letter or is null.

    Nothing but the text is read, and that whole. Rows and other columns stay; a taken name gets underscores at its end.
    """
    names = [unused("lang_pred", documents), unused("score", documents)]
    schema = T.StructType([*documents.schema, T.StructField(names[0], T.StringType(), False), T.StructField(names[1], T.DoubleType(), False)])
    where = documents.columns.index(text_column)
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        known = shared.value
        for batch in batches:
            texts, langs, scores = batch.column(where), [], []
            for start in range(0, batch.num_rows, BATCH):
                lang, score = predict(known, [grams_of(t.as_py()) for t in texts.slice(start, BATCH)])
                langs += lang
                scores.append(score)
            added = [pa.array(langs, pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=schema.names)

    return documents.mapInArrow(run, schema)
