"""Substring dedup by hashing lines or paragraphs: of equal units in a corpus the earliest stays, the others go.

A passage that is broken into lines differently in each document has no equal lines; for such corpora lines can be cut further,
at the ends of sentences.

Units are normalised (A-Z lower-cased, runs of white space and ASCII punctuation taken as one space) and hashed to 128
bits in the tasks that read the texts. Only hashes and places are shuffled: minima are taken before the shuffle, so a
line that a third of all documents share costs one row for each task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from . import hashing
from .shared import discard, stored, unused

PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _pieces(text: pa.Array, unit: str):
    """For texts taken a step at a time: (first text, bytes, bounds of units in them, first unit of each text)."""
    raw, offsets = hashing.buffers(text)
    for start, stop in hashing.steps(offsets):
        part, ends = raw[offsets[start] : offsets[stop]], offsets[start : stop + 1] - offsets[start]
        bounds, first = hashing.lines(part, ends, unit == "sentence")
        if unit == "paragraph":
            count = np.diff(hashing.words(part, bounds, PUNCTUATION)[3])
            # a paragraph begins at a text's first line and at a line with words behind one without
            opens = np.ones(len(count), bool)
            opens[1:] = (count[1:] > 0) & (count[:-1] == 0)
            opens[first[:-1]] = True
            bounds = np.append(bounds[:-1][opens], len(part))
            first = np.concatenate([[0], np.cumsum(opens)])[first]
        yield start, part, bounds, first


def _units(text: pa.Array, unit: str):
    """For texts taken a step at a time: (first text, first unit of each text, words, hashes and wholeness of units)."""
    for start, part, bounds, first in _pieces(text, unit):
        words, _, _, at = hashing.words(part, bounds, PUNCTUATION)
        opens = np.append(True, part[bounds[1:-1] - 1] == 10)
        opens[first[:-1]] = True
        whole = opens & np.append(opens[1:], True)
        yield start, first, np.diff(at), hashing.sequences(words, at), whole


def repeated_units(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", unit: str = "line", min_words: int = 1, min_piece: int = 5
) -> DataFrame:
    """doc_id, removed (unit numbers from 0, ascending) of the documents that lose units.

    A unit (line, paragraph or sentence) goes if an equal one stands before it: in a document with a smaller id, or earlier
    in the same one. Units without a word, or with fewer than min_words, always stay, as do sentences of fewer than min_piece
    words, which are equal by chance, unless they are a whole line. Rows without id or text are not looked at; rows that
    repeat an id share their ranks, so none of them removes the other's units of the same number.
    """
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("doc_id", pa.int64()), ("unit", pa.int32())])

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for start, first, count, (a, b), whole in _units(batch.column(1), unit):
                size = np.diff(first)
                number = np.arange(len(count)) - np.repeat(first[:-1], size)
                owner = np.repeat(ids[start : start + len(size)], size)
                keep = (count >= max(1, min_words)) & (whole | (count >= min_piece) if unit == "sentence" else True)
                columns = [a[keep].view(np.int64), b[keep].view(np.int64), owner[keep], number[keep].astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], schema=schema)

    known = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")).where("doc_id IS NOT NULL AND text IS NOT NULL")
    units = stored(known.mapInArrow(run, "a long, b long, doc_id long, unit int"), "units")
    place = F.struct("doc_id", "unit")
    first = units.groupBy("a", "b").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    # written, so that a unit with many places is split in the join: neither of its sides is an aggregate
    first = stored(first.where("first < last").select("a", "b", "first"), "first-units")
    again = units.join(first, ["a", "b"]).where(place > F.col("first"))
    removed = stored(again.groupBy("doc_id").agg(F.array_sort(F.collect_set("unit")).alias("removed")), "removed")
    discard(units, first)
    return removed


def remove_repeated_units(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", unit: str = "line", min_words: int = 1, min_piece: int = 5
) -> DataFrame:
    """The documents without repeated units, with columns n_units, n_removed and kept (start, end) added.

    ``kept`` has the stretches of the original text that stay, in characters, adjoining ones joined; the new text is these
    one after the other. If the text's last unit goes, the line feed before it stays. Which units go is said at
    ``repeated_units``. A null text stays null, with no units; an empty one has one empty unit. All rows and other columns
    stay; an added name that is taken gets underscores.
    """
    return rebuilt(documents, repeated_units(documents, id_column, text_column, unit, min_words, min_piece), id_column, text_column, unit)


def rebuilt(documents: DataFrame, removed: DataFrame, id_column: str, text_column: str, unit: str = "line") -> DataFrame:
    """The documents without the units listed in removed (doc_id, removed), as said at ``remove_repeated_units``."""
    key, gone = unused("removed_from", documents), unused("removed_units", documents)
    removed = removed.select(F.col("doc_id").alias(key), F.col("removed").alias(gone))
    # dealt by id at every size: a list small enough to broadcast would grow with the corpus until it is not
    both = documents.join(removed.hint("merge"), F.col(id_column) == F.col(key), "left").drop(key)
    names = [unused(name, documents) for name in ("n_units", "n_removed", "kept")]
    spans = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    kinds = [T.LongType(), T.LongType(), spans]
    schema = T.StructType([*documents.schema, *(T.StructField(n, k) for n, k in zip(names, kinds))])
    where, width = documents.columns.index(text_column), len(documents.columns)
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                part = batch.slice(begin, 500)
                texts, lists = part.column(where), part.column(width)
                made, counts, lost, spans, edge = [], [], [], [], [0]
                for start, raw, bounds, first in _pieces(texts, unit):
                    for i in range(len(first) - 1):
                        null = not texts[start + i].is_valid
                        edges = bounds[first[i] : first[i + 1] + 1]
                        raw_text = raw[edges[0] : edges[-1]]
                        stays = np.ones(len(edges) - 1, bool)
                        stays[[x for x in lists[start + i].as_py() or () if x < len(stays)]] = False
                        change = np.flatnonzero(np.diff(np.concatenate([[False], stays, [False]])))
                        pairs = np.zeros((0, 2), np.int64) if null else (edges[change] - edges[0]).reshape(-1, 2)
                        made.append(None if null else b"".join(raw_text[a:b].tobytes() for a, b in pairs.tolist()).decode())
                        pairs = pairs[pairs[:, 0] < pairs[:, 1]]
                        # in characters: without the bytes before that continue one
                        spans.append(pairs - np.searchsorted(np.flatnonzero((raw_text & 0xC0) == 0x80), pairs))
                        edge.append(edge[-1] + len(pairs))
                        counts.append(0 if null else len(stays))
                        lost.append(0 if null else int((~stays).sum()))
                columns = list(part.columns[:width])
                columns[where] = pa.array(made, pa.string())
                spans = np.concatenate([np.zeros((0, 2), np.int64), *spans])
                kept = pa.StructArray.from_arrays([pa.array(spans[:, 0]), pa.array(spans[:, 1])], fields=list(span_type.value_type))
                columns += [pa.array(counts, pa.int64()), pa.array(lost, pa.int64()), pa.ListArray.from_arrays(pa.array(edge, pa.int32()), kept, type=span_type)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return both.mapInArrow(run, schema)
