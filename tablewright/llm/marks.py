"""A table of bits, of fixed size, that tells tasks which rows of a scan to look at; a false hit costs time only."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

BITS = 23
_PART_BITS = BITS - 6


def mark(hashed: Column) -> Column:
    """The mark of a 64-bit hash: its upper bits."""
    return F.shiftrightunsigned(hashed, 64 - BITS)


def mark_of(hashes: np.ndarray) -> np.ndarray:
    """The same for an array of unsigned hashes."""
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def marked(table: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Whether each mark is in the table."""
    return (table[marks >> 3] >> (7 - (marks & 7)).astype(np.uint8)) & 1 == 1


def mark_table(found: DataFrame) -> Broadcast:
    """Whether each mark occurs in the column ``mark``, shared with all tasks. 2^BITS bits come to the driver."""
    schema = pa.schema([("part", pa.int64()), ("bits", pa.binary())])

    def run(batches):
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            marks = batch.column(1).to_numpy()
            for part in np.unique(marks >> _PART_BITS).tolist():
                bits = parts.setdefault(part, np.zeros(1 << _PART_BITS, bool))
                bits[marks[marks >> _PART_BITS == part] & ((1 << _PART_BITS) - 1)] = True
        for part, bits in parts.items():
            yield pa.RecordBatch.from_pylist([dict(part=part, bits=np.packbits(bits).tobytes())], schema=schema)

    spread = found.select("mark").distinct().select(F.shiftright("mark", _PART_BITS).alias("part"), "mark").repartition("part")
    table = np.zeros((1 << BITS - _PART_BITS, 1 << _PART_BITS - 3), np.uint8)
    for row in spread.mapInArrow(run, "part long, bits binary").collect():
        table[row.part] = np.frombuffer(row.bits, np.uint8)
    return found.sparkSession.sparkContext.broadcast(table.reshape(-1))
