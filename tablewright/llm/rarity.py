"""How often 64-bit hashes occur in a corpus, as a table of fixed size that every task can hold.

Hashes are counted in cells by their upper bits. A count is too large by what shares the cell and, up to 2^31, never too
small; beyond that it stops growing, in a task and in the corpus, but never turns small again. So it tells frequent hashes from the rest at any corpus size. Only orders of tokens are made of it: an order that
puts frequent tokens last makes joins cheap, and any order keeps them exact.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

#: Cells, and cells to a part: a part is a row while counts are added up.
CELL_BITS, PART_BITS = 22, 16
COUNTS = "part int, counts binary"
COUNTS_FIELDS = [("part", pa.int32()), ("counts", pa.binary())]


class CellCounts:
    """A task's own counts, given away as one row for each part.

    One step adds fewer than 2^31 hashes, since no text is longer, and a cell takes none from 2^31 on: nothing wraps.
    """

    def __init__(self, bits: int = CELL_BITS) -> None:
        self.bits, self.cells = bits, np.zeros(1 << bits, np.uint32)

    def add(self, hashes: np.ndarray) -> None:
        where = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        np.add.at(self.cells, where[self.cells[where] < 1 << 31], np.uint32(1))

    def rows(self) -> Iterator[tuple[int, bytes]]:
        for part, cells in enumerate(self.cells.reshape(-1, 1 << PART_BITS)):
            if cells.any():
                yield part, zlib.compress(cells.tobytes(), 1)


#: Levels from this one on mean: more often than chance allows.
FREQUENT = 160


def code_of(count: float) -> int:
    """The byte that stands for a count on a logarithmic scale: eight steps to a doubling, the last for all beyond."""
    return int(np.minimum(np.round(8 * np.log2(count + 1)), 255))


def _deviation_levels(cells: np.ndarray, mean: float) -> np.ndarray:
    """Fine steps of a cell's deviation from the mean up to where chance ends, then steps of an eighth of a doubling."""
    spread = (mean + 1) ** 0.5
    end = 6 * spread + mean + 4
    fine = np.clip(np.round(16 * (cells - mean) / spread + 64), 0, FREQUENT - 1)
    coarse = FREQUENT + 8 * np.log2(np.maximum(cells / end, 1))
    return np.where(cells > end, np.minimum(coarse, 255), fine).astype(np.uint8)


def cell_levels(counts: DataFrame, logarithmic: bool = False, bits: int = CELL_BITS) -> Broadcast:
    """A byte for each cell, higher for fuller ones, shared with all tasks.

    By default a level tells by how much a cell is fuller than chance makes it, so frequent hashes stand out whatever the
    number of hashes; from FREQUENT on it is no chance. ``logarithmic`` gives ``code_of`` a cell's count: exact counts for a
    vocabulary that is not much larger than the table.

    Counts are added up part by part in tasks. What comes to the driver has a fixed size, 2^bits counts.
    """
    kinds = pa.schema([("part", pa.int32()), ("total", pa.int64()), ("cells", pa.binary())])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                cells = np.frombuffer(zlib.decompress(blob.as_py()), np.uint32)
                sums[part] = sums.get(part, 0) + cells.astype(np.int64)
        for part, cells in sums.items():
            blob = zlib.compress(np.minimum(cells, 2**32 - 1).astype(np.uint32).tobytes(), 1)
            yield pa.RecordBatch.from_pylist([dict(part=part, total=int(cells.sum()), cells=blob)], schema=kinds)

    found = counts.repartition("part").mapInArrow(add, "part int, total long, cells binary").collect()
    mean = sum(row.total for row in found) / (1 << bits)
    empty = np.zeros(1, np.int64)
    level = (lambda x: np.minimum(np.round(8 * np.log2(x + 1)), 255).astype(np.uint8)) if logarithmic else (lambda x: _deviation_levels(x, mean))
    levels = np.full(1 << bits, level(empty)[0], np.uint8)
    for row in found:
        start = row.part << PART_BITS
        levels[start : start + (1 << PART_BITS)] = level(np.frombuffer(zlib.decompress(row.cells), np.uint32).astype(np.int64))
    return counts.sparkSession.sparkContext.broadcast(levels)


def level_of(levels: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return levels[(hashes >> np.uint64(65 - len(levels).bit_length())).astype(np.int64)]


class Recent:
    """Keys met lately in a task, so that copies which lie near each other are handled once. Bounded: two generations."""

    def __init__(self, size: int = 50_000) -> None:
        self.size, self.new, self.old = size, set(), set()

    def again(self, key) -> bool:
        if key in self.new:
            return True
        if len(self.new) >= self.size:
            self.new, self.old = set(), self.new
        self.new.add(key)
        return key in self.old


class Earliest:
    """The smallest place met lately with each key in a task. Bounded as ``Recent`` is."""

    def __init__(self, size: int = 50_000) -> None:
        self.size, self.new, self.old = size, {}, {}

    def lowers(self, key, place: int) -> bool:
        """Whether the key is met for the first time, or at a smaller place than before."""
        before = self.new.get(key)
        if before is None:
            if len(self.new) >= self.size:
                self.new, self.old = {}, self.new
            before = self.old.get(key)
        if before is not None and before <= place:
            self.new[key] = before
            return False
        self.new[key] = place
        return True
