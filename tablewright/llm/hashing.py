"""Hashes of words and word windows for a whole Arrow batch at once, with no Python loop over words.

A word's hash is the sum of a random number for each of its bytes times a power of an odd base, modulo 2^64. One running
sum over the bytes of all texts gives it for every word: the difference of two sums, divided by the power at the word's
start. Windows of words mix the words' hashes in order.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15 | 1
_MIX = np.uint64(0xD6E8FEB86659FD93)
#: Bytes hashed in one step; a longer text is one step of its own.
_STEP = 1 << 17


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """(number of each byte, A-Z as a-z; whether a byte is white space)."""
    numbers = np.random.Generator(np.random.PCG64(20240607)).integers(1, 2**64, 256, dtype=np.uint64) | np.uint64(1)
    numbers[ord("A") : ord("Z") + 1] = numbers[ord("a") : ord("z") + 1]
    space = np.zeros(256, bool)
    space[[0x20, *range(0x09, 0x0E)]] = True
    return numbers, space


_POWERS: list[np.ndarray] = []


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; kept for the usual step."""
    if not _POWERS or len(_POWERS[0]) < size:
        found = []
        for base in (_BASE, pow(_BASE, -1, 2**64)):
            steps = np.full(max(size, _STEP + 1), base, np.uint64)
            steps[0] = 1
            found.append(np.cumprod(steps, dtype=np.uint64))
        if size > 4 * _STEP:
            return found[0], found[1]
        _POWERS[:] = found
    return _POWERS[0], _POWERS[1]


def mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(32))
    values *= _MIX
    values ^= values >> np.uint64(29)
    return values


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column, one more offset than texts; a null is empty."""
    texts = texts.cast(pa.large_string()) if not pa.types.is_large_string(texts.type) else texts
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, offsets


def steps(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about a step's bytes together."""
    start = 0
    while start < len(offsets) - 1:
        stop = int(np.searchsorted(offsets, offsets[start] + _STEP, side="right")) - 1
        stop = min(max(stop, start + 1), len(offsets) - 1)
        yield start, stop
        start = stop


def words(raw: np.ndarray, ends_at: np.ndarray, separators: bytes = b"") -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, begin, end, first word of each text and one more) for texts that lie behind each other in raw.

    ends_at holds the texts' bounds, from 0. Bytes in ``separators`` end words as white space does.
    """
    numbers, space = _tables()
    if separators:
        space = space.copy()
        space[list(separators)] = True
    inside = ~space[raw]
    change = np.empty(len(raw) + 1, bool)
    change[1:-1] = inside[1:] != inside[:-1]
    change[0] = inside[0] if len(raw) else False
    change[-1] = inside[-1] if len(raw) else False
    # a text's bound also ends a word
    cut = ends_at[1:-1]
    cut = cut[(cut > 0) & (cut < len(raw))]
    both = cut[inside[cut - 1] & inside[cut]] if len(cut) else cut
    edges = np.flatnonzero(change)
    if len(both):
        edges = np.sort(np.concatenate([edges, np.repeat(np.unique(both), 2)]))
    begin, end = edges[0::2], edges[1::2]
    power, inverse = _powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    numbers.take(raw, out=sums[1:], mode="clip")
    sums[1:] *= power[: len(raw)]
    np.cumsum(sums[1:], out=sums[1:])
    found = (sums[end] - sums[begin]) * inverse[begin]
    return mixed(found + (end - begin).astype(np.uint64)), begin, end, np.searchsorted(begin, ends_at)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of each run of ``size`` hashes, in order."""
    count = max(0, len(hashes) - size + 1)
    found = hashes[:count].copy()
    for i in range(1, size):
        found = mixed(found) + hashes[i : i + count]
    return mixed(found)


def shingle_sets(texts: pa.Array, size: int = 5) -> Iterator[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its runs of ``size`` words, A-Z taken as a-z.

    A text with fewer words gives its whole sequence as one; one without words, or null, an empty array.
    """
    raw, offsets = buffers(texts)
    for start, stop in steps(offsets):
        part = raw[offsets[start] : offsets[stop]]
        hashes, _, _, first = words(part, offsets[start : stop + 1] - offsets[start])
        whole = windows(hashes, size)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if b - a >= size:
                yield np.unique(whole[a : b - size + 1])
            elif b > a:
                yield windows(hashes[a:b], b - a)
            else:
                yield hashes[:0]


def sequences(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each run hashes[first[i]:first[i + 1]], in order; of an empty run 0."""
    power, inverse = _powers(len(hashes) + 1)
    found = []
    for part in (hashes, mixed(hashes + np.uint64(_BASE))):
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * power[: len(part)], out=sums[1:])
        size = (first[1:] - first[:-1]).astype(np.uint64)
        found.append(np.where(size > 0, mixed((sums[first[1:]] - sums[first[:-1]]) * inverse[first[:-1]] + size), np.uint64(0)))
    return found[0], found[1]


def lines(raw: np.ndarray, ends_at: np.ndarray, sentences: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(bounds of all lines, one more than lines; first line of each text and one more) of texts that lie in raw.

    A line feed belongs to the line it ends, and one at a text's end begins no line; an empty text has one empty line.
    With sentences, lines are also cut behind white space that follows a full stop, an exclamation or a question mark.
    """
    feeds = np.flatnonzero(raw == 10) + 1
    if sentences and len(raw) > 1:
        ends = np.isin(raw[:-1], list(b".!?")) & _tables()[1][raw[1:]]
        ends = np.flatnonzero(ends) + 1
        feeds = np.union1d(feeds, ends[~np.isin(ends, ends_at)] + 1)
    feeds = feeds[~np.isin(feeds, ends_at)]
    text = np.searchsorted(ends_at, feeds, side="left")  # the text whose end is not before the feed's
    number = np.concatenate([np.arange(len(ends_at) - 1), text - 1])
    start = np.concatenate([ends_at[:-1], feeds])
    order = np.lexsort((start, number))
    bounds = np.append(start[order], len(raw))
    first = np.searchsorted(number[order], np.arange(len(ends_at)))
    return bounds, first
