"""Byte-level BPE: encoding with the tokenizers library over Arrow batches, offsets, and decoding by the byte table.

A byte-level vocabulary writes each byte as one printable character. The table between the two is a rule: printable bytes
stand for themselves, the others for the characters from 256 on, in order. A token is a run of such characters, so it is
a run of bytes, and may hold only a part of a character.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import json
import os
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, types as T

from .shared import unused

#: Fixed: the pattern whose matches are encoded separately.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Pieces that stay whole wherever others of their kind stand next to them.
_WORD = regex.compile(r" \p{L}+")

#: Texts in the tokenizer's hands at a time.
_TEXTS = 32


@functools.cache
def byte_characters() -> dict[str, int]:
    """Character to byte."""
    itself = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    others = [b for b in range(256) if b not in set(itself)]
    return {chr(b): b for b in itself} | {chr(256 + i): b for i, b in enumerate(others)}


@functools.cache
def _tokenizer(vocabulary: str):
    """One per Python worker; the file's path is known to all machines."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary)
    tokenizer.encode_special_tokens = True
    return tokenizer


@functools.cache
def token_bytes(vocabulary: str) -> list[bytes]:
    """The bytes of each id; special tokens are left out, a gap is empty."""
    with open(vocabulary, encoding="utf-8") as file:
        model = json.load(file)
    special = {token["content"] for token in model["added_tokens"] if token["special"]}
    table, words = byte_characters(), model["model"]["vocab"]
    found = [b""] * (1 + max(words.values(), default=-1))
    for word, i in words.items():
        if word not in special:
            found[i] = bytes(table[c] for c in word)
    return found


def encoded_lists(texts: pa.Array, vocabulary: str) -> Iterator[list[int]]:
    """The ids of each text, a few texts at a time: an encoding takes many times the memory of its text."""
    tokenizer = _tokenizer(vocabulary)
    for start in range(0, len(texts), _TEXTS):
        part = [text or "" for text in texts.slice(start, _TEXTS).to_pylist()]
        for encoding in tokenizer.encode_batch_fast(part, add_special_tokens=False):
            yield encoding.ids


def decode_bytes(ids: list[int], vocabulary: str) -> bytes:
    """The bytes of a list of ids; any list is valid, the result may begin or end inside a character."""
    return b"".join(map(token_bytes(vocabulary).__getitem__, ids))


def decode_pieces(ids: list[int], vocabulary: str) -> list[str]:
    """A text for each token: a character split between tokens is given whole to the token that completes it.

    Bytes that are no valid text become U+FFFD, at the latest in the last piece.
    """
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    table = token_bytes(vocabulary)
    return [decoder.decode(table[i], final=k == len(ids) - 1) for k, i in enumerate(ids)]


def offsets(ids: list[int], text: bytes, vocabulary: str) -> tuple[np.ndarray, np.ndarray]:
    """(byte, character) offsets: token k covers bytes byte[k] to byte[k + 1] of the text, and characters likewise.

    A token that begins inside a character has that character's number, so tokens that share one overlap by it.
    """
    table = token_bytes(vocabulary)
    at = np.fromiter(accumulate((len(table[i]) for i in ids), initial=0), np.int64, len(ids) + 1)
    raw = np.frombuffer(text, np.uint8)
    begun = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    inside = np.zeros(len(raw) + 1, bool)
    inside[:-1] = (raw & 0xC0) == 0x80
    return at, begun[at] - inside[at]


def encode(texts: DataFrame, vocabulary: str, text_column: str = "text", ids_column: str = "ids", with_offsets: bool = False) -> DataFrame:
    """The frame with the ids of each text, without special tokens; markup of special tokens in a text is ordinary text.

    with_offsets adds byte_offsets and char_offsets, one longer than ids. Rows, their order and all other columns stay;
    a new column's name that is taken gets underscores at its end. A null or empty text has no ids. Texts are encoded
    whole, whatever their length, one Arrow batch at a time.
    """
    names = [unused(ids_column, texts)]
    if with_offsets:
        names += [unused("byte_offsets", texts), unused("char_offsets", texts)]
    kinds = [T.IntegerType(), T.LongType(), T.LongType()]
    schema = T.StructType([*texts.schema, *(T.StructField(name, T.ArrayType(kind), False) for name, kind in zip(names, kinds))])
    where = texts.columns.index(text_column)

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, _TEXTS):
                part, ids, spans = batch.slice(start, _TEXTS), [], ([], [])
                for text, found in zip(part.column(where), encoded_lists(part.column(where), vocabulary)):
                    ids.append(np.array(found, np.int32))
                    if with_offsets:
                        for spot, at in zip(spans, offsets(found, (text.as_py() or "").encode(), vocabulary)):
                            spot.append(at)
                columns = [pa.array(ids, pa.list_(pa.int32()))]
                columns += [pa.array(spot, pa.list_(pa.int64())) for spot in spans if with_offsets]
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=[*part.schema.names, *names])

    return texts.mapInArrow(run, schema)


def decode(encoded: DataFrame, vocabulary: str, ids_column: str = "ids", bytes_column: str = "decoded") -> DataFrame:
    """The frame with the bytes of each list of ids (binary, as a list may be cut inside a character); null gives empty."""
    name = unused(bytes_column, encoded)
    schema = T.StructType([*encoded.schema, T.StructField(name, T.BinaryType(), False)])
    where = encoded.columns.index(ids_column)

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, _TEXTS):
                part = batch.slice(start, _TEXTS)
                found = [decode_bytes(ids or [], vocabulary) for ids in part.column(where).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.binary())], names=[*part.schema.names, name])

    return encoded.mapInArrow(run, schema)


class Pieces:
    """What a task knows of pieces of texts, as the pattern cuts them: tokens never cross a cut, and few pieces are new.

    For each piece its decimal ids joined by a space and its decoded bytes; for those with a character split between tokens
    also how many cuts lie inside characters and how many characters the tokens' offsets cover. Bounded: a full table is
    begun anew, and long pieces are kept for one step.
    """

    def __init__(self, vocabulary: str, pattern: str = PATTERN, most: int = 600_000):
        self.vocabulary, self.pattern, self.most = vocabulary, regex.compile(pattern), most
        self.table = token_bytes(vocabulary)
        self.lengths = np.array([len(t) for t in self.table])
        self.decimal = list(map(str, range(len(self.table))))
        self.known: dict[str, tuple[str, bytes]] = {}
        self.splits: dict[str, tuple[int, int]] = {}

    def _learn(self, pieces: list[str]) -> None:
        tokenizer = _tokenizer(self.vocabulary)
        # words after a space are cut the same way when they stand behind each other, so one call encodes them all
        words = [p for p in pieces if _WORD.fullmatch(p)]
        for start in range(0, len(words), 2000):
            part = words[start : start + 2000]
            ids = tokenizer.encode("".join(part), add_special_tokens=False).ids
            at = np.cumsum(self.lengths[ids])
            stops = np.searchsorted(at, np.cumsum([len(p.encode()) for p in part])) + 1
            self._keep(part, ids, [0, *stops.tolist()])
        others = [p for p in pieces if not _WORD.fullmatch(p)]
        for start in range(0, len(others), 1000):
            part = others[start : start + 1000]
            for piece, encoding in zip(part, tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                self._keep([piece], encoding.ids, [0, len(encoding.ids)])

    def _keep(self, pieces: list[str], ids: list[int], bounds: list[int]) -> None:
        """What is known of pieces whose tokens are ids[bounds[i]:bounds[i + 1]]."""
        for piece, start, stop in zip(pieces, bounds, bounds[1:]):
            own = ids[start:stop]
            self.known[piece] = " ".join(map(self.decimal.__getitem__, own)), b"".join(map(self.table.__getitem__, own))
            if not piece.isascii() and len(own) > 1:  # a byte is a character elsewhere
                raw = piece.encode()
                end, split = 0, 0
                for i in own[:-1]:
                    end += len(self.table[i])
                    split += (raw[end] & 0xC0) == 0x80
                if split:
                    self.splits[piece] = split, int(offsets(own, raw, self.vocabulary)[1][-1])

    def step(self, texts: list[str]) -> Iterator[tuple[str, bytes, int, int]]:
        """(ids joined by a space, decoded bytes, characters covered, cuts inside characters) of each text."""
        cut = [self.pattern.findall(text) for text in texts]
        if len(self.known) >= self.most:
            self.known.clear()
            self.splits.clear()
        new = set().union(*cut).difference(self.known)
        self._learn(list(new))
        for pieces in cut:
            found = list(map(self.known.__getitem__, pieces))
            chars, splits = sum(map(len, pieces)), 0
            for piece in [p for p in pieces if p in self.splits]:
                split, covered = self.splits[piece]
                chars, splits = chars + covered - len(piece), splits + split
            yield " ".join([f[0] for f in found]), b"".join([f[1] for f in found]), chars, splits
        for piece in new:
            if len(piece) > 100:
                self.known.pop(piece, None)
                self.splits.pop(piece, None)


def round_trip_digests(texts: DataFrame, vocabulary: str, text_column: str = "text", pattern: str = PATTERN) -> DataFrame:
    """The frame without its texts, with n_tokens, ids_sha256, decoded_sha256, n_chars and n_split: encoded, decoded and hashed
    in one pass.

    ids_sha256 is of the decimal ids joined by a space, decoded_sha256 of the decoded bytes, both in lower-case hex. n_chars
    is how many characters the tokens' offsets cover, n_split how many cuts between tokens lie inside a character. The
    matches of ``pattern`` are encoded separately. The ids never leave the task. Nulls, names and row order as in ``encode``.
    """
    rest = [c for c in texts.columns if c != text_column]
    names = [unused(name, texts) for name in ("n_tokens", "ids_sha256", "decoded_sha256", "n_chars", "n_split")]
    kinds = [T.LongType(), T.StringType(), T.StringType(), T.LongType(), T.LongType()]
    schema = T.StructType([*(texts.schema[c] for c in rest), *(T.StructField(n, k, False) for n, k in zip(names, kinds))])
    where, others = texts.columns.index(text_column), [texts.columns.index(c) for c in rest]

    def run(batches):
        known = Pieces(vocabulary, pattern)
        for batch in batches:
            counts, hashes, decoded, covered, split = [], [], [], [], []
            for start in range(0, batch.num_rows, _TEXTS):
                for ids, raw, chars, cuts in known.step([t or "" for t in batch.column(where).slice(start, _TEXTS).to_pylist()]):
                    counts.append(ids.count(" ") + 1 if ids else 0)
                    hashes.append(hashlib.sha256(ids.encode()).hexdigest())
                    decoded.append(hashlib.sha256(raw).hexdigest())
                    covered.append(chars)
                    split.append(cuts)
            columns = [pa.array(counts, pa.int64()), pa.array(hashes, pa.string()), pa.array(decoded, pa.string())]
            columns += [pa.array(covered, pa.int64()), pa.array(split, pa.int64())]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in others), *columns], names=[*rest, *names])

    return texts.mapInArrow(run, schema)
