"""Byte-level BPE against tiktoken, round trips, and packing against a plain best fit."""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tablewright.llm import bpe, packing

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    None, "", " ", "Hello world, it's 2024!", "naïve café — 日本語 😀👩‍👩‍👧", "<|endoftext|> is text", "a\r\n\tb  c d e", "x" * 3000, "é" * 2000,
    "\x00\x01\x7f", "word " * 4000, "١٢٣ 𝔘𝔫𝔦", "don't I'LL we'Ve",
]


@pytest.fixture(scope="module")
def plain():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def frame(spark, texts=TEXTS):
    return spark.createDataFrame([(i, t, "kept", 7) for i, t in enumerate(texts)], "doc_id long, text string, ids string, n_tokens int")


def test_ids_are_those_of_the_ranks(spark, plain):
    rows = bpe.encode(frame(spark), VOCABULARY).collect()
    assert [r.ids for r in rows] == ["kept"] * len(TEXTS)  # the clashing column stays, the new one is ids_
    assert [r.ids_ for r in sorted(rows, key=lambda r: r.doc_id)] == [plain.encode_ordinary(t or "") for t in TEXTS]


def test_round_trip_and_digests(spark, plain):
    encoded = bpe.encode(frame(spark), VOCABULARY, ids_column="tokens")
    for row in bpe.decode(encoded, VOCABULARY, "tokens").collect():
        assert bytes(row.decoded) == (row.text or "").encode()
    for row in bpe.round_trip_digests(frame(spark), VOCABULARY).collect():
        ids = plain.encode_ordinary(TEXTS[row.doc_id] or "")
        assert row.n_tokens == 7 and row.n_tokens_ == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((TEXTS[row.doc_id] or "").encode()).hexdigest()
    assert bpe.round_trip_digests(frame(spark).limit(0), VOCABULARY).count() == 0


def test_offsets_cover_the_text(spark):
    for row in bpe.encode(frame(spark), VOCABULARY, ids_column="tokens", with_offsets=True).collect():
        text = row.text or ""
        raw = text.encode()
        table = bpe.token_bytes(VOCABULARY)
        assert [raw[a:b] for a, b in zip(row.byte_offsets, row.byte_offsets[1:])] == [table[i] for i in row.tokens]
        assert row.byte_offsets[-1] == len(raw) and row.char_offsets[-1] == len(text)
        for byte, char in zip(row.byte_offsets, row.char_offsets):
            assert char == len(raw[:byte].decode(errors="ignore"))


def test_split_characters():
    tokenizer_ids = list(bpe.encoded_lists(__import__("pyarrow").array(["😀日x"]), VOCABULARY))[0]
    pieces = bpe.decode_pieces(tokenizer_ids, VOCABULARY)
    assert "".join(pieces) == "😀日x" and "" in pieces
    assert bpe.decode_pieces(tokenizer_ids[:1], VOCABULARY) == ["�"]
    assert len(bpe.byte_characters()) == 256 and set(bpe.byte_characters().values()) == set(range(256))


def plain_best_fit(lengths, capacities, cost):
    bins, left, where = [], sum(lengths), {}
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        room = [(space - used, b) for b, (space, used) in enumerate(bins) if space - used >= lengths[i]]
        if room:
            b = min(room)[1]
        else:
            able = [c for c in sorted(capacities) if c >= lengths[i]]
            bins.append((min(able, key=lambda c: (cost(c) / min(c, left), c)), 0))
            b = len(bins) - 1
        where[i] = (b, bins[b][1])
        bins[b] = (bins[b][0], bins[b][1] + lengths[i])
        left -= lengths[i]
    final = [min(c for c in capacities if c >= used) for _, used in bins]
    return [(*where[i], final[where[i][0]]) for i in range(len(lengths))]


def test_best_fit_is_the_plain_one():
    import random

    deal = random.Random(3)
    for _ in range(40):
        lengths = [deal.randint(1, 64) for _ in range(deal.randint(0, 60))]
        for cost in (packing.sequence_cost, lambda c: c + 3, lambda c: c**1.5 + 1):
            assert packing.best_fit(lengths, (8, 16, 32, 64), cost) == plain_best_fit(lengths, (8, 16, 32, 64), cost)


def check(rows, capacities):
    bins = {}
    for r in rows:
        if r.n_tokens:
            bins.setdefault((r.bin_id, r.capacity), []).append((r.position, r.n_tokens))
        else:
            assert r.bin_id is None and r.capacity is None
    assert len({b for b, _ in bins}) == len(bins)
    for (_, capacity), items in bins.items():
        at = 0
        for position, size in sorted(items):
            assert position == at
            at += size
        assert capacity == min(c for c in capacities if c >= at)


def test_packing_places_everything_once(spark):
    words = [0, 1, 5, 40, 64, 65, 200, 13, 13, 30] * 20
    rows = [(i if i % 50 else 7, " ".join(["w"] * n) if n else None, "x") for i, n in enumerate(words)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, piece string")
    for block in (4, 16384):
        placed = packing.pack(docs, capacities=(16, 32, 64), block=block).collect()
        check(placed, (16, 32, 64))
        assert sum(r.n_tokens for r in placed) == sum(words)
        assert len(placed) == sum(max(1, -(-n // 64)) for n in words)
        assert all(r.start == r.piece * 64 for r in placed)
    assert packing.pack(docs.limit(0)).count() == 0
    assert [r.doc_id for r in packing.pack(spark.createDataFrame([(None, "a b")], "doc_id long, text string")).collect()] == [None]


def test_sequences_of_packed_ids(spark):
    """Packed by token counts, every document's ids lie where its pieces say, and nothing overlaps."""
    texts = ["word " * (40 * i % 700) + f"end {i}" for i in range(120)] + [None, "", "x " * 9000]
    encoded = bpe.encode(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), VOCABULARY).cache()
    packed = packing.pack(encoded, length=F.size("ids"), capacities=(256, 512, 1024), block=50).cache()
    bins = {r.bin_id: r for r in packing.sequences(packed, encoded).collect()}
    ids = {r.doc_id: list(r.ids) for r in encoded.collect()}
    found, filled = {d: [None] * len(x) for d, x in ids.items()}, {b: 0 for b in bins}
    for p in packed.where("bin_id IS NOT NULL").collect():
        found[p.doc_id][p.start : p.start + p.n_tokens] = bins[p.bin_id].ids[p.position : p.position + p.n_tokens]
        assert p.position in bins[p.bin_id].starts
        filled[p.bin_id] += p.n_tokens
    assert found == ids
    assert all(filled[b] == len(r.ids) <= r.capacity for b, r in bins.items())


def test_pieces_are_forgotten(spark, plain):
    """A full table is begun anew, and long pieces are not kept; n_split counts cuts inside characters."""
    known = bpe.Pieces(VOCABULARY, most=3)
    texts = [t or "" for t in TEXTS]
    for start in range(0, len(texts), 2):
        for text, (ids, raw, chars, splits) in zip(texts[start : start + 2], known.step(texts[start : start + 2])):
            expected = plain.encode_ordinary(text)
            assert ids == " ".join(map(str, expected)) and raw == text.encode() and chars == len(text)
            ends = np.cumsum([len(plain.decode_single_token_bytes(i)) for i in expected])[:-1]
            assert splits == sum((raw[e] & 0xC0) == 0x80 for e in ends.tolist())
    assert not any(len(p) > 100 for p in known.known)
