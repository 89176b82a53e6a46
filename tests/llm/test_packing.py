"""Packed sequences hold every id of every document once, in place."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from loyaltylens.llm import packing
from loyaltylens.llm.packing import curve_keys, digests, hilbert_key, pack

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def ids_of(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 1]


ROWS = [(0, ""), (1, None), (2, "short text"), (3, "long words and more " * 3000), (4, "a<|endoftext|>b é"), (2, "short text"),
        (None, "no id"), *((i, f"text number {i} with some words") for i in range(10, 400)), *((i, "same copy " * 9) for i in range(500, 700))]


@pytest.mark.parametrize("bucket_tokens", [1 << 20, 256])
def test_round_trip(docs, monkeypatch, bucket_tokens):
    monkeypatch.setattr(packing, "BUCKET_TOKENS", bucket_tokens)
    frame = docs(ROWS)
    got = pack(frame, PATH).collect()
    sequences, whole = {}, {}
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length > 0
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        whole.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, ids))
    assert sorted(sequences) == list(range(len(sequences)))
    for n, parts in sequences.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 2048 or n == len(sequences) - 1
    want = {}
    for i, t in ROWS:
        ids = ids_of(t)
        want.setdefault((i, len(ids)), []).extend(enumerate(ids))
    for key, parts in whole.items():
        assert sorted((s + k, x) for s, ids in parts for k, x in enumerate(ids)) == sorted(want.pop(key))
    assert not want
    summed = {(r.doc_id, r.start, r.sequence_id, r.offset): r.ids_crc32 for r in digests(pack(frame, PATH)).collect()}
    assert summed == {(r.doc_id, r.start, r.sequence_id, r.offset): zlib.crc32(r.ids) for r in got}


@pytest.mark.parametrize("grid", [4096, 8, 2])
def test_buckets_are_as_many_as_the_tokens_ask_for(spark, monkeypatch, grid):
    monkeypatch.setattr(packing, "BUCKET_TOKENS", 500)
    monkeypatch.setattr(packing, "GRID", grid)
    rows = spark.range(10_000).selectExpr("shiftrightunsigned(xxhash64(id), 1) as place", "5L as n").cache()
    bounds = packing.bucket_bounds(rows)
    assert 95 <= len(bounds) + 1 <= 110
    places = np.array([r.place for r in rows.collect()])
    held = np.bincount(np.searchsorted(bounds, places, side="right"))
    assert held.min() > 0 and 5 * held.max() <= 1000


def test_round_trip_with_more_buckets_than_quantiles(docs, monkeypatch):
    monkeypatch.setattr(packing, "GRID", 4)
    test_round_trip(docs, monkeypatch, 256)


def test_no_rows(docs):
    assert pack(docs([]), PATH).count() == 0


@pytest.mark.parametrize("dimensions,bits", [(2, 3), (3, 2), (3, 3)])
def test_curve_visits_every_point_in_single_steps(dimensions, bits):
    side = 1 << bits
    points = np.stack(np.meshgrid(*[np.arange(side)] * dimensions, indexing="ij"), -1).reshape(-1, dimensions)
    keys = hilbert_key(points, bits)
    assert sorted(keys.tolist()) == list(range(side**dimensions))
    path = points[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_like_documents_are_closer_on_the_curve():
    rng = np.random.default_rng(4)
    topics = [rng.integers(0, 49000, 40) for _ in range(12)]
    ids = [rng.choice(topics[i % 12], 400) for i in range(240)]
    keys = curve_keys(np.concatenate(ids), np.repeat(np.arange(240), 400), 240)
    order = np.argsort(keys)
    assert (order[1:] % 12 == order[:-1] % 12).mean() > 0.6
