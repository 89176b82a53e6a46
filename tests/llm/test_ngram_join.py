"""Similar groups against all pairs in plain Python."""

from __future__ import annotations

import random

import numpy as np
import pytest
from tests.llm.conftest import by_id

from loyaltylens.llm import ngram_join
from loyaltylens.llm.components import connected_components
from loyaltylens.llm.ngram_join import Similarity, allocate, similar_groups, without_near_copies, word_sets

WORDS = [f"w{i}" for i in range(300)]


def corpus(seed):
    rng = random.Random(seed)
    texts = ["", None, " \t", "a", "A", "a b", "a b c", "A B  c", "a b c d", "a b c d e", "é É"]
    for _ in range(14):
        base = rng.choices(WORDS, k=rng.choice([8, 12, 20, 40, 90, 300]))
        for _ in range(rng.randrange(1, 16)):
            copy = base[:]
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
                at = rng.randrange(len(copy))
                copy[at : at + rng.randrange(2)] = rng.choices(WORDS, k=rng.randrange(2))
            texts.append(" ".join(copy))
    rng.shuffle(texts)
    return texts


def brute(texts, similarity):
    sets = [word_sets(t or "", similarity.size) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            union = len(sets[i]) + len(sets[j]) - shared
            if sets[i] and sets[j] and similarity.whole * shared >= similarity.part * union:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [(len(sets[i]), find(i)) for i in range(len(texts))]


@pytest.mark.parametrize("seed,similarity", [(1, Similarity(4, 85, 100)), (2, Similarity(5, 80, 100)), (3, Similarity(2, 60, 100))])
def test_groups_match_all_pairs(docs, seed, similarity):
    texts = corpus(seed)
    got = by_id(similar_groups(docs(texts), similarity))
    for i, want in enumerate(brute(texts, similarity)):
        assert (got[i]["n_shingles"], got[i]["component_id"]) == want, texts[i]
        assert got[i]["stays"] == (want[1] == i)


def test_cut_segments_lose_nothing(docs, monkeypatch):
    similarity, texts = Similarity(4, 85, 100), corpus(4)
    whole = allocate
    monkeypatch.setattr(ngram_join, "allocate", lambda counts, s: whole(dict.fromkeys(counts, 10**9), s))
    assert any(s.cut for s in ngram_join.allocate({10: 5, 12: 5}, similarity).values())
    got = by_id(similar_groups(docs(texts), similarity))
    assert [(got[i]["n_shingles"], got[i]["component_id"]) for i in range(len(texts))] == brute(texts, similarity)


def test_sets_with_one_hash_are_told_apart(docs, monkeypatch):
    real = ngram_join._set_hash
    monkeypatch.setattr(ngram_join, "_set_hash", lambda e, salt: np.uint64(7) if salt == 1 else real(e, salt))
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(ngram_join)
    try:
        got = by_id(similar_groups(docs(["a b c d", "e f g h", "a  b c d"]), Similarity(4, 85, 100)))
    finally:
        cloudpickle.unregister_pickle_by_value(ngram_join)
    assert [got[i]["component_id"] for i in range(3)] == [0, 1, 0]


def test_entries_cover_every_pair_within_the_distance():
    rng = np.random.default_rng(8)
    similarity = Similarity(4, 85, 100)
    for sets in (10, 10**9):
        schemes = allocate(dict.fromkeys(range(40), sets), similarity)
        edges = ngram_join.band_edges()
        for _ in range(300):
            n = int(rng.integers(6, 400))
            universe = rng.integers(0, 1 << 63, 3 * n, dtype=np.uint64)
            a = universe[:n]
            drop = int(rng.integers(0, max(1, n // 8)))
            b = np.r_[a[drop:], universe[n : n + int(rng.integers(0, max(1, n // 8)))]]
            shared, union = len(a) - drop, len(b) + drop
            if 100 * shared < 85 * union:
                continue
            band = int(np.searchsorted(edges, min(len(a), len(b)), side="right")) - 1
            scheme = schemes.get(band)
            if scheme is None:
                assert shared == union
            else:
                assert scheme.low <= len(a) <= scheme.high and scheme.low <= len(b) <= scheme.high
                assert set(scheme.entries(a, similarity).tolist()) & set(scheme.entries(b, similarity).tolist())


def test_kept_rows_columns_ties_and_missing_ids(docs):
    text = " ".join(WORDS[:50])
    frame = docs([(5, text), (3, text + " x"), (3, text + " x"), (None, text), (None, "only"), (None, "only"), (9, None), (None, None)])
    out = without_near_copies(frame, Similarity(4, 85, 100))
    assert out.columns == frame.columns
    assert sorted(((r.doc_id or 0), r.text or "") for r in out.collect()) == [(0, ""), (0, "only"), (3, text + " x"), (9, "")]
    assert similar_groups(docs([])).count() == 0 and without_near_copies(docs([])).count() == 0


def test_components_of_a_path_a_star_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 260)] + [(1, 1), (3, 2), (2, 3)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = {**{i: 100 for i in range(100, 141)}, **{i: 7 for i in (7, *range(200, 260))}, 2: 2, 3: 2}
    assert got == want
