"""Scores against plain counting, and the filter against what it holds."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter
from dataclasses import replace

import numpy as np
import pytest
from tests.llm.conftest import by_id

from loyaltylens.llm.lm_score import (
    CONTEXT_BINS, READ, STEPS, Model, Settings, Slice, bloom_filter, counted, levels, ngram_keys, score, shard_models, tokenised,
)

RNG = random.Random(5)
CHAIN = {a: RNG.sample("abcdefghijklmnopqrst", 3) for a in "abcdefghijklmnopqrst"}


def chain(n):
    word, out = RNG.choice(list(CHAIN)), []
    for _ in range(n):
        word = RNG.choice(CHAIN[word])
        out.append(word.upper() if RNG.random() < 0.3 else word)
    return " ".join(out)


TEXTS = ["", None, " \n", "rare É é\tİ", "x " * 30_000, *(chain(RNG.randrange(5, 80)) for _ in range(150))]


def expected(rows):
    split = [[*(t or "").encode().lower().split(), None] for _, t in rows]
    rest = [zlib.crc32(("" if i is None else str(i)).encode()) % 5 for i, _ in rows]
    counts = Counter(w for ws, r in zip(split, rest) if r != 1 for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    base = [sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in ws) for ws in split]
    return [(r == 1, len(ws), sum(counts[w] > 0 for w in ws), total, b) for r, ws, b in zip(rest, split, base)]


@pytest.mark.parametrize("settings", [Settings(), Settings(shard_bytes=1 << 14, slice_bytes=1 << 10), Settings(order=3), Settings(order=4)])
def test_counts_and_base_score_match_brute_force(docs, settings):
    rows = list(enumerate(TEXTS))
    got = by_id(score(docs(rows), settings=settings))
    for (i, _), (held_out, n, known, total, base) in zip(rows, expected(rows)):
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held_out, n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
    # The chain is predictable from the last word, and the model has to see that in texts it has not learnt from.
    held = [r for r in got.values() if r["held_out"] and r["doc_id"] >= 5]
    assert len(held) > 10 and sum(r["score"] for r in held) > 0.8 * sum(r["base_score"] for r in held)


def test_slices_do_not_change_scores(docs):
    frame = docs(TEXTS)
    one = by_id(score(frame, settings=Settings(shard_bytes=1 << 14)))
    many = by_id(score(frame, settings=Settings(shard_bytes=1 << 14, slice_bytes=1 << 10)))
    # The sample that sets the weights is the same, so are the scores.
    assert {i: round(r["score"], 6) for i, r in one.items()} == {i: round(r["score"], 6) for i, r in many.items()}


def test_all_training_texts_set_the_weights_whatever_the_files(docs):
    # More texts than the 2,000 that once set the weights, so that a sample of them would depend on the files.
    rows = [(i, chain(4)) for i in range(6000)]
    by_order = [by_id(score(docs(order).repartition(n))) for order, n in ((rows, 2), (rows[::-1], 5))]
    assert {i: round(r["score"], 9) for i, r in by_order[0].items()} == {i: round(r["score"], 9) for i, r in by_order[1].items()}


def test_a_token_after_an_unknown_word_falls_back_whole(docs):
    held = [i for i in range(30) if zlib.crc32(str(i).encode()) % 5 == 1][:2]
    learnt = next(i for i in range(30) if zlib.crc32(str(i).encode()) % 5 != 1)
    got = by_id(score(docs([(held[0], "unseen"), (held[1], "unseen other"), *((learnt, "a b c") for _ in range(5))])))
    # The texts differ by one token after a word never seen; it has its whole probability of a token never seen.
    alone = math.log10(0.5 / (got[learnt]["train_tokens"] + 0.5 * (4 + 1)))
    assert got[held[1]]["score"] - got[held[0]]["score"] == pytest.approx(alone, rel=1e-9)


def test_filter_returns_every_step_and_few_others():
    rng = np.random.default_rng(2)
    keys = rng.integers(0, 1 << 63, 20_000, dtype=np.uint64)
    counts = np.minimum(rng.zipf(1.7, len(keys)), 10**6)
    settings = replace(Settings(), probes=6)
    shards = 3
    rows = []
    for s in range(shards):
        own = keys % np.uint64(shards) == s
        rows.append({"shard": s, "tokens": b"", "times": b"", "bits": bloom_filter(keys[own], counts[own], 6).tobytes()})
    found = Slice(rows, shards, settings.probes).levels(keys)
    assert (found >= levels(counts)).all() and (found > levels(counts)).mean() < 0.05
    other = Slice(rows, shards, settings.probes).levels(rng.integers(1 << 63, (1 << 64) - 1, 20_000, dtype=np.uint64))
    assert (other > 0).mean() < 0.05
    assert (STEPS[levels(counts) - 1] <= counts).all() and (STEPS[levels(counts)] > counts).all()


def test_repeated_rows_missing_ids_no_rows(docs):
    rows = [(1, "a b"), (1, "a b"), (None, "a"), (None, None)]
    got = score(docs(rows)).collect()
    want = expected(rows)
    assert sorted((r.n_tokens, r.n_known, r.train_tokens) for r in got) == sorted((w[1], w[2], w[3]) for w in want)
    assert score(docs([])).count() == 0
    held_only = score(docs([(i, "a") for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1])).collect()
    assert held_only and all(r.train_tokens == 0 and r.n_known == 0 for r in held_only)


def test_scores_are_the_mixture_of_all_orders(docs):
    """The score against one counted with dictionaries; the filter takes few steps more than it holds."""
    rows = [(i, t) for i, t in enumerate(TEXTS) if i != 4]
    weights = tuple(tuple(0.1 * n + 0.02 * b for b in range(CONTEXT_BINS)) for n in (1, 2))
    settings = Settings(order=3, probes=10, shard_bytes=1 << 12)
    built = shard_models(counted(docs(rows).fillna("", ["text"]).select("doc_id", "text"), 3, settings), settings).collect()
    known = Slice([r.asDict() for r in built], 3, settings.probes)
    model = Model(3, sum(r["total"] for r in built), sum(r["distinct"] for r in built), len(rows), weights)
    split = [[*(t or "").encode().lower().split(), None] for _, t in rows]
    # Before a text stands the missing word, whose count is the number of texts; longer contexts stop there.
    padded = [(None, *ws) for ws in split]
    grams = Counter(ws[i - n : i] for ws in padded for n in (2, 3) for i in range(n, len(ws) + 1))
    single = Counter(w for ws in split for w in ws)

    def read(gram):
        return READ[np.searchsorted(STEPS, grams[gram], side="right")]

    same = 0
    for (_, text), ws in zip(rows, padded):
        tokens, ends = tokenised([(text or "").encode()])
        steps = np.array([known.levels(k) for k in ngram_keys(tokens, ends, 3)[1:]])
        got = model.log_probability(known.counts(tokens), steps, ends).sum()
        want = 0.0
        for i in range(1, len(ws)):
            p = (single[ws[i]] + 0.5) / (model.total + 0.5 * (model.distinct + 1))
            for n in (2, 3):
                context = len(rows) if i == 1 else single[ws[i - 1]] if n == 2 else read(ws[i - 2 : i])
                weight = weights[n - 2][min(int(math.log2(context + 1)), CONTEXT_BINS - 1)]
                p = weight * min(1.0, read(ws[max(0, i - n + 1) : i + 1]) / max(context, 1)) + (1 - weight) * p
            want += math.log10(p)
        same += got == pytest.approx(want, rel=1e-9)
    assert same >= 0.9 * len(rows)
