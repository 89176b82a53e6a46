"""Phrases against a count in plain Python, and what the summaries promise."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from loyaltylens.llm import collocations as c

LOWER = {i: i + 32 for i in range(65, 91)}


def brute(rows, longest=3, least=10, covered=50, best=2000):
    """Phrases by the contract, from (lang, text)."""
    counts, words_of = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            words_of[lang] += len(words)
            for n in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    result = {}
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in candidates.items():
            score, _, left, right = min(
                (1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))
            )
            inside = any(
                len(q) > len(p) and 100 * b >= covered * a and any(q[i : i + len(p)] == p for i in range(len(q)))
                for q, b in candidates.items()
            )
            if not inside:
                kept.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:best], 1):
            result[lang, rank] = (phrase.decode(), -a, left, right, words_of[lang], -score)
    return result


def found(df):
    return {(r["lang"], r["rank"]): (r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in df.collect()}


def sample(rows=300, seed=1):
    rng = random.Random(seed)
    words = ["new", "york", "city", "the", "of", "a", "ÄÖ", "ÄÖ x", "x\x0by", "", "42"]
    out = []
    for _ in range(rows):
        parts = [rng.choice(words) for _ in range(rng.randint(0, 40))]
        text = "".join(p + rng.choice([" ", "  ", "\t", ", ", ".", "\n", " "]) for p in parts)
        if rng.random() < 0.4:
            text += " New York City marathon" * rng.randint(1, 3)
        out.append((rng.choice(["en", "en", "de", None]), text))
    return [*out, ("en", None), ("fr", ""), ("en", "stop"), (None, "\x0c\r"), *[("en", "same words again")] * 12]


def frame(spark, rows):
    extra = [(i, t, lang, "s", 7) for i, (lang, t) in enumerate(rows)]
    return spark.createDataFrame(extra, "doc_id bigint, text string, lang string, phrase string, count int")


@pytest.mark.parametrize("longest", [2, 3, 4])
def test_equals_plain_count(spark, longest):
    rows = sample()
    settings = c.Settings(longest=longest, block_bytes=700, bucket_mass=900)
    assert found(c.collocations(frame(spark, rows), settings)) == brute(rows, longest)


def test_production_settings_and_ranks(spark):
    rows = sample(120, 2)
    assert found(c.collocations(frame(spark, rows))) == brute(rows)
    assert found(c.collocations(frame(spark, rows), c.Settings(best=3, min_count=4))) == brute(rows, least=4, best=3)


def test_empty(spark):
    for rows in ([], [("en", None), (None, "")], [("en", "a b c")]):
        assert c.collocations(frame(spark, rows)).collect() == []


def test_long_text_of_one_word(spark):
    rows = [("en", "spam ham " * 60_000), ("en", "q" * 100_000)]
    assert found(c.collocations(frame(spark, rows), c.Settings(block_bytes=1000))) == brute(rows)


def test_blocks_cut_at_pieces_only(spark):
    rows = [("en", "one two three. four five, " * 50), ("de", "ein\nzwei drei"), ("en", None)]
    blocks = c.blocks(frame(spark, rows), c.Settings(block_bytes=64)).collect()
    assert len({b["block"] for b in blocks}) == len(blocks) > 10
    pieces = Counter()
    for b in blocks:
        pieces.update((b["lang"], p.split()[0]) for p in bytes(b["data"]).split(c.MARK) if p.split())
    assert pieces["en", b"one"] == 50 and pieces["en", b"four"] == 50 and pieces["de", b"zwei"] == 1


@pytest.mark.parametrize("counters", [1, 2])
def test_summary_loses_nothing_frequent(counters):
    rng = np.random.default_rng(6)
    for _ in range(50):
        keys = rng.zipf(1.3, 3000) % 900
        threshold = 10
        summary = c.Summary(counters * len(keys) // threshold + 1)
        for part in np.array_split(keys, 17):
            values, counts = np.unique(part.astype(np.uint32), return_counts=True)
            summary.merge(values, counts)
            assert len(summary.keys) <= summary.capacity
        true = Counter(keys.tolist())
        assert {k for k, n in true.items() if n >= threshold} <= set(summary.may_reach(threshold).tolist())
        assert summary.lost < threshold
        for key, low in zip(summary.keys.tolist(), summary.counts.tolist()):
            assert low <= true[key] <= low + summary.lost


def test_exact_beyond_64_bits(spark):
    """Counts whose products pass 64 bits."""
    big = 9_000_000_000_000
    rows = [("en", 1, "x", big), ("en", 1, "y", big + 1), ("en", 2, "x y", big - 3)]
    frequent = spark.createDataFrame(rows, "lang string, size int, phrase string, count bigint")
    candidates = frequent.filter("size = 2").withColumnRenamed("count", "a")
    row = c.scored(candidates, frequent.filter("size >= 1")).first()
    assert row["score"] == 1_000_000 * (big - 3) ** 2 // (big * (big + 1))


def test_blocks_are_kept_compressed(spark):
    rows = sample(200, 4)
    plain = {b["block"]: b for b in c.blocks(frame(spark, rows), c.Settings(block_bytes=3000)).collect()}
    packed = c.blocks(frame(spark, rows), c.Settings(block_bytes=3000), packed=True).toArrow()
    assert packed.num_rows == len(plain) > 3
    for block, lang, data, size in zip(*packed.columns):
        own = plain[block.as_py()]
        assert lang.as_py() == own["lang"] and c.unpacked(data, size) == bytes(own["data"])
        assert size.as_py() == own["size"] == len(own["data"]) > len(data.as_py())


def test_one_block_at_a_time_meets_its_answers(spark):
    """The texts of a whole partition in one batch are more than an executor has room for."""
    settings = c.Settings(block_bytes=300, bucket_mass=500)
    found = c.keep(c.blocks(frame(spark, sample(60, 5) + [("fr", "., !")]), settings, packed=True), **c.PAGES)
    counted = c.exact_counts(found, c.answers(c.summaries(found, 3, settings), settings), 3, settings)
    nodes = counted._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in nodes and "Join" not in nodes
    assert {r["lang"] for r in counted.collect()} == {"en", "de", "und"}


def test_fingerprints_are_looked_up_together():
    rng = np.random.default_rng(7)
    arrays = [np.sort(rng.integers(0, 1 << 32, n, dtype=np.uint32)) for n in (0, 3, 50, 0, 900, 7, 1)]
    assert list(c.gathered(arrays, 50)) == [(0, 3), (3, 5), (5, 7)] and list(c.gathered([], 50)) == []
    every = np.concatenate(arrays)
    for frequent in (np.zeros(0, np.uint32), np.unique(every[::3]), np.unique(every)[:1], np.unique(every)[-1:]):
        assert c.among(every, frequent).tolist() == np.isin(every, frequent).tolist()


def test_ranks_over_parts_of_a_language(spark):
    rows = [("en", f"w{i} x{i}", 2, 20 + i % 7, 30, 30, 5 + i % 3) for i in range(500)]
    found = spark.createDataFrame(rows, "lang string, phrase string, size int, a bigint, l bigint, r bigint, score bigint")
    found = found.withColumn("part", c.F.pmod(c.F.xxhash64("phrase"), c.F.lit(8)))
    best = c.ranked(c.ranked(found, 9, "lang", "part"), 9, "lang").collect()
    expected = sorted((-r[6], -r[3], r[1]) for r in rows)[:9]
    assert [(-r["score"], -r["a"], r["phrase"]) for r in sorted(best, key=lambda r: r["rank"])] == expected
