"""Exact shard sizes, gapless slots, and a shuffle that is uniform."""

from __future__ import annotations

import zlib
from collections import Counter
from math import comb

import numpy as np
import pytest
from pyspark.sql import functions as F

from loyaltylens.llm import sharding


def check_law(rows, shards):
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    sizes = [len(slots.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and set(slots) <= set(range(shards))
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())


def test_report(docs):
    texts = ["", None, "Straße €", "same", "same", "x" * 70_000, *(f"text {i}" for i in range(60)), (3, "same"), (None, "no id")]
    given = docs(texts)
    rows = [r.asDict() for r in sharding.shard_report(given, 5).collect()]
    check_law(rows, 5)
    plain = [((i, t) if not isinstance(t, tuple) else t) for i, t in enumerate(texts)]
    expected = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in plain)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == expected
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("rows", None)}
    again = [r.asDict() for r in sharding.shard_report(given, 5).collect()]
    assert sorted(map(str, rows)) == sorted(map(str, again))


@pytest.mark.parametrize("rows", [0, 1, 15, 16, 17])
def test_few_rows(docs, rows):
    found = sharding.shard_report(docs([f"t{i}" for i in range(rows)]), 16).collect()
    assert len(found) == rows
    if rows:
        check_law([r.asDict() for r in found], 16)


def test_many_blocks_and_sources(spark, monkeypatch):
    """Sources and blocks of a few rows: every level of the matrix has several entries."""
    monkeypatch.setattr(sharding, "SOURCE_BITS", 3)
    monkeypatch.setattr(sharding, "BLOCK_BITS", 2)
    rows = spark.range(0, 500, numPartitions=7).withColumnRenamed("id", "block").withColumn("shard", F.lit("old"))
    found = [r.asDict() for r in sharding.uniform_shuffle(rows, 3, seed=5).collect()]
    check_law(found, 3)
    assert sorted(r["block"] for r in found) == list(range(500))
    order = [r["block"] for r in sorted(found, key=lambda r: (r["shard"], r["slot"]))]
    assert abs(np.corrcoef(order, range(500))[0, 1]) < 0.2


def test_draw_is_uniform():
    """Every pair of rows is equally often in one block, and every row equally often in each block."""
    rng = np.random.default_rng(3)
    places, together = Counter(), Counter()
    runs = 4000
    for _ in range(runs):  # the draw by itself: 6 rows of 3 sources to 2 blocks of 3
        left = np.array([3, 3])
        blocks = []
        for n in (1, 2, 3):
            own = sharding.draw(left, n, rng)
            left = left - own
            labels = np.repeat([0, 1], own)
            rng.shuffle(labels)
            blocks += labels.tolist()
        places.update(enumerate(blocks))
        together.update((i, j) for i in range(6) for j in range(i) if blocks[i] == blocks[j])
    assert all(abs(places[i, 0] / runs - 0.5) < 0.04 for i in range(6))
    share = 2 * comb(4, 1) / comb(6, 3)
    assert all(abs(c / runs - share) < 0.04 for c in together.values()) and len(together) == 15


def test_large_populations(monkeypatch):
    rng = np.random.default_rng(4)
    total, good, sample = 4 * 10**9, 10**9, 10**8
    found = [sharding.hypergeometric(good, total - good, sample, rng) for _ in range(200)]
    spread = (sample * 0.25 * 0.75 * (1 - sample / total)) ** 0.5
    assert abs(np.mean(found) - sample / 4) < 5 * spread / 200**0.5
    assert 0.8 < np.std(found) / spread < 1.2
    monkeypatch.setattr(sharding, "SMALL", 0)
    small = Counter(sharding.hypergeometric(7, 5, 6, rng) for _ in range(20_000))
    for k in range(1, 7):
        assert abs(small[k] / 20_000 - comb(7, k) * comb(5, 6 - k) / comb(12, 6)) < 0.02
    assert [sharding.hypergeometric(*x, rng) for x in ((0, 5, 3), (5, 0, 3), (5, 4, 0), (5, 4, 9))] == [0, 3, 0, 5]
    wide = sharding.draw(np.array([2**40, 0, 2**40, 5]), 2**40, rng)
    assert wide.sum() == 2**40 and wide[1] == 0 and wide[3] <= 5


def test_written_shards(docs, spark, tmp_path):
    given = docs([f"t{i}" for i in range(40)])
    sharding.write_shards(given, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    check_law([r.asDict() for r in back.collect()], 4)
    assert Counter(map(tuple, back.select(given.columns).collect())) == Counter(map(tuple, given.collect()))
