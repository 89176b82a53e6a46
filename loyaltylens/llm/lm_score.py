"""Language-model scores from a log-frequency Bloom filter of n-gram counts.

Training n-grams are counted in shards.  A shard holds the exact counts of its single tokens and a Bloom filter of
its longer n-grams, in which an n-gram stands once for every step up to its quantised count.  Its count is read back
by asking for step after step until one is missing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyaltylens.llm.common import keep, pieces
from loyaltylens.llm.hashing import joined, mixed, word_hashes

END = np.uint64(0x5BD1E9955BD1E995)  # stands for the end of a text, and for what is before its first token
STEPS = np.array(sorted({1, 3} | {2**i for i in range(1, 60)} | {3 * 2**i for i in range(60)}), dtype=np.float64)
# A count is read back as the middle of those that reach a step and not the next; 0 for none.
READ = np.r_[0.0, (STEPS[:-1] + STEPS[1:] - 1) / 2, STEPS[-1]]
RATIO_BINS, CONTEXT_BINS = 160, 24
ROOM = 1.3  # bits of the filter, of those that one spread over all words would need
COUNTED_TOKENS = 1 << 19  # tokens whose equal n-grams meet before they are moved


@dataclass(frozen=True)
class Settings:
    """``order``: longest n-gram.  ``probes``: bits asked per step, 10 at most; a missing step is taken for there once in
    2**probes.  ``shard_bytes``: text counted per shard.  ``slice_bytes``: most that is broadcast at a time."""

    order: int = 2
    probes: int = 6
    shard_bytes: int = 8 << 20
    slice_bytes: int = 192 << 20


def ngram_keys(tokens: np.ndarray, ends: np.ndarray, order: int) -> list[np.ndarray]:
    """For n = 1 to ``order``, the hash of the n-gram that ends at each token; texts stand one behind the other and
    ``ends`` are the places of their end tokens.  Before a text stands one end token; longer contexts stop there."""
    starts = np.r_[0, ends[:-1] + 1]
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[starts] = END
    keys = [tokens, joined(before, tokens)][:order]
    for _ in range(2, order):
        # The n-gram of n + 1 tokens is the n-gram before the token, joined with the token.
        context = np.empty_like(tokens)
        context[1:] = keys[-1][:-1]
        context[starts] = END
        keys.append(joined(mixed(context), tokens))
    return keys


def tokenised(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, each with its end token, and the places of the end tokens."""
    words, counts = word_hashes(found)
    ends = np.cumsum(counts + 1) - 1
    tokens = np.full(len(words) + len(found), END, dtype=np.uint64)
    inner = np.ones(len(tokens), bool)
    inner[ends] = False
    tokens[inner] = words
    return tokens, ends


def counted(rows: DataFrame, shards: int, settings: Settings) -> DataFrame:
    """Counts of all n-grams, packed: (shard, n, keys, counts).  Equal n-grams of about half a million tokens meet first."""

    def packed(held: list[list[np.ndarray]]) -> pa.RecordBatch:
        out = []
        for n, parts in enumerate(held, 1):
            keys, counts = np.unique(np.concatenate(parts), return_counts=True)
            parts.clear()
            shard = (keys % np.uint64(shards)).astype(np.int32)
            order = np.argsort(shard, kind="stable")
            cuts = np.searchsorted(shard[order], np.arange(shards + 1))
            keys, counts = keys[order], counts[order].astype(np.uint32)
            out += [
                (s, n, keys[a:b].tobytes(), counts[a:b].tobytes())
                for s, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a
            ]
        return _batch(out, ["shard", "n", "keys", "counts"], [pa.int32(), pa.int32(), pa.binary(), pa.binary()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [[] for _ in range(settings.order)], 0
        for _, found in pieces(batches):
            tokens, ends = tokenised(found)
            for own, keys in zip(held, ngram_keys(tokens, ends, settings.order)):
                own.append(keys)
            size += len(tokens)
            if size >= COUNTED_TOKENS:
                yield packed(held)
                size = 0
        if size:
            yield packed(held)

    return rows.mapInArrow(run, "shard int, n int, keys binary, counts binary")


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sum of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order].astype(np.int64)
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


def levels(counts: np.ndarray) -> np.ndarray:
    """Step of each count: how many of the quantised counts it reaches."""
    return np.searchsorted(STEPS, counts, side="right")


def count_of(reached: np.ndarray) -> np.ndarray:
    """The count that stands for each step."""
    return READ[reached]


def probe_words(keys: np.ndarray, step: int, probes: int, words: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """For each key, the word of the filter that holds a step, and the bits in it; one word, so one read of memory."""
    salt = np.uint64(step * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    spread = mixed(keys ^ salt)
    bits, mask = mixed(spread + salt), np.zeros(len(keys), np.uint64)
    for probe in range(probes):
        mask |= np.uint64(1) << ((bits >> np.uint64(6 * probe)) & np.uint64(63))
    return spread % (np.uint64(words) if isinstance(words, int) else words), mask


def bloom_filter(keys: np.ndarray, counts: np.ndarray, probes: int) -> np.ndarray:
    """Words that hold every key once per step of its count; sized by the number of entries.

    All bits of an entry lie in one word of 64.  Words fill unevenly, so there are ``ROOM`` times the bits that a filter
    spread over all words would have.
    """
    reached = levels(counts)
    found = np.zeros(max(1, math.ceil(int(reached.sum()) * probes * ROOM / math.log(2) / 64)), np.uint64)
    for step in range(1, int(reached.max(initial=0)) + 1):
        place, mask = probe_words(keys[reached >= step], step, probes, len(found))
        order = np.argsort(place)
        place, mask = place[order], mask[order]
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        found[place[first]] |= np.bitwise_or.reduceat(mask, first)
    return found


def shard_models(counts: DataFrame, settings: Settings) -> DataFrame:
    """One row per shard: keys and counts of its tokens, its Bloom filter, and sums."""

    def build(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        def part(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
            packed = b"".join(rows["keys"]), b"".join(rows["counts"])
            return summed(np.frombuffer(packed[0], np.uint64), np.frombuffer(packed[1], np.uint32))

        tokens, times = part(group[group.n == 1])
        longer, uses = part(group[group.n > 1])
        bits = bloom_filter(longer, uses, settings.probes)
        return pd.DataFrame({
            "shard": [key[0]], "tokens": [tokens.tobytes()], "times": [times.tobytes()], "bits": [bits.tobytes()],
            "total": [int(times.sum())], "distinct": [len(tokens)], "bytes": [16 * len(tokens) + bits.nbytes],
        })

    schema = "shard int, tokens binary, times binary, bits binary, total bigint, distinct bigint, bytes bigint"
    return counts.groupBy("shard").applyInPandas(build, schema)


class Slice:
    """Some shards of the model: counts of tokens, and the filter."""

    def __init__(self, rows: list, shards: int, probes: int) -> None:
        self.shards, self.probes = shards, probes
        tokens = [np.frombuffer(r["tokens"], np.uint64) for r in rows]
        self.tokens, self.times = np.concatenate(tokens), np.concatenate([np.frombuffer(r["times"], np.int64) for r in rows])
        order = np.argsort(self.tokens)
        self.tokens, self.times = self.tokens[order], self.times[order].astype(np.uint32 if self.times.max(initial=0) < 1 << 32 else np.int64)
        self.bits = np.frombuffer(b"".join(r["bits"] for r in rows), np.uint64)
        # First word and number of words of each shard; none for a shard of another slice.
        self.first, self.size = np.zeros(shards, np.uint64), np.zeros(shards, np.uint64)
        at = 0
        for r in rows:
            self.first[r["shard"]], self.size[r["shard"]] = at, len(r["bits"]) // 8
            at += len(r["bits"]) // 8

    def counts(self, tokens: np.ndarray) -> np.ndarray:
        if not len(self.tokens):
            return np.zeros(len(tokens), np.int64)
        distinct, back = np.unique(tokens, return_inverse=True)
        slot = np.minimum(np.searchsorted(self.tokens, distinct), len(self.tokens) - 1)
        return np.where(self.tokens[slot] == distinct, self.times[slot], 0).astype(np.int64)[back]

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Quantised count of each n-gram, 0 for none: probes step after step as long as all bits are there."""
        shard = (keys % np.uint64(self.shards)).astype(np.int64)
        found = np.zeros(len(keys), np.uint8)
        alive = np.flatnonzero(self.size[shard] > 0)
        step = 0
        while len(alive):
            step += 1
            own = shard[alive]
            place, mask = probe_words(keys[alive], step, self.probes, self.size[own])
            alive = alive[self.bits[self.first[own] + place] & mask == mask]
            found[alive] = step
        return found


@dataclass(frozen=True)
class Model:
    """Sums of the training texts, and the weight of each longer order by the size of the context's count."""

    order: int
    total: int
    distinct: int
    texts: int
    weights: tuple[tuple[float, ...], ...] = ()

    def unigram(self, times: np.ndarray) -> np.ndarray:
        """Probability of each token by its count alone; one part is left for a token never seen."""
        return (times + 0.5) / (self.total + 0.5 * (self.distinct + 1))

    def contexts(self, times: np.ndarray, reached: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        """Count of the context of each n-gram, n = 2 to ``order``: the count of the n-gram before, one token back."""
        starts = np.r_[0, ends[:-1] + 1]
        found = []
        for n in range(2, self.order + 1):
            own = times if n == 2 else count_of(reached[n - 3])
            before = np.r_[0, own[:-1]].astype(np.float64)
            before[starts] = self.texts
            found.append(before)
        return found

    def log_probability(self, times: np.ndarray, reached: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """log10 of the probability of each token: the orders from one to the longest, mixed by the weights."""
        p = self.unigram(times)
        for n, context in enumerate(self.contexts(times, reached, ends)):
            count = count_of(reached[n])
            weight = np.array(self.weights[n])[context_bin(context)]
            p = weight * np.minimum(1.0, count / np.maximum(context, 1)) + (1 - weight) * p
        return np.log10(p)


def context_bin(context: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(context, 0) + 1).astype(np.int64), CONTEXT_BINS - 1)


def _state(rows: DataFrame) -> DataFrame:
    """Texts with room for what the slices say about them: token counts and steps of the longer n-grams."""
    empty = F.lit(None).cast("binary")
    return rows.withColumn("times", empty).withColumn("steps", empty)


def looked_up(state: DataFrame, model_slice, order: int) -> DataFrame:
    """``state`` with the counts and steps that a broadcast slice knows added."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, length in _cuts(batch.column("text")):
                part = batch.slice(start, length)
                times, steps, ends = _probe(part, model_slice.value, order)
                starts = [0, *(ends[:-1] + 1).tolist()]
                cut = list(zip(starts, (ends + 1).tolist()))
                columns = {
                    "times": pa.array([times[a:b].tobytes() for a, b in cut], pa.binary()),
                    "steps": pa.array([steps[:, a:b].tobytes() for a, b in cut], pa.binary()),
                }
                yield pa.RecordBatch.from_arrays(
                    [columns.get(c, part.column(c)) for c in part.schema.names], part.schema.names
                )

    return state.mapInArrow(run, state.schema)


def _cuts(column: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    start = size = 0
    for row, length in enumerate(pc.binary_length(column).to_pylist()):
        if row > start and size + length > most:
            yield start, row - start
            start, size = row, 0
        size += length
    if len(column):
        yield start, len(column) - start


def _probe(part: pa.RecordBatch, known: Slice | None, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token counts, steps per longer order, and places of the end tokens; what earlier slices said is added."""
    found = part.column("text").cast(pa.binary()).to_pylist()
    tokens, ends = tokenised(found)
    times, steps = np.zeros(len(tokens), np.int64), np.zeros((order - 1, len(tokens)), np.uint8)
    if known is not None:
        keys = ngram_keys(tokens, ends, order)
        times = known.counts(tokens)
        steps = np.array([known.levels(k) for k in keys[1:]], dtype=np.uint8).reshape(order - 1, len(tokens))
    earlier = part.column("times").to_pylist()
    if earlier[0] is not None:
        times = times + np.frombuffer(b"".join(earlier), np.int64)
        rows = [np.frombuffer(x, np.uint8).reshape(order - 1, -1) for x in part.column("steps").to_pylist()]
        steps = np.maximum(steps, np.concatenate(rows, axis=1))
    return times, steps, ends


def tuned(state: DataFrame, last, model: Model) -> Model:
    """The model with weights that make all training texts likely when each n-gram is counted once less.

    Per order and size of context, tasks only return how often each ratio to the order below occurs.
    """
    order = model.order

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = np.zeros((order - 1, CONTEXT_BINS, RATIO_BINS), np.int64)
        for batch in batches:
            for start, length in _cuts(batch.column("text")):
                times, steps, ends = _probe(batch.slice(start, length), last.value, order)
                p = model.unigram(np.maximum(times - 1, 0))
                for n, context in enumerate(model.contexts(times, steps, ends)):
                    count = count_of(steps[n])
                    ratio = np.maximum(count - 1, 0) / np.maximum(context - 1, 1) / p
                    place = np.where(ratio > 0, np.clip(4 * np.log2(np.maximum(ratio, 1e-9)) + 40, 1, RATIO_BINS - 1), 0)
                    cell = context_bin(context) * RATIO_BINS + place.astype(np.int64)
                    tally[n] += np.bincount(cell, minlength=CONTEXT_BINS * RATIO_BINS).reshape(CONTEXT_BINS, RATIO_BINS)
        n, context, ratio = np.nonzero(tally)
        yield _batch(
            list(zip(n.tolist(), context.tolist(), ratio.tolist(), tally[n, context, ratio].tolist())),
            ["n", "context", "ratio", "uses"], [pa.int32(), pa.int32(), pa.int32(), pa.int64()],
        )

    each = state.mapInArrow(measure, "n int, context int, ratio int, uses bigint")
    tally = np.zeros((order - 1, CONTEXT_BINS, RATIO_BINS))
    for r in each.groupBy("n", "context", "ratio").agg(F.sum("uses").alias("uses")).collect():
        tally[r["n"], r["context"], r["ratio"]] = r["uses"]
    ratio = np.r_[0.0, 2.0 ** ((np.arange(1, RATIO_BINS) - 40) / 4)]
    weights = np.full((order - 1, CONTEXT_BINS), 0.3)
    for _ in range(50):
        own = weights[:, :, None] * ratio / (weights[:, :, None] * ratio + 1 - weights[:, :, None])
        uses = tally.sum(axis=2)
        # Three uses at the first guess stand in for contexts that the training texts lack.
        weights = ((tally * own).sum(axis=2) + 0.9) / (uses + 3)
    weights = np.clip(weights, 1e-4, 0.9999)
    # The first bin is the count 0: after a context never seen, the order below has the whole say.
    weights[:, 0] = 0.0
    return Model(order, model.total, model.distinct, model.texts, tuple(map(tuple, weights.tolist())))


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document.

    The model learns from all texts whose crc32 of the id, as text, leaves another remainder than 1 when divided
    by 5 (a missing id counts as an empty text, so such texts are learnt from).  Counts and filter follow the
    corpus.  The driver only passes shards on, in slices of at most ``slice_bytes``; if the model is larger, the
    texts are looked up slice by slice and what is known of them is written out in between.

    ``base_score`` is the sum of log10((c + 0.5) / (N + 0.5 (V + 1))) over the tokens, ``score`` the log10
    probability under the mixed orders.  A missing text is empty: its one token is its end.
    """
    spark = docs.sparkSession
    rest = F.crc32(F.coalesce(docs[id_col].cast("string"), F.lit("")).cast("binary")) % 5
    rows = docs.select(
        docs[id_col].cast("bigint").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"),
        (rest == 1).alias("held_out"),
    )
    training = rows.filter(~F.col("held_out")).select("doc_id", "text")
    size = training.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    shards = max(8, math.ceil(size[1] / settings.shard_bytes))
    models = keep(shard_models(counted(training, shards, settings), settings))
    sums = models.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("total", "distinct"))).first()
    model = Model(settings.order, int(sums[0]), int(sums[1]), int(size[0]))

    state, last = _state(rows), None
    loaded, held = [], 0
    for row in models.toLocalIterator():
        if loaded and held + row["bytes"] > settings.slice_bytes:
            last = spark.sparkContext.broadcast(Slice(loaded, shards, settings.probes))
            state = keep(looked_up(state, last, settings.order))
            last.unpersist()
            loaded, held = [], 0
        loaded.append(row.asDict())
        held += row["bytes"]
    last = spark.sparkContext.broadcast(Slice(loaded, shards, settings.probes) if loaded else None)
    del loaded
    model = tuned(state.filter(~F.col("held_out")), last, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, length in _cuts(batch.column("text")):
                part = batch.slice(start, length)
                times, steps, ends = _probe(part, last.value, model.order)
                starts = np.r_[0, ends[:-1] + 1]
                base = np.add.reduceat(np.log10(model.unigram(times)), starts)
                mixed_score = np.add.reduceat(model.log_probability(times, steps, ends), starts)
                known = np.add.reduceat((times > 0).astype(np.int64), starts)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), part.column("held_out"), pa.array(ends + 1 - starts, pa.int64()),
                        pa.array(known), pa.array([model.total] * length, pa.int64()), pa.array(base), pa.array(mixed_score),
                    ],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    schema = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return state.mapInArrow(run, schema)
