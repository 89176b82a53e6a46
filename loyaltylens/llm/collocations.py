"""Phrases whose words occur together far more often than apart, by mergeable frequent-item summaries.

Every count is exact in the end, and nothing that grows with the corpus is broadcast or held by the driver:

1. Texts are gathered into blocks of one language and a few MB, with a number each, and written once, compressed.
2. Each block counts its own word sequences and sends them, as 32-bit fingerprints, to hash partitions ("buckets").
3. Each bucket merges what the blocks sent into a Misra-Gries summary with more counters than its mass divided by the
   threshold, so that no frequent sequence is lost, and answers every block with one bit per fingerprint it sent.
4. Each block meets its answers, alone in its group, and counts again, only the sequences whose bit is set, now as
   texts; sums of these are exact.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loyaltylens.llm.common import keep, texts
from loyaltylens.llm.hashing import joined

# A-Z are lowered; these characters end a piece; BREAK is a byte that no UTF-8 text has.
BREAK = 0xFF
TABLE = bytes(c + 32 if 65 <= c <= 90 else BREAK if c in b".,;:!?\n\x0b\x0c\r" else c for c in range(256))
MARK = bytes([BREAK])

LOOKED_UP = 1 << 18  # fingerprints that are looked up at once
PAGES = {"compression": "none", "parquet.enable.dictionary": "false", "parquet.page.size.row.check.min": "1"}
PARTS = 64  # of the phrases of a language, each ranked by a task of its own first


@dataclass(frozen=True)
class Settings:
    longest: int = 3  # words of a phrase at most
    min_count: int = 10  # how often a phrase has to occur
    covered_percent: int = 50  # a phrase goes if a longer one holds this share of its occurrences
    best: int = 2000  # phrases per language
    block_bytes: int = 2 << 20  # text of a block; a task works on one block at a time
    bucket_mass: int = 1 << 22  # occurrences counted by one bucket, which a task holds at a time
    counters: int = 2  # counters of a summary, as a multiple of its mass divided by min_count


# -- blocks of text ---------------------------------------------------------------------------------


def blocks(
    docs: DataFrame, settings: Settings, text_col: str = "text", lang_col: str = "lang", packed: bool = False
) -> DataFrame:
    """block, lang, normalised data of all texts, ``settings.block_bytes`` each or a little more, and its size.

    Texts are cut at the ends of pieces only, so no phrase is lost between blocks.  ``packed`` data is compressed, for
    :func:`unpacked`: an executor holds a row several times over while it is read, sorted and sent.
    """
    limit = settings.block_bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list[bytes]] = {}
        held: dict[str, int] = {}
        number = TaskContext.get().partitionId() << 32

        def flush(lang: str) -> pa.RecordBatch:
            nonlocal number
            number += 1
            data = MARK.join(waiting.pop(lang))
            held.pop(lang)
            size = len(data)
            data = pa.compress(data, codec="zstd", asbytes=True) if packed else data
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([lang]), pa.array([data], pa.binary()), pa.array([size], pa.int64())],
                ["block", "lang", "data", "size"],
            )

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                data = text.as_py().translate(TABLE)
                start = 0
                while start < len(data):
                    end = data.find(MARK, start + limit) if len(data) - start > limit else len(data)
                    end = len(data) if end < 0 else end
                    waiting.setdefault(lang, []).append(data[start:end])
                    held[lang] = held.get(lang, 0) + end - start + 1
                    start = end + 1
                    if held[lang] >= limit:
                        yield flush(lang)
                    elif sum(held.values()) >= 4 * limit:
                        yield flush(max(held, key=held.get))
        for lang in list(held):
            yield flush(lang)

    found = texts(docs, lang_col, text_col).select(F.coalesce("doc_id", F.lit("und")).alias("lang"), "text")
    return found.mapInArrow(run, "block bigint, lang string, data binary, size bigint")


def unpacked(data: pa.BinaryScalar, size: pa.Int64Scalar) -> bytes:
    return pa.decompress(data.as_buffer(), decompressed_size=size.as_py(), codec="zstd", asbytes=True)


class Sequences:
    """All sequences of one to ``longest`` words of a block, each once, with their counts.

    Level n has, for every distinct sequence of n words, the number of its first n - 1 words on the level before, the
    number of its last word, and how often it occurs.  They are numbered as they are sorted, the same in both passes.
    """

    def __init__(self, data: bytes, longest: int) -> None:
        found = data.replace(MARK, b" \xff ").split()
        number: dict[bytes, int] = {MARK: 0}
        ids = np.fromiter((number.setdefault(w, len(number)) for w in found), np.int32, len(found))
        del found
        self.words = list(number)
        size = len(number)
        del number
        counts = np.bincount(ids, minlength=size)
        counts[0] = 0
        self.total = int(counts.sum())
        self.levels = [(np.zeros(size, np.int32), np.arange(size, dtype=np.int32), counts)]
        current = np.where(ids > 0, ids, np.int32(-1))
        for n in range(2, longest + 1):
            after = ids[n - 1 :]
            current = current[: len(after)]
            here = np.flatnonzero((current >= 0) & (after > 0))
            pairs = current[here].astype(np.int64) * size + after[here]
            keys, inverse, counts = np.unique(pairs, return_inverse=True, return_counts=True)
            self.levels.append(((keys // size).astype(np.int32), (keys % size).astype(np.int32), counts))
            current = np.full(len(after), -1, np.int32)
            current[here] = inverse

    def counts(self) -> np.ndarray:
        return np.concatenate([counts for _, _, counts in self.levels])

    def hashes(self, lang: str) -> np.ndarray:
        """64-bit hash of every sequence, of all levels."""
        seed = zlib.crc32(lang.encode())
        words = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in self.words), np.uint64, len(self.words))
        found = [words]
        for first, last, _ in self.levels[1:]:
            found.append(joined(found[-1][first], words[last]))
        return np.concatenate(found)

    def named(self, chosen: np.ndarray) -> Iterator[tuple[int, bytes, int]]:
        """Length, text and count of the sequences that are ``chosen`` (a flag for each, of all levels)."""
        at = 0
        for n, (first, last, counts) in enumerate(self.levels, 1):
            rows = np.flatnonzero(chosen[at : at + len(counts)] & (counts > 0))
            at += len(counts)
            column, parent = [last[rows]], first[rows]
            for before in range(n - 2, -1, -1):
                column.append(self.levels[before][1][parent])
                parent = self.levels[before][0][parent]
            parts = [[self.words[w] for w in c] for c in reversed(column)]
            yield from zip([n] * len(rows), map(b" ".join, zip(*parts)), counts[rows].tolist())


def by_bucket(hashes: np.ndarray, counts: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the sequences that occur, sorted by bucket and fingerprint, with both."""
    there = np.flatnonzero(counts)
    key = hashes[there]
    key = (key >> np.uint64(32)) % np.uint64(buckets) << np.uint64(32) | key & np.uint64(0xFFFFFFFF)
    order = np.argsort(key, kind="stable")
    key = key[order]
    return there[order], (key >> np.uint64(32)).astype(np.int64), key.astype(np.uint32)


# -- summaries ---------------------------------------------------------------------------------------


def count_type(min_count: int) -> np.dtype:
    return np.dtype("<u1" if min_count < 256 else "<u4")


def summaries(found: DataFrame, buckets: int, settings: Settings) -> DataFrame:
    """bucket, block, fingerprints and counts of every block, one row per bucket.

    A count above the threshold is sent as the threshold: whether a sum reaches it is the same.
    """
    kind = count_type(settings.min_count)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, lang, data, size in zip(*(batch.column(c) for c in ("block", "lang", "data", "size"))):
                own = Sequences(unpacked(data, size), settings.longest)
                counts = own.counts()
                order, bucket, prints = by_bucket(own.hashes(lang.as_py()), counts, buckets)
                del own
                sent = np.minimum(counts[order], settings.min_count).astype(kind)
                ends = np.searchsorted(bucket, np.arange(buckets + 1))
                there = np.flatnonzero(np.diff(ends))
                cut = [(int(ends[b]), int(ends[b + 1])) for b in there]
                arrays = [
                    pa.array(there, pa.int64()),
                    pa.array([block.as_py()] * len(there), pa.int64()),
                    pa.array([prints[s:e].tobytes() for s, e in cut], pa.binary()),
                    pa.array([sent[s:e].tobytes() for s, e in cut], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, ["bucket", "block", "prints", "counts"])

    return found.mapInArrow(run, "bucket bigint, block bigint, prints binary, counts binary")


class Summary:
    """Misra-Gries counters that can be merged: at most ``capacity`` of them stay.

    ``lost`` is what any key may have been counted short; it stays below mass / (capacity + 1).
    """

    def __init__(self, capacity: int) -> None:
        self.capacity, self.lost = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def merge(self, keys: np.ndarray, counts: np.ndarray) -> None:
        keys = np.concatenate([self.keys, keys])
        order = np.argsort(keys)
        keys = keys[order]
        first = np.flatnonzero(np.concatenate([[len(keys) > 0], keys[1:] != keys[:-1]]))
        self.keys, both = keys[first], np.concatenate([self.counts, counts])[order]
        self.counts = np.add.reduceat(both, first) if len(first) else both
        if len(self.keys) > self.capacity:
            place = len(self.counts) - self.capacity - 1
            least = int(np.partition(self.counts, place)[place])  # the largest count that has no room
            self.lost += least
            left = self.counts > least
            self.keys, self.counts = self.keys[left], self.counts[left] - least

    def may_reach(self, threshold: int) -> np.ndarray:
        """Every key whose true count is at least ``threshold``, and few others, in order."""
        return self.keys[self.counts + self.lost >= threshold]


def gathered(arrays: list[np.ndarray], least: int) -> Iterator[tuple[int, int]]:
    """From where to where neighbouring arrays have ``least`` values together; the last may have fewer."""
    start = held = 0
    for i, array in enumerate(arrays, 1):
        held += len(array)
        if held >= least or i == len(arrays):
            yield start, i
            start, held = i, 0


def among(prints: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Which of the fingerprints are among those of ``frequent``, which are in order."""
    if not len(frequent):
        return np.zeros(len(prints), bool)
    at = np.searchsorted(frequent, prints)
    return frequent[np.minimum(at, len(frequent) - 1)] == prints


def answers(sent: DataFrame, settings: Settings) -> DataFrame:
    """block, bucket and bits: which of the fingerprints that a block sent to a bucket may be frequent.

    A bucket is a group of one task: its size follows ``settings.bucket_mass``, as hashes deal sequences evenly and a
    block sends a sequence once, however often it occurs.
    """
    kind, threshold = count_type(settings.min_count), settings.min_count

    def run(group: pa.Table) -> pa.Table:
        prints = [np.frombuffer(p.as_buffer(), "<u4") for p in group.column("prints")]
        counts = [np.frombuffer(c.as_buffer(), kind) for c in group.column("counts")]
        mass = sum(int(c.sum(dtype=np.int64)) for c in counts)
        summary = Summary(settings.counters * mass // threshold + 1)
        for start, end in gathered(prints, summary.capacity):
            summary.merge(np.concatenate(prints[start:end]), np.concatenate(counts[start:end]))
        frequent = summary.may_reach(threshold)
        bits: list[bytes] = []
        for start, end in gathered(prints, LOOKED_UP):
            flags = among(np.concatenate(prints[start:end]), frequent)
            ends = np.cumsum([len(p) for p in prints[start:end]]).tolist()
            bits += [np.packbits(flags[s:e]).tobytes() for s, e in zip([0, *ends], ends)]
        return pa.table([group.column("block"), group.column("bucket"), pa.array(bits, pa.binary())], ["block", "bucket", "bits"])

    return sent.groupBy("bucket").applyInArrow(run, "block bigint, bucket bigint, bits binary")


def exact_counts(found: DataFrame, answered: DataFrame, buckets: int, settings: Settings) -> DataFrame:
    """lang, size, phrase and count of the sequences that may be frequent, one row per block; size 0 counts words."""
    names = ["lang", "size", "phrase", "count"]
    kinds = pa.schema(zip(names, [pa.string(), pa.int32(), pa.string(), pa.int64()]))

    def run(block: pa.Table, answer: pa.Table) -> pa.Table:
        if not answer.num_rows:  # a block without words
            return kinds.empty_table()
        lang = block.column("lang")[0].as_py()
        own = Sequences(unpacked(block.column("data")[0], block.column("size")[0]), settings.longest)
        counts = own.counts()
        order, bucket, _ = by_bucket(own.hashes(lang), counts, buckets)
        sizes = np.unique(bucket, return_counts=True)[1]
        bits = [answer.column("bits")[i].as_buffer() for i in np.argsort(answer.column("bucket").to_numpy()).tolist()]
        flags = [np.unpackbits(np.frombuffer(b, np.uint8), count=n) for b, n in zip(bits, sizes)]
        chosen = np.zeros(len(counts), bool)
        chosen[order] = np.concatenate(flags).astype(bool)
        rows = chain([(0, b"", own.total)], own.named(chosen))
        batches = []
        while part := list(islice(rows, 20_000)):
            size, phrase, count = zip(*part)
            arrays = [pa.array([lang] * len(size)), pa.array(size, pa.int32()), pa.array(phrase, pa.binary()).cast(pa.string())]
            batches.append(pa.RecordBatch.from_arrays([*arrays, pa.array(count, pa.int64())], schema=kinds))
        return pa.Table.from_batches(batches)

    # A group is sent by itself, so a task holds one block and its answers at a time.
    both = found.groupBy("block").cogroup(answered.groupBy("block"))
    return both.applyInArrow(run, "lang string, size int, phrase string, count bigint")


def frequent_sequences(docs: DataFrame, settings: Settings, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, size, phrase and count of every sequence of up to ``longest`` words that occurs ``min_count`` times.

    Counted within pieces, overlaps included, for each language by itself.  Rows of size 0 hold the words of a language.
    """
    # A page of the table is one block: by default it has 100 rows at least, and is held whole.
    found = keep(blocks(docs, settings, text_col, lang_col, packed=True), **PAGES)
    total = found.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    # About six bytes a word; it only decides how finely the sequences are dealt.
    buckets = max(1, math.ceil(total / 6 * settings.longest / settings.bucket_mass))
    # Kept, so that Spark can let go of the fingerprints, which take more room than the texts.
    answered = keep(answers(summaries(found, buckets, settings), settings))
    counted = exact_counts(found, answered, buckets, settings)
    sums = counted.groupBy("lang", "size", "phrase").agg(F.sum("count").alias("count"))
    return sums.filter((F.col("count") >= settings.min_count) | (F.col("size") == 0))


# -- phrases -----------------------------------------------------------------------------------------


def wide(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(19,0)")


def scored(candidates: DataFrame, frequent: DataFrame) -> DataFrame:
    """lang, phrase, size, a, l, r and score of the cut with the lowest score; of equal ones the first.

    Both parts of a frequent phrase are frequent, so they are all there.  The products are whole decimals of up to
    38 digits and the quotient is cut off, not rounded.
    """
    words = F.split("phrase", " ")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumns({
        "first": F.array_join(F.slice(words, F.lit(1), F.col("k")), " "),
        "rest": F.array_join(F.slice(words, F.col("k") + 1, F.col("size") - F.col("k")), " "),
    })
    left = frequent.select(F.col("lang").alias("lang_l"), F.col("phrase").alias("first"), F.col("count").alias("l"))
    right = frequent.select(F.col("lang").alias("lang_r"), F.col("phrase").alias("rest"), F.col("count").alias("r"))
    both = cuts.join(left, (F.col("lang") == F.col("lang_l")) & (cuts["first"] == left["first"])).select(cuts["*"], "l")
    both = both.join(right, (F.col("lang") == F.col("lang_r")) & (both["rest"] == right["rest"])).select(both["*"], "r")
    both = both.withColumn("_upper", F.lit(1_000_000).cast("decimal(7,0)") * (wide("a") * wide("a")))
    both = both.withColumn("_lower", wide("l") * wide("r")).withColumn("score", F.expr("_upper div _lower"))
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    return both.groupBy("lang", "phrase", "size", "a").agg(lowest).select(
        "lang", "phrase", "size", "a", "cut.l", "cut.r", "cut.score"
    )


def covering(candidates: DataFrame, settings: Settings) -> DataFrame:
    """lang, phrase and the highest count of a longer candidate that holds the phrase's words in a row."""
    words = F.split("phrase", " ")
    longer = candidates.filter("size > 2").select("lang", "a", "size", words.alias("words"))
    parts = [
        F.array_join(F.slice("words", start + 1, size), " ")
        for size in range(2, settings.longest)
        for start in range(settings.longest - size + 1)
    ]
    fits = [
        F.lit(start + size) <= F.col("size") if size < settings.longest else F.lit(False)
        for size in range(2, settings.longest)
        for start in range(settings.longest - size + 1)
    ]
    # A part as long as the phrase itself is no part of a longer one.
    proper = [size for size in range(2, settings.longest) for _ in range(settings.longest - size + 1)]
    inside = F.array(*(F.when(fit & (F.col("size") > n), p) for p, fit, n in zip(parts, fits, proper)))
    each = longer.select("lang", "a", F.explode(inside).alias("phrase")).filter("phrase IS NOT NULL")
    return each.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))


def ranked(found: DataFrame, best: int, *groups: str) -> DataFrame:
    """The ``best`` rows of each group and their rank."""
    order = Window.partitionBy(*groups).orderBy(F.desc("score"), F.desc("a"), "phrase")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)


def collocations(
    docs: DataFrame, settings: Settings = Settings(), text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """The best phrases of every language: lang, rank, phrase, a, l, r, n and score.

    ``a`` is how often the phrase occurs, ``l`` and ``r`` how often its two parts do at the cut that scores lowest,
    ``n`` the words of the language, ``score`` floor(1,000,000 a a / (l r)).  A phrase that mostly stands within a
    longer one is left out.

    A missing text is empty and a missing language is ``und``; repeated rows count each; equal scores are ranked by
    count, then phrase; an empty table gives no rows; other columns are not looked at.  Texts of any length are cut
    into blocks at the ends of pieces, and a hot phrase is added up per block before it moves.
    """
    frequent = keep(frequent_sequences(docs, settings, text_col, lang_col))
    totals = frequent.filter("size = 0").select("lang", F.col("count").alias("n"))
    candidates = frequent.filter("size >= 2").select("lang", "phrase", "size", F.col("count").alias("a"))
    found = scored(candidates, frequent.filter("size >= 1"))
    if settings.longest > 2:
        held = covering(candidates, settings)
        found = found.join(held, ["lang", "phrase"], "left")
        share = wide("longer") * 100 >= wide("a") * settings.covered_percent
        found = found.filter(~F.coalesce(share, F.lit(False)))
    # The best of each part of a language are found first, so that no task sorts a whole language.
    found = found.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    best = ranked(ranked(found, settings.best, "lang", "part"), settings.best, "lang")
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


ORACLE = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
s AS (SELECT lang, k, unnest(list_transform(generate_series(1, len(ws) - k + 1), lambda i:
        array_to_string(list_slice(ws, i, i + k - 1), ' '))) AS phrase
    FROM w, (VALUES (1), (2), (3)) AS sizes(k) WHERE len(ws) >= k),
f AS (SELECT lang, k, phrase, count(*) AS f FROM s GROUP BY lang, k, phrase),
n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
often AS MATERIALIZED (SELECT concat(lang, chr(10), phrase) AS key, f FROM f WHERE f >= 10),
c AS MATERIALIZED (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND f >= 10),
parts AS MATERIALIZED (SELECT c.lang, phrase, a, j, concat(c.lang, chr(10), array_to_string(list_slice(ws, 1, j), ' ')) AS head,
        concat(c.lang, chr(10), array_to_string(list_slice(ws, j + 1, c.k), ' ')) AS tail
    FROM c, (VALUES (1), (2)) AS cut(j) WHERE j < c.k),
heads AS MATERIALIZED (SELECT parts.*, often.f AS l FROM parts JOIN often ON head = key),
cuts AS (SELECT heads.*, often.f AS r, (1000000::HUGEINT * a * a) // (l::HUGEINT * often.f) AS score
    FROM heads JOIN often ON tail = key),
low AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inner_pairs AS (SELECT lang, a, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS phrase
    FROM c WHERE k = 3),
held AS (SELECT lang, phrase, max(a) AS longer FROM inner_pairs GROUP BY lang, phrase),
kept AS (SELECT low.* FROM low LEFT JOIN held ON low.lang = held.lang AND low.phrase = held.phrase
    WHERE longer IS NULL OR 100 * longer < 50 * a)
SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
    n::BIGINT AS n, score::BIGINT AS score
FROM kept JOIN n ON kept.lang = n.lang
QUALIFY row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""
