"""Similarity join on word n-grams, by partitions of the universe of n-grams.

Two sets of n-grams that are similar enough differ in at most H elements, which follows from their sizes.  If the
universe is dealt into more than H segments by a hash, one segment at least holds the same elements in both.  A segment
that is also indexed with each one of its elements left out counts for two.  So sets that share no entry cannot be
similar; those that do are candidates.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loyaltylens.llm.common import keep, one_of_each, pieces, unused
from loyaltylens.llm.components import connected_components
from loyaltylens.llm.hashing import joined, mixed, split_words, windows

SKETCH_BITS, FOLDED_WORDS = 2048, 8  # least bits of a sketch, and 64-bit words of its short form
BROADCAST_KEYS = 1_000_000  # a list of keys is broadcast up to this many (8 MB); a longer one is shuffled
SEEN = 200_000  # sets a task remembers as done already


@dataclass(frozen=True)
class Similarity:
    """Sets of ``size`` consecutive words, similar when intersection / union is ``part`` / ``whole`` or more."""

    size: int = 5
    part: int = 80
    whole: int = 100

    def largest(self, n: int) -> int:
        """Size of the largest set that can be similar to one of size n."""
        return n * self.whole // self.part

    def distance(self, total: int) -> int:
        """How many elements two similar sets of ``total`` elements together differ in at most."""
        return total * (self.whole - self.part) // (self.whole + self.part)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Distinct n-grams of a text; a shorter text is one n-gram, apart from all longer ones."""
    if len(words) >= size:
        return np.unique(windows(words, size))
    return mixed(windows(words, len(words)) ^ np.uint64(len(words))) if len(words) else words


def band_edges() -> np.ndarray:
    """First size of each band; a band ends a third above its start."""
    edges = [1]
    while edges[-1] < 1 << 40:
        edges.append(edges[-1] * 4 // 3 + 1)
    return np.array(edges)


@dataclass(frozen=True)
class Scheme:
    """How sets are indexed for pairs whose smaller set is in one band: ``whole`` segments as they are and ``cut``
    segments also with each one element left out.

    What a set holds in a segment is an entry of the index; that it holds nothing there is one only if it has to be.  A pair
    differs in at most H elements.  A whole segment that is not empty, and a cut one of two elements or more counted
    twice, add up to a set's weight: if that exceeds H, the set agrees with every similar one in an entry that is not
    empty.  Unrelated sets, which mostly agree where both hold nothing, then do not meet.
    """

    band: int
    low: int
    top: int  # largest smaller set
    high: int  # largest larger set
    whole: int
    cut: int

    def entries(self, elements: np.ndarray, similarity: Similarity) -> np.ndarray:
        segments = self.whole + self.cut
        segment = (mixed(elements ^ np.uint64(self.band + 1)) % np.uint64(segments)).astype(np.int64)
        value = mixed(elements)
        sums = np.zeros(segments, np.uint64)
        np.add.at(sums, segment, value)
        name = mixed(np.arange(segments, dtype=np.uint64) + np.uint64(self.band << 32))
        n = len(elements)
        partner = similarity.largest(n) if n <= self.top else self.top
        held = np.bincount(segment, minlength=segments)
        weight = np.minimum(held[self.cut :], 1).sum() + np.minimum(held[: self.cut], 2).sum()
        all_of_them = weight <= similarity.distance(n + partner)
        full = joined(name, sums)
        if not all_of_them:
            full = full[held > 0]
        if not self.cut:
            return full
        inside = (segment < self.cut) & ((held[segment] > 1) | all_of_them)
        return np.r_[full, joined(name[segment[inside]], sums[segment[inside]] - value[inside])]


def spare_segments(whole: int, cut: int, size: int, reach: int) -> int:
    """How many more whole segments give sets of ``size`` elements a weight above ``reach`` but for rare cases."""
    spare = 0
    while True:
        mean = size / (whole + spare + cut)
        lost = (whole + spare) * math.exp(-mean) + cut * (2 + mean) * math.exp(-mean)
        if whole + spare + 2 * cut - lost - 4 * math.sqrt(lost) > reach or spare > size:
            return spare
        spare += max(1, spare // 8)


def allocate(counts: dict[int, int], similarity: Similarity, pair_cost: float = 1e-4) -> dict[int, Scheme]:
    """The cheapest scheme of each band, given the number of sets in it.

    A cost is the number of entries, plus that of the pairs that meet by chance, which grow with the square of the
    sets: unrelated sets agree in a segment when it is empty in both (or all but empty, where one element may be
    left out), but only the rare sets without the weight for it have such entries.  Cut segments need fewer, larger
    segments but many more entries, so they pay where sets are many.
    """
    edges = band_edges()
    found = {}
    for band in counts:
        low, high = int(edges[band]), int(edges[band + 1]) - 1
        reach = similarity.distance(high + similarity.largest(high))
        if not reach:
            continue  # only equal sets are similar
        sets = counts[band] + counts.get(band + 1, 0)
        best = None
        for cut in range((reach + 1 + 1) // 2 + 1):
            whole = max(0, reach + 1 - 2 * cut)
            whole += spare_segments(whole, cut, high, reach) if cut in (0, (reach + 2) // 2) or reach < 64 else reach // 8
            mean = (low + high) / 2 / (whole + cut)
            entries = sets * (whole + cut * (1 + mean))
            chance = math.exp(-2 * mean) * (whole + cut * (1 + 2 * mean))
            cost = entries + pair_cost * sets * sets / 2 * chance
            if best is None or cost < best[0]:
                best = (cost, Scheme(band, low, high, similarity.largest(high), whole, cut))
        found[band] = best[1]
    return found


def sketch(elements: np.ndarray) -> np.ndarray:
    """Bit i tells whether the number of elements hashed to i is odd; as many bits as elements, rounded up to a power
    of two.  Two sketches differ in no more bits than the sets in elements; folded by XOR, a sketch is a shorter one
    of the same set."""
    bits = max(SKETCH_BITS, 1 << (len(elements) - 1).bit_length() if len(elements) else 0)
    odd = np.bincount((mixed(elements) >> np.uint64(20)).astype(np.int64) % bits, minlength=bits) & 1
    return np.packbits(odd.astype(bool)).view(np.uint64)


def folded(found: np.ndarray, words: int) -> np.ndarray:
    return np.bitwise_xor.reduce(found.reshape(-1, words), axis=0)


def bits_apart(p: bytes, q: bytes) -> int:
    words = min(len(p), len(q)) // 8
    return int(np.bitwise_count(folded(np.frombuffer(p, np.uint64), words) ^ folded(np.frombuffer(q, np.uint64), words)).sum())


TEXT_HASHES = ["text_key", "text_check"]
FOLDED = [f"s{i}" for i in range(FOLDED_WORDS)]


def hashed_sets(rows: DataFrame, size: int, salt: int) -> DataFrame:
    """doc_id, two hashes of the text, n, node and check (two of the set), band and sketch, whole and folded, of each
    text."""
    names = ["doc_id", *TEXT_HASHES, "n", "node", "check", "band", "sketch", *FOLDED]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = band_edges()
        for batch in batches:
            keys = [batch.column(h) for h in TEXT_HASHES]
            start = 0
            for ids, found in pieces([batch.select(["doc_id", "text"])]):
                sets = [shingles(words, size) for words in split_words(found)]
                sizes = np.array([len(s) for s in sets])
                node = np.array([_set_hash(s, 2 * salt + 1) for s in sets], dtype=np.uint64)
                check = np.array([_set_hash(s, 2 * salt + 2) for s in sets], dtype=np.uint64)
                sketches = [sketch(s) for s in sets]
                short = np.array([folded(s, FOLDED_WORDS) for s in sketches]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids, *(k.slice(start, len(found)) for k in keys), pa.array(sizes, pa.int64()), pa.array(node.view(np.int64)),
                        pa.array(check.view(np.int64)),
                        pa.array(np.searchsorted(edges, sizes, side="right") - 1, pa.int32()),
                        pa.array([s.tobytes() for s in sketches], pa.binary()),
                        *(pa.array(np.ascontiguousarray(short[:, i])) for i in range(FOLDED_WORDS)),
                    ],
                    names,
                )
                start += len(found)

    kinds = ["bigint"] * 6 + ["int", "binary"] + ["bigint"] * FOLDED_WORDS
    return rows.mapInArrow(run, ", ".join(f"`{n}` {k}" for n, k in zip(names, kinds)))


def _set_hash(elements: np.ndarray, salt: int) -> np.uint64:
    total = np.add.reduce(mixed(elements ^ np.uint64(salt)), dtype=np.uint64)
    return mixed(np.array([total + np.uint64(len(elements))], dtype=np.uint64))[0]


def index_entries(rows: DataFrame, similarity: Similarity, salt: int, schemes: dict[int, Scheme]) -> DataFrame:
    """(entry, node) of every set, in the scheme of its own band and, if it is small enough, of the band below."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges, seen = band_edges(), set()
        for _, found in pieces(batches):
            entries, nodes = [], []
            for words in split_words(found):
                elements = shingles(words, similarity.size)
                n = len(elements)
                node = _set_hash(elements, 2 * salt + 1)
                if not n or node in seen:
                    continue
                if len(seen) < SEEN:
                    seen.add(node)
                band = int(np.searchsorted(edges, n, side="right")) - 1
                for scheme in (schemes.get(band), schemes.get(band - 1)):
                    if scheme and scheme.low <= n <= scheme.high:
                        own = scheme.entries(elements, similarity)
                        entries.append(own)
                        nodes.append(np.full(len(own), node, np.uint64))
            if entries:
                columns = [pa.array(np.concatenate(x).view(np.int64)) for x in (entries, nodes)]
                for start in range(0, len(columns[0]), 1 << 16):
                    yield pa.RecordBatch.from_arrays([c.slice(start, 1 << 16) for c in columns], ["entry", "node"])

    return rows.select("doc_id", "text").mapInArrow(run, "entry bigint, node bigint")


def may_be_similar(similarity: Similarity) -> Column:
    """Sizes and folded sketches of sides a and b allow the pair to be similar; true for every pair that is."""
    total = F.col("a.n") + F.col("b.n")
    close = F.greatest("a.n", "b.n") * similarity.part <= F.least("a.n", "b.n") * similarity.whole
    apart = sum((F.bit_count(F.col(f"a.{s}").bitwiseXOR(F.col(f"b.{s}"))) for s in FOLDED), F.lit(0))
    return close & (apart * (similarity.whole + similarity.part) <= total * (similarity.whole - similarity.part))


def word_sets(text: str, size: int) -> set[tuple[bytes, ...]]:
    words = text.encode().lower().split()
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(size))))


def near_pairs(pairs: DataFrame, sets: DataFrame, similarity: Similarity) -> DataFrame:
    """Pairs (x, y) whose sizes and sketches allow them to be similar."""
    light = sets.select("node", "n", "sketch", *FOLDED)
    near = pairs.join(light.alias("a"), F.col("x") == F.col("a.node"))
    near = near.join(light.alias("b"), F.col("y") == F.col("b.node")).filter(may_be_similar(similarity))
    near = near.select(
        "x", "y", (F.col("a.n") + F.col("b.n")).alias("total"), F.col("a.sketch").alias("p"), F.col("b.sketch").alias("q")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            apart = np.array([bits_apart(*x) for x in zip(batch.column("p").to_pylist(), batch.column("q").to_pylist())])
            total = batch.column("total").to_numpy()
            close = apart * (similarity.whole + similarity.part) <= total * (similarity.whole - similarity.part)
            yield batch.select(["x", "y"]).filter(pa.array(close))

    return near.mapInArrow(run, "x bigint, y bigint")


def verified(pairs: DataFrame, sets: DataFrame, rows: DataFrame, similarity: Similarity) -> DataFrame:
    """Those of the pairs (x, y) whose sets of n-grams, as words, are similar.  Only texts of pairs that sizes and
    sketches leave are moved."""
    near = keep(near_pairs(pairs, sets, similarity))
    nodes = near.select(F.col("x").alias("node")).unionAll(near.select("y")).distinct()
    wanted = keep(nodes.join(sets.select("node", "text.*"), "node"))
    listed = F.broadcast(wanted) if wanted.count() <= BROADCAST_KEYS else wanted
    found = keep(rows.select(*TEXT_HASHES, "text").join(listed, TEXT_HASHES).dropDuplicates(["node"]))
    first = found.select(F.col("node").alias("x"), F.col("text").alias("text_x"))
    second = found.select(F.col("node").alias("y"), F.col("text").alias("text_y"))
    size, part, whole = similarity.size, similarity.part, similarity.whole

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for x, y in zip(batch.column("text_x"), batch.column("text_y")):
                a, b = word_sets(x.as_py(), size), word_sets(y.as_py(), size)
                shared = len(a & b)
                kept.append(whole * shared >= part * (len(a) + len(b) - shared))
            yield batch.select(["x", "y"]).filter(pa.array(kept, pa.bool_()))

    return near.join(first, "x").join(second, "y").mapInArrow(run, "x bigint, y bigint")


def similar_groups(
    docs: DataFrame, similarity: Similarity = Similarity(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id and ``stays`` of every row of ``docs``.

    Words are runs of anything but ASCII space, with A-Z lower-cased.  Documents are linked when their sets of
    n-grams are similar; component_id is the smallest id that links reach.  Texts without words have no links.

    Equal sets are one node.  In each entry of the index, all nodes are first compared with the one that has most entries in common with others; what
    that links needs no further pair.  Entries that still hold nodes of several components then give all pairs
    across components, whose sizes and sketches are compared within the join, so that only near pairs leave it.
    Every similar pair is linked directly or lies in one component.

    ``stays`` is true for one row of each group: that with the smallest id, then the smallest text_key.  A missing
    text is empty.  A row without an id counts behind all ids; component_id is missing if the group has no id.
    """
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = docs.select(
        docs[id_col].cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key"),
        F.hash(text).cast("bigint").alias("text_check"),
    )
    salt = 0
    while True:
        members = keep(hashed_sets(rows, similarity.size, salt))
        sets = members.filter("n > 0").groupBy("node", "check", "n", "band").agg(
            F.min(F.struct(*TEXT_HASHES)).alias("text"),
            F.min(F.struct(F.isnull("doc_id"), "doc_id", F.col("text_key").alias("own"))).alias("first"),
            F.first("sketch").alias("sketch"), *(F.first(s).alias(s) for s in FOLDED),
        )
        sets = keep(sets)
        # Different sets with one hash are hashed anew.
        if sets.groupBy("node").count().filter("count > 1").isEmpty():
            break
        salt += 1
    counts = {r["band"]: r["count"] for r in sets.groupBy("band").count().collect()}
    schemes = allocate(counts, similarity)
    dealt = index_entries(rows, similarity, salt, schemes).repartition("entry")
    shared = dealt.groupBy("entry").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    shared = shared.filter("low <> high").select("entry").hint("shuffle_hash")
    found = keep(dealt.join(shared, "entry").select("entry", "node").distinct())
    # The node with most entries in common with others is closest to what a group of near copies was made from.
    uses = found.groupBy("node").agg(F.count(F.lit(1)).alias("uses"))
    pivots = found.join(uses, "node").groupBy("entry").agg(F.max(F.struct("uses", "node"))["node"].alias("pivot"))
    buckets = keep(found.join(pivots, "entry").select("entry", "node", "pivot"))

    stars = buckets.filter("node <> pivot").select(F.col("pivot").alias("x"), F.col("node").alias("y")).distinct()
    links = keep(verified(stars, sets, rows, similarity))
    roots = keep(connected_components(links))

    labelled = buckets.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_entries = labelled.groupBy("entry").agg(F.min("root").alias("r0"), F.max("root").alias("r1"))
    open_entries = open_entries.filter("r0 <> r1").select("entry")
    rest = keep(labelled.join(open_entries, "entry", "left_semi").join(sets.select("node", "n", *FOLDED), "node"))
    left, right = rest.alias("a"), rest.alias("b")
    across = (F.col("a.entry") == F.col("b.entry")) & (F.col("a.root") < F.col("b.root"))
    unseen = (F.col("a.node") != F.col("a.pivot")) & (F.col("b.node") != F.col("b.pivot"))
    more = left.join(right, across & unseen & may_be_similar(similarity))
    more = more.select(F.col("a.node").alias("x"), F.col("b.node").alias("y")).distinct()
    more = keep(verified(more, sets, rows, similarity))
    if not more.isEmpty():
        kept = roots.filter("node <> root").select(F.col("root").alias("x"), F.col("node").alias("y"))
        roots = keep(connected_components(kept.unionAll(more)))

    firsts = roots.join(sets.select("node", "first"), "node").groupBy("root").agg(F.min("first").alias("chosen"))
    grouped = roots.join(firsts, "root").select("node", "chosen")
    chosen = sets.select("node", "first").join(grouped, "node", "left")
    chosen = chosen.select("node", F.coalesce("chosen", "first").alias("chosen"))
    linked = members.filter("n > 0").join(chosen, "node")
    stays = F.col("doc_id").eqNullSafe(F.col("chosen.doc_id")) & (F.col("text_key") == F.col("chosen.own"))
    return linked.select(
        "doc_id", "text_key", F.col("n").alias("n_shingles"), F.col("chosen.doc_id").alias("component_id"),
        stays.alias("stays"),
    ).unionAll(
        members.filter("n = 0").select(
            "doc_id", "text_key", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"),
            F.lit(True).alias("stays"),
        )
    )


def without_near_copies(
    docs: DataFrame, similarity: Similarity = Similarity(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of rows with the same id and text the one
    stays that is smallest in its columns, in their order."""
    groups = similar_groups(docs, similarity, id_col, text_col).filter("stays")
    key = unused(docs, "key")
    stay = groups.select(F.col("doc_id").alias("stay_id"), F.col("text_key").alias("stay_key"))
    keyed = docs.withColumn(key, F.xxhash64(F.coalesce(docs[text_col], F.lit(""))))
    same = keyed[id_col].eqNullSafe(stay["stay_id"]) & (keyed[key] == stay["stay_key"])
    return one_of_each(keyed.join(stay, same, "left_semi"), [id_col, key], docs.columns)


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN array_to_string(w, ' ') ELSE array_to_string(w[i : i + 3], ' ') END AS g
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
r AS (SELECT doc_id AS v, doc_id AS t FROM d UNION SELECT r.v, e.y FROM r JOIN e ON r.t = e.x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT v, min(t) AS component_id FROM r GROUP BY v) c ON c.v = d.doc_id
"""
