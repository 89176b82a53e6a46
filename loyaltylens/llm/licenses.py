"""License statements: winnowed fingerprints name candidates, banded alignment decides.

Where enough words of a template stand, the shared fingerprints are chained in the order of the template, and bands
between neighbours of the chain are aligned; a short template is aligned in one band.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyaltylens.llm.common import pieces, texts
from loyaltylens.llm.hashing import windows
from loyaltylens.llm.license_texts import ABSENT, DECIDING, TEMPLATES

GRAM, WINDOW = 3, 4  # words of a fingerprint, fingerprints of which the lowest is kept
SHORT = 15  # a template of fewer words that names no deciding words has to be there as a whole
CHAINED = 48  # templates of so many words are aligned along a chain of fingerprints, shorter ones in one band
NEAR = 12  # so many words after a match still belong to it when absent words are looked for
WORD = re.compile(r"[a-z0-9]+")
WORD_BYTES = re.compile(rb"[a-z0-9]+")
UPPER_TO_LOWER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id bigint, license string, matched_words bigint, coverage double, start bigint, end bigint"


def winnowed(hashes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Places of the fingerprints that are kept: the lowest of every ``window`` neighbours, the last of equals.

    Any run of ``window`` fingerprints that two texts share has one that both keep.
    """
    if len(hashes) <= window:
        return np.arange(len(hashes)) if len(hashes) else np.zeros(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(hashes, window)
    return np.unique(np.arange(len(views)) + window - 1 - views[:, ::-1].argmin(axis=1))


def holds(words: np.ndarray, phrase: np.ndarray) -> bool:
    """Does the phrase stand in the words, without others in between?"""
    data, sought = words.tobytes(), phrase.tobytes()
    at = data.find(sought)
    while at >= 0 and at % words.itemsize:
        at = data.find(sought, at + 1)
    return at >= 0


@dataclass(frozen=True)
class Match:
    license: str
    words: int  # matched words of the template
    coverage: float
    first: int  # first and last matched word of the text
    last: int

    def gives_way(self, other: Match) -> bool:
        """Does ``other`` overlap it with more words and no less coverage?"""
        overlap = self.first <= other.last and other.first <= self.last
        return overlap and other.words > self.words and other.coverage >= self.coverage


def chain(places: np.ndarray, at: np.ndarray) -> list[tuple[int, int]]:
    """A longest list of (place, at) in which both rise; ``places`` are sorted."""
    order = np.lexsort((-at, places))  # of one place at most one enters the chain
    rows, where = at[order].tolist(), places[order].tolist()
    tails, ends, before = [], [], []
    for i, row in enumerate(rows):
        k = bisect_left(tails, row)
        before.append(ends[k - 1] if k else -1)
        tails[k : k + 1], ends[k : k + 1] = [row], [i]
    found, i = [], ends[-1]
    while i >= 0:
        found.append((where[i], rows[i]))
        i = before[i]
    return found[::-1]


def compact(links: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The part of a chain that gains most: a link gains the template's words up to it, 8 at most, and a word that the
    text has more than the template costs a quarter, so links that a long insertion parts from the rest fall away."""
    best, a, b = 0.0, 0, 1
    gain, start = 8.0, 0
    for i in range(1, len(links)):
        if gain > best:
            best, a, b = gain, start, i
        rows, words = links[i][1] - links[i - 1][1], links[i][0] - links[i - 1][0]
        gain += min(rows, 8) - max(0, words - rows) / 4
        if gain < 8:
            gain, start = 8.0, i
    return links[start:] if gain > best else links[a:b]


def subsequence(rows: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of ``rows`` and each beginning of ``text``, the empty one first."""
    best = np.zeros(len(text) + 1, np.int32)
    if not len(text):
        return best
    for word in rows:
        best[1:] = np.maximum.accumulate(np.where(text == word, best[:-1] + 1, best[1:]))
    return best


def apart(found: list[Match]) -> list[Match]:
    """Of matches of one template that overlap, the one with most words, then the shortest; by place."""
    firsts, kept = [], []
    for match in sorted(found, key=lambda m: (-m.words, m.last - m.first, m.first)):
        i = bisect_left(firsts, match.first)
        clear = (i == 0 or kept[i - 1].last < match.first) and (i == len(kept) or kept[i].first > match.last)
        if clear:
            firsts.insert(i, match.first)
            kept.insert(i, match)
    return kept


class TemplateIndex:
    """Inverted index of the templates' kept fingerprints; its size depends on the templates only."""

    def __init__(
        self, templates: dict[str, str], min_coverage: float, deciding: dict[str, tuple[str, ...]] | None = None,
        absent: dict[str, tuple[str, ...]] | None = None,
    ) -> None:
        self.min_coverage = min_coverage
        deciding, absent = deciding or {}, absent or {}
        self.names = sorted(templates)
        self.numbers: dict[bytes, int] = {}
        self.least: list[float] = []  # words that a match has at least
        self.words, self.deciding, self.absent = [], [], []
        postings = defaultdict(list)
        for n, name in enumerate(self.names):
            coded = self._numbered(templates[name])
            self.words.append(coded)
            self.least.append(max(min(GRAM, len(coded)), min_coverage * len(coded)))
            phrases = deciding.get(name) or ([templates[name]] if len(coded) < SHORT else [])
            self.deciding.append([self._numbered(p) for p in phrases])
            self.absent.append([self._numbered(p) for p in absent.get(name, ())])
            grams = windows(coded, min(GRAM, len(coded)))
            for place in winnowed(grams):
                postings[int(grams[place])].append((n, int(place)))
        self.known = np.sort(np.fromiter(postings, np.uint64, len(postings)))
        entries = [postings[int(gram)] for gram in self.known]
        self.offsets = np.cumsum([0, *map(len, entries)])
        self.sizes = sorted({min(GRAM, len(w)) for w in self.words})  # words of the fingerprints
        self.posted = np.array([e for own in entries for e in own], dtype=np.int64).reshape(-1, 2)
        # Per template, a small number for each of its words, 0 for others, and how often it has each.
        self.own = []
        for coded in self.words:
            small = np.zeros(len(self.numbers) + 1, np.int64)
            distinct = np.unique(coded).astype(np.int64)
            small[distinct] = np.arange(1, len(distinct) + 1)
            uses = np.bincount(small[coded.astype(np.int64)], minlength=len(distinct) + 1)
            self.own.append((small, uses))

    def _numbered(self, text: str) -> np.ndarray:
        found = WORD_BYTES.findall(text.encode().lower())
        return np.array([self.numbers.setdefault(w, len(self.numbers) + 1) for w in found], dtype=np.uint64)

    def _decided(self, n: int, coded: np.ndarray, first: int, last: int) -> bool:
        """Are the deciding words there, each phrase in one piece, and those that name another license not?"""
        inside, near = coded[first : last + 1], coded[first : last + 1 + NEAR]
        return all(holds(inside, p) for p in self.deciding[n]) and not any(holds(near, p) for p in self.absent[n])

    def code(self, words: list[bytes]) -> np.ndarray:
        """The words as numbers; 0 for a word of no template."""
        get = self.numbers.get
        return np.fromiter((get(w, 0) for w in words), np.uint64, len(words))

    def hits(self, coded: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """Per template, places of the text with one of its kept fingerprints and the fingerprint's place in the template.

        All fingerprints of the text are probed.
        """
        inside, parts = coded != 0, []
        for size in self.sizes:
            count = max(0, len(coded) - size + 1)
            whole = np.logical_and.reduce([inside[i : i + count] for i in range(size)]) if count else np.zeros(0, bool)
            places = np.flatnonzero(whole)
            grams = windows(coded, size)[places]
            slot = np.minimum(np.searchsorted(self.known, grams), len(self.known) - 1)
            found = self.known[slot] == grams
            parts.append((places[found], slot[found]))
        places, slot = (np.concatenate(x) for x in zip(*parts))
        if not len(places):
            return []
        uses = self.offsets[slot + 1] - self.offsets[slot]
        entry = np.repeat(self.offsets[slot] - np.cumsum(uses) + uses, uses) + np.arange(uses.sum())
        template, at = self.posted[entry].T
        order = np.argsort(template, kind="stable")
        template, at, places = template[order], at[order], np.repeat(places, uses)[order]
        cuts = np.flatnonzero(np.r_[True, template[1:] != template[:-1], True]) if len(template) else []
        return [(int(template[a]), places[a:b], at[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]

    def matches(self, coded: np.ndarray) -> list[Match]:
        own: dict[int, list[Match]] = {}
        for n, places, at in self.hits(coded):
            if self.least[n] <= len(coded):
                find = self._chained if len(self.words[n]) >= CHAINED else self._banded
                found = apart(find(n, coded, places, at))
                if found:
                    own[n] = found
        firsts = {n: [m.first for m in found] for n, found in own.items()}

        def outbid(match: Match) -> bool:
            for n, found in own.items():
                # Matches of one template do not overlap, so only one that starts earlier can reach this one.
                for other in found[max(0, bisect_left(firsts[n], match.first) - 1) :]:
                    if other.first > match.last:
                        break
                    if match.gives_way(other):
                        return True
            return False

        kept = (m for found in own.values() for m in found if not outbid(m))
        return sorted(kept, key=lambda m: (m.first, m.license, m.last))

    def _stretch(self, n: int) -> int:
        """A match has no more words of the text than this: all insertions together may be as long as the template."""
        return 2 * len(self.words[n]) + 32

    def _promising(self, n: int, coded: np.ndarray, places: np.ndarray) -> list[int]:
        """Numbers of the windows around the places that hold the deciding words and enough words of the template.

        Window k has two stretches from word k * stretch on, so every match lies in one.
        """
        small, uses = self.own[n]
        step = self._stretch(n)
        found = []
        for k in np.unique(np.r_[places // step - 1, places // step]).tolist():
            window = coded[max(0, k * step) : (k + 2) * step]
            there = np.minimum(np.bincount(small[window.astype(np.int64)], minlength=len(uses)), uses)[1:]
            if there.sum() >= self.least[n] and all(holds(window, p) for p in self.deciding[n]):
                found.append(k)
        return found

    def _banded(self, n: int, coded: np.ndarray, places: np.ndarray, at: np.ndarray) -> list[Match]:
        """Matches in bands around the diagonals of the fingerprints."""
        template, band, step = self.words[n], self._band(n), self._stretch(n)
        good = np.array(self._promising(n, coded, places), dtype=np.int64)
        starts = np.unique(places - at)
        # The band around a diagonal lies whole in the window that begins before it.
        starts = starts[np.isin((starts - 2 * band) // step, good)]
        found, tried = [], -(1 << 60)
        for start in starts.tolist():
            if start <= tried:
                continue
            if start >= 0 and np.array_equal(coded[start : start + len(template)], template):
                last = start + len(template) - 1
                if self._decided(n, coded, start, last):
                    found.append(Match(self.names[n], len(template), 1.0, start, last))
                continue
            tried = start + band  # the band reaches the diagonals after it as well
            found += self._aligned(n, coded, start, band)
        return found

    def _chained(self, n: int, coded: np.ndarray, places: np.ndarray, at: np.ndarray) -> list[Match]:
        """Matches along chains of fingerprints that rise in the text and in the template, whatever is inserted."""
        step, found = self._stretch(n), []
        order = np.argsort(places, kind="stable")
        places, at = places[order], at[order]
        free = np.ones(len(places), bool)
        for k in self._promising(n, coded, places):
            a, b = np.searchsorted(places, [k * step, (k + 2) * step])
            while free[a:b].any():
                rest = a + np.flatnonzero(free[a:b])
                match = self._along(n, coded, compact(chain(places[rest], at[rest])))
                if match is None:
                    break
                found.append(match)
                free &= (places < match.first - GRAM) | (places > match.last)
        return found

    def _along(self, n: int, coded: np.ndarray, links: list[tuple[int, int]]) -> Match | None:
        """The match along a chain: its links, with bands between neighbours and at both ends aligned."""
        template, reach = self.words[n], 2 * self._band(n)
        place, row = links[0]
        head = subsequence(template[:row][::-1], coded[max(0, place - row - reach) : place][::-1])
        words, first = int(head[-1]), place - int(head.argmax())
        for (place, row), (after, below) in zip(links, links[1:]):
            if below - row == after - place and np.array_equal(template[row:below], coded[place:after]):
                words += below - row
            else:
                words += int(subsequence(template[row:below], coded[place:after])[-1])
        place, row = links[-1]
        tail = subsequence(template[row:], coded[place : place + len(template) - row + reach])
        words, last = words + int(tail[-1]), place + int(tail.argmax()) - 1
        if words < self.least[n] or not self._decided(n, coded, first, last):
            return None
        return Match(self.names[n], words, words / len(template), first, last)

    def _band(self, n: int) -> int:
        """By how many words the text may have more or fewer before the band is left."""
        return int(min(16, max(1, len(self.words[n]) // 4)))

    def _aligned(self, n: int, coded: np.ndarray, start: int, band: int) -> list[Match]:
        """Longest common subsequence of the template and the text around a diagonal.

        Row i, column b stand for word i of the template and word i + start + b of the text.
        """
        template, reach = self.words[n], 2 * band
        width = 2 * reach + 1
        places = np.arange(len(template))[:, None] + (start - reach) + np.arange(width)[None, :]
        there = (places >= 0) & (places < len(coded))
        text = np.where(there, coded[np.clip(places, 0, len(coded) - 1)], 0)
        equal = (text == template[:, None]) & there
        if np.count_nonzero(equal.any(axis=1)) < self.least[n]:
            return []  # no common subsequence has more words than rows that have an equal word
        score = np.zeros((len(template) + 1, width + 1), np.int32)
        for i in range(len(template)):
            best = np.maximum(score[i, :width] + equal[i], score[i, 1:])
            score[i + 1, :width] = np.maximum.accumulate(best)
        words = int(score[-1].max())
        if words < self.least[n]:
            return []
        matched, i, b = [], len(template), int(score[-1].argmax())
        while i and score[i, b]:
            if b and score[i, b - 1] == score[i, b]:
                b -= 1
            elif score[i - 1, b + 1] == score[i, b]:
                i, b = i - 1, b + 1
            else:
                i -= 1
                matched.append(i + start - reach + b)
        if not self._decided(n, coded, matched[-1], matched[0]):
            return []
        return [Match(self.names[n], words, words / len(template), matched[-1], matched[0])]


def find_licenses(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None,
    min_coverage: float = 0.7,
) -> DataFrame:
    """doc_id, license, matched_words, coverage of the template, start and end in code points, one row per match.

    Words are runs of ASCII letters and digits, in any case.  A template is tried where the text has one of its
    kept fingerprints; words may be inserted, in one place or many, as long as all of them are no more than the template has
    (and 32).  What names the license has to be there word for word (``DECIDING``), and what names another
    one must not be (``ABSENT``); of ``templates`` given here, those of fewer than 15 words have to be there as a whole.
    Matches of one template do not overlap; of different ones, a
    match gives way to an overlapping one with more words and no less coverage; of equal ones both stay.  A sentence that
    denies a license names it all the same.  A missing or empty
    text has no match; a text is looked at whole, whatever its length; rows that repeat an id come back as often as they are
    there; further columns, whatever their names, are ignored.
    """
    known = templates or TEMPLATES
    deciding, absent = ({}, {}) if templates else (DECIDING, ABSENT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = TemplateIndex(known, min_coverage, deciding, absent)
        for ids, found in pieces(batches):
            rows = []
            for doc_id, data in zip(ids.to_pylist(), found):
                coded = index.code(WORD_BYTES.findall(data.lower()))
                matches = index.matches(coded)
                if matches:
                    spans = [m.span() for m in WORD.finditer(data.decode().translate(UPPER_TO_LOWER))]
                    rows += [(doc_id, m.license, m.words, m.coverage, spans[m.first][0], spans[m.last][1]) for m in matches]
            columns = list(zip(*rows)) or [()] * 6
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
            names = ["doc_id", "license", "matched_words", "coverage", "start", "end"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    rows = texts(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    return rows.mapInArrow(run, SCHEMA)
