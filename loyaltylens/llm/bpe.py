"""Byte-pair merging of the word pieces of a tokenizer file, in two ways.

``RankArrays`` merges many pieces at once in numpy; ``merge_short`` merges one piece by scanning an array of ranks.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterable
from functools import cache, cached_property
from itertools import chain

import numpy as np
from tokenizers import Regex, Tokenizer, pre_tokenizers

CACHE_PIECES = 250_000  # results held per task; the cache starts anew beyond it
LONG_PIECE = 256  # only shorter pieces are held
TABLE_PIECES = 125_000  # pieces held per task in a table; the pipeline has little memory left in its last stage
TABLE_IDS = 4_000_000  # ids held there

# Up to U+024F, but for characters whose lower case reaches beyond it, lower-casing and composition
# change nothing that the plain expression below does not see.  Letters, digits and space there are these.
LEAVING = "".join(c for c in map(chr, range(0x250)) if max(c.lower()) > "\u024f")
PLAIN_ONLY = re.compile(f"[{LEAVING}\u0250-\U0010ffff]")
LETTERS = "a-zªµºß-öø-ɏ"
DIGITS = "0-9²³¹¼-¾"
SPACES = "\t-\r\x20\u0085 "
# A blank in front is passed over with the piece, which is quicker than to try a piece there.
PLAIN = re.compile(f" ?([{LETTERS}]+|[{DIGITS}]|'s|'t|'re|'ve|'m|'ll|'d|[^{SPACES}{LETTERS}{DIGITS}]+)")
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

NO_RANK = 1 << 40


def leaves_plain(text: str) -> bool:
    """Is there a character that the plain expression does not cover?  None is below U+0100, which is quick to see."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return PLAIN_ONLY.search(text) is not None
    return False


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class WordVocabulary:
    """Ids, merges and special strings of a tokenizers file that drops space and ends each piece with a suffix."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, split = spec["model"], spec["pre_tokenizer"]["pretokenizers"][0]
        if split["pattern"] != {"Regex": SPLIT} or not model["end_of_word_suffix"] or not spec["normalizer"]:
            raise ValueError(f"{path} does not split or normalise texts as expected here")
        self.normalizer = Tokenizer.from_file(path).normalizer
        self.splitter = pre_tokenizers.Split(Regex(SPLIT), "removed", invert=True)
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.size = 1 + max([*self.ids.values(), *self.special.values()])
        suffix = model["end_of_word_suffix"]
        self.inner = np.array([self.ids[c] for c in byte_symbols()], dtype=np.int64)
        self.last = np.array([self.ids[c + suffix] for c in byte_symbols()], dtype=np.int64)
        # A merge is known by its rank: pair (as one number) -> rank, rank -> symbol made.
        self.ranks: dict[int, int] = {}
        self.made: list[int] = []
        for merge in model["merges"]:
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self.ranks.setdefault(self.ids[a] * self.size + self.ids[b], len(self.made))
            self.made.append(self.ids[a + b])

    @cached_property
    def names(self) -> dict[int, str]:
        return {i: t for t, i in [*self.ids.items(), *self.special.items()]}

    @cached_property
    def ordered(self) -> bool:
        """Does every merge rank behind all merges that make its parts?  Then no merge brings up a lower rank."""
        latest: dict[int, int] = {}
        for rank in self.ranks.values():
            latest[self.made[rank]] = max(latest.get(self.made[rank], -1), rank)
        return all(
            rank > max(latest.get(pair // self.size, -1), latest.get(pair % self.size, -1))
            for pair, rank in self.ranks.items()
        )

    def pieces(self, text: str) -> list[str]:
        """The normalised pieces of a text; a special string is a piece of its own."""
        if leaves_plain(text) or any(s in text for s in self.special):
            found = []
            for part in self._special.split(text):
                if part in self.special:
                    found.append(part)
                elif part:
                    found += [p for p, _ in self.splitter.pre_tokenize_str(self.normalizer.normalize_str(part))]
            return found
        return PLAIN.findall(text.lower())

    def symbols(self, piece: str) -> list[int]:
        if piece in self.special:
            return [self.special[piece]]
        data = np.frombuffer(piece.encode(), np.uint8)
        found = self.inner[data]
        found[-1] = self.last[data[-1]]
        return found.tolist()


class RankArrays:
    """Merges of a vocabulary as sorted arrays, applied to ragged arrays of symbols."""

    def __init__(self, vocabulary: WordVocabulary) -> None:
        self.size = vocabulary.size
        self.one_at_a_time = not vocabulary.ordered
        pairs = np.fromiter(vocabulary.ranks, np.int64, len(vocabulary.ranks))
        order = np.argsort(pairs)
        self.pairs = pairs[order]
        self.rank_of = np.fromiter(vocabulary.ranks.values(), np.int64, len(pairs))[order]
        self.made = np.array(vocabulary.made, dtype=np.int64)

    def merge(self, symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Surviving symbols of all pieces, one piece behind the other, and the piece of each.

        ``owner`` numbers the piece of each symbol and never falls.  Every round finds the lowest rank of each
        piece, merges all places that have it (from the left where they overlap) and ranks the new neighbours.
        """
        done: list[tuple[np.ndarray, np.ndarray]] = []
        rank = self._ranked(symbols, owner, np.arange(len(symbols)))
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lowest = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.r_[starts, len(owner)]))
            active = lowest != NO_RANK
            if not active.all():
                done.append((symbols[~active], owner[~active]))
                symbols, owner, rank, lowest = symbols[active], owner[active], rank[active], lowest[active]
                if not len(symbols):
                    break
            at = np.flatnonzero(rank == lowest)
            at = at[self._apart(at, owner)]
            symbols[at] = self.made[rank[at]]
            alive = np.ones(len(symbols), bool)
            alive[at + 1] = False
            moved = at - np.arange(len(at))
            symbols, owner, rank = symbols[alive], owner[alive], rank[alive]
            near = np.zeros(len(symbols), bool)
            near[moved] = True
            near[moved[moved > 0] - 1] = True
            touched = np.flatnonzero(near)
            rank[touched] = self._ranked(symbols, owner, touched)
        symbols = np.concatenate([s for s, _ in done]) if done else symbols
        owner = np.concatenate([o for _, o in done]) if done else owner
        order = np.argsort(owner, kind="stable")
        return symbols[order], owner[order]

    def _ranked(self, symbols: np.ndarray, owner: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Rank of the symbol at each place with the next one; NO_RANK if they do not merge."""
        after = np.minimum(places + 1, len(symbols) - 1)
        pair = symbols[places] * self.size + symbols[after]
        slot = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        merges = (self.pairs[slot] == pair) & (owner[places] == owner[after]) & (after > places)
        return np.where(merges, self.rank_of[slot], NO_RANK)

    def _apart(self, at: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Which places to merge: none that overlaps a merged one on its left, and only the first of a piece if a
        merge can bring up a lower rank."""
        if self.one_at_a_time:
            return np.r_[True, owner[at[1:]] != owner[at[:-1]]]
        place = np.arange(len(at))
        run_start = np.maximum.accumulate(np.where(np.r_[True, np.diff(at) != 1], place, 0))
        return (place - run_start) % 2 == 0


def merge_short(symbols: list[int], vocabulary: WordVocabulary) -> list[int]:
    """Merge one piece: hold its parts and the rank at each boundary side by side, scan for the lowest rank again
    and again, delete that boundary and refresh the ranks of its two neighbours."""
    size, get, made = vocabulary.size, vocabulary.ranks.get, vocabulary.made
    parts = symbols[:]
    bounds = [get(a * size + b, NO_RANK) for a, b in zip(parts, parts[1:])]
    while bounds:
        best = min(bounds)
        if best == NO_RANK:
            break
        at = bounds.index(best)
        parts[at : at + 2] = [made[best]]
        del bounds[at]
        if at:
            bounds[at - 1] = get(parts[at - 1] * size + parts[at], NO_RANK)
        if at < len(bounds):
            bounds[at] = get(parts[at] * size + parts[at + 1], NO_RANK)
    return parts


def merge_long(symbols: list[int], vocabulary: WordVocabulary) -> list[int]:
    """The same result for a piece of any length: boundaries in a heap, parts in a linked list."""
    size, get, made = vocabulary.size, vocabulary.ranks.get, vocabulary.made
    parts, end = symbols[:], len(symbols)
    after, before = list(range(1, end + 1)), list(range(-1, end - 1))
    alive = [True] * end
    heap = [(rank, i) for i in range(end - 1) if (rank := get(parts[i] * size + parts[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i]
        if not alive[i] or j == end or get(parts[i] * size + parts[j]) != rank:
            continue
        parts[i], alive[j], after[i] = made[rank], False, after[j]
        if after[i] < end:
            before[after[i]] = i
        for left in (before[i], i):
            if left >= 0 and after[left] < end:
                new = get(parts[left] * size + parts[after[left]])
                if new is not None:
                    heapq.heappush(heap, (new, left))
    return [p for p, a in zip(parts, alive) if a]


class PieceCounts(dict):
    """Number of tokens by piece; pieces not known yet are merged together."""

    def __init__(self, path: str) -> None:
        super().__init__()
        self.vocabulary = WordVocabulary(path)
        self.arrays = RankArrays(self.vocabulary)

    def known(self, cut: list[list[str]]) -> list[str]:
        """Learn what is new in some texts' pieces; returns the new ones that are too long to be held for others."""
        new = set().union(*cut).difference(self)
        if len(self) + len(new) > CACHE_PIECES:
            self.clear()
            new = set().union(*cut)
        self.learn(new)
        return [p for p in new if len(p) > LONG_PIECE]

    def forget(self, pieces: list[str]) -> None:
        for piece in pieces:
            del self[piece]

    def learn(self, pieces: Iterable[str]) -> None:
        special = [p for p in pieces if p in self.vocabulary.special]
        plain = [p for p in pieces if p not in self.vocabulary.special]
        self.update(zip(special, [1] * len(special)))
        _, counts = merged(plain, self.vocabulary, self.arrays)
        self.update(zip(plain, counts.tolist()))


def merged(plain: list[str], vocabulary: WordVocabulary, arrays: RankArrays) -> tuple[np.ndarray, np.ndarray]:
    """Ids of pieces that are no special strings, one piece behind the other, and how many each has."""
    if not plain:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    coded = [p.encode() for p in plain]
    data = np.frombuffer(b"".join(coded), np.uint8)
    lengths = np.fromiter(map(len, coded), np.int64, len(coded))
    symbols = vocabulary.inner[data]
    ends = np.cumsum(lengths) - 1
    symbols[ends] = vocabulary.last[data[ends]]
    symbols, owner = arrays.merge(symbols, np.repeat(np.arange(len(plain)), lengths))
    return symbols, np.bincount(owner, minlength=len(plain))


class PieceTable(dict):
    """Number of each piece in a table of token ids; row 0 of the table is the id that ends a text.

    A piece that is not held gets the next number when it is looked up; the new pieces of some texts are merged
    together before the table is read.  When it holds too much, the pieces used most stay.
    """

    def __init__(self, path: str, end_id: int) -> None:
        self.vocabulary = WordVocabulary(path)
        self.arrays = RankArrays(self.vocabulary)
        super().__init__(zip(self.vocabulary.special, range(1, len(self.vocabulary.special) + 1)))
        self.kind = np.dtype("<u2" if self.vocabulary.size <= 1 << 16 else "<u4")
        self.ids = np.array([end_id, *self.vocabulary.special.values()], self.kind)
        self.counts = np.ones(len(self.ids), np.int64)
        self.uses = np.zeros(len(self.ids), np.int64)
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self.counts) + len(self.new)
        self.new.append(piece)
        return number

    def encoded(self, texts: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one behind the other, each with the end id, and how many each has."""
        found = [self._rows(text) for text in texts]
        self._learn()
        rows = np.concatenate(found) if found else np.zeros(0, np.int32)
        ids, counts = self._read(rows)
        ends = np.r_[0, np.cumsum(counts)][np.cumsum([0, *map(len, found)])]
        self.uses += np.bincount(rows, minlength=len(self.uses))
        if len(self.counts) > TABLE_PIECES or len(self.ids) > TABLE_IDS:
            self._shrink()
        return ids, np.diff(ends)

    def _rows(self, text: str) -> np.ndarray:
        pieces = self.vocabulary.pieces(text)
        return np.fromiter(chain(map(self.__getitem__, pieces), (0,)), np.int32, len(pieces) + 1)

    def _learn(self) -> None:
        """Append the ids of the new pieces; long ones are not held for other texts."""
        ids, counts = merged(self.new, self.vocabulary, self.arrays)
        self.ids = np.concatenate([self.ids, ids.astype(self.kind)])
        self.counts = np.concatenate([self.counts, counts])
        self.uses = np.concatenate([self.uses, np.zeros(len(counts), np.int64)])
        for piece in self.new:
            if len(piece) > LONG_PIECE:
                del self[piece]
        self.new = []

    def _read(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids in some rows of the table, one row behind the other, and how many each row has."""
        counts = self.counts[rows]
        starts = (np.cumsum(self.counts) - self.counts)[rows]
        places = np.repeat(starts - np.cumsum(counts) + counts, counts)
        places += np.arange(len(places))
        return self.ids[places], counts

    def _shrink(self) -> None:
        """Hold the pieces used most, half of what may be held, besides the end id and the special strings."""
        fixed = 1 + len(self.vocabulary.special)
        pieces = np.array(list(self), object)
        rows = np.fromiter(self.values(), np.int64, len(self))
        order = np.argsort(-self.uses[rows], kind="stable")
        order = order[rows[order] >= fixed][: TABLE_PIECES // 2]
        order = order[np.cumsum(self.counts[rows[order]]) <= TABLE_IDS // 2]
        kept = np.r_[:fixed, rows[order]]
        self.ids, self.counts = self._read(kept)
        self.uses = self.uses[kept] // 2
        self.clear()
        self.update(zip([*self.vocabulary.special, *pieces[order]], range(1, len(kept))))


@cache
def piece_counts(path: str) -> PieceCounts:
    """One per Python worker, so that the tasks that run in it share what is held."""
    return PieceCounts(path)


@cache
def piece_table(path: str, end_id: int) -> PieceTable:
    return PieceTable(path, end_id)


class PieceIds(dict):
    """Token ids by piece, each piece merged on its own."""

    def __init__(self, path: str) -> None:
        super().__init__()
        self.vocabulary = WordVocabulary(path)

    def __missing__(self, piece: str):
        symbols = self.vocabulary.symbols(piece)
        merge = merge_short if len(symbols) <= LONG_PIECE else merge_long
        found = self.written(merge(symbols, self.vocabulary))
        if len(piece) <= LONG_PIECE:
            if len(self) >= CACHE_PIECES:
                self.clear()
            self[piece] = found
        return found

    def written(self, ids: list[int]):
        """The form in which the ids of a piece are held."""
        return ids
