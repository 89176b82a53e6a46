"""Words and word sequences as 64-bit numbers, in numpy."""

from __future__ import annotations

import numpy as np

MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], dtype=np.uint64)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all."""
    values = (values ^ (values >> np.uint64(30))) * MULTIPLIERS[1]
    values = (values ^ (values >> np.uint64(27))) * MULTIPLIERS[2]
    return values ^ (values >> np.uint64(31))


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A hash of each pair, in this order."""
    return mixed(left * MULTIPLIERS[0] + right)


def windows(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words."""
    found = words[: max(0, len(words) - size + 1)]
    for n in range(1, size):
        found = joined(found, words[n : n + len(found)])
    return found


IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
BYTE_VALUES = np.random.default_rng(64).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


HELD = 1 << 21  # powers kept by a worker, of each base; those of longer texts are made anew
_powers: dict[int, np.ndarray] = {}


def powers(base: int, count: int) -> np.ndarray:
    """The first ``count`` powers of an odd number, modulo 2**64."""
    held = _powers.get(base)
    if held is not None and len(held) >= count:
        return held[:count]
    found = np.ones(max(count, min(HELD, 1 << 20)), np.uint64)
    done = 1
    while done < len(found):
        more = min(done, len(found) - done)
        found[done : done + more] = found[:more] * np.uint64(pow(base, done, 1 << 64))
        done += more
    if len(found) <= HELD:
        _powers[base] = found
    return found[:count]


def word_hashes(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of some texts, A-Z lower-cased, one text behind the other, and how many each text has.

    All words are hashed at once: a running sum of byte values times powers of a base gives the hash of a word as
    a difference, shifted back to the word's start.
    """
    data = np.frombuffer(b"\n" + b"\n".join(found).lower() + b"\n", np.uint8)
    space = IS_SPACE[data]
    change = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, ends = change[::2], change[1::2]
    size = len(data)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * powers(BASE, size), out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * powers(INVERSE, size)[starts] + (ends - starts).astype(np.uint64))
    after = np.cumsum([len(t) + 1 for t in found]) + 1
    return hashes, np.diff(np.r_[0, np.searchsorted(starts, after)])


def split_words(found: list[bytes]) -> list[np.ndarray]:
    """The word hashes of each text."""
    hashes, counts = word_hashes(found)
    return np.split(hashes, np.cumsum(counts)[:-1]) if len(counts) else []
