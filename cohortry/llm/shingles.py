"""Hashed word shingles of whole texts, for a batch of texts at once.

Words are runs of characters other than space, tab, line feed, vertical tab, form
feed and carriage return, as they stand.  A shingle is five words; a text of one
to four words has one shingle, all its words.  A text's shingles are a multiset.

A word's hash is a polynomial over its bytes modulo 2**64, taken from running sums
over the batch, then mixed; a shingle's hash mixes those of its words.
"""

from __future__ import annotations

import numpy as np

SHINGLE_WORDS = 5

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of SplitMix64)."""
    with np.errstate(over="ignore"):
        x = values + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0, 1, ... n - 1 modulo 2**64, kept for later calls."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, 1 << 20), np.uint64(base), dtype=np.uint64)
        steps[0] = 1
        known = _powers[base] = np.multiply.accumulate(steps)
        if len(known) > 1 << 24:  # not worth keeping for one huge text
            _powers.pop(base)
    return known[:n]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word, and the number of the text it is in."""
    flat = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    blank = (flat == 32) | ((flat >= 9) & (flat <= 13))
    edge = np.flatnonzero(np.diff(blank, prepend=True))
    starts, ends = edge[::2], edge[1::2]
    with np.errstate(over="ignore"):
        sums = np.zeros(len(flat) + 1, dtype=np.uint64)
        np.cumsum(_BYTES[flat] * _power(_BASE, len(flat)), out=sums[1:])
        found = (sums[ends] - sums[starts]) * _power(_BASE_INVERSE, len(flat))[starts]
        found = mix(found + (ends - starts).astype(np.uint64))
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    return found, np.searchsorted(text_ends, starts, side="right")


def shingle_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every shingle, and the number of the text it is in, in order."""
    words, owner = word_hashes(texts)
    n = len(words)
    counts = np.bincount(owner, minlength=len(texts))
    first = np.concatenate(([0], np.cumsum(counts)[:-1]))
    full = np.flatnonzero(owner[: max(0, n - SHINGLE_WORDS + 1)] == owner[SHINGLE_WORDS - 1 :])
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE_WORDS))
    with np.errstate(over="ignore"):
        found = np.full(len(full), SHINGLE_WORDS, dtype=np.uint64)
        for k in range(SHINGLE_WORDS):
            found = mix(found * np.uint64(_BASE) + words[full + k])
        few = counts[short].astype(np.uint64)
        for k in range(SHINGLE_WORDS - 1):
            there = counts[short] > k
            few[there] = mix(few[there] * np.uint64(_BASE) + words[first[short[there]] + k])
    found, owners = np.concatenate((found, few)), np.concatenate((owner[full], short))
    order = np.argsort(owners, kind="stable")
    return found[order], owners[order]


def counted(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, ...]:
    """(hash, text, count) of each different shingle, and each one's repetition.

    The last array numbers the repetitions 0, 1, ... along the sorted shingles,
    which the first two of the result are expanded from by ``count``.
    """
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(hashes)))
    repetition = np.arange(len(hashes)) - np.repeat(at, count)
    return hashes[at], owner[at], count, repetition
