"""SuperMinHash signatures (Ertl, 2017) of word-shingle sets, vectorised over a set's elements.

Each element draws one random permutation of the slots, step by step, and at step j offers slot
pi(j) the value r + j with a fresh r in [0, 1); a slot keeps its smallest offer. The ranks of one
element are correlated over the slots (a permutation), so estimates vary less than with
independent hashes. Once no slot's value exceeds j, later steps cannot change anything: the loop
stops, after one step for sets much larger than the signature.
"""

from __future__ import annotations

import hashlib

import numpy as np

from tessera.llm.wordhash import WordHasher, mixed

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Distinct shingles of a text's word fingerprints, as sorted 64-bit fingerprints.

    Fewer words than ``width`` make one shingle, no words none.
    """
    if not len(words):
        return words
    width = min(width, len(words))
    n = len(words) - width + 1
    out = words[:n].copy()
    for i in range(1, width):
        out = mixed(out + _GOLDEN) + words[i:n + i]
    return np.unique(mixed(out + np.uint64(width)))


class Shingler:
    """Shingle sets of a list of texts; one per task."""

    def __init__(self, width: int):
        self.width, self.hasher = width, WordHasher()

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        data = [t.encode() for t in texts]
        words, starts, _ = self.hasher(b" ".join(data))
        ends = np.searchsorted(starts, np.cumsum([len(d) + 1 for d in data])).tolist()
        return [shingles(words[a:b], self.width) for a, b in zip([0, *ends], ends)]


def signature(elements: np.ndarray, slots: int) -> np.ndarray:
    """The winning values per slot as float64: the step in the whole part, r in the fraction."""
    best = np.full(slots, np.inf)
    n, state, perm = len(elements), elements, None
    rows = np.arange(n)
    for step in range(slots if n else 0):
        state = mixed(state + _GOLDEN)
        r = (state >> np.uint64(11)).astype(np.float64) * 2.0**-53
        state = mixed(state + _GOLDEN)
        pick = step + ((state >> np.uint64(32)) * np.uint64(slots - step) >> np.uint64(32)).astype(np.int64)
        if perm is None and step:
            # only now is the permutation needed: step 0 swapped slot 0 with each element's pick
            perm = np.tile(np.arange(slots, dtype=np.int16), (n, 1))
            perm[rows, first], perm[:, 0] = 0, first
        if step:
            at = perm[rows, pick]
            perm[rows, pick] = perm[:, step]
        else:
            at = first = pick
        np.minimum.at(best, at, r + step)
        if best.max() <= step + 1:
            break
    return best


def short(sig: np.ndarray) -> np.ndarray:
    """16 bits of each slot's value: equal values stay equal, so estimates only err upwards."""
    return (mixed(sig.view(np.uint64)) >> np.uint64(48)).astype(np.uint16)


def band_hashes(sig: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit hash per band of the signature (the band's number is part of it)."""
    parts = mixed(sig.view(np.uint64)).reshape(bands, -1)
    out = np.arange(1, bands + 1, dtype=np.uint64) * _GOLDEN
    for i in range(parts.shape[1]):
        out = mixed(out + parts[:, i])
    return out.view(np.int64)


def set_key(elements: np.ndarray) -> int:
    """A signed 64-bit name of a set."""
    return int.from_bytes(hashlib.blake2b(elements.tobytes(), digest_size=8).digest(), "little", signed=True)
