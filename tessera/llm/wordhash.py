"""64-bit fingerprints of all words of a byte buffer, by array operations, and tables keyed by them.

A word is a run of bytes other than ASCII white space. Its fingerprint is a polynomial of random
per-byte values modulo 2^64, read off two prefix sums and mixed with the length: equal words have
equal fingerprints, and two of n different words collide with a chance of about n^2 / 2^65.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

#: Bytes hashed at once.
WINDOW = 1 << 20
#: Bytes of the longest word that a table keeps.
LONGEST = 64

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x2545F4914F6CDD1D
_BREAK = np.zeros(256, bool)
_BREAK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit integers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHasher:
    """``hasher(data)`` gives fingerprints, starts and ends of the words; A-Z equal a-z if ``fold``."""

    def __init__(self, fold: bool = True):
        self.values = mixed(np.arange(1, 257, dtype=np.uint64) * _GOLDEN)
        if fold:
            self.values[65:91] = self.values[97:123]
        self.power = self.inverse = np.zeros(0, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.power) < n:
            n = max(n, WINDOW)
            for name, base in (("power", _BASE), ("inverse", pow(_BASE, -1, 1 << 64))):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))

    def _windows(self, broken: np.ndarray) -> Iterator[tuple[int, int]]:
        at, n = 0, len(broken)
        while at < n:
            end = min(n, at + WINDOW)
            if end < n:
                back = np.flatnonzero(broken[at:end])
                if len(back):
                    end = at + int(back[-1]) + 1
                else:  # a word longer than the window
                    ahead = np.flatnonzero(broken[end:])
                    end = end + int(ahead[0]) + 1 if len(ahead) else n
            yield at, end
            at = end

    def _long(self, a: np.ndarray, start: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One word longer than a window, hashed window by window: each continues the polynomial where the last one ended."""
        self._grow(WINDOW)
        h = np.zeros(1, np.uint64)
        for at in range(start, end, WINDOW):
            part = self.values[a[at:min(end, at + WINDOW)]]
            h += (part * self.power[:len(part)]).sum(dtype=np.uint64, keepdims=True) * np.array([pow(_BASE, at - start, 1 << 64)], np.uint64)
        return mixed(h + np.array([end - start], np.uint64) * _GOLDEN), np.array([start]), np.array([end])

    def __call__(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a = np.frombuffer(data, np.uint8)
        broken = _BREAK[a]
        found = []
        for at, end in self._windows(broken):
            if end - at > WINDOW:
                found.append(self._long(a, at, end - bool(broken[end - 1])))
                continue
            edge = np.diff(broken[at:end].view(np.int8), prepend=1, append=1)
            starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
            self._grow(end - at)
            sums = np.zeros(end - at + 1, np.uint64)
            np.cumsum(self.values[a[at:end]] * self.power[:end - at], out=sums[1:])
            h = (sums[ends] - sums[starts]) * self.inverse[starts] if len(starts) else np.zeros(0, np.uint64)
            found.append((mixed(h + (ends - starts).astype(np.uint64) * _GOLDEN), starts + at, ends + at))
        if not found:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*found))


class WordTable:
    """Fingerprint -> run of values, as sorted arrays; keeps up to ``room`` words of at most ``LONGEST`` bytes.

    New words go to a small sorted run that joins the large one when it has a quarter of its
    size, so a word is moved only a few times.
    """

    def __init__(self, compute: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], room: int):
        self.compute, self.room, self.pool = compute, room, np.zeros(0, np.uint16)
        empty = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.runs = [empty, empty]

    @staticmethod
    def _merge(one, two):
        at = np.searchsorted(one[0], two[0])
        return tuple(np.insert(a, at, b) for a, b in zip(one, two))

    def over(self, data: bytes, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All words' values in one array, and each word's number of values."""
        if not len(hashes):
            return self.pool[:0], np.zeros(0, np.int64)
        known, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        place, size = np.zeros(len(known), np.int64), np.full(len(known), -1, np.int64)
        for keys, places, sizes in self.runs:
            if len(keys):
                at = np.minimum(np.searchsorted(keys, known), len(keys) - 1)
                hit = keys[at] == known
                place[hit], size[hit] = places[at[hit]], sizes[at[hit]]
        new = np.flatnonzero(size < 0)
        pool = self.pool
        if len(new):
            short = ends[first[new]] - starts[first[new]] <= LONGEST
            new, n_kept = np.concatenate((new[short], new[~short])), int(short.sum())  # what isn't kept comes last
            values, size[new] = self.compute([data[s:e] for s, e in zip(starts[first[new]].tolist(), ends[first[new]].tolist())])
            place[new] = len(pool) + np.cumsum(size[new]) - size[new]
            pool = np.concatenate((pool, values)) if len(pool) else values
            new = new[:n_kept]
            if sum(len(r[0]) for r in self.runs) + len(new) <= self.room:
                self.pool = pool[:len(self.pool) + int(size[new].sum())]
                self.runs[1] = self._merge(self.runs[1], (known[new], place[new], size[new]))
                if 4 * len(self.runs[1][0]) > len(self.runs[0][0]):
                    self.runs = [self._merge(*self.runs), (known[:0], place[:0], size[:0])]
        sizes = size[back]
        shift = place[back] - (np.cumsum(sizes) - sizes)
        return pool[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))], sizes
