"""Plain Python versions of what the operators compute, for small inputs, and shared fixtures."""

from __future__ import annotations

import random
import re

import pytest

SF_SMALL = "/root/testdata/sf0.001"
SPACES = re.compile("[\x20\x09-\x0d]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return [w for w in SPACES.split(lowered(text)) if w]


def shingle_set(text, width, short=True):
    w = words(text)
    if len(w) >= width:
        return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1))
    return frozenset([tuple(w)]) if w and short else frozenset()


class Sets:
    def __init__(self, items):
        self.up = {x: x for x in items}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def near_groups(texts, width, percent):
    """Index -> least index of its group; texts without words are alone."""
    sets = [shingle_set(t, width) for t in texts]
    found, by = Sets(range(len(texts))), {}
    for i, s in enumerate(sets):
        near = set()
        for x in s:
            near.update(by.setdefault(x, []))
            by[x].append(i)
        for j in near:
            both = len(s & sets[j])
            if found.find(i) != found.find(j) and 100 * both >= percent * (len(s) + len(sets[j]) - both):
                found.join(i, j)
    return [found.find(i) for i in range(len(texts))], sets


def jump(key, shards):
    key &= (1 << 64) - 1
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) & ((1 << 64) - 1)
        j = int(float(b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def merges(ranks, data):
    """Byte pairs merged by rank, leftmost first."""
    parts = [data[i:i + 1] for i in range(len(data))]
    while True:
        able = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not able:
            return [ranks[p] for p in parts]
        i = min(able)[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


PIECES = ["a", "B", "é", " ", "  ", "\n", "'s", "'", "<|endoftext|>", "<|startoftext|>", "<|end", "0", "10", "22", "!?", "\u3000",
          "\xa0", "日本", "👍🏽", "\x1c", "\t", "word ", " the", "Σ", "\u0301", "K", "\u200b", "İ", "ſ", "Ab,", "x.", "ing", "aaaa", "====="]


@pytest.fixture(scope="session")
def odd_texts():
    rng = random.Random(7)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 60))) for _ in range(1500)] + [None, "", "   ", "\n"]


@pytest.fixture
def doc_table(spark):
    """Documents with clashing column names: rows of (doc_id, text)."""
    def make(rows):
        return spark.createDataFrame([(i, t, "x", 1.0, 5, "n", 2) for i, t in rows],
                                     "doc_id long, text string, score string, key double, node int, shard string, size int")
    return make
