"""Token counts of whole texts with a library tokenizer, huge documents by overlap resynchronisation.

A document up to ``chunk`` characters is counted by its runs (see RunCounter); a longer one is
encoded in chunks that overlap, and neighbours are spliced at a boundary that both encodings share and that is proven
stable. The proof: the pre-tokenizer scans left to right and a match depends only on the text
from its start on, so where the left chunk (right by induction) and the right chunk both start a
pre-token, both go on alike. The boundary must also lie a guard before the left chunk's end, so
that no match, look-ahead or special string that decided it was cut. A boundary between tokens
inside a pre-token proves nothing and is never used. Where the overlap holds no common boundary,
it is doubled, up to the whole rest of the document.

Null and empty texts have 0 bytes and 0 tokens. Repeated rows and ids repeat, null ids stay. An
empty table gives no rows.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm.texts import map_texts, worker_cache
from tessera.llm.wordhash import WordHasher, WordTable, mixed

#: Characters of a chunk, of the first overlap tried, and before a chunk's end that prove nothing.
CHUNK, OVERLAP, GUARD = 1 << 14, 128, 32
#: Counted runs that a worker keeps (some 30 bytes each).
ROOM = 1_000_000

# White space outside ASCII: a run could end on it, so such a text is encoded whole.
_OTHER_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]").search
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def _starts(encoding, low: int, high: int) -> dict[int, int]:
    """Pre-token starts in [low, high) of an encoded chunk -> first token of that pre-token."""
    found: dict[int, int] = {}
    at = low
    while at < high:
        word = encoding.char_to_word(at)
        if word is None:  # a character without a token of its own
            at += 1
            continue
        begin, end = encoding.word_to_chars(word)
        if low <= begin < high:
            found[begin] = encoding.word_to_tokens(word)[0]
        at = max(end, at + 1)
    return found


def chunked_ids(tok, text: str, chunk: int = CHUNK, overlap: int = OVERLAP, guard: int = GUARD):
    """Token ids of a whole text as a sequence of lists, from overlapping chunks."""
    encode = lambda a, b: tok.encode(text[a:b], add_special_tokens=False)
    first = lambda e, p: _starts(e, p, p + 1)[p] if p else 0  # noqa: E731  token that starts at p
    # the current chunk is text[start:end]; its tokens count from its stable boundary ``proven`` on
    start, proven, end = 0, 0, min(len(text), chunk + overlap)
    left = encode(start, end)
    while end < len(text):
        lap, begin = end - (start + chunk), start + chunk
        right_end = min(len(text), begin + max(chunk, lap) + overlap)
        right = encode(begin, right_end)
        known = _starts(left, max(chunk, proven), end - start - guard)
        common = {p - chunk for p in known} & _starts(right, 0, lap).keys()
        if not common:
            end = min(len(text), begin + 2 * lap)  # widen: the left chunk reaches further
            left = encode(start, end)
            continue
        p = min(common)
        yield left.ids[first(left, proven):known[p + chunk]]
        start, proven, end, left = begin, p, right_end, right
    yield left.ids[first(left, proven):]


class RunCounter:
    """Token counts of texts up to a chunk, from the runs they are made of.

    The same fact cuts a text where no overlap is needed: a pre-token never spans the change from a
    character that isn't white space to a space or line break. A run is such a character and the
    word after it. Runs are counted once and kept in a bounded table of fingerprints; new runs of a
    slice go to the library joined, and the tokens that begin with a space or line break part them
    again. Texts with other or repeated white space are encoded whole.
    """

    def __init__(self, tok):
        self.tok, self.hasher = tok, WordHasher(fold=False)
        self.table = WordTable(self._count, ROOM)
        self.begins = np.zeros(tok.get_vocab_size(), bool)
        self.begins[[i for t, i in tok.get_vocab().items() if t[0] in "\u0120\u010a"]] = True

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _count(self, runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        counts = np.zeros(len(runs), np.uint32)
        led = [i for i, r in enumerate(runs) if r[0] in b" \n"]
        first = [i for i, r in enumerate(runs) if r[0] not in b" \n"]  # a text's first word
        parts = [b"".join(runs[i] for i in led[k:k + 1000]).decode() for k in range(0, len(led), 1000)]
        ids = np.array([x for part in self._ids(parts) for x in part], np.int64)
        starts = np.flatnonzero(self.begins[ids])
        if len(starts) != len(led):
            raise AssertionError("runs and their tokens differ")
        counts[led] = np.diff(starts, append=len(ids))
        counts[first] = [len(x) for x in self._ids([runs[i].decode() for i in first])]
        return counts, np.ones(len(runs), np.int64)

    def __call__(self, texts: list[str]) -> list[int]:
        data = [t.encode() for t in texts]
        whole = b" ".join(data)
        a = np.frombuffer(whole, np.uint8)
        stops = np.cumsum([len(d) + 1 for d in data])
        begins = stops - np.array([len(d) + 1 for d in data])
        hashes, starts, ends = self.hasher(whole)
        if not len(starts):
            return [len(x) for x in self._ids(texts)]
        owner = np.searchsorted(stops, starts, "right")
        leads = starts > begins[owner]  # a character stands before the word
        lead = np.where(leads, a[np.maximum(starts, 1) - 1], 0)
        gap = starts - np.maximum(np.concatenate(([0], ends[:-1])), begins[owner])
        odd = np.where(leads, (gap != 1) | ((lead != 0x20) & (lead != 0x0A)), False)
        wrong = np.bincount(owner, odd, len(texts)) > 0
        last = np.zeros(len(texts), np.int64)
        np.maximum.at(last, owner, ends)
        wrong |= last != stops - 1  # ends with white space, or blank
        wrong |= np.array([bool(_OTHER_SPACE(t)) for t in texts])
        fine = ~wrong[owner]
        counts, _ = self.table.over(whole, mixed(hashes[fine] + lead[fine].astype(np.uint64)), (starts - leads)[fine], ends[fine])
        out = np.bincount(owner[fine], counts, len(texts)).astype(np.int64)
        again = np.flatnonzero(wrong)
        out[again] = [len(x) for x in self._ids([texts[i] for i in again])]
        return out.tolist()


def counter(tok, chunk: int = CHUNK, overlap: int = OVERLAP):
    """A function of texts giving their token counts."""
    short = RunCounter(tok)

    def count(texts: list[str]) -> list[int]:
        out = [0 if len(t) <= chunk else sum(map(len, chunked_ids(tok, t, chunk, overlap))) for t in texts]
        own = [i for i, t in enumerate(texts) if 0 < len(t) <= chunk]
        for i, n in zip(own, short([texts[i] for i in own]) if own else []):
            out[i] = n
        return out
    return count


def count_tokens(df: DataFrame, *, key: str, text: str, vocabulary: str, limit: int) -> DataFrame:
    """``key, n_bytes, n_tokens, over_limit`` for every row; ``vocabulary`` is a path that workers can read.

    The vocabulary is byte-level BPE whose pattern joins white space only to what follows it.
    """
    def make():
        count = worker_cache(("counter", vocabulary), lambda: counter(tokenizer(vocabulary)))

        def work(texts: list[str]) -> dict[str, list]:
            n = count(texts)
            return {"n_bytes": [len(t.encode()) for t in texts], "n_tokens": n, "over_limit": [x > limit for x in n]}
        return work
    return map_texts(df, key, text, make, [("n_bytes", "long", pa.int64()), ("n_tokens", "long", pa.int64()),
                                           ("over_limit", "boolean", pa.bool_())], keeps=True)
