"""Byte-level BPE by a lazily determinised finite-state transducer, and streaming decoding.

Encoding. A token sequence is the merge result of its bytes exactly when every adjacent pair of
tokens merges back to itself. So the merges compile to a non-deterministic transducer: a state is
(last token, node in the byte trie of the vocabulary); a byte moves along the trie, and where it
ends a token that may follow the last one, a branch outputs that token and returns to the root.
Determinisation keeps the set of open branches, each with the output it still owes; what all
branches agree on is emitted at once. A branch lives at most as long as the longest token, so the
look-ahead is bounded. States and transitions are built when first met and kept in a bounded
cache; when it is full, further ones are built for the moment, and after many of these the cache
is dropped and grows anew.

Decoding. Ids become bytes by gathering from one array of all tokens' bytes; an incremental UTF-8
state machine turns the byte stream into text, carrying an unfinished character of up to three
bytes from one block to the next.

Texts are split by the vocabulary's pattern in bounded windows: the last match of a window is
scanned again with more text after it, since only a match that stops before the window's end is
final. Null and empty texts have no ids. Repeated rows repeat, null keys stay, an empty table
gives no rows. Unknown ids raise an error; bytes that aren't UTF-8 decode to U+FFFD.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import sys
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.texts import Memo, map_texts, releasing, worker_cache

#: Determinised states kept, pieces whose ids are kept, characters of a pre-token window, ids of a decoded block.
STATES, MEMO_ROOM, WINDOW, DECODE_BLOCK = 80_000, 150_000, 1 << 18, 1 << 16
#: A rank above all ranks.
NEVER = 1 << 62


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a tiktoken file: some 50,000 lines of base64 token and rank, whatever the input."""
    lines = open(path, "rb").read().split(b"\n")
    return {base64.b64decode(t): int(r) for t, r in (x.split() for x in lines if x)}


class State:
    """A determinised state: open branches, known moves, and known outputs of a last byte."""

    __slots__ = ("branches", "moves", "ends")

    def __init__(self, branches):
        self.branches, self.moves, self.ends = branches, {}, {}


class Transducer:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.tokens = ranks, {r: t for t, r in ranks.items()}
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError("every single byte must be a token")
        # byte trie: per node its children by byte, and the token that ends there or -1
        self.children: list[dict[int, int]] = [{}]
        self.ends = [-1]
        for token, rank in ranks.items():
            node = 0
            for b in token:
                at = self.children[node].get(b)
                if at is None:
                    at = self.children[node][b] = len(self.children)
                    self.children.append({})
                    self.ends.append(-1)
                node = at
            self.ends[node] = rank
        self.pairs: dict[int, bool] = {}
        self.spines: dict[int, dict[int, list[bytes]]] = {0: {}, -1: {}}
        self.states: dict[tuple, State] = {}
        self._clear()

    def _clear(self) -> None:
        for state in self.states.values():
            state.moves.clear()  # states refer to each other: without this they would never be freed
        self.states = {}
        self.stored = self.passing = 0
        self.start = self._state((((), -1, 0),))

    def merged(self, data: bytes) -> list[bytes]:
        """The last merge of ``data`` by the merges' definition, lowest rank first and leftmost first:
        the parts before the merge that leaves one token, or all parts where several remain."""
        parts, before = [data[i:i + 1] for i in range(len(data))], []
        while len(parts) > 1:
            ranked = [(self.ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.ranks]
            if not ranked:
                return parts
            before, (_, i) = parts, min(ranked)
            parts = [*parts[:i], parts[i] + parts[i + 1], *parts[i + 2:]]
        return before or parts

    def spine(self, token: int, side: int) -> list[bytes]:
        """What stands at the left (0) or right (-1) edge of a token while it is merged, byte first."""
        known = self.spines[side].get(token)
        if known is None:
            data = self.tokens[token]
            known = [data]
            if len(data) > 1:
                parts = self.merged(data)
                if len(parts) != 2 or max(self.ranks[x] for x in parts) > token:
                    raise ValueError(f"token {token} isn't made by the merges")
                known = [*self.spine(self.ranks[parts[side]], side), data]
            self.spines[side][token] = known
        return known

    def follows(self, last: int, token: int) -> bool:
        """Whether ``token`` may stand after ``last``: no merge across their border comes first.

        Ranks grow from parts to wholes, so the tokens at the border climb their spines in rank
        order; a border merge happens if its rank comes before the next climb on either side (on
        equal ranks the leftmost goes first).
        """
        key = last << 32 | token
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= 3 * STATES:
                self.pairs.clear()
            left, right, rank = self.spine(last, -1), self.spine(token, 0), self.ranks
            i = j = 0
            known = True
            while True:
                up_left = rank[left[i + 1]] if i + 1 < len(left) else NEVER
                up_right = rank[right[j + 1]] if j + 1 < len(right) else NEVER
                across = rank.get(left[i] + right[j], NEVER)
                if across < up_left and across <= up_right and across < NEVER:
                    known = False
                    break
                if up_left == up_right == NEVER:
                    break
                if up_left <= up_right:
                    i += 1
                else:
                    j += 1
            self.pairs[key] = known
        return known

    def _state(self, branches: tuple) -> State:
        state = self.states.get(branches)
        if state is None:
            state = State(branches)
            if len(self.states) < STATES:
                self.states[branches] = state
            else:
                self.passing += 1
        return state

    def _move(self, state: State, byte: int) -> tuple[State, tuple]:
        """Build a transition: advance every branch, branch off the ended token, emit the common output.

        Branches stay in the order of the places where their open token begins.
        """
        children, ends, out, ended = self.children, self.ends, [], None
        for owed, last, node in state.branches:
            child = children[node].get(byte)
            if child is None:
                continue
            if children[child]:
                out.append((owed, last, child))
            token = ends[child]
            if token >= 0 and ended is None and (last < 0 or self.follows(last, token)):
                ended = ((*owed, token), token, 0)  # one at most: the tokens of a prefix are unique
        out.append(ended)
        first = out[0][0]
        n = len(first)
        for owed, _, _ in out:
            while owed[:n] != first[:n]:
                n -= 1
        if n:
            out = [(owed[n:], last, node) for owed, last, node in out]
        move = self._state(tuple(out)), first[:n]
        if self.stored < 2 * STATES:
            self.stored += 1
            state.moves[byte] = move
        return move

    def _end(self, state: State, byte: int) -> tuple:
        """What the last byte of a text emits: no new state is needed for it."""
        for owed, last, node in state.branches:
            child = self.children[node].get(byte)
            if child is not None:
                token = self.ends[child]
                if token >= 0 and (last < 0 or self.follows(last, token)):
                    ids = (*owed, token)
                    if self.stored < 2 * STATES:
                        self.stored += 1
                        state.ends[byte] = ids
                    return ids
        raise AssertionError("every text has tokens")

    def encode(self, data: bytes) -> list[int]:
        """Ids of one pre-token."""
        if not data:
            return []
        if self.passing > 50 * STATES:
            self._clear()
        state, ids = self.start, []
        for byte in data[:-1]:
            move = state.moves.get(byte) or self._move(state, byte)
            state, emitted = move
            if emitted:
                ids += emitted
        ids += state.ends.get(data[-1]) or self._end(state, data[-1])
        return ids


def pieces(pattern, text: str, window: int = WINDOW) -> Iterator[list[str]]:
    """The matches of a text, in lists; every character is in one match."""
    at, size = 0, window
    while at < len(text):
        found = pattern.findall(text, at, at + size)
        if at + size < len(text):
            found.pop()  # may go on beyond the window
            if not found:
                size *= 2
                continue
        yield found
        at, size = at + sum(map(len, found)), window


class Utf8Stream:
    """Incremental UTF-8: blocks of bytes in, text out; the state is an unfinished character's bytes."""

    def __init__(self):
        self.held = b""

    @staticmethod
    def unfinished(data: bytes) -> int:
        """Bytes at the end that begin a character without ending it."""
        for back in range(1, min(3, len(data)) + 1):
            b = data[-back]
            if b < 0x80:
                return 0
            if b >= 0xC0:
                need = 2 if b < 0xE0 else 3 if b < 0xF0 else 4
                return back if back < need and b < 0xF8 else 0
        return 0

    def feed(self, data: bytes) -> str:
        data = self.held + data
        n = self.unfinished(data)
        self.held = data[len(data) - n:] if n else b""
        return (data[:-n] if n else data).decode("utf-8", "replace")

    def end(self) -> str:
        held, self.held = self.held, b""
        return held.decode("utf-8", "replace")


class Codec:
    """Encoder and streaming decoder of a vocabulary, one per task."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex
        if sys.byteorder != "little" or array("I").itemsize != 4:
            raise NotImplementedError("ids are packed as native 32-bit integers")
        self.pattern, self.transducer = regex.compile(pattern), Transducer(ranks)
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.memo = Memo(lambda piece: array("I", self.transducer.encode(piece.encode())).tobytes(), MEMO_ROOM)

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian 32-bit integers."""
        return b"".join(b"".join(map(self.memo.__getitem__, found)) for found in pieces(self.pattern, text))

    def close(self) -> None:
        self.transducer._clear()

    def token_bytes(self, ids: np.ndarray) -> bytes:
        if len(ids) and int(ids.max()) >= len(self.sizes):
            raise ValueError("unknown token id")
        sizes = self.sizes[ids]
        shift = self.starts[ids] - (np.cumsum(sizes) - sizes)
        return self.bytes[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))].tobytes()

    def decode(self, ids: np.ndarray) -> Iterator[str]:
        """The text of an id sequence, block by block."""
        stream = Utf8Stream()
        for at in range(0, len(ids), DECODE_BLOCK):
            yield stream.feed(self.token_bytes(ids[at:at + DECODE_BLOCK]))
        yield stream.end()


def codec(path: str, pattern: str) -> Codec:
    """One codec per worker process."""
    return worker_cache(("codec", path, pattern), lambda: Codec(read_ranks(path), pattern))


def encode_table(df: DataFrame, *, key: str, text: str, vocabulary: str, pattern: str) -> DataFrame:
    """``key, ids`` for every row."""
    def make():
        own = codec(vocabulary, pattern)
        return lambda texts: {"ids": [np.frombuffer(own.encode(t), "<i4") for t in texts]}
    return map_texts(df, key, text, make, [("ids", "array<int>", pa.list_(pa.int32()))], keeps=True)


def decode_table(df: DataFrame, *, key: str, ids: str, vocabulary: str, pattern: str) -> DataFrame:
    """``key, text`` for every row of ids; null ids give null."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary, pattern)
        for batch in batches:
            out = ["".join(own.decode(np.array(x.as_py(), "<u4"))) if x.is_valid else None for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["key", "text"])
    return df.select(F.col(key).alias("key"), F.col(ids).alias("ids")).mapInArrow(releasing(run), f"key {kind}, text string")


def round_trip(df: DataFrame, *, key: str, text: str, vocabulary: str, pattern: str) -> DataFrame:
    """``key, n_tokens, ids_sha256, decoded_sha256, same``: encode, decode the ids, and digest both."""
    def make():
        own = codec(vocabulary, pattern)

        def work(texts: list[str]) -> dict[str, list]:
            gc.freeze()  # states and memo are kept long: the collector needn't look at them again
            out: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "same": []}
            for t in texts:
                data = own.encode(t)
                decoded, whole = hashlib.sha256(), hashlib.sha256(t.encode())
                for part in own.decode(np.frombuffer(data, "<u4")):
                    decoded.update(part.encode())
                out["n_tokens"].append(len(data) // 4)
                out["ids_sha256"].append(hashlib.sha256(data).hexdigest())
                out["decoded_sha256"].append(decoded.hexdigest())
                out["same"].append(decoded.digest() == whole.digest())
            return out
        return work
    return map_texts(df, key, text, make, [("n_tokens", "long", pa.int64()), ("ids_sha256", "string", pa.string()),
                                           ("decoded_sha256", "string", pa.string()), ("same", "boolean", pa.bool_())], keeps=True)
