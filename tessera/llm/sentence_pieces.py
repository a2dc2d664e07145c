"""SentencePiece BPE encoding that keeps offsets, and decoding.

Normalisation takes, at every position, the longest key of the model's compiled character map
(a double array) that is a prefix of the rest, and records for each byte it puts out where in
the source the prefix began. White space is then squeezed, escaped and headed as the model asks,
and the record goes along. Pieces are byte ranges of the normalised text, so the record projects
each of them to a byte span of the source: the spans are those of the library's own proto. A byte
piece of an unknown character is an empty span but for the last one, which holds the character.
A stretch in which no key matches and spaces are only escaped is recorded as one run: each of its
pieces stands for as many source bytes as it has itself, an escaped space for one.

Merging works per unit (white space and what follows it): no piece of the vocabulary goes on into
white space, which is checked when a model is read. Texts are normalised in windows of about a
million characters that end between units; a unit without white space is merged in memory that
grows with its length.

Null and empty texts have no pieces and decode to an empty text. Repeated rows are rows of their
own, null keys stay, an empty table gives no rows, other columns are not read. Strings of control
pieces (``<s>``) or byte pieces (``<0x41>``) inside a text are ordinary characters. Decoding an id
out of range raises; null ids decode to null; bytes that are no UTF-8 become U+FFFD one by one.
Models other than BPE, user-defined or unused pieces, and white space as a suffix raise.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import re
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.texts import Memo, map_texts, releasing, worker_cache

#: How white space is written in pieces.
SPACE = "▁"
#: Kinds of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Characters of a text that are normalised at a time, units that a worker remembers, and the longest of them.
WINDOW, MEMO_ROOM, LONG_UNIT = 1 << 20, 400_000, 64
_UNIT = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value
    while at < len(data):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
        else:
            n = {1: 8, 2: 0, 5: 4}[tag & 7] or varint()
            yield tag >> 3, data[at:at + n]
            at += n


@dataclass
class Model:
    """What a model file says."""
    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    kinds: list[int] = field(default_factory=list)
    byte_fallback: bool = False
    unknown_surface: str = " ⁇ "
    char_map: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True
    escape: bool = True


def read_model(data: bytes) -> Model:
    """A model file's content, parsed and checked."""
    out, kind_of_model, suffix = Model(), 1, 0
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            out.pieces.append(piece.get(1, b"").decode())
            out.scores.append(struct.unpack("<f", piece.get(2, bytes(4)))[0])
            out.kinds.append(piece.get(3, NORMAL))
        elif number == 2:
            trainer = dict(_fields(value))
            kind_of_model, suffix = trainer.get(3, 1), trainer.get(24, 0)
            out.byte_fallback = bool(trainer.get(35, 0))
            out.unknown_surface = trainer.get(44, out.unknown_surface.encode()).decode()
        elif number == 3:
            rule = dict(_fields(value))
            out.char_map = rule.get(2, b"")
            out.dummy_prefix, out.squeeze, out.escape = (bool(rule.get(n, 1)) for n in (3, 4, 5))
    if kind_of_model != 2 or suffix or {USER_DEFINED, UNUSED} & set(out.kinds):
        raise NotImplementedError("a BPE model without user-defined or unused pieces, white space as a prefix")
    if any(SPACE in p.lstrip(SPACE) for p in out.pieces):
        raise NotImplementedError("a piece goes on into white space")
    return out


class CharMap:
    """Longest-prefix look-up in a compiled character map: double array, then the replacements."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.texts = blob[4 + size:]
        self.mapped = Memo(lambda c: any(self._walk(c.encode())), 1 << 16)

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & (1 << 9)) >> 6)

    def _walk(self, data: bytes) -> tuple[tuple[int, int] | None, bool]:
        """The longest key in front as (its bytes, its value), and whether a longer one may follow."""
        best, at = None, self._offset(self.units[0])
        for n, byte in enumerate(data):
            at ^= byte
            unit = self.units[at] if at < len(self.units) else 0
            if unit & 0x800000FF != byte:
                return best, False
            at ^= self._offset(unit)
            if unit >> 8 & 1:
                best = n + 1, self.units[at] & 0x7FFFFFFF
        return best, True

    def longest(self, text: str, at: int) -> tuple[int, bytes] | None:
        """Characters of the longest key that begins at a position, and what replaces it."""
        room = 16
        while True:
            data = text[at:at + room].encode()
            best, more = self._walk(data)
            if not more or at + room >= len(text):
                break
            room *= 4
        if best is None:
            return None
        return len(data[:best[0]].decode()), self.texts[best[1]:self.texts.index(b"\0", best[1])]

    def first_of(self, text: str) -> list[str]:
        """Characters of a text with which a key may begin."""
        return [c for c in set(text) if self.mapped[c]] if self.units else []

    def hits(self, text: str, start: int, end: int) -> Iterator[tuple[int, int, bytes]]:
        """(position, characters, replacement) of the keys met from ``start``; the last may pass ``end``."""
        first = self.first_of(text[start:end])
        if not first:
            return
        free = start
        for m in re.compile("[" + "".join(map(re.escape, first)) + "]").finditer(text, start, end):
            if m.start() >= free and (hit := self.longest(text, m.start())):
                free = m.start() + hit[0]
                yield m.start(), *hit


def _plain(text: str, base: int) -> tuple[bytes, np.ndarray]:
    """Bytes of an unmapped stretch, and for each the source byte where its character begins."""
    data = text.encode()
    at = np.arange(base, base + len(data))
    if len(data) != len(text):
        inside = (np.frombuffer(data, np.uint8) & 0xC0) == 0x80
        at[inside] = base
        at = np.maximum.accumulate(at)
    return data, at


class Normalizer:
    """Normalised text with its alignment to the source."""

    def __init__(self, model: Model):
        self.model, self.map = model, CharMap(model.char_map)

    def _stretch(self, text: str, start: int, end: int, base: int) -> tuple[list[tuple[bytes, np.ndarray, int]], int, int]:
        """Parts (bytes, origins, first source byte of a replacement or -1) for ``text[start:end]``; position and byte of their end."""
        out = []
        for at, n, new in self.map.hits(text, start, end):
            if at > start:
                out.append((*_plain(text[start:at], base), -1))
                base += len(out[-1][0])
            out.append((new, np.full(len(new), base), base))
            base += len(text[at:at + n].encode())
            start = at + n
        if start < end:
            out.append((*_plain(text[start:end], base), -1))
            base, start = base + len(out[-1][0]), end
        return out, start, base

    @staticmethod
    def _body(parts: list[tuple[bytes, np.ndarray, int]]) -> int | None:
        """The source byte behind leading spaces (and what is replaced by one space)."""
        for data, origins, mapped in parts:
            rest = data.lstrip(b" ")
            if mapped < 0 and rest:
                return int(origins[len(data) - len(rest)])
            if mapped >= 0 and data != b" ":
                return mapped
        return None

    @staticmethod
    def _squeezed(parts: list[tuple[bytes, np.ndarray, int]], after_space: bool) -> tuple[list[tuple[bytes, np.ndarray, int]], bool]:
        """Spaces that follow a space are dropped: anywhere in plain parts, at the front of replacements."""
        out = []
        for data, origins, mapped in parts:
            space = np.frombuffer(data, np.uint8) == 32
            if mapped < 0:
                gone = space & np.concatenate(([after_space], space[:-1]))
            else:
                gone = (np.cumsum(~space) == 0) & after_space
            if gone.any():
                data, origins = np.frombuffer(data, np.uint8)[~gone].tobytes(), origins[~gone]
            if data:
                after_space = data.endswith(b" ")
            out.append((data, origins, mapped))
        return out, after_space

    def __call__(self, text: str, window: int = WINDOW, runs: bool = True) -> Iterator[tuple[str, np.ndarray | int]]:
        """Stretches of the normalised text with their origins, which have one entry more: where the stretch ends in the source.

        With ``runs``, the origins of a stretch that is one run are only its first source byte.
        """
        model, start, base = self.model, 0, 0
        after_space, headed, body = model.squeeze, not model.dummy_prefix, None if model.squeeze else 0
        held: tuple[bytes, np.ndarray] = b"", np.empty(0, np.int64)  # spaces that may be the last of the text
        while start < len(text):
            end = self._cut(text, start + window)
            if runs and model.dummy_prefix and model.escape and not model.squeeze:
                part = text[start:end]
                if SPACE not in part and not self.map.first_of(part):
                    yield ("" if headed else SPACE) + part.replace(" ", SPACE), base
                    headed, start = True, end
                    base += len(part.encode()) if end < len(text) else 0
                    continue
            while True:
                parts, stop, past = self._stretch(text, start, end, base)
                if stop == end or stop >= len(text):
                    break
                end = self._cut(text, stop + 1)  # a key goes on beyond the cut: the next one
            if model.squeeze:
                body = self._body(parts) if body is None else body
                parts, after_space = self._squeezed(parts, after_space)
            data, at = b"".join([held[0], *(p[0] for p in parts)]), np.concatenate([held[1], *(p[1] for p in parts)])
            held = b"", np.empty(0, np.int64)
            if model.squeeze:
                kept = data.rstrip(b" ")
                held = data[len(kept):], at[len(kept):]
                data, at = kept, at[:len(kept)]
            start, base = stop, past
            if not data:
                continue
            if not headed:
                data, at, headed = b" " + data, np.concatenate(([body], at)), True
            if model.escape:
                at = np.repeat(at, np.where(np.frombuffer(data, np.uint8) == 32, 3, 1))
                data = data.replace(b" ", SPACE.encode())
            finish = int(held[1][0]) if len(held[1]) else base
            yield data.decode(), np.append(at, finish)

    @staticmethod
    def _cut(text: str, at: int) -> int:
        """The first place from ``at`` on where a space follows something else, or the end."""
        while 0 < (at := text.find(" ", at)):
            if text[at - 1] not in f" {SPACE}":
                return at
            at += 1
        return len(text)


class Codec:
    """Encoder and decoder of a model, one per worker process."""

    def __init__(self, model: Model):
        self.model, self.normalizer = model, Normalizer(model)
        normal = [i for i, k in enumerate(model.kinds) if k == NORMAL]
        self.ids = {model.pieces[i]: i for i in normal}
        self.order = {model.pieces[i]: -model.scores[i] for i in normal}
        self.pairs = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.unknown = model.kinds.index(UNKNOWN)
        self.bytes = {int(model.pieces[i][3:5], 16): i for i, k in enumerate(model.kinds) if k == BYTE}
        self.names = [str(i) for i in range(len(model.pieces))]
        self.headed = model.dummy_prefix and model.escape  # every unit begins with white space
        self.byte_of = np.full(len(model.pieces), -1, np.int64)
        for byte, i in self.bytes.items():
            self.byte_of[i] = byte
        # a byte below 128 is a character whatever is around it
        self.surfaces = ["" if k == CONTROL else model.unknown_surface if k == UNKNOWN else chr(b) if 0 <= b < 128 else p.replace(SPACE, " ")
                         for p, k, b in zip(model.pieces, model.kinds, self.byte_of.tolist())]
        self.memo = Memo(lambda u: self._pieces(SPACE + u if self.headed and u[:1] != SPACE else u), MEMO_ROOM)
        self.inner = Memo(self._pieces, MEMO_ROOM // 10)

    def merged(self, unit: str) -> list[str]:
        """The unit's characters merged by score, highest first, leftmost among equals."""
        parts, n = list(unit), len(unit)
        if n <= LONG_UNIT:
            order, never = self.order.get, float("inf")
            able_at = [order(a + b, never) for a, b in zip(parts, parts[1:])]
            while able_at and (best := min(able_at)) < never:
                i = able_at.index(best)
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
                del able_at[i]
                if i < len(able_at):
                    able_at[i] = order(parts[i] + parts[i + 1], never)
                if i:
                    able_at[i - 1] = order(parts[i - 1] + parts[i], never)
            return parts
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        able: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            both = parts[i] + parts[after[i]]
            if (order := self.order.get(both)) is not None:
                heapq.heappush(able, (order, i, both))
        for i in range(n - 1):
            offer(i)
        while able:
            _, i, both = heapq.heappop(able)
            j = after[i]
            if j == n or not parts[i] or len(parts[i]) + len(parts[j]) != len(both):
                continue
            parts[i], parts[j] = both, ""
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
                offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [p for p in parts if p]

    def _pieces(self, unit: str) -> bytes:
        """(id, normalised bytes, source bytes in a plain run) of the unit's pieces, as 32-bit integers."""
        out = array("i")
        for piece in self.merged(unit):
            own, size = self.ids.get(piece), len(piece.encode())
            if own is not None:
                out.extend((own, size, size - 2 * piece.count(SPACE)))
            elif self.model.byte_fallback:
                data = piece.encode()
                for n, byte in enumerate(data):
                    out.extend((self.bytes[byte], 1, size if n + 1 == size else 0))
            else:
                out.extend((self.unknown, size, size - 2 * piece.count(SPACE)))
        return out.tobytes()

    def _units(self, text: str) -> list[str]:
        """Units of a normalised text, without their white space where that is one."""
        if self.headed and SPACE * 2 not in text:
            units = text.split(SPACE)
            del units[0]
            return units
        return _UNIT.findall(text)

    def _long(self, unit: str) -> bytes:
        """A long unit, cut where no piece joins the two characters."""
        if self.headed and unit[:1] != SPACE:
            unit = SPACE + unit
        cuts = [i + 1 for i, pair in enumerate(zip(unit, unit[1:])) if "".join(pair) not in self.pairs]
        return b"".join(map(self.inner.__getitem__, [unit[a:b] for a, b in zip([0, *cuts], [*cuts, len(unit)])]))

    def _found(self, text: str) -> np.ndarray:
        """(id, normalised bytes, source bytes in a plain run) of the pieces of a normalised text."""
        units = self._units(text)
        if len(text) > LONG_UNIT and max(map(len, units)) > LONG_UNIT:
            found = [self.memo[u] if len(u) <= LONG_UNIT else self._long(u) for u in units]
        else:
            found = map(self.memo.__getitem__, units)
        return np.frombuffer(b"".join(found), "<i4").reshape(-1, 3)

    def encode(self, text: str, window: int = WINDOW, runs: bool = True) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Ids, and first and next source bytes of a text's pieces, window by window."""
        for data, origins in self.normalizer(text, window, runs):
            found = self._found(data)
            ids = found[:, 0]
            if run := isinstance(origins, int):
                ends = np.cumsum(found[:, 2], dtype=np.int64) + origins
                if not origins:
                    ends -= 1  # the space that heads the text is no source byte
                begins = ends - found[:, 2]
                begins[:1] = origins
            else:
                ends = np.cumsum(found[:, 1], dtype=np.int64)
                begins = ends - found[:, 1]
            if not self.model.byte_fallback and (unknown := ids == self.unknown).any():
                # neighbouring unknown pieces are one
                first = ~(unknown & np.concatenate(([False], unknown[:-1])))
                ids, begins, ends = ids[first], begins[first], ends[np.append(np.flatnonzero(first)[1:], len(first)) - 1]
            yield (ids, begins, ends) if run else (ids, origins[begins], origins[ends])

    def _bytes_text(self, data: bytes) -> str:
        """UTF-8 in which every byte of no character is U+FFFD on its own."""
        out = []
        while data:
            try:
                out.append(data.decode())
                break
            except UnicodeDecodeError as e:
                out.append(data[:e.start].decode() + "�")
                data = data[e.start + 1:]
        return "".join(out)

    def decode(self, ids: np.ndarray) -> str:
        """The text of an id sequence: the first piece's own space goes, runs of byte pieces are one."""
        if not len(ids):
            return ""
        if int(ids.min()) < 0 or int(ids.max()) >= len(self.surfaces):
            raise ValueError("unknown token id")
        numbers, model = ids.tolist(), self.model
        high = np.flatnonzero(self.byte_of[ids] >= 128)
        parts = list(map(self.surfaces.__getitem__, numbers))
        for run in np.split(high, np.flatnonzero(np.diff(high) > 1) + 1) if len(high) else ():
            data = self.byte_of[ids[run]].astype(np.uint8).tobytes()
            parts[run[0]:run[-1] + 1] = [self._bytes_text(data), *[""] * (len(run) - 1)]
        if model.dummy_prefix or model.squeeze:
            for i, number in enumerate(numbers):
                if model.kinds[number] == NORMAL and model.pieces[number].startswith(SPACE):
                    parts[i] = parts[i][1:]
                    if not model.squeeze:
                        break
                if parts[i]:
                    break
        return "".join(parts)


def codec(path: str) -> Codec:
    """One codec per worker process."""
    def make() -> Codec:
        with open(path, "rb") as file:
            return Codec(read_model(file.read()))
    return worker_cache(("sentence pieces", path), make)


def _joined(own: Codec, text: str) -> list[np.ndarray]:
    found = list(own.encode(text))
    return [np.concatenate(x) for x in zip(*found)] if found else [np.empty(0, np.int32), *[np.empty(0, np.int64)] * 2]


def encode_table(df: DataFrame, *, key: str, text: str, model: str) -> DataFrame:
    """``key, ids, begins, ends`` for every row: pieces and the UTF-8 byte spans of the text that they stand for."""
    def make():
        own = codec(model)

        def work(texts: list[str]) -> dict[str, list]:
            ids, begins, ends = zip(*(_joined(own, t) for t in texts))
            return {"ids": ids, "begins": begins, "ends": ends}
        return work
    return map_texts(df, key, text, make, [("ids", "array<int>", pa.list_(pa.int32())), ("begins", "array<long>", pa.list_(pa.int64())),
                                           ("ends", "array<long>", pa.list_(pa.int64()))], keeps=True)


def decode_table(df: DataFrame, *, key: str, ids: str, model: str) -> DataFrame:
    """``key, text`` for every row of ids; null ids give null."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in batches:
            out = [own.decode(np.array(x.as_py(), np.int32)) if x.is_valid else None for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["key", "text"])
    return df.select(F.col(key).alias("key"), F.col(ids).alias("ids")).mapInArrow(releasing(run), f"key {kind}, text string")


def round_trip(df: DataFrame, *, key: str, text: str, model: str) -> DataFrame:
    """``key, n_tokens, ids_sha256, decoded_sha256, same, covered``: encode, decode the ids, digest both.

    ``same``: the decoded text is the source; ``covered``: the spans follow each other without a gap.
    """
    def make():
        own = codec(model)

        def work(texts: list[str]) -> dict[str, list]:
            gc.freeze()  # pieces and memo are kept long: the collector needn't look at them again
            out: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "same": [], "covered": []}
            for t in texts:
                ids, begins, ends = _joined(own, t)
                decoded = own.decode(ids)
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(hashlib.sha256(",".join(map(own.names.__getitem__, ids.tolist())).encode()).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(decoded.encode()).hexdigest())
                out["same"].append(decoded == t)
                out["covered"].append(bool((begins[1:] == ends[:-1]).all()) and [0, *ends[-1:]][-1] == len(t.encode()))
            return out
        return work
    return map_texts(df, key, text, make, [("n_tokens", "long", pa.int64()), ("ids_sha256", "string", pa.string()),
                                           ("decoded_sha256", "string", pa.string()), ("same", "boolean", pa.bool_()),
                                           ("covered", "boolean", pa.bool_())], keeps=True)
