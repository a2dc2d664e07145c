"""Interpolated modified Kneser-Ney language model (order 2 or 3), counted and applied in Spark.

The model is never in one place. Documents are packed once into blocks of tokens (a written
table). A block's distinct bigrams go, as packed arrays, to the shards of a hash of the context.
A shard adds the counts of all blocks into sorted hash arrays, stores them in a file that its
worker maps into memory, answers every block from it (counts of the block's bigrams, totals of its
contexts), and passes on in how many contexts each word was seen. A second round by word does the
same for these continuation counts. Finally each block meets its answers and scores its documents:

    p(w | v) = max(c(vw) - D(c(vw)), 0) / c(v.) + (D1 N1(v.) + D2 N2(v.) + D3 N3+(v.)) / c(v.) * p(w)
    p(w)     = max(a(w) - E(a(w)), 0) / sum of a + (E1 N1 + E2 N2 + E3 N3+) / sum of a / (V + 1)

with a(w) the number of distinct contexts of w, and discounts D and E from the counts of counts of
either level (Chen and Goodman, 1998). V + 1 leaves one share for unknown words, so the
probabilities of all words and the unknown one add up to 1 after any context.

With order 3 a round by pair of words comes first. Its shards count trigrams and answer for them, and
pass on after how many words each bigram was seen; these continuation counts take the place of the
bigrams' own in the rounds above, and p(w | uv) has the same form with p(w | v) inside. Pairs of words
are not dealt over several shards.

A context seen more than ``HOT_TOKENS`` times is dealt over several shards by a hash of context and
follower, so equal bigrams still meet. Each of these shards knows a part of the context's totals;
the second round adds the parts in the context's home shard and tells them to the blocks. The list
of such contexts has at most one row per ``HOT_TOKENS`` tokens and goes to every task.

A shard's file lies in the worker's own temporary folder and is deleted with the task; what other
tasks need is in shared storage. With a ``model_path`` every shard's sorted arrays are stored there,
and ``score_with`` scores other documents from them: a task maps the one shard that it answers for. Work, memory and traffic per task are bounded by the sizes of a
block and of a shard; their numbers follow the input.

Words are fingerprints of 64 bits (contexts) and 48 bits (followers), so two different words are
taken for one with a negligible chance. Null and empty texts are the end token alone. Rows with a
null id learn. Repeated rows count and are scored each. Without rows to learn from, every score is
0. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import mmap
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import blocks_of, written
from tessera.llm.texts import releasing, releasing_group, slices, small_batches
from tessera.llm.wordhash import WordHasher, mixed

#: Tokens of a block, and text bytes per shard.
BLOCK_TOKENS, SHARD_BYTES = 1_500_000, 8 << 20
#: Times a context is seen for each shard that it is dealt to.
HOT_TOKENS = 1_000_000
#: Fingerprints of the document's end and of the context before its first word.
END, BEGIN = np.uint64(0xE0D0E0D0E0D0E0D1), np.uint64(0xB0E0B0E0B0E0B0E3)

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_ROW = "kind string, shard int, block long, data binary"


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed byte string; integers are split into byte planes, which compress better."""
    out = []
    for a in arrays:
        planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T if len(a) else a.view(np.uint8)
        data = zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())
        out += [np.array([len(a), len(data)], np.int64).tobytes(), a.dtype.str.encode().ljust(8), data]
    return b"".join(out)


def unpacked(data: bytes | memoryview) -> list[np.ndarray]:
    data, at, out = memoryview(data), 0, []
    while at < len(data):
        n, size = np.frombuffer(data[at:at + 16], np.int64).tolist()
        kind = np.dtype(bytes(data[at + 16:at + 24]).decode().strip())
        raw = zstandard.ZstdDecompressor().decompress(data[at + 24:at + 24 + size], max_output_size=max(1, n * kind.itemsize))
        out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(kind.itemsize, n).T).view(kind).ravel())
        at += 24 + size
    return out


def follower(words: np.ndarray) -> np.ndarray:
    """48-bit fingerprints as uint64."""
    return mixed(words) >> np.uint64(16)


def six_bytes(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """48-bit integers as a 4-byte and a 2-byte array."""
    return keys.astype(np.uint32), (keys >> np.uint64(32)).astype(np.uint16)


def joined(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return low.astype(np.uint64) | high.astype(np.uint64) << np.uint64(32)


def pair_keys(contexts: np.ndarray, followers: np.ndarray) -> np.ndarray:
    return mixed(contexts + _GOLDEN) + followers * _GOLDEN


def pair_names(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Fingerprints of contexts of two words."""
    return mixed(mixed(one + _GOLDEN) ^ (two * _GOLDEN))


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys, and each key's place among them: ``np.unique`` with fewer arrays at once."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.append(True, ordered[1:] != ordered[:-1])[:len(keys)]
    ordered = ordered[new]
    place = np.cumsum(new)
    place -= 1
    back = np.empty(len(keys), np.int64)
    back[order] = place
    return ordered, back


def counts_array(n: np.ndarray) -> np.ndarray:
    """Counts within a block or a shard's types. Counts over all blocks stay 64-bit integers."""
    return n.astype(np.uint32)


def token_blocks(docs: DataFrame, *, doc_id: str, text: str, learn: Column, shards: int) -> DataFrame:
    """Written table of blocks: ids, lengths and learning flags of documents, vocabulary, token sequence."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"),
                       F.coalesce(learn, F.lit(True)).alias("learn"))
    schema = "block long, doc_ids array<long>, lengths array<int>, learns array<boolean>, vocabulary binary, tokens binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, task = WordHasher(), TaskContext.get().partitionId()
        ids, learns, lengths, parts, size, made = [], [], [], [], 0, 0

        def block() -> pa.RecordBatch:
            words, seq = distinct(np.concatenate(parts))
            columns = [pa.array([task << 32 | made]), pa.array([ids], pa.list_(pa.int64())),
                       pa.array([lengths], pa.list_(pa.int32())), pa.array([learns], pa.list_(pa.bool_())),
                       pa.array([packed(words)], pa.binary()), pa.array([packed(seq.astype(np.uint32))], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["block", "doc_ids", "lengths", "learns", "vocabulary", "tokens"])

        for batch in batches:
            all_ids, all_learns = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for start, texts in slices(batch, 1):
                data = [t.encode() for t in texts]
                words, starts, _ = hasher(b" ".join(data))
                ends = np.searchsorted(starts, np.cumsum([len(d) + 1 for d in data]))
                parts.append(np.insert(words, ends, END))
                lengths += (np.diff(ends, prepend=0) + 1).tolist()
                ids += all_ids[start:start + len(texts)]
                learns += all_learns[start:start + len(texts)]
                size += len(parts[-1])
                if size >= BLOCK_TOKENS:
                    yield block()
                    ids, learns, lengths, parts, size, made = [], [], [], [], 0, made + 1
        if parts:
            yield block()
    return written(rows.mapInArrow(releasing(run), schema), "lm-blocks")


class Hot:
    """Contexts that are dealt to several shards: sorted fingerprints, and their numbers of shards."""

    def __init__(self, contexts: np.ndarray, splits: np.ndarray):
        order = np.argsort(contexts)
        self.contexts, self.splits = contexts[order], splits[order]

    def __call__(self, names: np.ndarray) -> np.ndarray:
        """Numbers of shards, 1 for other contexts."""
        if not len(self.contexts):
            return np.ones(len(names), np.int64)
        at = np.minimum(np.searchsorted(self.contexts, names), len(self.contexts) - 1)
        return np.where(self.contexts[at] == names, self.splits[at], 1)


def hot_contexts(blocks: DataFrame) -> Hot:
    """Contexts seen more than ``HOT_TOKENS`` times.

    A block names a context only from an even share of that on, so what is not named of a context
    stays below ``HOT_TOKENS`` in all.
    """
    least, limit = max(1, HOT_TOKENS // max(1, blocks.count())), HOT_TOKENS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n_docs, vocabulary, tokens in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                words = unpacked(vocabulary.as_buffer())[0]
                n = np.bincount(unpacked(tokens.as_buffer())[0], minlength=len(words))
                n[words == END] = 0
                names, n = np.append(words, BEGIN), np.append(n, n_docs)
                yield pa.RecordBatch.from_arrays([pa.array(x[n >= least].astype(np.int64)) for x in (names.view(np.int64), n)],
                                                 ["context", "n"])
    found = (blocks.select(F.size("doc_ids"), "vocabulary", "tokens").mapInArrow(releasing(run), "context long, n long")
             .groupBy("context").agg(F.sum("n").alias("n")).where(F.col("n") > limit).toArrow())
    return Hot(found["context"].to_numpy().view(np.uint64), -(-found["n"].to_numpy() // limit))


def shards_of(contexts: np.ndarray, followers: np.ndarray, shards: int, hot: Hot) -> np.ndarray:
    """The shard of each bigram: its context's home, or one of those that the context is dealt to."""
    out = (follower(contexts) % np.uint64(shards)).astype(np.int64)
    splits = hot(contexts)
    dealt = np.flatnonzero(splits > 1)
    if len(dealt):
        pairs = mixed(pair_keys(contexts[dealt], followers[dealt]) ^ _GOLDEN)
        out[dealt] = (out[dealt] + (pairs % splits[dealt].astype(np.uint64)).astype(np.int64)) % shards
    return out


def in_parts(order: np.ndarray, shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, positions) of every shard that occurs; ``order`` sorts by shard."""
    own = shard[order]
    cuts = np.flatnonzero(np.diff(own, prepend=-1))
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(own)]):
        yield int(own[a]), order[a:b]


class Trigrams:
    """A block's distinct trigrams: contexts of two words, and the word that follows."""

    def __init__(self, block: Block, seq: np.ndarray, lengths: np.ndarray, shards: int):
        n = np.uint64(len(block.names))  # the last name is the begin
        one = np.empty(len(seq), np.uint64)
        one[2:] = seq[:-2]
        starts = np.cumsum(lengths) - lengths
        one[starts] = n - np.uint64(1)
        more = starts[lengths > 1]
        one[more + 1] = n - np.uint64(1)
        contexts, at = distinct(one * n + block.context[block.back].astype(np.uint64))
        first, second = np.divmod(contexts, n)
        self.lower = second.astype(np.int64)
        self.names = pair_names(block.names[first.astype(np.int64)], block.names[self.lower])
        keys, self.back = distinct(at.astype(np.uint64) * n + seq)
        context, word = np.divmod(keys, n)
        self.context, self.word = context.astype(np.int64), word.astype(np.int64)
        self.shard = (follower(self.names) % np.uint64(shards)).astype(np.int64)[self.context]
        self.by_shard = np.argsort(self.shard, kind="stable")


class Block:
    """A block's distinct bigrams, in the order in which shards are asked."""

    def __init__(self, words: np.ndarray, seq: np.ndarray, lengths: np.ndarray, shards: int, hot: Hot):
        n = len(words)  # context n is the begin
        starts = np.cumsum(lengths) - lengths
        before = np.empty(len(seq), np.uint64)
        before[1:] = seq[:-1]
        before[starts] = n
        before *= np.uint64(n + 1)
        before += seq
        keys, self.back = distinct(before)
        del before
        context, word = np.divmod(keys, np.uint64(n + 1))
        self.context, self.word = context.view(np.int64), word.view(np.int64)
        self.names = np.append(words, BEGIN)
        keys = follower(self.names)
        self.home = (keys % np.uint64(shards)).astype(np.int32)  # of contexts, and words
        self.by_home = np.argsort(self.home, kind="stable")
        self.shard = self.home[self.context]  # of bigrams
        dealt = np.flatnonzero((hot(self.names) > 1)[self.context])
        if len(dealt):
            self.shard[dealt] = shards_of(self.names[self.context[dealt]], keys[self.word[dealt]], shards, hot)
        self.by_shard = np.argsort(self.shard, kind="stable")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kind, shard, block, data = zip(*rows) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays([pa.array(kind, pa.string()), pa.array(shard, pa.int32()), pa.array(block, pa.int64()),
                                       pa.array(data, pa.binary())], ["kind", "shard", "block", "data"])


def _ask(shards: int, hot: Hot, order: int, level: int):
    """Blocks -> what they ask of the context shards of bigrams or trigrams (``level``).

    Contexts, their numbers of n-grams, followers, learned counts; for trigrams also the contexts' second
    words. Below the order the counts come from the level above, and a block asks without any.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.array(row["lengths"], np.int64)
                seq = unpacked(row["tokens"])[0]
                block = Block(unpacked(row["vocabulary"])[0], seq, lengths, shards, hot)
                own = block if level == 2 else Trigrams(block, seq, lengths, shards)
                learned = np.zeros(len(own.context), np.int64)
                if level == order:
                    learned = np.bincount(own.back[np.repeat(np.array(row["learns"], bool), lengths)], minlength=len(learned))
                names = follower(block.names)
                rows = []
                for shard, at in in_parts(own.by_shard, own.shard):
                    contexts, sizes = np.unique(own.context[at], return_counts=True)
                    lower = [block.names[own.lower[contexts]]] if level == 3 else []
                    rows.append(("ask", shard, row["block"], packed(
                        own.names[contexts], counts_array(sizes), *six_bytes(names[own.word[at]]), counts_array(learned[at]), *lower)))
                    if len(rows) >= 64:
                        yield _batch(rows)
                        rows = []
                yield _batch(rows)
    return run


class Mapped:
    """Sorted hashes with counts in a file of the worker's own, mapped into memory while in use."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray):
        self.n, self.file = len(hashes), tempfile.TemporaryFile()
        self.file.write(hashes.tobytes())
        self.file.write(counts.astype(np.int64).tobytes())
        self.file.flush()
        if self.n:
            self.map = mmap.mmap(self.file.fileno(), 0, access=mmap.ACCESS_READ)
            self.hashes, self.counts = np.frombuffer(self.map, np.uint64, self.n), np.frombuffer(self.map, np.int64, self.n, self.n * 8)

    def __call__(self, wanted: np.ndarray) -> np.ndarray:
        """Counts of the wanted hashes, 0 where unknown."""
        if not self.n:
            return np.zeros(len(wanted), np.int64)
        at = np.minimum(np.searchsorted(self.hashes, wanted), self.n - 1)
        return np.where(self.hashes[at] == wanted, self.counts[at], 0)


def _counts_of_counts(n: np.ndarray) -> np.ndarray:
    """Types seen 1, 2, 3 and 4 times, all types, and the sum."""
    return np.array([*((n == k).sum() for k in (1, 2, 3, 4)), (n > 0).sum(), n.sum()], np.int64)


def _about(names: np.ndarray, about: list[np.ndarray], contexts: np.ndarray) -> list[np.ndarray]:
    """What a shard knows of contexts, 0 for unknown ones."""
    if not len(names):
        return [np.zeros(len(contexts), np.int64)] * len(about)
    at = np.minimum(np.searchsorted(names, contexts), len(names) - 1)
    return [np.where(names[at] == contexts, x[at], 0) for x in about]


def _stored_shard(kind: str):
    """A stored context shard and all asks of it -> answers, from its arrays mapped into memory."""
    def run(table: pa.Table) -> pa.Table:
        shard, kinds = table["shard"][0].as_py(), table["kind"].to_pylist()
        if "model" in kinds:
            hashes, total, names, *about = unpacked(table["data"][kinds.index("model")].as_buffer())
        else:  # no learned n-gram has fallen to this shard
            hashes, total, names, *about = (np.zeros(0, t) for t in (np.uint64, np.int64, np.uint64, *[np.int64] * 4))
        model = Mapped(hashes, total)
        del hashes, total
        rows = []
        for what, block, data in zip(kinds, table["block"].to_pylist(), table["data"]):
            if what == "ask":
                contexts, sizes, low, high, *_ = unpacked(data.as_buffer())
                asked = pair_keys(np.repeat(contexts, sizes), joined(low, high))
                rows.append((kind, shard, block, packed(model(mixed(asked)), *_about(names, about, contexts))))
        return pa.Table.from_batches([_batch(rows)])
    return run


class Counted:
    """All messages to a context shard, added up, and its answers to the blocks; its arrays too, if they are to be kept."""

    def __init__(self, table: pa.Table, kind: str, keep: bool = False):
        shard, self.rows = table["shard"][0].as_py(), []
        # of each message: contexts, their numbers of n-grams, followers in two parts, learned counts, contexts' second words
        self.asks = [unpacked(data.as_buffer()) for data in table["data"]]
        self.seen = [a[4] > 0 for a in self.asks]
        keys = np.concatenate([self.hashes(a)[seen] for a, seen in zip(self.asks, self.seen)])
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[:len(keys)])
        hashes, self.first = keys[new], order[new]
        del keys
        counts = np.concatenate([a[4][seen] for a, seen in zip(self.asks, self.seen)])[order]
        del order
        total = np.add.reduceat(counts, new, dtype=np.int64) if len(new) else np.zeros(0, np.int64)
        del counts, new
        model = Mapped(hashes, total)
        # contexts of the learned n-grams: totals, and how many followers once, twice, more often
        names, context = distinct(self.learned(lambda a: np.repeat(a[0], a[1])))
        about = [np.bincount(context, w, len(names)).astype(np.int64) for w in (total, total == 1, total == 2, total >= 3)]
        self.names, self.about = names, about
        self.rows.append(("sum", 0, 0, packed(_counts_of_counts(total))))
        if keep:
            self.rows.append(("model", shard, 0, packed(hashes, total, names, *about)))
        del hashes, total, context
        for what, block, a in zip(table["kind"].to_pylist(), table["block"].to_pylist(), self.asks):
            if what == "part":
                continue
            self.rows.append((kind, shard, block, packed(model(self.hashes(a)), *_about(names, about, a[0]))))

    @staticmethod
    def hashes(ask: list[np.ndarray]) -> np.ndarray:
        contexts, sizes, low, high, *_ = ask
        return mixed(pair_keys(np.repeat(contexts, sizes), joined(low, high)))

    def learned(self, get: Callable[[list[np.ndarray]], np.ndarray]) -> np.ndarray:
        """One entry per distinct learned n-gram; ``get`` gives one per n-gram of a message."""
        return np.concatenate([get(a)[seen] for a, seen in zip(self.asks, self.seen)])[self.first]


def _trigram_shard(shards: int, hot: Hot, keep: bool = False):
    """All asks of a shard of word pairs -> answers to blocks, continuation counts of bigrams by their context, counts of counts."""
    def run(table: pa.Table) -> pa.Table:
        own = Counted(table, "trigrams", keep)
        second = own.learned(lambda a: np.repeat(a[5], a[1]))
        last = own.learned(lambda a: joined(a[2], a[3]))
        order = np.lexsort((last, second))
        second, last = second[order], last[order]
        new = np.flatnonzero(np.append(True, (second[1:] != second[:-1]) | (last[1:] != last[:-1]))[:len(second)])
        n = np.diff(np.append(new, len(second)))
        second, last = second[new], last[new]
        shard = shards_of(second, last, shards, hot)
        for to, at in in_parts(np.argsort(shard, kind="stable"), shard):
            contexts, sizes = np.unique(second[at], return_counts=True)
            own.rows.append(("part", to, 0, packed(contexts, counts_array(sizes), *six_bytes(last[at]), counts_array(n[at]))))
        return pa.Table.from_batches([_batch(own.rows)])
    return run


def _bigram_shard(shards: int, hot: Hot, keep: bool = False):
    """All messages to a context shard -> answers to blocks, parts of dealt contexts' totals, continuation counts by word, counts of counts."""
    def run(table: pa.Table) -> pa.Table:
        own = Counted(table, "bigrams", keep)
        words, contexts_of = np.unique(own.learned(lambda a: joined(a[2], a[3])), return_counts=True)
        for i in np.flatnonzero(hot(own.names) > 1).tolist():
            key = follower(own.names[i:i + 1])
            own.rows.append(("total", int(key[0] % np.uint64(shards)), 0, packed(key, *(x[i:i + 1] for x in own.about))))
        home = (words % np.uint64(shards)).astype(np.int64)
        for to, at in in_parts(np.argsort(home, kind="stable"), home):
            own.rows.append(("part", to, 0, packed(*six_bytes(words[at]), counts_array(contexts_of[at]))))
        return pa.Table.from_batches([_batch(own.rows)])
    return run


def _ask_words(shards: int, counted: bool):
    """Blocks -> the words, and the begin, that they ask of word shards; ``counted``: with how often they occur in learned rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys = follower(np.append(unpacked(row["vocabulary"])[0], BEGIN))
                shard = (keys % np.uint64(shards)).astype(np.int64)
                n = []
                if counted:
                    learns = np.repeat(np.array(row["learns"], float), row["lengths"])
                    n = [counts_array(np.bincount(unpacked(row["tokens"])[0], learns, len(keys)).astype(np.int64))]
                yield _batch([("ask", to, row["block"], packed(*six_bytes(keys[at]), *(x[at] for x in n)))
                              for to, at in in_parts(np.argsort(shard, kind="stable"), shard)])
    return run


def _word_shard(keep: bool = False):
    """Continuation counts, parts of dealt contexts' totals and asks of a word shard -> answers to blocks, counts of counts.

    A stored shard comes as one ``model`` message in place of the counts.
    """
    def run(table: pa.Table) -> pa.Table:
        shard, parts, asks, dealt, held = table["shard"][0].as_py(), [], [], {}, None
        for kind, block, data in zip(table["kind"].to_pylist(), table["block"].to_pylist(), table["data"]):
            arrays = unpacked(data.as_buffer())
            if kind == "part":
                parts.append((joined(*arrays[:2]), arrays[2]))
            elif kind == "total":
                context, *about = (int(x[0]) for x in arrays)
                dealt[context] = np.array(about, np.int64) + dealt.get(context, 0)
            elif kind == "model":
                held = arrays
            else:
                asks.append((block, joined(*arrays[:2]), arrays[2:]))
        raw_keys, raw_back = np.unique(np.concatenate([a[1] for a in asks if a[2]] or [np.zeros(0, np.uint64)]), return_inverse=True)
        raw = np.bincount(raw_back, np.concatenate([a[2][0] for a in asks if a[2]] or [np.zeros(0)]), len(raw_keys)).astype(np.int64)
        if held is None:
            keys = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.uint64)
            hashes, back = np.unique(keys, return_inverse=True)
            total = np.bincount(back, np.concatenate([p[1] for p in parts]), len(hashes)).astype(np.int64) if parts else np.zeros(0, np.int64)
            contexts = np.array(sorted(dealt), np.uint64)
            abouts = np.array([dealt[k] for k in contexts.tolist()], np.int64).reshape(-1, 4).T
        else:
            hashes, total, raw_keys, raw, contexts, *abouts = held
        model = Mapped(hashes, total)
        rows = [("sum", 0, 0, packed(_counts_of_counts(total)))]
        if keep:
            rows.append(("model", shard, 0, packed(hashes, total, raw_keys, raw, contexts, *abouts)))
        for block, keys, counted in asks:
            own = []
            if counted:
                own = [raw[np.searchsorted(raw_keys, keys)] if held is None else _about(raw_keys, [raw], keys)[0]]
            at = np.flatnonzero(np.isin(keys, contexts))
            if len(at):
                to = np.searchsorted(contexts, keys[at])
                own += [at, *(x[to] for x in abouts)]
            rows.append(("words", shard, block, packed(model(keys), *own)))
        return pa.Table.from_batches([_batch(rows)])
    return run


def discounts(counts: np.ndarray) -> np.ndarray:
    """D for counts 0, 1, 2 and 3 or more, from the counts of counts."""
    n = counts[:4].astype(float)
    if not n[0] or not n[1]:
        return np.array([0, 0.5, 0.5, 0.5])
    y = n[0] / (n[0] + 2 * n[1])
    d = [0.0]
    for k in (1, 2, 3):
        d.append(min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.0), k) if n[k - 1] else d[-1])
    return np.array(d)


def _interpolated(count: np.ndarray, context: np.ndarray, about: np.ndarray, d: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Probabilities from counts, what is known of their contexts (total, followers once, twice, more often), and the lower order."""
    total = about[0]
    some = np.maximum(total, 1)
    share = np.where(total > 0, (d[1] * about[1] + d[2] * about[2] + d[3] * about[3]) / some, 1.0)
    p = count - d[np.minimum(count, 3)]
    np.maximum(p, 0, out=p)
    p /= some[context]
    p[(total == 0)[context]] = 0.0
    p += share[context] * lower
    return p


def _scores(sums: list[np.ndarray], shards: int, hot: Hot):
    """A block and its answers -> its documents' scores; ``sums`` of the levels from the highest order down to words."""
    *levels, e = map(discounts, sums)
    d, order, word_sums = levels[-1], len(sums), sums[-1]
    n_tokens, types, known_words = int(sums[0][5]), int(word_sums[5]), int(word_sums[4])
    once, twice = int(word_sums[0]), int(word_sums[1])
    back_off = (e[1] * once + e[2] * twice + e[3] * (known_words - once - twice)) / types if types else 1.0

    def run(table: pa.Table) -> pa.Table:
        kinds, by = table["kind"].to_pylist(), {}
        for i, (kind, shard) in enumerate(zip(kinds, table["shard"].to_pylist())):
            by.setdefault(kind, {})[shard] = i
        row = table.slice(by["block"][0], 1).to_pylist()[0]
        lengths = np.array(row["lengths"], np.int64)
        words, seq = unpacked(row["vocabulary"])[0], unpacked(row["data"])[0]
        block = Block(words, seq, lengths, shards, hot)
        count = np.zeros(len(block.context), np.int64)
        about = np.zeros((4, len(block.names)), np.int64)
        for shard, at in in_parts(block.by_shard, block.shard):
            told = unpacked(table["data"][by["bigrams"][shard]].as_buffer())
            count[at] = told[0]
            about[:, np.unique(block.context[at])] = told[1:]
        seen, raw = np.zeros((2, len(block.names)), np.int64)
        for shard, at in in_parts(block.by_home, block.home):
            told = unpacked(table["data"][by["words"][shard]].as_buffer())
            seen[at] = told[0]
            if order > 2:
                raw[at] = told.pop(1)
            if len(told) > 1:  # whole totals of dealt contexts in place of the parts
                about[:, at[told[1]]] = told[2:]
        seen = seen[:-1]
        p_word = np.maximum(seen - e[np.minimum(seen, 3)], 0) / max(types, 1) + back_off / (known_words + 1)
        p = _interpolated(count, block.context, about, d, p_word[block.word])[block.back]
        if order > 2:
            three = Trigrams(block, seq, lengths, shards)
            count = np.zeros(len(three.context), np.int64)
            above = np.zeros((4, len(three.names)), np.int64)
            for shard, at in in_parts(three.by_shard, three.shard):
                told = unpacked(table["data"][by["trigrams"][shard]].as_buffer())
                count[at] = told[0]
                above[:, np.unique(three.context[at])] = told[1:]
            p = _interpolated(count[three.back], three.context[three.back], above, levels[0], p)
            own = raw[:-1]
        else:  # a word's own count: as a context, or for the end the number of documents that begin
            own = about[0][:-1].copy()
            own[words == END] = about[0][-1]
        base = np.log10((own + 0.1) / (n_tokens + 0.1 * (known_words + 1)))
        starts = np.cumsum(lengths) - lengths
        add = lambda x: np.add.reduceat(x, starts)
        return pa.table({
            "doc_id": pa.array(row["doc_ids"], pa.int64()), "learned": pa.array(row["learns"], pa.bool_()),
            "n_tokens": pa.array(lengths), "n_known": pa.array(add((own > 0)[seq].astype(np.int64))),
            "train_tokens": pa.array(np.full(len(lengths), n_tokens)), "base_score": pa.array(add(base[seq])),
            "score": pa.array(add(np.log10(p)))})
    return run


def _sums(answers: DataFrame) -> np.ndarray:
    """Counts of counts over all shards: six numbers a shard, added in tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(6, np.int64)
        for batch in batches:
            for data in batch.column(0):
                total += unpacked(data.as_buffer())[0]
        yield pa.RecordBatch.from_arrays([pa.array([int(x)]) for x in total], [f"s{i}" for i in range(6)])
    rows = answers.where("kind = 'sum'").select("data").mapInArrow(run, ", ".join(f"s{i} long" for i in range(6)))
    got = rows.agg(*[F.coalesce(F.sum(f"s{i}"), F.lit(0)).alias(f"s{i}") for i in range(6)]).first()
    return np.array(list(got), np.int64)


def _answered(blocks: DataFrame, levels: list[DataFrame], sums: list[np.ndarray], shards: int, hot: Hot) -> DataFrame:
    """Blocks meet their answers."""
    none = lambda kind: F.lit(None).cast(kind)
    own = blocks.select(F.lit("block").alias("kind"), F.lit(0).alias("shard"), "block", F.col("tokens").alias("data"), "doc_ids",
                        "lengths", "learns", "vocabulary")
    for level in levels:
        own = own.unionAll(level.where("kind IN ('trigrams', 'bigrams', 'words')").select(
            "kind", "shard", "block", "data", none("array<long>").alias("doc_ids"), none("array<int>").alias("lengths"),
            none("array<boolean>").alias("learns"), none("binary").alias("vocabulary")))
    return own.groupBy("block").applyInArrow(
        releasing_group(_scores(sums, shards, hot)),
        "doc_id long, learned boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


_LEVELS = {3: "trigrams", 2: "bigrams", 1: "words"}


def score_documents(docs: DataFrame, *, doc_id: str, text: str, learn: Column, order: int = 2, model_path: str | None = None) -> DataFrame:
    """``doc_id, learned, n_tokens, n_known, train_tokens, base_score, score`` of every document.

    ``score`` is the log10 probability of the text under the model of the rows where ``learn``
    holds; ``base_score`` that under their smoothed word frequencies. ``order`` is 2 or 3. With
    ``model_path`` the shards' sorted arrays are stored there for ``score_with``.
    """
    if order not in (2, 3):
        raise ValueError("the order is 2 or 3")
    size = docs.agg(F.sum(F.octet_length(text).cast("long") + F.lit(8))).first()[0] or 0
    shards, keep = blocks_of(size, SHARD_BYTES), model_path is not None
    blocks = token_blocks(docs, doc_id=doc_id, text=text, learn=learn, shards=shards)
    hot = hot_contexts(blocks)
    levels, asked = [], blocks.mapInArrow(releasing(_ask(shards, hot, order, 2)), _ROW)
    if order == 3:
        threes = blocks.mapInArrow(releasing(_ask(shards, hot, order, 3)), _ROW)
        levels.append(written(threes.groupBy("shard").applyInArrow(releasing_group(_trigram_shard(shards, hot, keep)), _ROW), "lm-trigrams"))
        asked = asked.unionAll(levels[0].where("kind = 'part'"))
    levels.append(written(asked.groupBy("shard").applyInArrow(releasing_group(_bigram_shard(shards, hot, keep)), _ROW), "lm-bigrams"))
    words = blocks.select("block", "vocabulary", "tokens", "lengths", "learns").mapInArrow(releasing(_ask_words(shards, order > 2)), _ROW)
    levels.append(written(words.unionAll(levels[-1].where("kind IN ('part', 'total')")).groupBy("shard").applyInArrow(releasing_group(_word_shard(keep)), _ROW), "lm-words"))
    sums = [_sums(level) for level in levels]
    if keep:
        for n, level in zip(range(order, 0, -1), levels):
            level.where("kind = 'model'").select("shard", "data").write.mode("overwrite").parquet(f"{model_path}/{_LEVELS[n]}")
        about = [(order, shards, [x.tolist() for x in sums], hot.contexts.view(np.int64).tolist(), hot.splits.tolist())]
        docs.sparkSession.createDataFrame(about, _ABOUT).coalesce(1).write.mode("overwrite").parquet(f"{model_path}/about")
    return _answered(blocks, levels, sums, shards, hot)


_ABOUT = "order int, shards int, sums array<array<long>>, hot array<long>, splits array<long>"


def score_with(docs: DataFrame, model_path: str, *, doc_id: str, text: str) -> DataFrame:
    """New documents under a stored model: the columns of ``score_documents``, none of the rows learned."""
    spark = docs.sparkSession
    about = spark.read.schema(_ABOUT).parquet(f"{model_path}/about").first()
    order, shards = about["order"], about["shards"]
    hot = Hot(np.array(about["hot"], np.int64).view(np.uint64), np.array(about["splits"], np.int64))
    blocks = token_blocks(docs, doc_id=doc_id, text=text, learn=F.lit(False), shards=shards)
    levels = []
    for n in range(order, 0, -1):
        held = spark.read.schema("shard int, data binary").parquet(f"{model_path}/{_LEVELS[n]}").select(
            F.lit("model").alias("kind"), "shard", F.lit(0).cast("long").alias("block"), "data")
        if n > 1:
            asks, answer = blocks.mapInArrow(releasing(_ask(shards, hot, 0, n)), _ROW), _stored_shard(_LEVELS[n])
        else:
            words = blocks.select("block", "vocabulary", "tokens", "lengths", "learns")
            asks, answer = words.mapInArrow(releasing(_ask_words(shards, order > 2)), _ROW), _word_shard()
        levels.append(written(asks.unionAll(held).groupBy("shard").applyInArrow(releasing_group(answer), _ROW), f"lm-{_LEVELS[n]}"))
    return _answered(blocks, levels, [np.array(x, np.int64) for x in about["sums"]], shards, hot)
