"""Toxicity by a factorization machine over hashed terms.

score = sigmoid(bias + sum of term weights + sum over pairs of terms of <v_i, v_j>): the pair part
learns that an insult next to a group mention weighs more than both alone, which linear weights
cannot express. Terms are a text's distinct words (ASCII lower-cased, anything but letters parts
words) and their prefixes, hashed to ``buckets``; whole texts count, wherever the terms stand.

Fitting uses at most ``sample`` labelled rows, chosen by a hash of the key (a documented bound;
with fewer labels, all). Chi-square keeps at most ``kept`` buckets, so the model, which
travels to every task, has at most kept * (factors + 1) numbers at any corpus size. Everything
else covers all rows.

Null and empty texts get the score of no terms at all. Null keys or labels are no training rows; a
key labelled twice counts once, as toxic if any label says so. With no labels, or only one kind,
the score is the smoothed base rate. An empty table gives no rows. Repeated rows repeat.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written
from tessera.llm.texts import Memo, forget, map_texts, releasing, slices, small_batches

#: Labelled rows that a fit takes at most.
SAMPLE = 20_000
#: Words whose terms a worker remembers.
MEMO_ROOM = 100_000


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 20
    prefixes: tuple[int, ...] = (4, 5, 6)
    kept: int = 4096
    least_rows: int = 4
    factors: int = 4
    epochs: int = 30
    batch: int = 256
    rate: float = 0.5
    l2: float = 1e-4
    seed: int = 7


@dataclass
class Model:
    bias: float
    buckets: int
    prefixes: tuple[int, ...]
    terms: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # sorted buckets
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    factors: np.ndarray = field(default_factory=lambda: np.zeros((0, 1)))


# ASCII letters to lower case, other ASCII bytes to spaces, the rest of UTF-8 kept
_LETTERS = bytes(b if b >= 0x80 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def word_set(text: str) -> set[bytes]:
    return set(text.encode().translate(_LETTERS).split())


def terms_of(word: bytes, buckets: int, prefixes: tuple[int, ...]) -> tuple[int, ...]:
    """Buckets of a word and of its prefixes (by characters; a prefix is not the word itself)."""
    text = word.decode("utf-8", "replace")
    named = [b"w" + word, *(b"p%d" % n + text[:n].encode() for n in prefixes if len(text) >= n)]
    return tuple(zlib.crc32(x) % buckets for x in named)


def training_rows(docs: DataFrame, labels: DataFrame, *, key: str, text: str, label: str, learn: Column,
                  settings: Settings, sample: int = SAMPLE) -> DataFrame:
    """Written table ``label, terms`` of the bounded sample of labelled rows where ``learn`` holds."""
    picked = (labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"))
              .where(F.col("key").isNotNull() & F.col("label").isNotNull()).groupBy("key").agg(F.max("label").alias("label"))
              .withColumnRenamed("key", key).where(learn).withColumnRenamed(key, "key"))
    picked = written(picked, "labels")
    n = picked.count()
    if n > sample:
        # a hash threshold a little below the share leaves few rows for the exact bound to sort
        picked = picked.where(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < int((1 << 30) * 0.95 * sample / n))
        picked = picked.orderBy(F.xxhash64("key"), "key").limit(sample)
    # at most ``sample`` rows of a key and a flag: small enough to broadcast
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(picked), "key")
    buckets, prefixes = settings.buckets, settings.prefixes

    def make():
        memo = Memo(lambda w: terms_of(w, buckets, prefixes), MEMO_ROOM)
        return lambda texts: {"terms": [sorted(set().union(*map(memo.__getitem__, word_set(t)))) for t in texts]}
    return written(map_texts(rows, "label", "text", make, [("terms", "array<int>", pa.list_(pa.int32()))])
                   .withColumnRenamed("key", "label"), "toxicity-terms")


def kept_terms(rows: DataFrame, settings: Settings) -> list[int]:
    """The buckets with the largest chi-square between presence and label."""
    n, pos = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not n or not 0 < pos < n:
        return []
    seen = rows.select("label", F.explode("terms").alias("term")).groupBy("term").agg(
        F.count("*").cast("double").alias("c"), F.sum("label").cast("double").alias("a"))
    c, a = F.col("c"), F.col("a")
    off = a * F.lit(float(n)) - c * F.lit(float(pos))
    chi = F.lit(float(n)) * off * off / (c * (F.lit(float(n)) - c) * F.lit(float(pos)) * F.lit(float(n - pos)))
    found = (seen.where((c >= settings.least_rows) & (c < n)).withColumn("chi", chi).where("chi > 6.635")
             .orderBy(F.desc("chi"), "term").limit(settings.kept).select("term").collect())
    return sorted(r.term for r in found)


def fit_arrays(labels: np.ndarray, lengths: np.ndarray, terms: np.ndarray, size: int, settings: Settings) -> tuple:
    """(bias, weights, factors) by mini-batch AdaGrad on the logistic loss; rows are runs of ``terms``."""
    rng = np.random.default_rng(settings.seed)
    w, v = np.zeros(size), rng.normal(0, 0.02, (size, settings.factors))
    rate0 = np.clip(labels.mean(), 1e-4, 1 - 1e-4)
    bias, g_b, g_w, g_v = float(np.log(rate0 / (1 - rate0))), 1.0, np.full(size, 1e-2), np.full(v.shape, 1e-2)
    starts = np.cumsum(lengths) - lengths
    for _ in range(settings.epochs):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), settings.batch):
            rows = order[at:at + settings.batch]
            n = lengths[rows]
            owner = np.repeat(np.arange(len(rows)), n)
            idx = terms[np.repeat(starts[rows] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            own = v[idx]
            total = np.zeros((len(rows), v.shape[1]))
            np.add.at(total, owner, own)
            squares = np.bincount(owner, (own * own).sum(1), len(rows))
            z = bias + np.bincount(owner, w[idx], len(rows)) + 0.5 * ((total * total).sum(1) - squares)
            err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[rows]) / len(rows) * 32
            used, at_used = np.unique(idx, return_inverse=True)
            d_w = np.bincount(at_used, err[owner], len(used)) + settings.l2 * w[used]
            d_v = np.zeros((len(used), v.shape[1]))
            np.add.at(d_v, at_used, err[owner, None] * (total[owner] - own))
            d_v += settings.l2 * v[used]
            g_b += err.sum() ** 2
            bias -= settings.rate * err.sum() / np.sqrt(g_b)
            g_w[used] += d_w ** 2
            w[used] -= settings.rate * d_w / np.sqrt(g_w[used])
            g_v[used] += d_v ** 2
            v[used] -= settings.rate * 0.3 * d_v / np.sqrt(g_v[used])
    return float(bias), w, v


def fit(rows: DataFrame, settings: Settings) -> Model:
    """Fit on a written table of ``training_rows``, in one task: the sample is bounded."""
    n, pos = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    share = (pos + 0.5) / (n + 5.0)
    kept = np.array(kept_terms(rows, settings), np.int64)
    if not len(kept):
        return Model(float(np.log(share / (1 - share))), settings.buckets, settings.prefixes)

    def train(table: pa.Table) -> pa.Table:
        # kept terms only, in an order that doesn't depend on the tasks
        held = sorted(zip(table["label"].to_pylist(), table["terms"].to_pylist()))
        lengths = np.array([len(t) for _, t in held], np.int64)
        flat = np.searchsorted(kept, np.array([x for _, t in held for x in t], np.int64))
        bias, w, v = fit_arrays(np.array([y for y, _ in held], float), lengths, flat, len(kept), settings)
        return pa.table({"bias": [bias], "w": [w.tolist()], "v": [v.ravel().tolist()]})

    few = map_kept(rows, kept)
    got = few.groupBy("one").applyInArrow(train, "bias double, w array<double>, v array<double>").first()
    return Model(got.bias, settings.buckets, settings.prefixes, kept, np.array(got.w),
                 np.array(got.v).reshape(len(kept), settings.factors))


def map_kept(rows: DataFrame, kept: np.ndarray) -> DataFrame:
    """Rows with only the kept terms, under one key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            terms = [np.intersect1d(np.array(x.as_py(), np.int64), kept) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([pa.array([1] * b.num_rows, pa.int32()), b.column(0),
                                              pa.array(terms, pa.list_(pa.int64()))], ["one", "label", "terms"])
    return rows.select("label", "terms").mapInArrow(run, "one int, label int, terms array<long>")


def scorer(model: Model):
    """A function of texts giving their scores."""
    at = {int(t): i for i, t in enumerate(model.terms)}
    memo = Memo(lambda w: tuple(at[t] for t in terms_of(w, model.buckets, model.prefixes) if t in at), MEMO_ROOM)

    def score(texts: list[str]) -> list[float]:
        out = []
        for t in texts:
            hits = set(map(memo.__getitem__, word_set(t)))
            z = model.bias
            rows = list(set().union(*hits))
            if rows:
                rows.sort()
                own = model.factors[rows]
                total = own.sum(0)
                z += float(model.weights[rows].sum() + 0.5 * (total @ total - (own * own).sum()))
            out.append(1 / (1 + float(np.exp(-max(-30.0, min(30.0, z))))))
        return out
    return score


def score_table(docs: DataFrame, model: Model, *, key: str, text: str) -> DataFrame:
    """``key, score`` for every row."""
    def make():
        score = scorer(model)
        return lambda texts: {"score": score(texts)}
    return map_texts(docs, key, text, make, [("score", "double", pa.float64())])


def keep_below(docs: DataFrame, model: Model, *, text: str, limit: float) -> DataFrame:
    """``docs`` with all its columns, without the rows that score ``limit`` or more.

    Batches pass through as they came; only a slice of their texts at a time becomes Python strings.
    """
    small_batches(docs.sparkSession)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        score = scorer(model)
        for batch in batches:
            kept = [s < limit for _, texts in slices(batch, at) for s in score(texts)]
            yield batch.filter(pa.array(kept, pa.bool_()))
    return docs.mapInArrow(releasing(run), docs.schema)


def fit_labels(docs: DataFrame, labels: DataFrame, *, key: str, text: str, label: str, learn: Column,
               settings: Settings = Settings(), sample: int = SAMPLE) -> Model:
    return fit(training_rows(docs, labels, key=key, text=text, label=label, learn=learn, settings=settings,
                             sample=sample), settings)
