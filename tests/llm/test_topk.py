from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import hard_negatives, topk, vectors


def _ints(rows):
    return [(i, *rest, [math.floor(256 * x) for x in v]) for i, *rest, v in rows
            if i is not None and None not in rest and v is not None and all(x is not None and math.isfinite(x) for x in v)]


def _dot(a, b):
    return sum(x * y for x, y in zip(a, b))


def _want(rows, asks, k):
    out, ints = [], _ints(rows)
    for i, q in ints:
        if asks(i):
            scored = sorted((-_dot(q, v), j) for j, v in ints if j != i)[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored)]
    return sorted(out)


def _want_negatives(rows, asks, positives, negatives, low, high):
    out, ints = [], _ints(rows)
    for i, label, q in ints:
        if not asks(i):
            continue
        scored = sorted((-_dot(q, v), j, other) for j, other, v in ints if j != i)
        near = [(j, -s) for s, j, other in scored if other == label][:positives]
        for j, p in near:
            fit = [(jj, -s) for s, jj, other in scored if other != label and low * p <= -100 * s <= high * p][:negatives]
            out += [(i, j, n + 1, jj, p, s) for n, (jj, s) in enumerate(fit)]
    return sorted(out)


@pytest.fixture(params=[1024, 15])
def small_blocks(request, monkeypatch):
    monkeypatch.setattr(vectors, "LEAST_ROWS", request.param)
    monkeypatch.setattr(vectors, "BLOCK_VALUES", 8 * request.param)


ODD = [(300, None), (301, [1.0, None]), (302, [float("nan")]), (303, [float("inf")]), (None, [1.0]), (304, []), (305, [2.0, 1.0])]


def test_top_k_against_brute_force(spark, small_blocks):
    rng = random.Random(3)
    rows = [(i, [rng.choice([0.0, rng.uniform(-1, 1)]) for _ in range(8)]) for i in range(120)]
    rows += [(200 + i, rows[0][1]) for i in range(9)] + ODD  # ties
    rows += [(10, rows[20][1]), (10, rows[20][1]), (7, rows[30][1])]  # repeated ids, of a query and of a candidate
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, score string, rank int")
    asks = F.col("vec_id") % 10 == 0
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = topk.top_k(df, row_id="vec_id", vector="embedding", is_query=asks, k=5).collect()
    assert sorted(tuple(r) for r in got) == _want(rows, lambda i: i % 10 == 0, 5)
    few = topk.top_k(df.limit(3), row_id="vec_id", vector="embedding", is_query=asks, k=5).collect()
    assert len(few) == 2
    assert topk.top_k(df.limit(0), row_id="vec_id", vector="embedding", is_query=asks, k=5).count() == 0


def test_huge_components_take_part_or_raise(spark):
    args = dict(row_id="vec_id", vector="embedding", k=2)
    table = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    rows = [(1, [1e16, 1.0]), (2, [0.0, 3.0]), (3, [0.004, -1.0]), (4, [0.0, 2.0**40])]
    got = topk.top_k(table(rows), is_query=F.col("vec_id") < 4, **args).collect()
    assert sorted(tuple(r) for r in got) == _want(rows, lambda i: i < 4, 2)
    labelled = [(i, 0, v) for i, v in rows]
    got = hard_negatives.hard_negatives(table(rows), row_id="vec_id", vector="embedding", label=F.col("vec_id") % 2,
                                        is_anchor=F.col("vec_id") < 4).collect()
    assert sorted(tuple(r)[:6] for r in got) == _want_negatives([(i, i % 2, v) for i, _, v in labelled], lambda i: i < 4, 5, 10, 30, 90)
    with pytest.raises(Exception, match="63 bits"):  # the score
        topk.top_k(table([(1, [1e16]), (2, [1e3])]), is_query=F.col("vec_id") == 1, **args).collect()
    with pytest.raises(Exception, match="63 bits"):  # a score far below zero, if it is among the results
        topk.top_k(table([(1, [1e16]), (2, [-1e3])]), is_query=F.col("vec_id") == 1, **args).collect()
    with pytest.raises(Exception, match="63 bits"):  # the component
        topk.top_k(table([(1, [1e17]), (2, [1.0])]), is_query=F.col("vec_id") == 1, **args).collect()
    low = [(1, [1e16]), (2, [-1e3]), (3, [0.0]), (4, [0.004])]
    got = topk.top_k(table(low), is_query=F.col("vec_id") == 1, **args).collect()
    assert sorted(tuple(r) for r in got) == _want(low, lambda i: i == 1, 2)


@pytest.mark.parametrize("seed", [1, 2])
def test_hard_negatives_against_brute_force(spark, small_blocks, seed):
    rng = random.Random(seed)
    rows = [(i, rng.choice([0, 0, 1, 2]), [rng.choice([0.0, rng.uniform(-1, 1) + (i % 3 == 0)]) for _ in range(6)]) for i in range(150)]
    rows += [(400 + i, i % 2, rows[0][2]) for i in range(12)] + [(500, 1, [0.0] * 6), (510, 1, [0.0] * 6), (520, 7, [1.0] * 6)]
    rows += [(i, 1, v) for i, v in ODD] + [(600, None, [1.0] * 6), (10, 1, rows[20][2]), (7, 0, rows[30][2])]
    df = spark.createDataFrame([(i, x, v, 1, "n") for i, x, v in rows], "vec_id long, label int, embedding array<float>, rank int, p string")
    rows = [(r.vec_id, r.label, r.embedding) for r in df.collect()]
    few = [r for r in rows if r[0] is not None and r[0] < 12]
    for asked, held in ((df, rows), (df.where("vec_id < 12"), few), (df.limit(0), [])):
        got = hard_negatives.hard_negatives(asked, row_id="vec_id", vector="embedding", label=F.col("label"), is_anchor=F.col("vec_id") % 5 == 0,
                                            positives=4, negatives=3, low=30, high=90).collect()
        assert sorted(tuple(r)[:6] for r in got) == _want_negatives(held, lambda i: i % 5 == 0, 4, 3, 30, 90)


def test_threshold_stops_early():
    rng = np.random.default_rng(4)
    held = rng.integers(-30, 30, (4000, 8)).astype(np.float64)
    anchor = np.array([90.0, -2, 1, 0, 1, 0, 0, 0])
    best, scores, read = hard_negatives.Lists(held).search(anchor, np.ones(4000, bool), [(-10**6, 10**6)], 5, np.arange(4000))
    assert read < 3000
    assert scores[best[0]].tolist() == sorted((held @ anchor).tolist(), reverse=True)[:5]
    best, _, read = hard_negatives.Lists(held).search(anchor, np.ones(4000, bool), [(10**7, 10**8)], 5, np.arange(4000))
    assert read < 200 and not len(best[0])  # the threshold is below the window at once


def test_vectors_without_components(spark):
    df = spark.createDataFrame([(i, i % 2, []) for i in range(9)], "vec_id long, label int, embedding array<float>")
    got = hard_negatives.hard_negatives(df, row_id="vec_id", vector="embedding", label=F.col("label"), is_anchor=F.col("vec_id") == 4,
                                        positives=2, negatives=3).collect()
    assert sorted(tuple(r)[:6] for r in got) == [(4, p, n + 1, 2 * n + 1, 0, 0) for p in (0, 2) for n in range(3)]
    best = topk.top_k(df, row_id="vec_id", vector="embedding", is_query=F.col("vec_id") == 4, k=2).collect()
    assert sorted(tuple(r) for r in best) == [(4, 1, 0, 0), (4, 2, 1, 0)]
