"""Fits on cells equal fits on rows, and leave the rows of a large table alone."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tessera.ml import boost as B
from tessera.ml import cells as CE
from tessera.ml import search as SE
from tessera.ml import train as T


@pytest.fixture(scope="module")
def parts(spark):
    rng = random.Random(3)
    rows = [(i, x := rng.random() * 9, float(z := rng.randrange(7)), float(rng.randrange(40)), 10 * x + 3 * z + rng.random()) for i in range(3000)]
    df = spark.createDataFrame(rows, "pix long, x double, z double, noise double, y double").persist()
    return df.where("pix % 5 > 0"), df.where("pix % 5 = 0")


FEATURES = ["x", "z", "noise"]
CANDIDATES = [{"stepSize": 0.3, "maxDepth": 4}, {"stepSize": 0.2, "maxDepth": 8, "leaves": 12}, {"stepSize": 0.2, "maxDepth": 5, "leaves": 9, "columns": 0.7},
              {"stepSize": 0.3, "maxDepth": 3, "leaves": 1}]


def close(got, want):
    assert [r.keys() for r in got] == [r.keys() for r in want]
    for g, w in zip(got, want):
        assert {k: v for k, v in g.items() if not isinstance(v, float)} == {k: v for k, v in w.items() if not isinstance(v, float)}
        assert [g[k] for k in g if isinstance(g[k], float)] == pytest.approx([w[k] for k in w if isinstance(w[k], float)], rel=1e-9)


def both(monkeypatch, run):
    """What ``run`` gives on rows and on cells, and the rows that the fits on cells read."""
    fitted, whole = [], SE.CE.cells
    want = run()
    monkeypatch.setattr(CE, "LEAST_ROWS", 1)
    monkeypatch.setattr(CE, "cells", lambda *a, **k: fitted.append(whole(*a, **k)) or fitted[-1])
    got = run()
    close(got, want)
    assert len(fitted) == 1  # grouped once for all fits
    return fitted[0]


def test_search_on_cells_equals_search_on_rows(parts, monkeypatch):
    train, valid = (SE.assemble(p, FEATURES) for p in parts)
    small = both(monkeypatch, lambda: SE.search(train, valid, CANDIDATES, label="y", rounds=5, patience=3))
    assert small.rows == 2400 and small.valid.count() == 600
    again = CE.cells(*parts, FEATURES, label="y", rows=2400).train.agg(F.sum(CE.WEIGHT), F.count("y"), F.sum(F.col("y") * F.col(CE.WEIGHT))).first()
    assert again[0] == 2400 and again[1] <= 2400 and again[2] == pytest.approx(parts[0].agg(F.sum("y")).first()[0])


@pytest.mark.parametrize("how", ["rfe", "rfa"])
def test_selection_on_cells_equals_selection_on_rows(parts, monkeypatch, how):
    both(monkeypatch, lambda: getattr(SE, how)(*parts, FEATURES, label="y", rounds=4, params={"maxDepth": 3}))


def test_joint_search_on_cells(parts, monkeypatch):
    both(monkeypatch, lambda: SE.search_select(SE.FitMemo(*parts, label="y", rounds=3), FEATURES, CANDIDATES[:2], how="rfa"))


def test_cells_are_bounded_by_the_bins(spark):
    df = spark.range(40_000).select((F.rand(1) * 5).alias("a"), F.rand(2).alias("b"), F.lit(1.0).alias("c"), F.rand(3).alias("y"))
    small = CE.cells(df, df, ["a", "b", "c"], label="y", rows=40_000)
    assert small.train.count() <= CE.BINS**2 and small.train.agg(F.sum(CE.WEIGHT)).first()[0] == 40_000


def test_what_must_stay_on_rows():
    assert not CE.countable("rf", {}) and not CE.countable("gbt", {"subsamplingRate": 0.8}) and CE.countable("gbt", {"maxDepth": 4})
    assert CE.thresholds([3.0, 1.0, 2.0, 1.0]) == [1.5, 2.5] and CE.thresholds([1.0, 1.0]) == []
    assert len(CE.thresholds([float(i) for i in range(1000)])) <= CE.BINS - 1


def test_a_null_is_an_error(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0), (3.0, None)], "a double, y double")
    with pytest.raises(Exception, match="y is null"):
        CE.cells(df, df, ["a"], label="y", rows=3)


def test_boosting_on_cells_equals_boosting_on_rows(parts, monkeypatch):
    train, valid = (SE.assemble(p, FEATURES) for p in parts)
    def run():
        return T.train_model(train, valid, label="y", rounds=13, seed=5, params={"stepSize": 0.3, "maxDepth": 4})
    want, seen, fit = run(), [], B.Trees.fit
    monkeypatch.setattr(CE, "LEAST_ROWS", 1)
    monkeypatch.setattr(B.Trees, "fit", lambda self, df, i, seed: seen.append(df.count()) or fit(self, df, i, seed))
    got = run()
    assert got.curve == pytest.approx(want.curve, rel=1e-9) and got.best_iter == want.best_iter and got.rmse == pytest.approx(want.rmse)
    assert len(seen) == 13 and max(seen) < 2400  # fewer cells than rows, in every round
    assert dict(T.feature_importance(got.model, FEATURES)) == pytest.approx(dict(T.feature_importance(want.model, FEATURES)), rel=1e-6)
    assert got.model.getOrDefault("subsamplingRate") == 1.0 and got.model.getNumTrees == got.best_iter


def test_boosting_on_cells_draws_rows_for_each_round(parts, monkeypatch):
    train, valid = (SE.assemble(p, FEATURES) for p in parts)
    args = dict(label="y", rounds=12, params={"stepSize": 0.3, "maxDepth": 4, "subsamplingRate": 0.5})
    want = T.train_model(train, valid, seed=5, **args)
    monkeypatch.setattr(CE, "LEAST_ROWS", 1)
    got, other = (T.train_model(train, valid, seed=s, **args) for s in (5, 6))
    assert got.curve == pytest.approx(want.curve, rel=0.2) and got.curve != other.curve
    rows = parts[0].withColumn("cell", F.floor(F.col("z")))
    out = CE.drawn(rows, ["cell"], label="y", numbers=[1, 2], rate=0.5, seed=5).collect()
    sizes = {r["cell"]: r["count"] for r in rows.groupBy("cell").count().collect()}
    assert len(out) == len(sizes) and any(r._n1 != r._n2 for r in out)
    for i in (1, 2):
        assert all(0 < r[f"_n{i}"] < sizes[r["cell"]] for r in out) and abs(sum(r[f"_n{i}"] for r in out) / 2400 - 0.5) < 0.06
    whole = CE.drawn(rows, ["cell"], label="y", numbers=[1], rate=1.0, seed=5)
    assert whole.agg(F.sum("_n1"), F.sum("_y1")).first() == pytest.approx(tuple(parts[0].agg(F.count("y").cast("double"), F.sum("y")).first()))
    assert not CE.drawable({"subsamplingRate": 0.8, "minInstancesPerNode": 9}) and CE.drawable({"subsamplingRate": 0.8})


def test_boosting_with_a_patience_on_cells_equals_boosting_on_rows(parts, monkeypatch):
    train, valid = (SE.assemble(p, ["z", "noise"]) for p in parts)
    args = dict(label="y", rounds=26, patience=3, seed=5, params={"stepSize": 0.9, "maxDepth": 5})
    want, seen, fit = T.train_model(train, valid, **args), [], B.Trees.fit
    assert want.stop_iter is not None and want.stop_iter < 26
    monkeypatch.setattr(CE, "LEAST_ROWS", 1)
    monkeypatch.setattr(B.Trees, "start", None)  # no fit of a whole block on rows
    monkeypatch.setattr(B.Trees, "fit", lambda self, df, i, seed: seen.append(df.count()) or fit(self, df, i, seed))
    bins = T.large_bins(train, valid, label="y", params=args["params"])
    for got in (T.train_model(train, valid, **args), T.train_model(train, valid, bins=bins, **args)):
        assert got.curve == pytest.approx(want.curve, rel=1e-9) and (got.best_iter, got.stop_iter) == (want.best_iter, want.stop_iter)
        assert got.rmse == pytest.approx(want.rmse) and got.n_valid == 600 and got.model.getNumTrees == got.best_iter
    assert max(seen) < 2400 and len(seen) <= 2 * (want.stop_iter + B.CHAIN)
    assert bins.valid.agg(F.sum(B._ROWS)).first()[0] == 600 and bins.train.count() == 2400
