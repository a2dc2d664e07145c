"""Spark ML helpers: truncated scoring, learning curve, patience rule, permutation."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from tessera.ml import train as T
from tessera.ml.baseline import fit_baseline, predict_baseline
from tessera.ml.select import permuted_column


@pytest.fixture(scope="module")
def data(spark):
    rows = [(i, float(i % 17), float((i * 7) % 11), float((i % 17) * 2.0 - (i * 7) % 11 + (i % 5)))
            for i in range(1, 801)]
    df = spark.createDataFrame(rows, "pix long, a double, b double, y double")
    return T.assemble(df, ["a", "b"]).persist()


def test_first_k_model_is_the_sum_over_its_trees(data):
    model = T.make_learner("gbt", label="y", seed=1, maxIter=6, maxDepth=3).fit(data)
    short = T.first_k_model(model, 4)
    row = data.first()
    want = sum(w * t.predict(row.features) for w, t in list(zip(model.treeWeights, model.trees))[:4])
    assert short.getNumTrees == 4 and short.transform(data).first().prediction == pytest.approx(want)


def test_patience_stops_a_fit(data):
    train, valid = data.where("pix % 4 > 0"), data.where("pix % 4 = 0")
    res = T.train_model(train, valid, label="y", rounds=25, seed=1, patience=3, params={"maxDepth": 6, "stepSize": 1.0})
    assert res.stop_iter is not None and res.stop_iter < 25 and res.model.getNumTrees == res.best_iter == res.stop_iter - 3


def test_boruta_tells_signal_from_noise(spark):
    import random
    from tessera.ml import search as SE
    rng = random.Random(1)
    rows = []
    for i in range(400):
        x = rng.random()
        rows.append((i, x, rng.random(), rng.random(), rng.random(), 10 * x + rng.random()))
    df = spark.createDataFrame(rows, "pix long, signal double, noise double, n2 double, n3 double, y double")
    got = {r["feature"]: r for r in SE.boruta(df, ["signal", "noise", "n2", "n3"], label="y", key="pix", max_iter=25, num_trees=8, max_depth=4)}
    assert got["signal"]["decision"] == "confirmed" and got["signal"]["tried"] < 10
    assert "rejected" in {got[f]["decision"] for f in ("noise", "n2", "n3")}
    assert "confirmed" not in {got[f]["decision"] for f in ("noise", "n2", "n3")}
    with pytest.raises(ValueError, match="can't decide"):
        SE.boruta(df, ["signal", "noise"], label="y", key="pix", max_iter=3)


def test_saved_models_and_their_errors(spark, data, tmp_path):
    from tessera.ml import predict as PR
    root = f"file://{tmp_path}/models"
    for name, params in (("gbt", {"maxIter": 4}), ("rf", {"numTrees": 4}), ("lr", {})):
        T.save_model(T.make_learner(name, label="y", seed=1, **params).fit(data), f"{root}/{name}_model")
    spark.createDataFrame([("{}",)], "value string").write.text(f"{root}/bad_model/metadata")
    tried = PR.try_models(spark, PR.saved_models(spark, root))
    assert {r.model: r.status for r in tried.collect()} == {"gbt_model": 1, "rf_model": 1, "lr_model": 1, "bad_model": 0}
    raw = data.drop("features").withColumn("edem", F.lit(100.0))
    registry = tried.withColumn("features", F.array(F.lit("a"), F.lit("b"))).withColumn(
        "rmse", F.expr("case model when 'rf_model' then 1.0 when 'gbt_model' then 2.0 else 3.0 end"))
    out = PR.predict_surface(raw, registry, target="edem")
    assert out.columns == [*raw.columns, "ml_zdif", "ml_edem"]
    row = out.orderBy("pix").first()
    one = data.where(F.col("pix") == row.pix)
    preds = [PR.load_model(spark, f"{root}/{m}_model").transform(one).first().prediction for m in ("gbt", "rf", "lr")]
    assert row.ml_zdif == pytest.approx(sum(preds) / 3) and row.ml_edem == pytest.approx(100 - sum(preds) / 3)
    best = PR.predict_surface(raw, registry, target="edem", best=1).orderBy("pix").first()
    assert best.ml_zdif == pytest.approx(preds[1])
    with pytest.raises(ValueError, match="needs the column"):
        PR.predict_surface(raw.drop("b"), registry, target="edem")
    with pytest.raises(ValueError, match="no usable model"):
        PR.predict_surface(raw, registry.where("status = 0"), target="edem")
    with pytest.raises(ValueError, match="no model can be loaded"):
        PR.predict_surface(raw, registry.withColumn("status", F.lit(1)), target="edem")
    pixels = spark.createDataFrame([("t", i, float(i % 3), 1.0, 50.0) for i in range(15)], "tile string, pixel_idx long, a double, b double, edem double")
    grid = spark.createDataFrame([("t", 4, 4)], "tile string, width long, height long")
    with pytest.raises(ValueError, match="don't fill the grid"):
        PR.predict_tiles(pixels, grid, registry, f"{root}/out", target="edem")


def test_predict_tiles_writes_every_pixel(spark, monkeypatch, tmp_path):
    from conftest import SF_SMALL

    from tessera.plans import queries_ml as Q
    monkeypatch.setattr(Q, "scratch_path", lambda _, name: f"file://{tmp_path}/{name}")
    want = {r.tile: r["count"] for r in Q.labelled(spark, SF_SMALL).groupBy("tile").count().collect()}
    cells = {r.tile: r.cells for r in Q.predict_tiles(spark, SF_SMALL).collect()}
    assert any(n % 16 for t, n in want.items() if t in cells)
    assert cells == {t: -(-want[t] // 16) * 16 for t in sorted(want)[3:]}
    blocks = spark.read.parquet(f"file://{tmp_path}/predicted")
    full = blocks.select("tile", F.explode("data").alias("v")).groupBy("tile").agg(F.count("v").alias("n")).collect()
    assert {r.tile: r.n for r in full} == {t: want[t] for t in cells}


def test_searches_fit_every_candidate(spark, monkeypatch):
    """The lists that reach the fits are F1's grid and all that random_candidates lists of either space."""
    from conftest import SF_SMALL

    from tessera.plans import queries_ml as Q
    tried = []

    def search(train, valid, candidates, **_):
        tried.append([dict(c) for c in candidates])
        return [{"rank": 1, "candidate": 0, **candidates[0], "rmse": 0.0, "r2": 0.0}]
    listed = {}
    for r in Q.random_candidates(spark, SF_SMALL).collect():
        listed.setdefault(r.space, []).append((r.stepSize, r.maxDepth, r.leaves, r.columns))
    monkeypatch.setattr(Q.SE, "search", search)
    for query in (Q.grid_search, Q.random_search, Q.random_search_log):
        query(spark, SF_SMALL).collect()
    assert {(c["stepSize"], c["maxDepth"], c["leaves"]) for c in tried[0]} == {(s, d, n) for s in (0.2, 0.1) for d in (10, 12) for n in (25, 35)}
    for space, got in zip(("uniform", "log"), tried[1:]):
        assert sorted(((c["stepSize"], c["maxDepth"], c["leaves"], c.get("columns")) for c in got), key=str) == sorted(listed[space], key=str)
        assert len(got) == 8
    assert all(0.09 <= s <= 0.34 and d in (10, 12) and 20 <= n <= 39 and c is None for s, d, n, c in listed["uniform"])
    assert all(0.01 <= s <= 0.2 and 15 <= d <= 19 and n == 31 and 0.6 <= c <= 1 for s, d, n, c in listed["log"])


def test_rules_of_patience(spark):
    assert [T.early_stopping_rounds(n) for n in (10, 400, 500, 1000, 1001, 5000)] == [20, 40, 100, 100, 50, 250]
    from tessera.operators import metrics as M
    got = spark.createDataFrame([(n,) for n in (10, 400, 500, 1000, 1001, 5000)], "n int").select(
        M.early_stopping_rounds(F.col("n")).alias("p")).collect()
    assert [r.p for r in got] == [20, 40, 100, 100, 50, 250]


def test_first_k_of_all_trees_equals_model(data):
    model = T.make_learner("gbt", label="y", seed=1, maxIter=6, maxDepth=3).fit(data)
    full = model.transform(data).select("pix", "prediction")
    mine = T.predict_first_k(model, data, 6, out="p2").select("pix", "p2")
    joined = full.join(mine, "pix").collect()
    assert all(abs(r.prediction - r.p2) < 1e-9 for r in joined)


def test_curve_last_point_is_rmse(data):
    res = T.train_model(data, data, label="y", rounds=5, seed=3, params={"maxDepth": 3})
    full = T.score(res.model.transform(data), "y")
    assert res.curve[-1] == pytest.approx(full["rmse"], rel=1e-9)
    assert res.best_iter == min(range(1, 6), key=lambda i: (res.curve[i - 1], i))


def test_best_iteration_patience():
    assert T.best_iteration([5, 4, 4, 4, 3], 2) == (2, 4)
    assert T.best_iteration([5, 4, 3], None) == (3, None)


def test_unknown_learner():
    with pytest.raises(ValueError):
        T.make_learner("catboost", label="y")


def test_permutation_is_a_permutation(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 301)], "pix long, v double")
    out = permuted_column(df, "v", key="pix", seed=11).collect()
    assert sorted(r.v for r in out) == [float(i) for i in range(1, 301)]
    assert sum(r.v == float(r.pix) for r in out) < 30


def test_baseline_per_group(spark):
    df = spark.createDataFrame([("a", 1.0, 3.0), ("a", 2.0, 5.0), ("b", 1.0, 1.0), ("b", 3.0, 5.0)],
                               "g string, x double, y double")
    m = {r.g: (r.slope, r.intercept) for r in fit_baseline(df, label="y", feature="x", by=["g"]).collect()}
    assert m["a"] == pytest.approx((2.0, 1.0)) and m["b"] == pytest.approx((2.0, -1.0))
    pred = predict_baseline(df, fit_baseline(df, label="y", feature="x", by=["g"]), feature="x", by=["g"])
    assert all(math.isclose(r.pred, r.y) for r in pred.collect())
