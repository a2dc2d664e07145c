"""Boosting in blocks: equal to one fit, stops by patience, goes on after a loss."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tessera.ml import boost as B
from tessera.ml import train as T


@pytest.fixture(scope="module")
def parts(spark):
    rows = [(i, float(i % 17), float((i * 7) % 11), 5.0, float((i % 17) * 2.0 - (i * 7) % 11 + (i * 31 % 13))) for i in range(1, 601)]
    df = T.assemble(spark.createDataFrame(rows, "pix long, a double, b double, c double, y double"), ["a", "b"]).persist()
    return df.where("pix % 4 > 0"), df.where("pix % 4 = 0")


def test_blocks_equal_one_fit(parts, tmp_path):
    train, valid = parts
    whole = T.make_learner("gbt", label="y", seed=1, maxIter=7, maxDepth=3, stepSize=0.3).fit(train)
    res = B.boost(train, valid, label="y", learner=B.Trees(0.3, maxDepth=3), rounds=7, block=3, path=f"file://{tmp_path}/fit")
    assert res.curve == pytest.approx(T.learning_curve(whole, valid)) and len(res.curve) == 7 and res.stop_iter is None
    want = [r.prediction for r in T.first_k_model(whole, res.best_iter).transform(valid).orderBy("pix").collect()]
    got = [r.prediction for r in res.model.transform(valid).orderBy("pix").collect()]
    assert got == pytest.approx(want) and res.model.getNumTrees == res.best_iter
    assert len(res.model.featureImportances) == 2 and res.model.getLabelCol() == "y"


def test_first_block_in_one_go_equals_single_rounds(parts, tmp_path):
    """Random samples of the rows included; the rule cuts inside the block."""
    train, valid = parts
    args = dict(label="y", learner=B.Trees(0.3, maxDepth=3, subsamplingRate=0.8), rounds=9, block=9, seed=5)
    for patience in (None, 1):
        one = B.boost(train, valid, path=f"file://{tmp_path}/one-{patience}", patience=patience, **args)
        all_ = B.boost(train, valid, path=f"file://{tmp_path}/first-{patience}", patience=patience, first=9, **args)
        assert all_.curve == pytest.approx(one.curve) and (all_.best_iter, all_.stop_iter) == (one.best_iter, one.stop_iter)
        assert all_.model.getNumTrees == one.model.getNumTrees == one.best_iter
        assert T.score(all_.model.transform(valid), "y")["rmse"] == pytest.approx(min(one.curve))
        again = B.boost(train, valid, path=f"file://{tmp_path}/first-{patience}", patience=patience, first=9, **args)
        assert again.curve == all_.curve


def test_running_prediction_is_kept_every_few_rounds(parts, monkeypatch):
    """No round's input is computed from more than ``CHAIN`` learners (before: from all of the block)."""
    train, valid = parts
    added = []

    class Counted(B.Trees):
        def fit(self, df, number, seed):
            plan = df._jdf.queryExecution().withCachedData().toString()
            added.append(plan.split("InMemoryRelation")[0].count("_stage"))
            return super().fit(df, number, seed)
    B.boost(train, valid, label="y", learner=Counted(0.3, maxDepth=2), rounds=11, block=11)
    assert len(added) == 11 and max(added) == max(added[:B.CHAIN]) and added[B.CHAIN] == added[0] == 0


def test_rounds_behind_the_first_block(parts, tmp_path):
    train, valid = parts
    args = dict(label="y", rounds=7, block=3)
    one = B.boost(train, valid, learner=B.Trees(0.3, maxDepth=3), path=f"file://{tmp_path}/one", **args)
    both = B.boost(train, valid, learner=B.Trees(0.3, maxDepth=3), path=f"file://{tmp_path}/both", first=4, **args)
    assert both.curve == pytest.approx(one.curve) and both.model.getNumTrees == one.best_iter
    assert T.score(both.model.transform(valid), "y")["rmse"] == pytest.approx(min(one.curve))


class Flaky(B.Trees):
    """Fails once in a given round, and counts the rounds it fits."""

    def __init__(self, fails, *args, **params):
        super().__init__(*args, **params)
        self.fails, self.fitted = fails, []

    def fit(self, df, number, seed):
        if number == self.fails:
            self.fails = None
            raise RuntimeError("lost")
        self.fitted.append(number)
        return super().fit(df, number, seed)


def test_goes_on_behind_the_last_whole_block(parts, tmp_path):
    train, valid = parts
    args = dict(label="y", rounds=8, block=2)
    flaky = Flaky(6, 0.3, maxDepth=2)
    with pytest.raises(RuntimeError, match="lost"):
        B.boost(train, valid, learner=flaky, path=f"file://{tmp_path}/fit", **args)
    assert flaky.fitted == [1, 2, 3, 4, 5]
    res = B.boost(train, valid, learner=flaky, path=f"file://{tmp_path}/fit", **args)
    assert flaky.fitted == [1, 2, 3, 4, 5, 5, 6, 7, 8]
    straight = B.boost(train, valid, learner=B.Trees(0.3, maxDepth=2), path=f"file://{tmp_path}/other", **args)
    assert res.curve == pytest.approx(straight.curve) and res.best_iter == straight.best_iter
    again = B.boost(train, valid, learner=flaky, path=f"file://{tmp_path}/fit", **args)
    assert flaky.fitted[-1] == 8 and len(flaky.fitted) == 9 and again.curve == res.curve
    assert not list((tmp_path / "fit").glob("rows-*"))  # running tables go when they are used up
    with pytest.raises(ValueError, match="other settings"):
        B.boost(train, valid, learner=B.Trees(0.2, maxDepth=2), path=f"file://{tmp_path}/fit", **args)


def test_a_thousand_rounds_stop_at_the_patience(parts):
    train, valid = parts
    learner = Flaky(None, 1.0, maxDepth=6)
    res = B.boost(train, valid, label="y", learner=learner, rounds=1000, patience=4, block=10)
    assert res.stop_iter == res.best_iter + 4 == len(res.curve) == len(learner.fitted) < 100
    assert res.curve[res.best_iter - 1] == min(res.curve) and res.model.getNumTrees == res.best_iter
    assert T.score(res.model.transform(valid), "y")["rmse"] == pytest.approx(min(res.curve))


def test_lines_against_a_plain_loop(parts):
    train, valid = parts
    res = B.boost(train, valid, label="y", learner=B.Lines(["a", "b", "c"], 0.7), rounds=20, block=4)
    rows, held = [r.asDict() for r in train.collect()], [r.asDict() for r in valid.collect()]
    for r in rows + held:
        r["f"] = 0.0
    curve = []
    for i in range(20):
        x = ["a", "b", "c"][i % 3]
        n, mx, my = len(rows), sum(r[x] for r in rows) / len(rows), sum(r["y"] - r["f"] for r in rows) / len(rows)
        sxx = sum((r[x] - mx) ** 2 for r in rows)
        slope = sum((r[x] - mx) * (r["y"] - r["f"] - my) for r in rows) / sxx if sxx else 0.0
        for r in rows + held:
            r["f"] += 0.7 * (my + slope * (r[x] - mx))
        curve.append((sum((r["y"] - r["f"]) ** 2 for r in held) / len(held)) ** 0.5)
    assert n and res.curve == pytest.approx(curve)
    table = res.model.orderBy("round").collect()
    assert [r.feature for r in table[:3]] == ["a", "b", "c"][:min(3, len(table))] and len(table) == res.best_iter


def test_empty_curve_and_ties():
    assert B.best_iteration([], 3) == (0, None)
    assert B.best_iteration([2.0, 1.0, 1.0, 1.0], 2) == (2, 4)
    assert B.best_iteration([2.0, 1.0, 1.0, 0.5], None) == (4, None)
