"""Shuffles by bijection, searches joined with selection, and a leaderboard within a budget."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tessera.ml import search as SE
from tessera.ml import select as SL


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 225, 1000, 4099])
def test_shuffled_positions_are_a_bijection(spark, n):
    out = spark.range(n).select("id", SL.shuffled_position(F.col("id"), n, 3).alias("a"), SL.shuffled_position(F.col("id"), n, 4).alias("b")).collect()
    assert sorted(r.a for r in out) == sorted(r.b for r in out) == list(range(n))
    if n >= 1000:
        assert sum(r.a == r.id for r in out) < 12 and sum(r.a == r.b for r in out) < 12


def test_shuffled_positions_are_spread(spark):
    n, at = 10_007, F.col("id")
    rows = spark.range(n).select("id", SL.shuffled_position(at, n, 9).alias("to")).collect()
    for k in range(4):  # where each quarter goes: a quarter of it everywhere
        part = [r.to * 4 // n for r in rows if r.id * 4 // n == k]
        assert all(abs(part.count(q) / len(part) - 0.25) < 0.04 for q in range(4))
    mean = (n - 1) / 2
    assert abs(sum((r.id - mean) * (r.to - mean) for r in rows)) / sum((r.id - mean) ** 2 for r in rows) < 0.04


@pytest.mark.parametrize("n", [1, 5, 225, 4099])
def test_positions_of_several_columns_equal_single_ones(spark, n):
    df = SL.with_shuffled_positions(spark.range(n), {"a": 3, "b": 4}, n=n, pos="id")
    assert df.where((F.col("a") != SL.shuffled_position(F.col("id"), n, 3)) | (F.col("b") != SL.shuffled_position(F.col("id"), n, 4))).count() == 0
    rounds = [line for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "xxhash64(" in line and "aggregate(" not in line]
    assert len(rounds) == SL._ROUNDS and all(line.count("xxhash64(") == 2 for line in rounds)  # one hash a round and column


def test_shuffled_columns_keep_their_values(spark):
    df = spark.createDataFrame([(i * 3, float(i), None if i % 10 == 0 else float(-i)) for i in range(300)], "key long, a double, b double")
    rows = SL.shuffled_columns(SL.numbered_rows(df, key="key"), {"a": 1, "b": 2}, n=300)
    out = rows.collect()
    for c in ("a", "b"):
        assert sorted((r[f"{c}_shadow"] for r in out), key=str) == sorted((r[c] for r in out), key=str)
        assert sum(r[c] == r[f"{c}_shadow"] for r in out) < 15
    plan = rows.select("*")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner, (_pos") == 1  # one join for all columns


@pytest.fixture(scope="module")
def parts(spark):
    rng = random.Random(1)
    rows = [(i, x := rng.random(), z := rng.random(), rng.random(), 10 * x + 3 * z + rng.random() / 5) for i in range(700)]
    df = spark.createDataFrame(rows, "pix long, x double, z double, noise double, y double").persist()
    return df.where("pix % 5 > 0"), df.where("pix % 5 = 0")


GOOD, BAD = {"stepSize": 0.3, "maxDepth": 4}, {"stepSize": 0.001, "maxDepth": 1}


def test_memo_fits_an_item_once_and_after_a_restart(parts, tmp_path):
    train, valid = parts
    memo = SE.FitMemo(train, valid, label="y", rounds=3, path=f"file://{tmp_path}/memo")
    first = memo(["x", "z"], GOOD)
    assert memo(["z", "x"], dict(reversed(GOOD.items()))) == first and (memo.fits, memo.hits) == (1, 1)
    memo(["x"], GOOD)
    again = SE.FitMemo(train, valid, label="y", rounds=3, path=f"file://{tmp_path}/memo")
    assert again(["x", "z"], GOOD) == first and (again.fits, again.hits) == (0, 1)
    again(["x", "z"], BAD)
    assert again.fits == 1


def test_search_joined_with_selection(parts):
    train, valid = parts
    memo = SE.FitMemo(train, valid, label="y", rounds=4)
    raced = SE.race(memo, ["x", "z", "noise"], [GOOD, BAD])
    assert [r["kept"] for r in raced] == [True, False] and raced[1]["gap"] > 0 == raced[0]["gap"]
    rfe = SE.search_select(memo, ["x", "z", "noise"], [GOOD, BAD], how="rfe")
    assert {r["candidate"] for r in rfe} == {0} and [r["features"] for r in rfe] == ["noise,x,z", "x,z", "x"]
    fits = memo.fits
    rfa = SE.search_select(memo, ["x", "z", "noise"], [GOOD, BAD], how="rfa")
    assert [r["features"] for r in rfa] == ["x", "x,z", "noise,x,z"] and memo.fits == fits  # the same subsets: all from the memo
    assert [r["rmse"] for r in rfa if r["best"]] == [r["rmse"] for r in rfe if r["best"]] and sum(r["best"] for r in rfa) == 1
    with pytest.raises(ValueError):
        SE.search_select(memo, ["x"], [GOOD], how="other")


def test_halving_stays_within_its_budget(parts):
    train, valid = parts
    ranked = SE.assemble(train, ["x", "z", "noise"]).withColumn("_rank", F.floor(F.col("pix") / 5) * 4 + F.col("pix") % 5 - 1)
    held = SE.assemble(valid, ["x", "z", "noise"])
    learners = {"gbt": {"maxIter": 6, "stepSize": 0.3}, "dt": {"maxDepth": 1}, "lr": {}}
    n = train.count()
    for budget in (n * 8 / 2, n * 8 / 6):
        table = SE.leaderboard_halving(ranked, held, held, label="y", learners=learners, budget=budget, rank="_rank")
        assert sum(r["cost"] for r in table) == table[-1]["spent"] <= budget
        assert [r["rows"] for r in table] == sorted(r["rows"] for r in table) and table[-1]["rung"] == 2
        full = SE.leaderboard_fit(ranked, held, held, label="y", learners=learners)
        assert next(r["model"] for r in table if r["rung"] == 2 and r["place"] == 1) == full[0]["model"]
        assert sum(r["rmse_holdout"] is not None for r in table) == 1
    with pytest.raises(ValueError, match="budget"):
        SE.leaderboard_halving(ranked, held, held, label="y", learners=learners, budget=2, rank="_rank")
    assert SE.halving_plan(1000, {"a": 1.0}, 500.0, 1) == [0.5] and SE.halving_plan(10, {"a": 1.0, "b": 1.0}, 1e9, 1) == [1.0]


def test_sparse_keys_are_numbered_in_even_blocks(spark, monkeypatch):
    from tessera.operators import numbering as N
    ranged = []
    whole = N.index_ordered
    monkeypatch.setattr(N, "index_ordered", lambda *a, **k: ranged.append(1) or whole(*a, **k))
    monkeypatch.setattr(N, "MOST_BLOCKS", 5)
    keys = [i * i * 1000 + 7 for i in range(400)]
    df = spark.createDataFrame([(k, k % 3) for k in keys], "key long, g int")
    for sparse, block in ((True, 50), (False, 1 << 40)):
        out = N.index_within(df, order_key="key", block=block, dense=False).collect()
        assert [r.idx for r in sorted(out, key=lambda r: r.key)] == list(range(400)) and bool(ranged) == sparse
        ranged.clear()
    assert N.index_within(df.limit(0), order_key="key", dense=False).count() == 0


def test_boruta_query_goes_on_until_every_feature_is_decided(spark, monkeypatch):
    from tessera.plans import queries_ml as Q
    rows = spark.range(20).select(F.col("id").alias("pix"), F.rand(1).alias(Q.LABEL), *[F.rand(i).alias(f) for i, f in enumerate(Q.FEATURES)])
    seen = []

    class Forest:
        def fit(self, df):
            seen.append(df.columns)

    def importance(model, cols):  # one feature beats the shadows in every other of 14 iterations, then never again
        odd = 1.0 if len(seen) <= 14 and len(seen) % 2 else 0.0
        return [(c, 0.5 if c.endswith("_shadow") else odd if c == "f_tax" else 1.0) for c in cols]
    monkeypatch.setattr(Q, "_prepared", lambda *a: rows)
    monkeypatch.setattr(SE, "make_learner", lambda *a, **k: Forest())
    monkeypatch.setattr(SE, "feature_importance", importance)
    got = {r.feature: r for r in Q.boruta(spark, "none").collect()}
    assert got["f_tax"].decision == "rejected" and got["f_tax"].tried == len(seen) == 27 and got["f_tax"].hits == 7
    assert all(got[f].decision == "confirmed" and got[f].tried == 7 for f in Q.FEATURES if f != "f_tax")


def test_shadows_of_bins_keep_their_counts_and_move_no_row(spark):
    df = spark.range(300).select(F.col("id").alias("_pos"), (F.col("id") % 7).cast("double").alias("a"),
                                 F.when(F.col("id") < 280, 0.0).otherwise(3.0).alias("b"), F.lit(0.0).alias("c"))
    ends = SL.bin_ends(df, ["a", "b", "c"])
    assert ends == {"a": [43, 86, 129, 172, 215, 258, 300], "b": [280, 280, 280, 300], "c": [300]}
    shadowed = SL.shuffled_bins(df, {"a": 1, "b": 2, "c": 3}, ends, n=300)
    out = shadowed.collect()
    assert len(out) == 300 and shadowed.columns == [*df.columns, "a_shadow", "b_shadow", "c_shadow"]
    for c in ("a", "b", "c"):
        assert sorted(r[f"{c}_shadow"] for r in out) == sorted(r[c] for r in out)
    assert sum(r.a == r.a_shadow for r in out) < 75 and sum(r.b == r.b_shadow == 3 for r in out) < 8
    plan = shadowed._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_boruta_of_a_large_table_reads_bins(spark, monkeypatch):
    rng = random.Random(1)
    rows = [(i // 2 if i % 9 else None, x := rng.random(), rng.random(), rng.random(), rng.random(), 10 * x + rng.random()) for i in range(400)]
    df = spark.createDataFrame(rows, "pix long, signal double, noise double, n2 double, n3 double, y double")
    fitted = []
    monkeypatch.setattr(SE.CE, "LEAST_ROWS", 1)
    monkeypatch.setattr(SE, "shuffled_columns", None)  # no row is sent anywhere
    monkeypatch.setattr(SE, "assemble", lambda d, cols, whole=SE.assemble: fitted.append((d, cols)) or whole(d, cols))
    got = {r["feature"]: r for r in SE.boruta(df, ["signal", "noise", "n2", "n3"], label="y", key="pix", max_iter=25, num_trees=8, max_depth=4)}
    assert got["signal"]["decision"] == "confirmed" and got["signal"]["tried"] < 10
    assert "rejected" in {got[f]["decision"] for f in ("noise", "n2", "n3")}
    assert "confirmed" not in {got[f]["decision"] for f in ("noise", "n2", "n3")}
    first, cols = fitted[0]
    assert first.count() == 400 and first.agg(F.sum("y")).first()[0] == pytest.approx(sum(r[-1] for r in rows))
    assert first.agg(F.max("signal"), F.max("signal_shadow")).first() == (31.0, 31.0) and len(cols) == 8
