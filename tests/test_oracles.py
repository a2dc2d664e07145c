"""Every registered query with an oracle equals DuckDB on sf0.001; the others run."""

from __future__ import annotations

import math
from collections import Counter

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

SQL = E.oracle_sql()
QUERIES = E.queries()
# Spark ML fits: one run each, with what their results must show
ML = {
    "train_gbt": lambda r: r[0]["stop_iter"] is not None and r[0]["n_valid"] > 100,
    "learning_curve": lambda r: [x["iteration"] for x in r] == list(range(1, len(r) + 1)),
    "feature_importance": lambda r: abs(sum(x["importance"] for x in r) - 1) < 1e-9,
    "seed_ensemble": lambda r: r[-1]["learner"] == "ensemble" and r[-1]["rmse"] < max(x["rmse"] for x in r[:-1]),
    "best_iter_chain": lambda r: r[1]["patience"] == r[0]["best_iteration"] + 10 and r[2]["patience"] == r[1]["best_iteration"]
    and any(x["stop_iteration"] for x in r),
    "rounds_study": lambda r: r[-1]["stop_iteration"] is not None and r[0]["stop_iteration"] is None,
    "model_variants": lambda r: len(r) == 4,
    "automl_leaderboard": lambda r: len({round(x["rmse_tuning"], 6) for x in r}) == len(r) == 6,
    "grid_search": lambda r: len(r) == 8 and [x["rank"] for x in r] == list(range(1, 9)),
    "random_search": lambda r: len(r) == 8 and len({x["stepSize"] for x in r}) == 8,
    "leaderboard_budget": lambda r: r[-1]["spent"] <= sum(20 * x["rows"] for x in r) and sum(x["rmse_holdout"] is not None for x in r) == 1,
    "search_rfe": lambda r: sum(x["best"] for x in r) == 1 and {x["n_features"] for x in r} == {1, 2, 3, 4},
    "search_rfa": lambda r: sum(x["best"] for x in r) == 1 and {x["n_features"] for x in r} == {1, 2, 3, 4},
    "search_boruta": lambda r: sum(x["best"] for x in r) == 1 and len({x["features"] for x in r}) == 1,
    "rfe": lambda r: sum(x["selected"] for x in r) == r[0]["n_features"],
    "rfa": lambda r: sum(x["best"] for x in r) == 1,
    "boruta": lambda r: any(x["decision"] == "confirmed" for x in r),
    "model_registry": lambda r: sorted(x["status"] for x in r) == [0] + [1] * 7,
    "predict_saved_models": lambda r: all(x["ml_edem"] is not None for x in r) and len(r) > 1000,
    "predict_best_model": lambda r: any(abs(x["ml_best"] - x["ml_top5"]) > 1 for x in r),
    "predict_tiles": lambda r: len(r) == 22 and all(x["cells"] % 16 == 0 for x in r),
}


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    return v


def _bag(rows, cols):
    return Counter(tuple(_norm(r[c]) for c in cols) for r in rows)


def test_every_query_has_an_entry():
    assert set(SQL) <= set(QUERIES)
    assert len(SQL) >= 55


@pytest.mark.parametrize("name", sorted(n for n in SQL if not n.startswith("op")))  # the others are in tests/llm
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = [r.asDict() for r in df.collect()]
    rel = duck.sql(SQL[name])
    want = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    assert sorted(rel.columns) == cols
    assert _bag(got, cols) == _bag(want, cols)


@pytest.mark.parametrize("name", sorted(ML))
def test_ml_query(spark, name):
    rows = [r.asDict() for r in QUERIES[name](spark, SF_SMALL).collect()]
    assert ML[name](rows), rows[:8]


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n not in SQL and n not in ML and n != "pipeline" and not n.startswith("op")))
def test_rows_only_query_runs(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() > 0


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["n", "rmse", "r2"] and len(rows) == 1
