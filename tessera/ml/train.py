"""Training and evaluation with Spark ML.

* Learners come from a registry keyed by name, with keyword parameters
  (the reference's positional mix-up between seed and device is avoided).
* Early stopping is NOT Spark's ``validationIndicatorCol`` rule (which has no
  patience). With a patience, a GBT is boosted by ``ml.boost``, which stops inside
  the fit by W4's rule and keeps the first k trees as one model. Without one, all
  rounds are fitted and the curve comes from ``evaluateEachIteration``.
* Every fit and every score is a distributed Spark job; only metrics, curves
  (one value per round) and importances (one value per feature) reach the
  driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import (DecisionTreeRegressor, FMRegressor, GBTRegressor, GeneralizedLinearRegression,
                                   LinearRegression, RandomForestRegressor)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.ml import cells as CE
from tessera.ml.boost import BLOCK, Bins, Trees, boost, boost_cells, write_forest
from tessera.ml.boost import bins as written_bins
from tessera.operators.metrics import best_iteration, early_stopping_rounds, rmse_r2_aggs  # noqa: F401
from tessera.session import scratch_path, scratch_scope

FEATURES_COL = "features"

LEARNERS = {
    "gbt": GBTRegressor,
    "rf": RandomForestRegressor,
    "dt": DecisionTreeRegressor,
    "lr": LinearRegression,
    "glr": GeneralizedLinearRegression,
    "fm": FMRegressor,
}
SEEDED = {"gbt", "rf", "dt", "fm"}


def assemble(df: DataFrame, features: Sequence[str], *, out: str = FEATURES_COL) -> DataFrame:
    """Feature vector; nulls are an error (impute first, as the reference does)."""
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="error").transform(df)


def make_learner(name: str, *, label: str, seed: int | None = None, **params):
    if name not in LEARNERS:
        raise ValueError(f"Unknown learner '{name}'. Use one of {sorted(LEARNERS)}.")
    kwargs = dict(featuresCol=FEATURES_COL, labelCol=label, predictionCol="prediction", **params)
    if seed is not None and name in SEEDED:
        kwargs["seed"] = seed
    return LEARNERS[name](**kwargs)


def score(pred: DataFrame, label: str, prediction: str = "prediction") -> dict:
    row = pred.agg(*rmse_r2_aggs(label, prediction)).collect()[0]
    return {"n": row["n"], "rmse": row["rmse"], "r2": row["r2"]}


def learning_curve(model, valid: DataFrame) -> list[float]:
    """Validation RMSE after each boosting round (sqrt of the squared loss)."""
    return [math.sqrt(x) for x in model.evaluateEachIteration(valid, "squared")]


def first_k_model(model, k: int):
    """A GBT model of the first k trees: one model, one ``transform``, whatever k is."""
    k = max(1, min(k, model.getNumTrees))
    spark = SparkSession.getActiveSession()
    whole = scratch_path(spark, "whole_gbt")
    save_model(model, whole)
    short = write_forest(spark, spark.read.parquet(f"{whole}/data"), spark.read.parquet(f"{whole}/treesMetadata"), whole,
                         scratch_path(spark, "first_gbt"), k)
    return short.setFeaturesCol(model.getFeaturesCol()).setPredictionCol(model.getPredictionCol())


def predict_first_k(model, df: DataFrame, k: int, out: str = "prediction") -> DataFrame:
    """Score a GBT with its first k trees."""
    return first_k_model(model, k).setPredictionCol(out).transform(df)


@dataclass
class FitResult:
    learner: str
    seed: int | None
    rounds: int | None
    best_iter: int | None
    rmse: float
    r2: float | None
    n_valid: int
    model: object = field(repr=False)
    curve: list[float] = field(default_factory=list, repr=False)
    stop_iter: int | None = None

    def metrics_row(self) -> dict:
        best = None if self.best_iter is None else f"{self.best_iter}_of_{self.rounds}"
        return {"learner": self.learner, "seed": self.seed, "rmse": self.rmse, "r2": self.r2,
                "best_iter": best, "stop_iter": self.stop_iter, "n_valid": self.n_valid}


def large_bins(train: DataFrame, valid: DataFrame, *, label: str, params: dict) -> Bins | None:
    """What boosted fits on these splits read, where the table is large and the parameters let them read cells."""
    n = train.count() if CE.drawable(params) else 0
    return written_bins(train, valid, label=label, rows=n) if n >= CE.LEAST_ROWS else None


def train_model(train: DataFrame, valid: DataFrame, *, label: str, learner: str = "gbt",
                rounds: int = 20, seed: int | None = 42, patience: int | None = None,
                params: dict | None = None, path: str | None = None, bins: Bins | None = None) -> FitResult:
    """M1: fit on assembled ``train``, score on assembled ``valid``.

    For GBT: ``patience`` (e.g. from X8) applies W4 with use-best-model and ends the fit when it
    applies; ``None`` keeps the best of all rounds. Up to one block of rounds is fitted whole and
    cut, with the same result but for the trees' random samples. Fits on a large table read its cells
    (``boost.boost_cells``), which ``bins`` may have ready. ``path`` is the folder of a fit
    with a patience, from which an interrupted one goes on; that reads rows, and its first block is fitted
    in one go on a large table.
    """
    params = dict(params or {})
    if learner == "gbt" and path is None and CE.drawable(params):
        with scratch_scope(train.sparkSession):
            own = bins or large_bins(train, valid, label=label, params=params)
            if own is not None:
                res = boost_cells(own, label=label, rounds=rounds, seed=seed or 0, params=params, patience=patience)
                m = score(res.model.transform(valid), label)
                return FitResult(learner, seed, rounds, res.best_iter, m["rmse"], m["r2"], m["n"], res.model, res.curve, res.stop_iter)
    if learner == "gbt" and patience is not None and (rounds > BLOCK or path is not None):
        step = params.pop("stepSize", 0.1)
        res = boost(train, valid, label=label, learner=Trees(step, **params), rounds=rounds, patience=patience, seed=seed or 0, path=path,
                    first=BLOCK if train.count() >= CE.LEAST_ROWS else 0)
        m = score(res.model.transform(valid), label)
        return FitResult(learner, seed, rounds, res.best_iter, m["rmse"], m["r2"], m["n"], res.model, res.curve, res.stop_iter)
    if learner == "gbt":
        params.setdefault("maxIter", rounds)
    model = make_learner(learner, label=label, seed=seed, **params).fit(train)
    if learner == "gbt":
        curve = learning_curve(model, valid)
        best, stop = best_iteration(curve, patience)
        model = first_k_model(model, best)
        m = score(model.transform(valid), label)
        return FitResult(learner, seed, rounds, best, m["rmse"], m["r2"], m["n"], model, curve, stop)
    m = score(model.transform(valid), label)
    return FitResult(learner, seed, None, None, m["rmse"], m["r2"], m["n"], model)


def feature_importance(model, features: Sequence[str]) -> list[tuple[str, float]]:
    """M9: (feature, importance) for tree models, sorted by importance (desc)."""
    imp = model.featureImportances.toArray().tolist()
    return sorted(zip(features, imp), key=lambda t: (-t[1], t[0]))


def save_model(model, path: str) -> str:
    """Persist a fitted model (Spark ML format)."""
    model.write().overwrite().save(path)
    return path


def results_frame(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """Driver-side result rows (one per fit) as a DataFrame."""
    names = [f.split()[0] for f in schema.split(",")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)
