"""M0: closed-form least-squares baseline (one feature), global or per group.

Fitting is one aggregate (``regr_slope``/``regr_intercept``); the model is a
frame with one row per group, joined back for prediction. Fit -> predict ->
score is therefore checkable against a SQL oracle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.metrics import rmse_r2_aggs
from tessera.session import join_null_safe, small_side


def fit_baseline(df: DataFrame, *, label: str, feature: str, by: Sequence[str] = ()) -> DataFrame:
    y, x = F.col(label).cast("double"), F.col(feature).cast("double")
    return df.groupBy(*by).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def predict_baseline(df: DataFrame, model: DataFrame, *, feature: str, out: str = "pred",
                     by: Sequence[str] = ()) -> DataFrame:
    """Score rows with a fitted baseline. The model has one row per group, or one row."""
    m = model.select(*by, F.col("slope").alias("_s"), F.col("intercept").alias("_i"))
    # rows of a group without a model keep a null prediction
    joined = join_null_safe(df, small_side(m, "baseline"), by, "left") if by else df.crossJoin(F.broadcast(m))
    return joined.withColumn(out, F.col("_i") + F.col("_s") * F.col(feature).cast("double")).drop("_s", "_i")


def fit_score(train: DataFrame, valid: DataFrame, *, label: str, feature: str,
              by: Sequence[str] = ()) -> DataFrame:
    """Fit on ``train``, score on ``valid`` -> (by..., slope, intercept, n, rmse, r2)."""
    model = fit_baseline(train, label=label, feature=feature, by=by)
    scored = predict_baseline(valid, model, feature=feature, by=by)
    metrics = scored.groupBy(*by).agg(*rmse_r2_aggs(label, "pred"))
    return model.join(metrics, on=list(by), how="inner") if by else model.crossJoin(metrics)
