"""Scores, learning curves and model tables."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rmse_r2_aggs(label: str, pred: str) -> list[Column]:
    """A7 as aggregate expressions: n, rmse = sqrt(mean((y-p)^2)), r2 = 1 - SSres/SStot.

    SStot is computed as n * var_pop(y); SStot = 0 gives a null r2.
    """
    y, p = F.col(label).cast("double"), F.col(pred).cast("double")
    valid = y.isNotNull() & p.isNotNull()
    err2 = F.when(valid, (y - p) * (y - p))
    yv = F.when(valid, y)
    n = F.count(err2)
    ss_tot = F.var_pop(yv) * n
    return [n.cast("long").alias("n"),
            F.sqrt(F.avg(err2)).alias("rmse"),
            (F.lit(1.0) - F.try_divide(F.sum(err2), F.when(ss_tot > 0, ss_tot))).alias("r2")]


def score(df: DataFrame, label: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(*rmse_r2_aggs(label, pred))


# Fixed values of X8, by number of rounds: (applies from, least patience, share of the rounds).
PATIENCE_RULES = [(0, 20, 0.1), (500, 100, 0.1), (1001, 50, 0.05)]


def early_stopping_rounds(rounds: Column | int) -> Column | int:
    """Patience for a number of boosting rounds; a column gives a column, a number a number."""
    if isinstance(rounds, Column):
        n = rounds.cast("long")
        out = F.lit(None).cast("long")
        for start, least, share in PATIENCE_RULES:
            out = F.when(n >= start, F.greatest(F.lit(least), F.floor(n * F.lit(share))).cast("long")).otherwise(out)
        return out
    _, least, share = [r for r in PATIENCE_RULES if rounds >= r[0]][-1]
    return max(least, int(rounds * share))


def best_iteration(curve: Sequence[float], patience: int | None) -> tuple[int, int | None]:
    """W4 on a driver-side curve (one value per round): (best iteration, stop iteration).

    Iterations are 1-based. ``patience=None`` means no early stopping; an empty curve has best iteration 0.
    """
    best_i, best_v, stop = 0, math.inf, None
    for i, v in enumerate(curve, start=1):
        if v < best_v:
            best_i, best_v = i, v
        if patience is not None and i - best_i >= patience:
            stop = i
            break
    return best_i, stop


def patience_stop(curve: DataFrame, patience: int | Column, *, run: Sequence[str] = ("run",),
                  iteration: str = "iteration", metric: str = "rmse") -> DataFrame:
    """W4 + A9: best iteration under patience early stopping (use_best_model).

    Training stops at the first iteration i with i - argmin_{j<=i} >= patience;
    the best iteration is the argmin (earliest on ties) up to there, or over
    the whole curve if it never stops. A curve has one row per boosting round
    (bounded by the round count), so one window per run is fine.
    """
    run = list(run)
    pat = patience if isinstance(patience, Column) else F.lit(patience)
    w = Window.partitionBy(*run).orderBy(iteration).rowsBetween(Window.unboundedPreceding, 0)
    best_so_far = F.min(F.struct(F.col(metric).alias("m"), F.col(iteration).alias("i"))).over(w)
    walked = curve.where(F.col(metric).isNotNull()).withColumn("_best", best_so_far.getField("i"))
    stops = walked.where(F.col(iteration) - F.col("_best") >= pat)
    first_stop = stops.groupBy(*run).agg(F.min_by(F.col("_best"), F.col(iteration)).alias("_stop_best"),
                                          F.min(F.col(iteration)).alias("stop_iteration"))
    overall = walked.groupBy(*run).agg(
        F.min(F.struct(F.col(metric).alias("m"), F.col(iteration).alias("i"))).getField("i").alias("_all_best"))
    return (overall.join(first_stop, on=run, how="left")
            .select(*run, F.coalesce("_stop_best", "_all_best").alias("best_iteration"), "stop_iteration"))


def ensemble_mean_wide(df: DataFrame, pred_cols: Sequence[str], out: str = "ml_zdif") -> DataFrame:
    """A10/R2 when the k model predictions are columns of one scan: no shuffle."""
    total = None
    for c in pred_cols:
        total = F.col(c) if total is None else total + F.col(c)
    return df.withColumn(out, total / F.lit(float(len(pred_cols))))


def ensemble_mean_long(df: DataFrame, *, key: Sequence[str], pred: str = "pred",
                       out: str = "ml_zdif", keep: Sequence[str] = ()) -> DataFrame:
    """A10/R2 over a long (key, model, pred) table: one aggregate per pixel."""
    return df.groupBy(*key).agg(F.avg(pred).alias(out), *[F.first(k).alias(k) for k in keep])


def last_model_wins(df: DataFrame, *, key: Sequence[str], pred: str = "pred", pos: str = "pos",
                    out: str = "ml_zdif") -> DataFrame:
    """Models applied in order overwrite each other, so the last position counts."""
    return df.groupBy(*key).agg(F.max_by(F.col(pred), F.col(pos)).alias(out))


def last_model_wide(df: DataFrame, pred_cols: Sequence[str], out: str = "ml_zdif") -> DataFrame:
    """R3 with the models' predictions as columns, in the order they are applied: the last value counts."""
    return df.withColumn(out, F.coalesce(*[F.col(c) for c in reversed(pred_cols)]))


def leaderboard(scores: DataFrame, *, metric: str = "rmse", model: str = "model") -> DataFrame:
    """Rank models by validation score (ties by name).

    ``scores`` has one row per model, so the un-partitioned window is bounded
    by the number of models, not by the data.
    """
    w = Window.orderBy(F.col(metric), F.col(model))
    return scores.withColumn("rank", F.rank().over(w).cast("long"))
