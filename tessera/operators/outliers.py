"""Outlier removal on one column. Rows whose value is null are dropped.

Each method reduces the column to two bounds (moments or quantiles) and then
filters map-only against them.

Exact quantiles (A6, linear interpolation as pandas / DuckDB ``quantile_cont``)
are computed without Spark's exact ``percentile`` aggregate, which merges a
count for every distinct value into a single task. Instead:

1. one pass: ``count`` and a ``percentile_approx`` bracket ``[q(p - d), q(p + d)]``
   around every wanted probability (redone at higher accuracy only for very
   large tables);
2. one pass without a shuffle counts the rows below and up to the end of each
   bracket, which proves that the order statistics lie in their brackets
   (otherwise a bracket is widened and the pass repeated);
3. one pass tags only the rows in a bracket and counts ``(bracket, value)``: equal
   values are one row, so a value that fills most of the column costs no task
   more than any other. The running count over the distinct values of a bracket
   picks the order statistics.

NaN is a missing value like null: neither takes part.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.columns import require_columns

METHODS = ("zscore", "iqr", "percentile")


BRACKET_ROWS = 100_000  # target rows per bracket (their distinct values are ranked in one task)
MIN_ACCURACY, MAX_ACCURACY = 10_000, 1_000_000


def _present(col: str) -> Column:
    """The value as double; NaN is null."""
    x = F.col(col).cast("double")
    return F.when(~F.isnan(x), x)


def _brackets(x: DataFrame, probs: list[float], margin: float, accuracy: int):
    """One pass: row count and sketch quantiles at ``p - margin`` and ``p + margin``."""
    lo_p = [max(0.0, p - margin) for p in probs]
    hi_p = [min(1.0, p + margin) for p in probs]
    row = x.agg(F.count(F.lit(1)).alias("n"),
                F.percentile_approx("_x", F.array(*[F.lit(q) for q in lo_p + hi_p]), accuracy).alias("q")
                ).collect()[0]
    if row["n"] == 0:
        return 0, [], []
    return row["n"], row["q"][:len(probs)], row["q"][len(probs):]


def _pick(x: DataFrame, lo: list[float], hi: list[float], need: list[tuple[int, int]]):
    """One pass: ``(picked, below, upto)`` of the wanted order statistics.

    ``below``/``upto`` count the rows under ``lo`` and up to ``hi`` of each bracket;
    ``picked`` maps (bracket, rank) to a value, for ranks inside the brackets.
    """
    k = len(lo)
    v = F.col("_x")
    zones = x.agg(*[F.count_if(v < F.lit(lo[i])).alias(f"b{i}") for i in range(k)], *[F.count_if(v <= F.lit(hi[i])).alias(f"u{i}") for i in range(k)]).first()
    below, upto = [zones[f"b{i}"] for i in range(k)], [zones[f"u{i}"] for i in range(k)]
    # only the few rows of the brackets are tagged and shuffled
    inside = [(v >= F.lit(lo[i])) & (v <= F.lit(hi[i])) for i in range(k)]
    tags = F.array_compact(F.array(*[F.when(inside[i], F.lit(i)) for i in range(k)]))
    tagged = x.where(reduce(or_, inside)).select(F.explode(tags).alias("_p"), v.alias("_v"))
    counts = tagged.groupBy("_p", "_v").agg(F.count(F.lit(1)).alias("_c"))
    # distinct values of a bracket, about 2 * margin * n of them at most
    running = F.sum("_c").over(Window.partitionBy("_p").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    ranked = counts.withColumn("_end", running).withColumn("_start", F.col("_end") - F.col("_c"))
    ranks = [(i, r, r - below[i]) for i in range(k) for r in sorted(set(need[i]))]
    wanted = F.array(*[F.struct(F.lit(i).alias("p"), F.lit(r).cast("long").alias("r"), F.lit(d).cast("long").alias("d")) for i, r, d in ranks])
    hits = ranked.select("_v", F.explode(F.filter(wanted, lambda w: (w["p"] == F.col("_p")) & (w["d"] >= F.col("_start"))
                                                  & (w["d"] < F.col("_end")))).alias("w")).collect()
    return {(h["w"]["p"], h["w"]["r"]): h["_v"] for h in hits}, below, upto


def exact_quantiles(df: DataFrame, col: str, probs: list[float], *,
                    accuracy: int | None = None) -> list[float | None]:
    """Exact linear-interpolation quantiles of ``col`` (nulls ignored).

    The sketch accuracy grows with the row count so that a bracket holds about
    ``BRACKET_ROWS`` rows (4n / accuracy), within [1e4, 1e6]: cheap sketches on
    small tables, at most ~4M bracket rows per probability at 10^12 rows. The
    first sketch uses the smallest accuracy and is redone only when the count
    it returns asks for more (over ~250M rows), so smaller tables take three
    passes in all: sketch, prove, pick.
    """
    x = df.select(_present(col).alias("_x")).where(F.col("_x").isNotNull())
    acc = accuracy or MIN_ACCURACY
    n, lo, hi = _brackets(x, probs, 2.0 / acc, acc)
    if n == 0:
        return [None for _ in probs]
    if accuracy is None:
        wanted_acc = int(min(MAX_ACCURACY, max(MIN_ACCURACY, 4 * n // BRACKET_ROWS)))
        if wanted_acc > acc:
            acc = wanted_acc
            n, lo, hi = _brackets(x, probs, 2.0 / acc, acc)
    margin = 2.0 / acc
    # ranks (0-based) of the order statistics each probability needs
    pos = [p * (n - 1) for p in probs]
    need = [(math.floor(h), min(math.floor(h) + 1, n - 1)) for h in pos]
    while True:
        picked, below, upto = _pick(x, lo, hi, need)
        if all(below[i] <= need[i][0] and need[i][1] < upto[i] for i in range(len(probs))):
            break
        margin *= 16  # bracket missed (never expected from the sketch guarantee): widen
        _, lo, hi = _brackets(x, probs, margin, acc)
    out = []
    for i in range(len(probs)):
        a, b = picked[(i, need[i][0])], picked[(i, need[i][1])]
        d = pos[i] - need[i][0]
        out.append(a if (d == 0 or a == b) else a * (1.0 - d) + b * d)
    return out


def _percentile(df: DataFrame, col: str, probs: list[float], exact: bool) -> list[float | None]:
    if exact:
        return exact_quantiles(df, col, probs)
    row = df.agg(F.percentile_approx(_present(col), F.array(*[F.lit(p) for p in probs]), 10000).alias("q")).collect()
    return list(row[0]["q"]) if row[0]["q"] is not None else [None for _ in probs]


def outlier_bounds(df: DataFrame, tcol: str, approach: str = "zscore", threshold: float = 3,
                   lower_percentile: float = 0.05, upper_percentile: float = 0.95,
                   exact: bool = True) -> DataFrame:
    """One row ``(_lo, _hi)`` of inclusive bounds for ``tcol``."""
    require_columns(df, [tcol])
    x = _present(tcol)
    if approach == "zscore":
        stats = df.agg(F.avg(x).alias("_mu"), F.stddev_pop(x).alias("_sd"))
        # |x - mu| / sd <= t  <=>  mu - t*sd <= x <= mu + t*sd  (sd > 0); sd = 0 keeps nothing
        return stats.select(
            F.when(F.col("_sd") > 0, F.col("_mu") - F.lit(threshold) * F.col("_sd")).alias("_lo"),
            F.when(F.col("_sd") > 0, F.col("_mu") + F.lit(threshold) * F.col("_sd")).alias("_hi"),
            F.col("_mu"), F.col("_sd"))
    spark = df.sparkSession
    if approach == "iqr":
        q1, q3 = _percentile(df, tcol, [0.25, 0.75], exact)
        lo = None if q1 is None else q1 - 1.5 * (q3 - q1)
        hi = None if q1 is None else q3 + 1.5 * (q3 - q1)
        return spark.createDataFrame([(lo, hi)], "_lo double, _hi double")
    if approach == "percentile":
        lo, hi = _percentile(df, tcol, [lower_percentile, upper_percentile], exact)
        return spark.createDataFrame([(lo, hi)], "_lo double, _hi double")
    raise ValueError(f"approach is one of {', '.join(METHODS)}, not {approach!r}")


def remove_outlier(df: DataFrame, tcol: str, approach: str = "zscore", threshold: float = 3,
                   lower_percentile: float = 0.05, upper_percentile: float = 0.95,
                   exact: bool = True) -> DataFrame:
    bounds = outlier_bounds(df, tcol, approach, threshold, lower_percentile, upper_percentile, exact)
    x = _present(tcol)
    joined = df.crossJoin(F.broadcast(bounds))
    if approach == "zscore":
        # the z-score itself, as the reference compares it (try_divide: sd = 0 -> null -> dropped)
        keep = F.abs(F.try_divide(x - F.col("_mu"), F.col("_sd"))) <= F.lit(threshold)
    else:
        keep = (x >= F.col("_lo")) & (x <= F.col("_hi"))
    return joined.where(keep).select(*df.columns)
