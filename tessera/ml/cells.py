"""Fits on cells: rows that fall into the same bins of every feature, as one weighted row.

Spark's trees look at a feature only through at most ``maxBins`` bins, and at a cell's rows only
through their number and the sums of their labels and squares. Rows of one cell are never parted by
a split, so their mean label with their number as weight gives the same gains, splits, leaves and
residuals, round after round. k features have at most ``maxBins ** k`` cells, however many rows there
are; where nearly every row has a cell of its own, a fit costs what it costs on rows, and the grouping.

That holds for learners that take every row with weight 1 (no sampling of rows). Where boosting draws
rows for every round, ``drawn`` decides row by row and round by round, in one pass for several rounds,
and leaves the number and the label sum of the drawn rows of each cell (``boost.boost_cells``). The bins are those
that Spark's rule gives for a sample of the rows of the size that Spark itself takes
(all of them up to 10,000), so a fit equals the one on rows but for which rows were sampled.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import materialize

WEIGHT = "_weight"
BINS, SAMPLED = 32, 10_000
#: Rows from which fits read cells; below, grouping costs more than it saves.
LEAST_ROWS = 1_000_000


def thresholds(values: Sequence[float], bins: int = BINS) -> list[float]:
    """Spark's candidate splits of a continuous feature: between all values, or at strides of equal counts."""
    counts: dict[float, int] = {}
    for v in values:
        counts[v] = counts.get(v, 0) + 1
    seen = sorted(counts)
    middles = [(a + b) / 2 for a, b in zip(seen, seen[1:])]
    splits = min(bins, max(1, len(values))) - 1
    if len(middles) <= splits:
        return middles
    stride = len(values) / (splits + 1)
    out, count, target = [], counts[seen[0]], stride
    for v, middle in zip(seen[1:], middles):
        before, count = count, count + counts[v]
        if abs(before - target) < abs(count - target):
            out.append(middle)
            target += stride
    return out


def countable(learner: str, params: dict) -> bool:
    """Whether a fit takes every row once, so that it may read cells."""
    return learner == "gbt" and params.get("subsamplingRate", 1.0) == 1.0 and params.get("maxBins", BINS) == BINS and "weightCol" not in params


def drawable(params: dict) -> bool:
    """Whether a boosted fit may read cells whose rows are drawn anew for every round."""
    whole = countable("gbt", params) or params.get("minInstancesPerNode", 1) == 1  # a share of an unknown number of rows
    return whole and countable("gbt", {k: v for k, v in params.items() if k != "subsamplingRate"}) and "maxIter" not in params


def weighted_params(params: dict, rows: int) -> dict:
    """The parameters for cells: ``minInstancesPerNode`` as a share of the ``rows``, halfway between two counts."""
    out = {**params, "weightCol": WEIGHT}
    least = out.pop("minInstancesPerNode", 1)
    if 2 * least > rows:
        out["maxDepth"] = 0  # no split leaves that many on both sides
    elif least > 1:
        out["minWeightFractionPerNode"] = (least - 0.5) / rows
    return out


@dataclass
class Cells:
    """Both splits with every feature as the number of its bin; ``train`` a row per cell with its mean label and weight."""
    train: DataFrame
    valid: DataFrame
    features: list[str]
    rows: int

    def unpersist(self) -> None:
        self.train.unpersist()
        self.valid.unpersist()


def grid(df: DataFrame, features: Sequence[str], *, rows: int, seed: int = 42) -> list[list[float]]:
    """The thresholds of each feature, from a sample of the size that Spark takes."""
    own = df.select(*[F.col(f).cast("double").alias(f) for f in features])
    some = own if rows <= SAMPLED else own.sample(SAMPLED / rows, seed=seed)
    got = some.collect()  # about SAMPLED rows of k numbers
    return [thresholds([r[i] for r in got]) for i in range(len(features))]


def binned(df: DataFrame, features: Sequence[str], found: list[list[float]]) -> DataFrame:
    """``df`` with every feature as the number of its bin; null or NaN features are an error."""
    # a tree goes left up to and with the threshold, a bucket begins at its lower bound
    splits = [[-math.inf, *[math.nextafter(t, math.inf) for t in own], math.inf] for own in found]
    plain = [i for i, s in enumerate(splits) if len(s) > 2]
    taken, bins = [features[i] for i in plain], [f"_bin_{i}" for i in plain]
    df = df.select(*[c for c in df.columns if c not in features],
                   *[F.coalesce(F.col(f).cast("double"), F.raise_error(F.lit(f"{f} is null")).cast("double")).alias(f) for f in features])
    if taken:
        df = Bucketizer(inputCols=taken, outputCols=bins, splitsArray=[splits[i] for i in plain], handleInvalid="error").transform(df)
    return df.select(*[c for c in df.columns if c not in features and c not in bins],
                     # numbers in order: without the description that would make them categories
                     *[F.col(f"_bin_{i}").alias(f, metadata={}) if i in plain else F.lit(0.0).alias(f) for i, f in enumerate(features)])


def given(label: str) -> Column:
    """The label as a number; null is an error."""
    return F.coalesce(F.col(label).cast("double"), F.raise_error(F.lit(f"{label} is null")).cast("double")).alias(label)


def cells(train: DataFrame, valid: DataFrame, features: Sequence[str], *, label: str, rows: int, seed: int = 42) -> Cells:
    """Cells of the scalar columns ``features``; null or NaN features or labels are an error, as in a fit on rows."""
    features = list(features)
    found = grid(train, features, rows=rows, seed=seed)
    grouped = binned(train.select(*features, given(label)), features, found).groupBy(*features).agg(
        F.avg(label).alias(label), F.count(F.lit(1)).cast("double").alias(WEIGHT))
    parts = max(train.sparkSession.sparkContext.defaultParallelism, 1)
    small = materialize(grouped.repartition(parts), "cells").persist()
    held = binned(valid.select(*features, label), features, found).withColumn(WEIGHT, F.lit(1.0))
    return Cells(small, held.persist(), features, rows)


def scalars(df: DataFrame, vector: str, *, label: str) -> tuple[DataFrame, list[str]]:
    """An assembled table's label and features as columns of their own, and the features' names there."""
    names = [f"_x{i}" for i in range(len(df.select(vector).first()[0]))]
    return df.select(label, vector_to_array(vector).alias("_v")).select(label, *[F.col("_v")[i].alias(x) for i, x in enumerate(names)]), names


def drawn(df: DataFrame, features: Sequence[str], *, label: str, numbers: Sequence[int], rate: float, seed: int) -> DataFrame:
    """A row per cell of a binned table, with the number ``_n{i}`` and label sum ``_y{i}`` of the rows that round i draws.

    Every row is drawn or not for each round on its own, with the chance ``rate``; one pass draws for all ``numbers``.
    """
    taken = [F.col(label) if rate >= 1 else F.when(F.rand(seed * 7919 + i) < rate, F.col(label)) for i in numbers]
    return (df.select(*features, *[t.alias(f"_y{i}") for i, t in zip(numbers, taken)]).groupBy(*features)
            .agg(*[F.count(f"_y{i}").cast("double").alias(f"_n{i}") for i in numbers], *[F.sum(f"_y{i}").alias(f"_y{i}") for i in numbers]))


def on_rows(nodes: DataFrame, found: list[list[float]]) -> DataFrame:
    """Saved nodes of trees that were fitted on bins, with the features' own thresholds."""
    table = F.array(*[F.array(*[F.lit(t) for t in own]).cast("array<double>") for own in found])
    split = F.col("nodeData.split")
    own = F.element_at(F.element_at(table, split["featureIndex"] + 1), F.floor(split["leftCategoriesOrThreshold"][0]).cast("int") + 1)
    return nodes.withColumn("nodeData", F.when(split["featureIndex"] < 0, F.col("nodeData")).otherwise(
        F.col("nodeData").withField("split.leftCategoriesOrThreshold", F.array(own))))
