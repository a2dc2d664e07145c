"""Boosting that stops inside the fit, in blocks of rounds that can be resumed.

A round fits a small learner to what the rounds before leave of the label, adds it to the running
prediction and scores the validation rows; W4's patience rule ends the fit as soon as it applies,
so thousands of rounds are only a bound. Rounds come in blocks. At the end of a block the rows are
written with their running prediction, then its learners' curve; only that last write makes the
block count. A fit that is called again with the same folder goes on behind the last whole block.
Inside a block the running prediction is an expression over the last few learners, kept in memory
every ``CHAIN`` rounds, so a round costs the learner's own passes and one aggregate, and no join. Only
the columns that the learner reads go beyond a fit's first block. Trees can fit their first rounds in one go, which bins
the rows once for all of these rounds; the patience rule then cuts what it wouldn't have fitted.

``boost_cells`` fits on cells instead of rows, also with a patience; it has no blocks to go on from.

With trees and a sampling rate of 1 the model equals Spark's gradient boosting with squared loss
for the same rounds: the first tree has weight 1, later ones are fitted to twice the residual and
have the step as weight. Null labels and features are an error (impute first).
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark.errors import AnalysisException
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.ml import cells as CE
from tessera.operators.metrics import best_iteration, rmse_r2_aggs
from tessera.session import delete_path, materialize, scratch_path, scratch_scope

FEATURES_COL = "features"
#: Rounds of a block.
BLOCK = 25
#: Rounds whose learners the running prediction is computed from before it is kept.
CHAIN = 4
#: Rounds whose rows one pass draws in a fit on cells.
DRAWN = 10
#: Running prediction and fitting target, beside the caller's columns.
RUNNING, TARGET = "_running", "_target"
#: Row count and sum of squared deviations of a validation cell.
_ROWS, _SPREAD = "_rows", "_spread"
_PROGRESS = "block int, round int, rmse double, weight double, settings string"


def stage_path(path: str, number: int) -> str:
    return f"{path}/stages/{number:06d}"


class Trees:
    """Regression trees of Spark ML on an assembled feature vector."""

    def __init__(self, step: float = 0.1, **params):
        self.step, self.params = step, params

    def reads(self) -> list[str]:
        return [FEATURES_COL, *([self.params["weightCol"]] if "weightCol" in self.params else [])]

    def settings(self) -> str:
        return f"trees {self.step} {sorted(self.params.items())}"

    def weight(self, number: int) -> float:
        return 1.0 if number == 1 else self.step

    def target(self, number: int, residual):
        return residual if number == 1 else residual * 2.0

    def start(self, df: DataFrame, rounds: int, seed: int, label: str) -> GBTRegressionModel:
        """The first rounds in one go: the trees, and the random samples, of as many single fits."""
        return GBTRegressor(featuresCol=FEATURES_COL, labelCol=label, maxIter=rounds, stepSize=self.step, seed=seed + 1, **self.params).fit(df)

    def curve(self, model: GBTRegressionModel, valid: DataFrame) -> list[float]:
        """Validation RMSE after each of the model's rounds."""
        return [math.sqrt(x) for x in model.evaluateEachIteration(valid, "squared")]

    def fit(self, df: DataFrame, number: int, seed: int):
        return GBTRegressor(featuresCol=FEATURES_COL, labelCol=TARGET, maxIter=1, seed=seed + number, **self.params).fit(df)

    def add(self, df: DataFrame, stage, weight: float) -> DataFrame:
        one = stage.setPredictionCol("_stage").transform(df)
        return one.withColumn(RUNNING, F.col(RUNNING) + F.lit(weight) * F.col("_stage")).drop("_stage")

    def save(self, spark: SparkSession, stages: list, path: str) -> None:
        """The block's models, one folder each under the number of its first tree, several at a time."""
        with ThreadPool(4) as pool:
            pool.map(lambda s: s[1].write().overwrite().save(stage_path(path, s[0])), stages)

    def model(self, spark: SparkSession, path: str, k: int, label: str, grid: list | None = None, **params) -> GBTRegressionModel:
        """The first k trees as one model, which is below ``path`` and scores with one ``transform``; ``grid``: of trees on bins."""
        number = F.regexp_extract(F.col("_metadata.file_path"), r"/stages/(\d+)/", 1).cast("int")
        nodes = spark.read.parquet(f"{path}/stages/*/data").withColumn("treeID", F.col("treeID") + number - 1)
        trees = spark.read.parquet(f"{path}/stages/*/treesMetadata").withColumn("_1", F.col("_1") + number - 1)
        weight = F.when(F.col("_1") == 0, F.lit(self.weight(1))).otherwise(F.lit(self.weight(2)))
        if grid is not None:
            nodes = CE.on_rows(nodes, grid)
        return write_forest(spark, nodes, trees.withColumn("_3", weight), stage_path(path, 1), f"{path}/model", k, labelCol=label,
                            predictionCol="prediction", **params)


def write_forest(spark: SparkSession, nodes: DataFrame, trees: DataFrame, like: str, out: str, k: int, **params) -> GBTRegressionModel:
    """A boosted model of the first k trees, from node and tree tables in Spark ML's own file format.

    ``like`` is a saved model whose description is taken over, but for ``params`` and the number of trees.
    """
    about = json.loads(spark.read.text(f"{like}/metadata").first()["value"])
    about["paramMap"] |= {"maxIter": k, **params}
    about["numTrees"] = k
    nodes.where(F.col("treeID") < k).select("treeID", "nodeData").write.mode("overwrite").parquet(f"{out}/data")
    trees.where(F.col("_1") < k).select("_1", "_2", "_3").write.mode("overwrite").parquet(f"{out}/treesMetadata")
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.mode("overwrite").text(f"{out}/metadata")
    return GBTRegressionModel.load(out)


class Lines:
    """Least-squares lines on one feature a round, in turn: a learner whose rounds SQL can repeat."""

    def __init__(self, features: Sequence[str], step: float = 0.5):
        self.features, self.step = list(features), step

    def reads(self) -> list[str]:
        return self.features

    def settings(self) -> str:
        return f"lines {self.step} {self.features}"

    def weight(self, number: int) -> float:
        return self.step

    def target(self, number: int, residual):
        return residual

    def fit(self, df: DataFrame, number: int, seed: int):
        feature = self.features[(number - 1) % len(self.features)]
        x, y = F.col(feature).cast("double"), F.col(TARGET)
        got = df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.avg(y).alias("mean")).first()
        flat = got["slope"] is None  # a constant feature has no slope
        return feature, 0.0 if flat else got["slope"], got["mean"] if flat else got["intercept"]

    def add(self, df: DataFrame, stage, weight: float) -> DataFrame:
        feature, slope, intercept = stage
        line = F.lit(intercept) + F.lit(slope) * F.col(feature).cast("double")
        return df.withColumn(RUNNING, F.col(RUNNING) + F.lit(weight) * line)

    def save(self, spark: SparkSession, stages: list, path: str) -> None:
        table = spark.createDataFrame([(number, *stage) for number, stage in stages], "round int, feature string, slope double, intercept double")
        table.coalesce(1).write.mode("overwrite").parquet(stage_path(path, stages[0][0]))

    def model(self, spark: SparkSession, path: str, k: int, label: str) -> DataFrame:
        """Table of the first k lines with their weight."""
        return spark.read.parquet(f"{path}/stages/*").where(F.col("round") <= k).withColumn("weight", F.lit(self.step))


@dataclass
class Boosted:
    """A finished fit: the model up to its best iteration, and how it got there."""
    best_iter: int
    stop_iter: int | None
    curve: list[float]
    model: object = field(repr=False)
    path: str


def _progress(spark: SparkSession, path: str) -> list:
    """What whole blocks have left: one row per round (bounded by the rounds)."""
    try:
        return spark.read.schema(_PROGRESS).parquet(f"{path}/progress").orderBy("round").collect()
    except AnalysisException:
        return []  # nothing there yet


def boost(train: DataFrame, valid: DataFrame, *, label: str, learner, rounds: int, patience: int | None = None,
          seed: int = 42, block: int = BLOCK, path: str | None = None, digits: int | None = None, first: int = 0) -> Boosted:
    """Fit up to ``rounds`` rounds, stop ``patience`` rounds behind the best validation RMSE, keep the best.

    ``path`` is the fit's folder in shared storage; an interrupted fit goes on from there. ``digits``
    rounds the curve before the rule looks at it. ``first``: rounds of a first block that is fitted in
    one go (trees only).
    """
    spark = train.sparkSession
    path = path or scratch_path(spark, "boost")
    settings = f"{label} {learner.settings()} seed {seed} digits {digits}"
    done = _progress(spark, path)
    if done and done[0]["settings"] != settings:
        raise ValueError(f"{path} holds a fit with other settings: {done[0]['settings']}")
    curve = [r["rmse"] for r in done]
    number = max((r["block"] for r in done), default=-1) + 1
    cols = list(dict.fromkeys([label, *learner.reads(), RUNNING]))
    rows = lambda b, part: f"{path}/rows-{b:05d}/{part}"
    parts = {"train": train, "valid": valid}
    if not done:
        for part, df in parts.items():
            df.withColumn(RUNNING, F.lit(0.0)).write.mode("overwrite").parquet(rows(0, part))

    def over() -> bool:
        return len(curve) >= rounds or best_iteration(curve, patience)[1] is not None
    while not over():
        held = {part: spark.read.parquet(rows(number, part)).select(*cols).persist() for part in parts}
        now, new, stages, kept = dict(held), [], [], []
        residual = F.col(label).cast("double") - F.col(RUNNING)
        if first and not curve:
            stage = learner.start(now["train"], min(first, rounds), seed, label)
            stages.append((1, stage))
            now = {part: learner.add(df, stage, 1.0) for part, df in now.items()}
            found = learner.curve(stage, held["valid"])
            curve.extend(found[:best_iteration(found, patience)[1]])  # a stop of None takes all
            new = [(number, i, v, learner.weight(i), settings) for i, v in enumerate(curve, start=1)]
        while not (first and number == 0) and len(new) < block and not over():
            i = len(curve) + 1
            stage = learner.fit(now["train"].withColumn(TARGET, learner.target(i, residual)), i, seed)
            stages.append((i, stage))
            now = {part: learner.add(df, stage, learner.weight(i)) for part, df in now.items()}
            rmse = now["valid"].agg(*rmse_r2_aggs(label, RUNNING)).first()["rmse"]
            curve.append(rmse if digits is None or rmse is None else round(rmse, digits))
            new.append((number, i, curve[-1], learner.weight(i), settings))
            if len(new) % CHAIN == 0 and len(new) < block and not over():
                now, before = {part: df.persist() for part, df in now.items()}, kept
                for df in now.values():
                    df.count()
                for df in before:
                    df.unpersist()
                kept = list(now.values())
        if not over():
            for part, df in now.items():
                df.write.mode("overwrite").parquet(rows(number + 1, part))
        learner.save(spark, stages, path)
        spark.createDataFrame(new, _PROGRESS).coalesce(1).write.mode("overwrite").parquet(f"{path}/progress/block={number}")
        for df in [*held.values(), *kept]:
            df.unpersist()
        delete_path(spark, f"{path}/rows-{number:05d}")
        number += 1
    curve = curve[:rounds]
    best, stop = best_iteration(curve, patience)
    return Boosted(best, stop, curve, learner.model(spark, path, best, label), path)


@dataclass
class Bins:
    """A large table's rows with every feature as the number of its bin, and the cells of its validation rows."""
    train: DataFrame
    valid: DataFrame
    features: list[str]
    grid: list[list[float]]
    rows: int


def bins(train: DataFrame, valid: DataFrame, *, label: str, rows: int) -> Bins:
    """What ``boost_cells`` reads, written once for any number of fits on these assembled splits.

    A validation cell has its mean label, its row count and the sum of its squared deviations, which is all that
    an RMSE needs: the rows of a cell have the same prediction.
    """
    tasks = max(train.sparkSession.sparkContext.defaultParallelism, 1)
    flat, names = CE.scalars(train, FEATURES_COL, label=label)
    grid = CE.grid(flat, names, rows=rows)
    held = materialize(CE.binned(flat.select(*names, CE.given(label)), names, grid).repartition(tasks), "binned")
    other = CE.scalars(valid, FEATURES_COL, label=label)[0]
    cells = CE.binned(other.select(*names, CE.given(label)), names, grid).groupBy(*names).agg(
        F.count(F.lit(1)).cast("double").alias(_ROWS), F.avg(label).alias(label), (F.var_pop(label) * F.count(F.lit(1))).alias(_SPREAD))
    return Bins(held, materialize(cells.repartition(tasks), "valid_cells"), names, grid, rows)


def _curve(scored: DataFrame, label: str, numbers: Sequence[int]) -> list[float]:
    """RMSE over the rows of the validation cells, for each prediction ``_at{i}``."""
    squares = [F.sum(F.col(_SPREAD) + F.col(_ROWS) * (F.col(label) - F.col(f"_at{i}")) ** 2) for i in numbers]
    return list(scored.agg(*[F.sqrt(s / F.sum(_ROWS)).alias(f"_at{i}") for i, s in zip(numbers, squares)]).first())


def boost_cells(own: Bins, *, label: str, rounds: int, seed: int, params: dict, patience: int | None = None) -> Boosted:
    """Spark's gradient boosting with squared loss for up to ``rounds``, on the cells of a large assembled table.

    With a ``subsamplingRate`` every row is drawn or left out for each round, as there; a pass over the
    binned rows draws for ``DRAWN`` rounds. The patience rule is looked at every ``CHAIN`` rounds and cuts what
    went beyond its stop. The trees' thresholds are the features' own again at the end.
    """
    params = dict(params)
    step, rate = params.pop("stepSize", 0.1), params.pop("subsamplingRate", 1.0)
    spark = own.train.sparkSession
    path = scratch_path(spark, "boost_cells")
    tasks = max(spark.sparkContext.defaultParallelism, 1)
    learner = Trees(step, **CE.weighted_params(params, max(1, round(own.rows * rate))))
    names = own.features
    features = VectorAssembler(inputCols=names, outputCol=FEATURES_COL, handleInvalid="error")
    with scratch_scope(spark):
        now, stages, kept, curve = None, [], [], []
        scored = features.transform(own.valid).select(label, _ROWS, _SPREAD, FEATURES_COL, F.lit(0.0).alias(RUNNING)).persist()
        first = scored
        while len(curve) < rounds and best_iteration(curve, patience)[1] is None:
            i = len(stages) + 1
            if (i - 1) % DRAWN == 0:
                numbers = range(i, min(i + DRAWN, rounds + 1))
                new = CE.drawn(own.train, names, label=label, numbers=numbers, rate=rate, seed=seed)
                new = new.withColumn(RUNNING, F.lit(0.0)) if now is None else new.join(now.select(*names, RUNNING), names)
                before, now = kept, features.transform(materialize(new.repartition(tasks), "drawn")).persist()
                kept = [now]
                for df in before:
                    df.unpersist()
            left = F.col(f"_y{i}") / F.col(f"_n{i}") - F.col(RUNNING)
            fitted = now.where(F.col(f"_n{i}") > 0).select(FEATURES_COL, learner.target(i, left).alias(TARGET), F.col(f"_n{i}").alias(CE.WEIGHT))
            stages.append((i, learner.fit(fitted, i, seed)))
            now = learner.add(now, stages[-1][1], learner.weight(i))
            scored = learner.add(scored, stages[-1][1], learner.weight(i)).withColumn(f"_at{i}", F.col(RUNNING))
            if (i - numbers[0] + 1) % CHAIN == 0 or i == numbers[-1]:
                now, scored = now.persist(), scored.persist()
                curve += _curve(scored, label, range(len(curve) + 1, i + 1))
                now.count()
                kept.append(now)
                first.unpersist()
                first, scored = scored, scored.select(*[c for c in scored.columns if not c.startswith("_at")])
        for df in [*kept, first]:
            df.unpersist()
        curve = curve[:best_iteration(curve, patience)[1]]  # a stop of None takes all
        best, stop = best_iteration(curve, patience)
        learner.save(spark, stages[:best], path)
        model = learner.model(spark, path, best, label, own.grid, weightCol="", stepSize=step, subsamplingRate=rate)
    return Boosted(best, stop, curve, model, path)
