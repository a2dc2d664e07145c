"""Prediction with saved models.

A model directory holds a Spark ML model; a registry row ``(model, path,
features, status, rmse)`` says where it is and what it needs. Everything that can
be wrong with a model (it doesn't load, the table lacks a feature, no model is
left) raises before a pixel is read. The k models of an ensemble score one scan as
k columns, whose mean corrects the surface; tiles leave as block tables, and
tiles whose blocks exist are skipped.
"""

from __future__ import annotations

import importlib
import json
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, IllegalArgumentException, SparkRuntimeException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.ml.train import FEATURES_COL, assemble
from tessera.operators.clean import corrected_surface
from tessera.operators.metrics import ensemble_mean_wide, leaderboard
from tessera.sources.catalog import discover_files, skip_existing
from tessera.sources.raster import grid_check
from tessera.sources.sinks import pixel_blocks, write_blocks

REGISTRY = "model string, path string, features array<string>, status int, rmse double"


#: What Spark says of files that are missing, empty or damaged, as against a job that failed.
BROKEN_FILES = ["FAILED_READ_FILE", "CANNOT_READ_FILE_FOOTER", "is not a Parquet file", "FileNotFoundException", "InvalidInputException",
                "PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "requirement failed", "empty collection", "ParseException", "MappingException"]


def saved_models(spark: SparkSession, root: str, ending: str = "_model") -> DataFrame:
    """(model, path) of the model directories below ``root``, by their metadata files; no content is read."""
    files = discover_files(spark, root, "part-*", recursive=True)
    path = F.regexp_extract("path", f"^(.*/[^/]*{ending})/metadata/[^/]+$", 1)
    return (files.select(path.alias("path")).where("path <> ''").distinct()
            .select(F.element_at(F.split("path", "/"), -1).alias("model"), "path"))


def load_model(spark: SparkSession, path: str):
    """Load whatever learner was saved; a directory that holds no readable model raises ValueError.

    Only what a broken directory causes says so: missing or unreadable files and a description without
    a known class. A job that fails for another reason (a lost executor) fails here, too.
    """
    try:
        meta = json.loads(spark.read.text(f"{path}/metadata").first()[0])
        package, _, name = meta["class"].rpartition(".")
        module = importlib.import_module(package.replace("org.apache.spark.ml", "pyspark.ml"))
        return getattr(module, name).load(path)
    except (AnalysisException, IllegalArgumentException, ImportError, AttributeError, KeyError, TypeError, ValueError) as e:
        raise ValueError(f"no model can be loaded from {path}") from e
    except (Py4JJavaError, SparkRuntimeException) as e:
        if any(sign in str(e) for sign in BROKEN_FILES):
            raise ValueError(f"no model can be loaded from {path}") from e
        raise


def usable(registry: DataFrame) -> DataFrame:
    """Registry rows of finished models."""
    return registry.where(F.col("status") == 1)


def check_features(columns: Sequence[str], features: Sequence[str], model: str) -> None:
    """P10: the schema must have every feature; no row is read."""
    missing = [f for f in features if f not in columns]
    if missing:
        raise ValueError(f"model {model} needs the column(s) {missing}")


def try_models(spark: SparkSession, models: DataFrame) -> DataFrame:
    """(model, path, status, reason), status 1 for a directory whose model loads.

    One try per model, not per row of data.
    """
    rows = []
    for r in models.select("model", "path").collect():
        try:
            load_model(spark, r.path)
            rows.append((r.model, r.path, 1, None))
        except ValueError as e:
            rows.append((r.model, r.path, 0, str(e)))
    return spark.createDataFrame(rows, "model string, path string, status int, reason string")


def pick(registry: DataFrame, best: int | None = None) -> list:
    """The usable registry rows, the ``best`` ones of the leaderboard; none left raises."""
    rows = leaderboard(usable(registry)).orderBy("rank", "model")
    rows = (rows if best is None else rows.limit(best)).collect()
    if not rows:
        raise ValueError("the leaderboard has no usable model")
    return rows


def predict_columns(df: DataFrame, registry_rows: Sequence, prefix: str = "p_") -> tuple[DataFrame, list[str]]:
    """R2: every model's prediction as a column of one scan; models load and fit the schema first."""
    spark, out, names = df.sparkSession, df, []
    models = []
    for r in registry_rows:
        check_features(df.columns, r.features, r.model)
        models.append((r, load_model(spark, r.path)))
    for i, (r, model) in enumerate(models):
        name = f"{prefix}{i}"
        out = assemble(out, r.features, out=FEATURES_COL)
        out = model.setFeaturesCol(FEATURES_COL).setPredictionCol(name).transform(out).drop(FEATURES_COL)
        names.append(name)
    return out, names


def predict_surface(df: DataFrame, registry: DataFrame, *, target: str, best: int | None = None,
                    out: str = "ml_zdif", surface: str = "ml_edem") -> DataFrame:
    """R1/R2/R4/R5 + P5: mean of the picked models, and the corrected surface."""
    scored, names = predict_columns(df, pick(registry, best))
    return corrected_surface(ensemble_mean_wide(scored, names, out=out), target, out, surface).drop(*names)


def predict_tiles(df: DataFrame, grid: DataFrame, registry: DataFrame, path: str, *, target: str, best: int | None = None,
                  block: int = 256, tile: str = "tile", idx: str = "pixel_idx", done: DataFrame | None = None) -> DataFrame:
    """Predict the tiles that aren't ``done`` (S12), check them against the grid (P8), write blocks.

    Returns the grid check; a tile with the wrong number of pixels raises before anything is written.
    """
    todo = df if done is None else skip_existing(df, done, key=tile)
    check = grid_check(todo, grid if done is None else skip_existing(grid, done, key=tile), tile=tile)
    wrong = check.where("NOT ok").limit(5).collect()
    if wrong:
        raise ValueError("pixels don't fill the grid of " + ", ".join(f"{r[tile]} ({r.n} of {r.expected})" for r in wrong))
    surface = predict_surface(todo, registry, target=target, best=best)
    sized = surface.join(grid.select(tile, "width", "height"), tile)
    write_blocks(pixel_blocks(sized, width="width", height="height", block=block, value="ml_edem", tile=tile, idx=idx), path, tile=tile)
    return check
