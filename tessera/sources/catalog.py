"""File catalogue operators.

A catalogue is a DataFrame ``(res, tile, path)`` of raster files; listings,
pairings and exclusions are joins on ``tile``, never list positions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.paths import output_path, tile_parquet_path, variable_name

REFERENCE_SUFFIX = "edem_W84.tif"  # fixed value: the raster every tile must have once


def discover_files(spark: SparkSession, root: str, pattern: str = "*.parquet",
                   recursive: bool = False) -> DataFrame:
    """S3: list files under ``root`` matching ``pattern`` -> (path, length).

    Only metadata columns are selected, so no file content is read.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.load(root).select("path", "length")


def tile_catalog(cat: DataFrame, *, root: str, suffix: str = "_byldem.parquet") -> DataFrame:
    """Per tile its Parquet path and raster count -> (res, tile, fparquet, n_files)."""
    per_tile = cat.groupBy("res", "tile").agg(F.count(F.lit(1)).cast("long").alias("n_files"))
    return per_tile.select("res", "tile", tile_parquet_path(root, F.col("res"), F.col("tile"), suffix)
                           .alias("fparquet"), "n_files")


def union_catalogs(parts: Sequence[DataFrame], *, distinct: bool = False) -> DataFrame:
    """Several listings as one catalogue, columns matched by name; a path listed twice stays twice, or once if ``distinct``."""
    out = parts[0].select("res", "tile", "path")
    for p in parts[1:]:
        out = out.unionByName(p.select("res", "tile", "path"))
    return out.distinct() if distinct else out


def rasters_by_tile(cat: DataFrame) -> DataFrame:
    """Rasters of each tile as a sorted list (bounded by bands per tile)."""
    return cat.groupBy("res", "tile").agg(F.array_sort(F.collect_list("path")).alias("paths"))


def suffix_filter(paths: DataFrame, suffixes: Sequence[str], *, path: str = "path") -> DataFrame:
    """Keep paths ending with any suffix -> (pos, path...).

    A path matching two suffixes appears twice; order is suffix-major (by pos).
    The suffix list is a user parameter of a handful of entries: broadcast.
    """
    spark = paths.sparkSession
    sfx = spark.createDataFrame(list(enumerate(suffixes)), "pos int, ending string")
    return (paths.join(F.broadcast(sfx), F.col(path).endswith(F.col("ending")), "inner")
            .drop("ending"))


def reference_file_check(cat: DataFrame, suffix: str = REFERENCE_SUFFIX) -> DataFrame:
    """Per tile, how many rasters end with ``suffix`` and the path if exactly one."""
    hit = F.col("path").endswith(F.lit(suffix))
    agg = cat.groupBy("tile").agg(F.count(F.when(hit, 1)).cast("long").alias("n_match"),
                                  F.min(F.when(hit, F.col("path"))).alias("_p"))
    return agg.select("tile", "n_match", F.when(F.col("n_match") == 1, F.col("_p")).alias("path"))


def pair_files(tiles: DataFrame, cat: DataFrame) -> DataFrame:
    """Pair every tile's Parquet path with its rasters by key, not by position."""
    return tiles.select("tile", "fparquet").join(cat.select("tile", "path"), on="tile", how="inner")


def skip_existing(todo: DataFrame, done: DataFrame, key: str = "tile") -> DataFrame:
    """Work items whose output already exists are dropped (left anti join)."""
    return todo.join(done.select(key).distinct(), on=key, how="left_anti")


def model_files(files: DataFrame, *, path: str = "path", ending: str = "_model.txt") -> DataFrame:
    """Model artefacts are files whose name ends with ``_model.txt``."""
    return files.where(F.col(path).endswith(F.lit(ending)))


def variable_names(cat: DataFrame) -> DataFrame:
    """X3 on every catalogue row -> (tile, path, var)."""
    return cat.select("tile", "path", variable_name(F.col("path"), F.col("tile"), F.col("res")).alias("var"))


def output_paths(cat: DataFrame, outdir: str, suffix: str = REFERENCE_SUFFIX) -> DataFrame:
    """Output raster path of each tile's reference raster."""
    ref = cat.where(F.col("path").endswith(F.lit(suffix)))
    return ref.select("tile", output_path(outdir, F.col("path")).alias("out_path"))
