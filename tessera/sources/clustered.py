"""Tile tables clustered by (tile, slab): per-tile work without shuffling pixels again.

A slab is a run of ``block`` pixels of a tile. The table is bucketed by (tile, slab) and sorted by
pixel inside a bucket, one file per bucket; Spark knows that from the catalog, so windows and
aggregates whose keys contain (tile, slab) need no exchange of pixels. What crosses slabs (W1's
carry, a tile's means) is a table of a row per slab or tile. Where a slab is a whole number of
raster lines and as many as a block is high, lines and blocks are made in place, too.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import materialize, scratch_path

SLAB = "slab"


def write_clustered(df: DataFrame, path: str, *, block: int, buckets: int, tile: str = "tile", key: str = "pixel_idx",
                    name: str | None = None) -> str:
    """Write ``df`` with its ``slab`` column below ``path`` as a bucketed table; returns the table's name in the catalog.

    Rows are dealt by the buckets' own hash, so each task writes one file.
    """
    name = name or f"tiles_{uuid.uuid4().hex[:12]}"
    slabbed = df.withColumn(SLAB, F.floor(F.col(key) / F.lit(block)).cast("long"))
    (slabbed.repartition(buckets, tile, SLAB).write.mode("overwrite").bucketBy(buckets, tile, SLAB).sortBy(tile, SLAB, key)
     .option("path", path).saveAsTable(name))
    return name


def read_clustered(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def footer_counts(spark: SparkSession, path: str, *, tile: str = "tile", key: str = "pixel_idx") -> DataFrame:
    """A2 without a scan: ``tile, n, first, last`` (rows, least and greatest key) of a table partitioned by tile.

    The aggregate is pushed into the Parquet source, which answers it from row group statistics.
    """
    own = spark.newSession()  # the source's settings hold for this read only
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    counts = footer_plan(own, path, tile=tile, key=key)
    out = scratch_path(spark, "footer_counts")
    counts.write.parquet(out)
    return spark.read.schema(counts.schema).parquet(out)


def footer_plan(own: SparkSession, path: str, *, tile: str, key: str) -> DataFrame:
    return own.read.parquet(path).groupBy(tile).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("first"), F.max(key).alias("last"))


def tile_sketches(df: DataFrame, cols: list[str], *, tile: str = "tile", k: int = 800) -> DataFrame:
    """A6 once for all questions: written table ``tile, column, n, sketch`` of mergeable quantile sketches.

    One pass; a sketch has a bounded size, whatever the tile's. Nulls take no part.
    """
    aggs = []
    for c in cols:
        value = F.col(c).cast("double")
        aggs += [F.count(value).alias(f"_n_{c}"), F.kll_sketch_agg_double(value, F.lit(k)).alias(f"_s_{c}")]
    wide = df.groupBy(tile).agg(*aggs)
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_n_{c}").alias("n"), F.col(f"_s_{c}").alias("sketch")) for c in cols]))
    return materialize(wide.select(tile, each.alias("s")).select(tile, "s.*"), "sketches")


def sketch_bounds(sketches: DataFrame, probs: list[float]) -> DataFrame:
    """``column, n, quantiles``: quantiles over all the tiles of ``sketches`` (filter it first), by merging; no pixel is read."""
    whole = sketches.where("n > 0").groupBy("column").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))
    return whole.select("column", "n", F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(float(p)) for p in probs])).alias("quantiles"))
