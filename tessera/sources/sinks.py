"""Scans and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.columns import nan_to_null


def scan_tiles(spark: SparkSession, paths: Sequence[str], *, columns: Sequence[str] | None = None,
               schema: str | None = None, source_col: str | None = "source_file") -> DataFrame:
    """One multi-file Parquet scan; NaN -> NULL at the source.

    ``columns`` prunes the scan (it reaches ReadSchema); ``source_col`` keeps
    the file each row came from (``_metadata.file_path``) when the tile is not
    a column of the files.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(*paths)
    cols = list(columns) if columns is not None else df.columns
    sel = [F.col(c) for c in cols]
    if source_col:
        sel.append(F.col("_metadata.file_path").alias(source_col))
    return nan_to_null(df.select(*sel))


def write_tiles(df: DataFrame, path: str, *, tile: str = "tile", key: str = "pixel_idx",
                rows_per_task: int = 1 << 22, mode: str = "overwrite",
                partition_by: Sequence[str] | None = None) -> None:
    """One Parquet directory per tile (or per ``partition_by``, e.g. roi/tile).

    Overwrite replaces only the partitions written. Rows are clustered by
    ``(tile, key div rows_per_task)``: each task writes few files per tile, and
    a hot tile (say a third of all rows) is spread over many tasks instead of
    landing in one.
    """
    slab = F.floor(F.col(key) / F.lit(rows_per_task))
    (df.repartition(tile, slab).write.mode(mode)
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(*(partition_by or [tile])).parquet(path))


def write_chunks(df: DataFrame, path: str, *, rows_per_file: int = 100_000,
                 chunk: str | Sequence[str] | None = None) -> None:
    """Files of at most ``rows_per_file`` rows; with ``chunk`` one directory per chunk id (or ids)."""
    w = df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
    if chunk:
        w = w.partitionBy(*([chunk] if isinstance(chunk, str) else chunk))
    w.parquet(path)


def pixel_lines(pixels: DataFrame, *, width: int | str, height: int | str, value: str = "v", tile: str = "tile",
                idx: str = "pixel_idx", slab: str | None = None) -> DataFrame:
    """Pixels -> raster lines (tile, line, height, data array<float>); a group is one line of ``width`` cells.

    A line with missing, repeated or surplus cells raises. ``slab`` is a column that holds whole
    lines of a tile: it stays, and on a table clustered by (tile, slab) nothing is shuffled.
    """
    by = [tile] if slab is None else [tile, slab]
    own = lambda x: (F.lit(x) if isinstance(x, int) else F.col(x)).cast("long")
    cells = pixels.select(*by, own(width).alias("_w"), own(height).alias("height"), F.col(idx).alias("_i"), F.col(value).cast("float").alias("_v"))
    lines = cells.selectExpr(*by, "_w", "height", "_i div _w AS line", "_i % _w AS _i", "_v").groupBy(*by, "line").agg(
        F.max("_w").alias("_w"), F.max("height").alias("height"), F.array_sort(F.collect_list(F.struct("_i", "_v"))).alias("_cells"))
    # sorted places 0, 1, 2, ...: neither a gap nor a repeat
    whole = (F.size("_cells") == F.col("_w")) & F.forall(F.transform("_cells", lambda x, i: x.getField("_i") == i), lambda x: x)
    wrong = F.concat(F.lit("line of "), F.size("_cells").cast("string"), F.lit(" cells, or with repeated ones, where the grid has "),
                     F.col("_w").cast("string"))
    return lines.select(*by, "line", "height", F.when(whole, F.transform("_cells", lambda x: x.getField("_v")))
                        .otherwise(F.raise_error(wrong)).alias("data"))


def line_blocks(lines: DataFrame, *, block: int, tile: str = "tile", line: str = "line", height: int | str = "height",
                data: str = "data", slab: str | None = None) -> DataFrame:
    """Raster lines -> blocks of ``block x block`` cells, ragged at the right/bottom edge.

    -> (tile, brow, bcol, h, w, n, data array<float> row-major). Every line is cut into its blocks'
    pieces, so a block is made of ``block`` rows, not of block^2 cells. A block with missing or
    repeated lines, or lines of unequal length, raises. ``slab`` is a column that holds the block row.
    """
    high = (F.lit(height) if isinstance(height, int) else F.col(height)).cast("long")
    pieces = lines.select(tile, *([] if slab is None else [slab]), F.col(line).cast("long").alias("_l"), high.alias("_h"), F.col(data).alias("_d"),
                          F.explode(F.sequence(F.lit(0), F.floor((F.size(data) - 1) / block).cast("int"))).alias("bcol"))
    cut = pieces.select(tile, (F.floor(F.col("_l") / block) if slab is None else F.col(slab)).alias("brow"), F.col("bcol").cast("long").alias("bcol"), "_l", "_h",
                        F.slice("_d", F.col("bcol") * block + 1, F.lit(block)).alias("_p"))
    agg = cut.groupBy(tile, "brow", "bcol").agg(
        F.max(F.least(F.lit(block).cast("long"), F.col("_h") - F.col("brow") * block)).alias("h"), F.max(F.size("_p")).cast("long").alias("w"),
        F.min(F.size("_p")).alias("_least"), F.count(F.lit(1)).alias("_n"),
        F.array_sort(F.collect_list(F.struct("_l", "_p"))).alias("_pieces"))
    # h sorted line numbers from the first to the last of the block: neither a gap nor a repeat
    in_order = F.forall(F.transform("_pieces", lambda x, i: x.getField("_l") == F.col("brow") * block + i), lambda x: x)
    whole = (F.col("_n") == F.col("h")) & (F.col("_least") == F.col("w")) & in_order
    wrong = F.concat(F.lit("block of "), F.col("_n").cast("string"), F.lit(" lines, or with repeated or unequal ones, where the grid has "),
                     F.col("h").cast("string"))
    return agg.select(tile, "brow", "bcol", "h", "w", (F.col("h") * F.col("w")).alias("n"),
                      F.when(whole, F.flatten(F.transform("_pieces", lambda x: x.getField("_p")))).otherwise(F.raise_error(wrong)).alias("data"))


def pixel_blocks(pixels: DataFrame, *, width: int | str, height: int | str, block: int, value: str = "v",
                 tile: str = "tile", idx: str = "pixel_idx", slab: str | None = None) -> DataFrame:
    """Pixels -> blocks, by way of raster lines (``pixel_lines``, ``line_blocks``).

    ``width`` and ``height`` (numbers or columns) are the tile's grid. ``slab``: a column that holds
    the block row, ``pixel_idx div (width * block)``; on a table clustered by it nothing is shuffled.
    """
    lines = pixel_lines(pixels, width=width, height=height, value=value, tile=tile, idx=idx, slab=slab)
    return line_blocks(lines, block=block, tile=tile, slab=slab)


def write_blocks(blocks: DataFrame, path: str, *, tile: str = "tile", dealt: bool = False) -> None:
    """Block table partitioned by tile; a tile's blocks are dealt over tasks by block row, unless they are ``dealt`` so."""
    ((blocks if dealt else blocks.repartition(tile, "brow")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(tile).parquet(path))


def blocks_to_pixels(blocks: DataFrame, *, width: int, block: int, tile: str = "tile",
                     value: str = "v") -> DataFrame:
    """Inverse of ``pixel_blocks`` (used to check round trips)."""
    ex = blocks.select(tile, "brow", "bcol", "w", F.posexplode("data").alias("_i", value))
    r = F.col("brow") * block + F.floor(F.col("_i") / F.col("w"))
    c = F.col("bcol") * block + F.col("_i") % F.col("w")
    return ex.select(tile, (r * width + c).cast("long").alias("pixel_idx"), value)


def append_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Result tables (metrics, importances, leaderboards) are appended, one row per run."""
    df.write.mode("append").format(fmt).save(path)
