"""Neighbour fill along the pixel order of each tile.

Reference semantics (an in-place loop over nulls in ascending order): a null
becomes the mean of the previous and the next row that are non-null at that
moment. Earlier fills feed later ones, later rows are still original. The
closed form used here, equal to that loop:

    prev = last non-null value strictly before the row
    next = value of the very next row (NOT the next non-null one)
    v' = v ?? (prev + next) / 2 ?? prev ?? next

A run a, _, _, b becomes a, a, (a+b)/2, b; a leading run only fills its last
cell (with b). Neighbours are 1-D in ``key`` order and cross raster-row ends.

For large tiles the work is split into ``(tile, key div block)`` windows plus
a small per-block summary (last non-null value and first cell of each block,
carried across blocks by a window over the few blocks of a tile), so no task
ever holds a whole 81M-pixel tile. Tiles up to 4M rows use one window per tile,
which is cheaper (one scan, one shuffle); ``block="auto"`` picks per call.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.columns import INTEGRAL_TYPES
from tessera.session import join_null_safe, small_side


def _result(df: DataFrame, name: str):
    """Combine ``_p_<name>``/``_n_<name>`` (previous non-null, next cell) into the filled value."""
    dt = df.schema[name].dataType
    v = F.col(name).cast("double")
    p, n = F.col("_p_" + name).cast("double"), F.col("_n_" + name).cast("double")
    filled = F.coalesce(v, (p + n) / F.lit(2.0), p, n)
    target = "double" if isinstance(dt, INTEGRAL_TYPES) else dt.simpleString()
    return filled.cast(target).alias(name)


DEFAULT_BLOCK = 1 << 16
ONE_LEVEL_MAX_ROWS = 1 << 22  # largest tile sorted as one window partition under "auto"


def neighbour_fill(df: DataFrame, cols: Sequence[str], *, key: str = "pixel_idx",
                   tile: str = "tile", block: int | str | None = "auto", slab: str | None = None) -> DataFrame:
    """W1 on ``cols``. ``block``: "auto" (one small job decides from the largest
    tile), an int (two-level with that block size) or None (one window per tile).
    ``slab`` is a column that holds the blocks already: on a table clustered by
    (tile, slab) the pixels are not shuffled.
    """
    cols = [c for c in cols if c in df.columns]  # unknown columns are ignored
    if not cols:
        return df
    if slab is not None:
        return _two_level(df, cols, key=key, tile=tile, blk=slab)
    if block == "auto":
        largest = df.groupBy(tile).count().agg(F.max("count")).collect()[0][0] or 0
        block = None if largest <= ONE_LEVEL_MAX_ROWS else DEFAULT_BLOCK
    if block is None:
        return _one_level(df, cols, key=key, tile=tile)
    blocked = df.withColumn("_blk", F.floor(F.col(key) / F.lit(block)).cast("long"))
    return _two_level(blocked, cols, key=key, tile=tile, blk="_blk").drop("_blk")


def _one_level(df: DataFrame, cols: list[str], *, key: str, tile: str) -> DataFrame:
    w = Window.partitionBy(tile).orderBy(key)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    # each window function once, as a column; the fill formula then reads the columns
    helpers = []
    for c in cols:
        helpers += [F.last(F.col(c), ignorenulls=True).over(before).alias("_p_" + c),
                    F.lead(F.col(c), 1).over(w).alias("_n_" + c)]
    with_nb = df.select("*", *helpers)
    return with_nb.select(*[_result(df, n) if n in cols else F.col(n) for n in df.columns])


def _two_level(df: DataFrame, cols: list[str], *, key: str, tile: str, blk: str) -> DataFrame:
    # Per block: last non-null value of each column and the (possibly null) first cell.
    summary_aggs = []
    for c in cols:
        summary_aggs.append(F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(key))).alias("_last_" + c))
        # min_by keeps a null value at the smallest key (a null first cell stays null)
        summary_aggs.append(F.min_by(F.col(c), F.col(key)).alias("_first_" + c))
    summary = df.groupBy(tile, blk).agg(*summary_aggs)

    wb = Window.partitionBy(tile).orderBy(blk)
    wb_before = wb.rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(
        tile, blk,
        *[F.last(F.col("_last_" + c), ignorenulls=True).over(wb_before).alias("_in_" + c) for c in cols],
        *[F.lead(F.col("_first_" + c), 1).over(wb).alias("_nx_" + c) for c in cols])

    # one row per block; broadcast if that is few, so that the pixels stay where they are
    joined = join_null_safe(df, small_side(carry, "carry"), [tile, blk], "left")
    w = Window.partitionBy(tile, blk).orderBy(key)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    helpers = [F.lead(F.col(key), 1).over(w).isNull().alias("_is_last")]
    for c in cols:
        helpers += [F.last(F.col(c), ignorenulls=True).over(before).alias("_pb_" + c),
                    F.lead(F.col(c), 1).over(w).alias("_nb_" + c)]
    with_nb = joined.select("*", *helpers)
    with_nb = with_nb.select(
        *df.columns,
        *[F.coalesce(F.col("_pb_" + c), F.col("_in_" + c)).alias("_p_" + c) for c in cols],
        *[F.when(F.col("_is_last"), F.col("_nx_" + c)).otherwise(F.col("_nb_" + c)).alias("_n_" + c)
          for c in cols])
    return with_nb.select(*[_result(df, n) if n in cols else F.col(n) for n in df.columns])
