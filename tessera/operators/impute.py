"""Imputation: global mean/mode (I1), per-tile means (I2), preprocess chain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import INTEGRAL_TYPES, NUMERIC_TYPES, require_columns
from tessera.operators.clean import assign_nulls
from tessera.operators.neighbour import neighbour_fill
from tessera.session import join_null_safe, materialize, small_side


def fill_statistics(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One-row frame of fill values: mean for numeric columns, mode otherwise.

    Means are one aggregate (partial aggregation on the map side). Modes avoid
    Spark's ``mode`` aggregate, which merges a count for every distinct value in
    one task: all non-numeric columns are stacked as ``(column, value)`` pairs and
    counted with one shuffle by value, then each column keeps its most frequent
    value through a fixed-size ``min_by``. Ties of the mode go to the smallest
    value; an all-null column gives null.
    """
    cols = list(cols or df.columns)
    numeric = [c for c in cols if isinstance(df.schema[c].dataType, NUMERIC_TYPES)]
    other = [c for c in cols if c not in numeric]
    rows = []
    if numeric or not other:
        rows.append(df.agg(*[F.avg(F.col(c)).alias(c) for c in numeric]))
    if other:
        pairs = F.array(*[F.struct(F.lit(c).alias("_col"), F.col(c).cast("string").alias("_val")) for c in other])
        stacked = df.select(F.explode(pairs).alias("_kv")).select("_kv._col", "_kv._val") \
            .where(F.col("_val").isNotNull())
        counts = stacked.groupBy("_col", "_val").agg(F.count(F.lit(1)).alias("_n"))
        modes = counts.groupBy("_col").agg(
            F.min_by(F.col("_val"), F.struct((-F.col("_n")).alias("_k"), F.col("_val"))).alias("_mode"))
        rows.append(modes.agg(*[F.max(F.when(F.col("_col") == F.lit(c), F.col("_mode")))
                                .cast(df.schema[c].dataType).alias(c) for c in other]))
    stats = rows[0] if len(rows) == 1 else rows[0].crossJoin(rows[1])  # one row each
    return stats.select(*cols)


def _filled(df: DataFrame, cols: Sequence[str], stats_prefix: str = "_fill_") -> list:
    out = []
    for name in df.columns:
        if name in cols:
            dt = df.schema[name].dataType
            c = F.col(name).cast("double") if isinstance(dt, INTEGRAL_TYPES) else F.col(name)
            fill = F.col(stats_prefix + name)
            out.append(F.coalesce(c, fill.cast(c_type(dt))).alias(name))
        else:
            out.append(F.col(name))
    return out


def c_type(dt) -> str:
    return "double" if isinstance(dt, INTEGRAL_TYPES) else dt.simpleString()


def fill_nulls(df: DataFrame, cols: Sequence[str] | None = None, *,
               exclude: Sequence[str] = ()) -> DataFrame:
    """Fill every column (or ``cols``) over the whole frame.

    Numeric columns get their mean (integral columns become double, as a
    pandas integer column with missing values does); other columns get their
    mode. Columns without nulls keep their values. The statistics row is one
    row, so the cross join is a broadcast of a fixed-size frame.
    """
    cols = [c for c in (cols or df.columns) if c not in exclude]
    require_columns(df, cols)
    if not cols:
        return df
    stats = fill_statistics(df, cols)
    stats = stats.select(*[F.col(c).alias("_fill_" + c) for c in cols])
    joined = df.crossJoin(F.broadcast(stats))
    return joined.select(*_filled(df, cols))


def fill_per_tile(df: DataFrame, cols: Sequence[str], *, tile: str = "tile") -> DataFrame:
    """Fill numeric ``cols`` with the mean of their own tile.

    Statistics are one aggregate grouped by tile (partial aggregation before
    the shuffle), joined back on the tile key; no window holds a whole tile.
    The statistics have one row per tile; they are broadcast if their counted
    rows allow it, so a hot tile doesn't land in one join task.
    """
    require_columns(df, [tile, *cols])
    stats = df.groupBy(tile).agg(*[F.avg(F.col(c)).alias("_fill_" + c) for c in cols])
    joined = join_null_safe(df, small_side(stats, "tile_means"), [tile], "left")
    return joined.select(*_filled(df, cols))


def preprocess_chain(df: DataFrame, *, lval: float, hval: float, fill_groups: Sequence[Sequence[str]],
                     key: str = "pixel_idx", tile: str = "tile", exclude: Sequence[str] = (),
                     final: str = "fill", block: int | str | None = "auto") -> DataFrame:
    """P2 -> W1 on each group of columns -> I1 (or drop nulls with ``final='drop:<col>'``)."""
    out = assign_nulls(df, lval, hval, exclude=[key, tile, *exclude])
    flat = [c for cols in fill_groups for c in cols]
    if len(flat) == len(set(flat)):
        # disjoint groups fill independently: one pass (one shuffle and sort) for all
        out = neighbour_fill(out, flat, key=key, tile=tile, block=block)
    else:
        for cols in fill_groups:
            out = neighbour_fill(out, list(cols), key=key, tile=tile, block=block)
    if final == "fill":
        # written once: the fill statistics and the filled rows both read the neighbour fill
        out = materialize(out, "neighbour_filled")
        return fill_nulls(out, exclude=[key, tile, *exclude])
    if final.startswith("drop:"):
        col = final.split(":", 1)[1]
        require_columns(out, [col])
        return out.where(F.col(col).isNotNull())
    raise ValueError(f"Unknown final step '{final}'.")
