"""Masking, dropping, labelling and profiling of pixel tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import numeric_columns, require_columns

# Fixed values of the reference: sentinel for "no data" and the default valid
# ranges of the two masking functions.
SENTINEL = -9999
ENCODE_RANGE = (-40, 1000)
ASSIGN_RANGE = (-50, 10000)


def in_range(c: Column, lval: float, hval: float, *, sentinel: float | None = SENTINEL) -> Column:
    """True where the value is kept by P1: not the sentinel and inside [lval, hval]."""
    cond = c.between(F.lit(lval), F.lit(hval))
    if sentinel is not None:
        cond = cond & (c != F.lit(sentinel))
    return cond


def encode_nulls_bycol(df: DataFrame, col: str, lval: float = ENCODE_RANGE[0],
                       hval: float = ENCODE_RANGE[1]) -> DataFrame:
    """Sentinel -> null, then values outside [lval, hval] -> null (bounds kept)."""
    require_columns(df, [col])
    c = F.col(col)
    return df.withColumn(col, F.when(in_range(c, lval, hval), c))


def assign_nulls(df: DataFrame, lval: float = ASSIGN_RANGE[0], hval: float = ASSIGN_RANGE[1],
                 *, exclude: Sequence[str] = ()) -> DataFrame:
    """Every numeric column outside [lval, hval] -> null (covers -inf and +inf).

    Key columns are listed in ``exclude``; non-numeric columns are left alone
    (the reference raises on them).
    """
    targets = set(numeric_columns(df, exclude=exclude))
    return df.select(*[F.when(F.col(n).between(F.lit(lval), F.lit(hval)), F.col(n)).alias(n)
                       if n in targets else F.col(n) for n in df.columns])


def dropnulls_bycol(df: DataFrame, col: str) -> DataFrame:
    """Drop rows where ``col`` is null; error if the column is absent."""
    require_columns(df, [col])
    return df.where(F.col(col).isNotNull())


def clean_filter(df: DataFrame, cols: Sequence[str], lval: float = ENCODE_RANGE[0],
                 hval: float = ENCODE_RANGE[1]) -> DataFrame:
    """P1 followed by P3 on each column, written as one filter on the raw columns.

    Equivalent to encode-then-drop, but the predicate reaches the Parquet scan
    (PushedFilters) instead of running after a full read.
    """
    require_columns(df, cols)
    cond = None
    for c in cols:
        one = in_range(F.col(c), lval, hval)
        cond = one if cond is None else cond & one
    return df.where(cond)


def target_difference(df: DataFrame, tcol: str, rcol: str, yvar: str = "zdif") -> DataFrame:
    """label = tcol - rcol."""
    require_columns(df, [tcol, rcol])
    return df.withColumn(yvar, F.col(tcol) - F.col(rcol))


def corrected_surface(df: DataFrame, tcol: str, pred: str, out: str | None = None) -> DataFrame:
    """P5: ml_tcol = tcol - predicted error (null if either is null)."""
    require_columns(df, [tcol, pred])
    return df.withColumn(out or f"ml_{tcol}", F.col(tcol) - F.col(pred))


def harmonise_roi(df: DataFrame, *, roi_col: str = "roi", substitute: Mapping[str, str],
                  ref: str = "ldem", alt: str = "pdem") -> DataFrame:
    """Regions listed in ``substitute`` take their reference from ``alt``.

    One pass instead of per-region drop/rename/union: ``ref`` becomes ``alt`` for
    those regions, ``alt`` is dropped, rows without a reference are removed.
    """
    require_columns(df, [roi_col, ref, alt])
    regions = list(substitute)
    merged = F.when(F.col(roi_col).isin(regions), F.col(alt)).otherwise(F.col(ref))
    return df.withColumn(ref, merged).drop(alt).where(F.col(ref).isNotNull())


def concat_tiles(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate by column name; absent columns become null."""
    if not frames:
        raise ValueError("No frames to concatenate.")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A1: one aggregate pass -> (column_name, n_null)."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).cast("long").alias(c) for c in cols])
    return wide.unpivot([], cols, "column_name", "n_null")


def tile_counts(df: DataFrame, tile: str = "tile") -> DataFrame:
    """A2: rows per tile."""
    return df.groupBy(tile).agg(F.count(F.lit(1)).cast("long").alias("n"))
