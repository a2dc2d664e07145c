"""Raster arrays -> pixel tables.

A raster arrives as a *raster-row table*: one row per raster line,
``(tile, var, band, row, data array<float>)``, so no single row ever holds a
whole 81M-cell band. ``posexplode`` turns it into the long pixel form
``(tile, pixel_idx, name, value)`` with ``pixel_idx = row * width + col``; one
conditional-aggregation pivot (one shuffle for any number of bands) makes the
wide table, one column per band.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import BROADCAST_ROWS, materialize


def raster_to_pixels(rows: DataFrame, *, width: int | str, data: str = "data", row: str = "row",
                     keep: Sequence[str] = ("tile",), value: str = "value") -> DataFrame:
    """Flatten each raster line row-major -> (keep..., pixel_idx, value)."""
    w = F.lit(width) if isinstance(width, int) else F.col(width)
    exploded = rows.select(*keep, F.col(row).alias("_row"), w.alias("_w"),
                           F.posexplode(F.col(data)).alias("_col", value))
    return exploded.select(*keep, (F.col("_row").cast("long") * F.col("_w") + F.col("_col")).alias("pixel_idx"),
                           F.col(value).cast("float").alias(value))


def band_names(long: DataFrame, *, var: str = "var", band: str = "band",
               group: Sequence[str] = ("tile",)) -> DataFrame:
    """A variable with more than one band is named ``{var}_band{b}``, else ``{var}``.

    The band count per (tile, var) is a small aggregate joined back.
    """
    nb = long.groupBy(*group, var).agg(F.countDistinct(band).alias("_nb"))
    named = long.join(nb, on=[*group, var], how="inner")
    name = F.when(F.col("_nb") > 1, F.concat(F.col(var), F.lit("_band"), F.col(band).cast("string"))) \
        .otherwise(F.col(var))
    return named.withColumn("name", name).drop("_nb")


def band_arrays(rows: DataFrame, *, data: str, var: str = "var", group: Sequence[str] = ("tile",),
                keep: Sequence[str] = ()) -> DataFrame:
    """S6 on a raster-line table whose arrays hold one value per band -> (group..., keep..., name, value).

    The number of bands is metadata of the line (its array's size), so the names
    are made before the arrays are exploded: no join of pixel size.
    """
    n = F.size(data)
    one = lambda x, i: F.struct(
        F.when(n > 1, F.concat(F.col(var), F.lit("_band"), (i + 1).cast("string"))).otherwise(F.col(var)).alias("name"),
        x.cast("float").alias("value"))
    return rows.select(*group, *keep, F.explode(F.transform(data, one)).alias("_b")).select(*group, *keep, "_b.name", "_b.value")


def band_columns(rows: DataFrame, *, keys: Sequence[str], data: str, names: Sequence[str]) -> DataFrame:
    """J1 on lines that hold one value per band: one column per name, aligned on ``keys``.

    Nothing is exploded: a line's values become columns. Keys that repeat and lines of another
    length raise; NaN becomes null.
    """
    one = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.first(data).alias("_d"))
    checked = (F.when(F.col("_n") > 1, F.raise_error(F.lit("several lines for the same keys")))
               .when(F.size("_d") != len(names), F.raise_error(F.lit(f"a line without {len(names)} values"))).otherwise(F.col("_d")))
    one = one.select(*keys, checked.alias("_d"))
    value = lambda i: F.col("_d")[i].cast("float")
    return one.select(*keys, *[F.when(~F.isnan(value(i)), value(i)).alias(n) for i, n in enumerate(names)])


def lines_to_columns(rows: DataFrame, *, width: int | str, names: Sequence[str], data: str = "data", row: str = "row",
                     name: str = "name", keep: Sequence[str] = ("tile",)) -> DataFrame:
    """S5 + S6 + J1 in one: raster lines of all bands -> (keep..., pixel_idx, one column per name).

    Lines of the same (keep, row) meet, are zipped cell by cell and exploded once, so what is
    shuffled is one row per line and band, never a cell. A band that a line lacks is null there;
    two lines of one band and lines of unequal length raise; names outside ``names`` are left out.
    """
    w = F.lit(width) if isinstance(width, int) else F.col(width)
    arrays = []
    for i, n in enumerate(names):
        hit = F.col(name) == F.lit(n)
        arrays += [F.count(F.when(hit, 1)).alias(f"_n{i}"), F.first(F.when(hit, F.col(data)), ignorenulls=True).alias(f"_a{i}")]
    met = rows.where(F.col(name).isin(*names)).groupBy(*keep, F.col(row).cast("long").alias("_row"), w.cast("long").alias("_w")).agg(*arrays)
    sizes = F.array_compact(F.array(*[F.when(F.col(f"_a{i}").isNotNull(), F.size(f"_a{i}")) for i in range(len(names))]))
    blank = F.array_repeat(F.lit(None).cast("float"), F.coalesce(F.array_max(sizes), F.lit(0)))
    zipped = F.arrays_zip(*[F.coalesce(F.col(f"_a{i}").cast("array<float>"), blank).alias(f"c{i}") for i in range(len(names))])
    checked = (F.when(F.greatest(*[F.col(f"_n{i}") for i in range(len(names))], F.lit(0)) > 1, F.raise_error(F.lit("duplicate line of a band")))
               .when(F.array_min(sizes) != F.array_max(sizes), F.raise_error(F.lit("lines of unequal length"))).otherwise(zipped))
    cells = met.select(*keep, "_row", "_w", F.posexplode(checked).alias("_col", "_v"))
    value = lambda i: F.col("_v").getField(f"c{i}")
    return cells.select(*keep, (F.col("_row") * F.col("_w") + F.col("_col")).alias("pixel_idx"), *[value(i).alias(n) for i, n in enumerate(names)])


def align_columns(long: DataFrame, *, keys: Sequence[str], names: Sequence[str],
                  name: str = "name", value: str = "value") -> DataFrame:
    """One column per name, aligned on ``keys`` (full-outer semantics).

    Absent cells are null; two values for the same (keys, name) raise an error
    at run time (the check is part of each output column, so it cannot be
    pruned away).
    """
    aggs = []
    for n in names:
        hit = F.col(name) == F.lit(n)
        cnt = F.count(F.when(hit, 1))
        val = F.first(F.when(hit, F.col(value)), ignorenulls=True)
        aggs.append(F.when(cnt <= 1, val)
                    .otherwise(F.raise_error(F.lit(f"duplicate value for column {n}"))).alias(n))
    return long.groupBy(*keys).agg(*aggs)


def nodata_to_null(value: Column, nodata: Column | float | None) -> Column:
    """Value equal to nodata -> null; NaN -> null; undefined nodata replaces nothing."""
    v = value
    keep = ~F.isnan(v.cast("double"))
    if nodata is not None:
        nd = nodata if isinstance(nodata, Column) else F.lit(nodata)
        # a null nodata compares as unknown -> treated as "not nodata"
        keep = keep & F.coalesce(v.cast("double") != nd.cast("double"), F.lit(True))
    return F.when(keep, v)


def grid_check(pixels: DataFrame, grid: DataFrame, *, tile: str = "tile", counts: DataFrame | None = None) -> DataFrame:
    """Rows per tile against width*height -> (tile, n, expected, ok).

    ``counts`` (tile, n) spares the scan where the rows are counted already.
    Every tile of either side is reported: a tile of the grid without a row has
    n = 0 and fails; a tile without a grid entry (unknown resolution) only
    warns, expected and ok are null.
    """
    if counts is None:
        counts = pixels.groupBy(tile).agg(F.count(F.lit(1)).cast("long").alias("n"))
    counts = counts.withColumnRenamed("n", "_n")
    g = grid.select(F.col(tile).alias("_g"), (F.col("width").cast("long") * F.col("height").cast("long")).alias("expected"))
    n = F.coalesce(F.col("_n"), F.lit(0)).cast("long")
    return (counts.join(g, F.col(tile).eqNullSafe(F.col("_g")), "full")
            .select(F.coalesce(tile, "_g").alias(tile), n.alias("n"), "expected", (n == F.col("expected")).alias("ok")))


def ingest_with_quarantine(pixels: DataFrame, grid: DataFrame, *, tile: str = "tile", failed: DataFrame | None = None,
                           counts: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """All tiles in one job; tiles that cannot be used go to a quarantine table with a reason.

    ``failed`` (tile, reason) adds what the reader or the catalogue found: an unreadable
    file, no rasters, no reference raster; ``counts`` spares a scan. Returns (pixels of good tiles, status table
    (tile, status, reason)); a tile of the grid without a row is quarantined too.
    """
    chk = grid_check(pixels, grid, tile=tile, counts=counts)
    if failed is not None:
        reasons = failed.groupBy(F.col(tile).alias("_f")).agg(F.min("reason").alias("_why"))
        chk = chk.join(reasons, F.col(tile).eqNullSafe(F.col("_f")), "full").withColumn(tile, F.coalesce(tile, "_f")).drop("_f")
    else:
        chk = chk.withColumn("_why", F.lit(None).cast("string"))
    bad = F.coalesce(~F.col("ok"), F.lit(False)) | F.col("_why").isNotNull()
    status = chk.select(
        tile, F.when(bad, F.lit("quarantined")).otherwise(F.lit("ingested")).alias("status"),
        F.when(F.col("_why").isNotNull(), F.col("_why")).when(F.col("n") == 0, F.lit("no rows"))
        .when(F.col("ok") == F.lit(False), F.concat(F.lit("rows "), F.col("n").cast("string"), F.lit(" != expected "),
                                                    F.col("expected").cast("string")))
        .when(F.col("ok").isNull(), F.lit("grid unknown")).alias("reason"))
    status = materialize(status, "ingest_status")
    good = status.where(F.col("status") == "ingested").select(F.col(tile).alias("_ok"))
    good = F.broadcast(good) if status.count() <= BROADCAST_ROWS else good
    return pixels.join(good, F.col(tile).eqNullSafe(F.col("_ok")), "left_semi"), status


def missing_inputs(catalog: DataFrame, tiles: DataFrame, *, suffix: str, tile: str = "tile") -> DataFrame:
    """(tile, reason) of tiles without rasters or without exactly one reference raster."""
    hit = F.count(F.when(F.col("path").endswith(F.lit(suffix)), 1))
    found = catalog.groupBy(F.col(tile).alias("_t")).agg(F.count("path").alias("_files"), hit.alias("_refs"))
    all_ = tiles.select(tile).distinct().join(found, F.col(tile).eqNullSafe(F.col("_t")), "left")
    reason = (F.when(F.coalesce("_files", F.lit(0)) == 0, F.lit("no rasters"))
              .when(F.col("_refs") == 0, F.lit("no reference raster")).when(F.col("_refs") > 1, F.lit("several reference rasters")))
    return all_.select(tile, reason.alias("reason")).where(F.col("reason").isNotNull())
