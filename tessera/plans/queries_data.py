"""Registered queries: scans, catalogue, raster, cleaning, imputation, sampling.

Each query pairs a Spark builder with the DuckDB SQL that must give the same
rows. Floats computed by aggregates are rounded to 4 decimals in both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.columns import round_all
from tessera.operators import clean as C
from tessera.operators import impute as I
from tessera.operators import sample as S
from tessera.operators.neighbour import neighbour_fill
from tessera.plans import fixtures as fx
from tessera.plans.fixtures import with_fixtures as W
from tessera.plans.registry import query
from tessera.session import materialize
from tessera.sources import catalog as K
from tessera.sources import clustered as CL
from tessera.sources import files as FI
from tessera.sources import raster as RS
from tessera.sources import sinks as SK

LO, HI = 5000, 450000  # P1 range on px (FIXTURES B1)
W1_SQL = """select tile, pixel_idx, coalesce(v, (prv + nxt) / 2, prv, nxt) v
from (select tile, pixel_idx, v,
             last_value(v ignore nulls) over (partition by tile order by pixel_idx
                                              rows between unbounded preceding and 1 preceding) prv,
             lead(v) over (partition by tile order by pixel_idx) nxt
      from {src})"""

MD5 = "md5(cast({k} as varchar) || ':{s}')"


def md5(k: str, s: int) -> str:
    return MD5.format(k=k, s=s)


# --------------------------------------------------------------------------- scans

@query("scan_tiles", ids="S1", sql="""
select 'orders' tbl, cast(count(*) as bigint) n, cast(sum(o_orderkey) as bigint) key_sum from orders
union all
select 'lineitem' tbl, cast(count(*) as bigint) n, cast(sum(l_orderkey) as bigint) key_sum from lineitem""")
def scan_tiles(spark: SparkSession, sf: str) -> DataFrame:
    paths = [f"{sf}/orders.parquet", f"{sf}/lineitem.parquet"]
    df = SK.scan_tiles(spark, paths, schema="o_orderkey bigint, l_orderkey bigint")
    tbl = F.regexp_extract("source_file", r"([^/]+)\.parquet$", 1)
    return (df.select(tbl.alias("tbl"), F.coalesce("o_orderkey", "l_orderkey").alias("key"))
            .groupBy("tbl").agg(F.count(F.lit(1)).cast("long").alias("n"), F.sum("key").cast("long").alias("key_sum")))


@query("scan_projected", ids="S2", sql="select o_orderkey, o_totalprice from orders")
def scan_projected(spark: SparkSession, sf: str) -> DataFrame:
    return SK.scan_tiles(spark, [f"{sf}/orders.parquet"], columns=["o_orderkey", "o_totalprice"], source_col=None)


@query("discover_files", ids="S3")
def discover_files(spark: SparkSession, sf: str) -> DataFrame:
    """Every Parquet file of the folder, with its length; a test compares it with the file system."""
    return K.discover_files(spark, sf, "*.parquet").select(F.element_at(F.split("path", "/"), -1).alias("name"), "length")


# ------------------------------------------------------------------------ catalogue

TILE_CATALOG_SQL = """select res, tile, concat('/data/TILES', res, '/', tile, '/', tile, '_byldem.parquet') fparquet,
       cast(count(*) as bigint) n_files from cat group by res, tile"""


@query("tile_catalog", ids="S4 U2", sql=W(TILE_CATALOG_SQL, "cat"))
def tile_catalog(spark: SparkSession, sf: str) -> DataFrame:
    return K.tile_catalog(fx.cat(spark, sf), root="/data/TILES")


@query("pair_files", ids="J2", sql=W(f"""
select c.tile, t.fparquet, c.path from cat c join ({TILE_CATALOG_SQL}) t on c.tile = t.tile""", "cat"))
def pair_files(spark: SparkSession, sf: str) -> DataFrame:
    cat = fx.cat(spark, sf)
    return K.pair_files(K.tile_catalog(cat, root="/data/TILES"), cat)


@query("skip_existing", ids="S12 J4", sql=W("""
select distinct tile from cat where tile not in (select tile from cat_existing)""", "cat", "cat_existing"))
def skip_existing(spark: SparkSession, sf: str) -> DataFrame:
    todo = fx.cat(spark, sf).select("tile").distinct()
    return K.skip_existing(todo, fx.cat_existing(spark, sf))


@query("suffix_filter", ids="P13", sql=W("""
select s.pos, c.path from cat c join (values (0, 'edem_W84.tif'), (1, 'LiDAR.tif'), (2, '.tif')) s(pos, ending)
  on suffix(c.path, s.ending)""", "cat"))
def suffix_filter(spark: SparkSession, sf: str) -> DataFrame:
    return K.suffix_filter(fx.cat(spark, sf), fx.CAT_SUFFIXES).select("pos", "path")


@query("reference_file_check", ids="P9 T4", sql=W("""
select tile, cast(count(*) filter (where suffix(path, 'edem_W84.tif')) as bigint) n_match,
       case when count(*) filter (where suffix(path, 'edem_W84.tif')) = 1
            then min(path) filter (where suffix(path, 'edem_W84.tif')) end path
from cat group by tile""", "cat"))
def reference_file_check(spark: SparkSession, sf: str) -> DataFrame:
    return K.reference_file_check(fx.cat(spark, sf))


@query("variable_names", ids="X3", sql=W("""
select tile, path,
  lower(replace(replace(replace(string_split(path, '/')[-1], '.tif', ''), '_' || cast(res as varchar), ''),
                tile || '_', '')) var
from cat""", "cat"))
def variable_names(spark: SparkSession, sf: str) -> DataFrame:
    return K.variable_names(fx.cat(spark, sf))


@query("output_paths", ids="X4", sql=W("""
select tile, '/data/OUT/' || string_split(path, '/')[-2] || '/' || replace(string_split(path, '/')[-1], '.tif', '_ML.tif') out_path
from cat where suffix(path, 'edem_W84.tif')""", "cat"))
def output_paths(spark: SparkSession, sf: str) -> DataFrame:
    return K.output_paths(fx.cat(spark, sf), "/data/OUT")


# --------------------------------------------------------------------------- raster

@query("raster_to_pixels", ids="S5 P12", sql=W("select tile, pixel_idx, v from ras", "ras"))
def raster_to_pixels(spark: SparkSession, sf: str) -> DataFrame:
    return fx.ras(spark, sf).select("tile", "pixel_idx", "v")


BANDS = range(1, fx.RAS_WIDTH + 1)


@query("multiband_to_columns", ids="S6 J1", sql="select vec_id, " + ", ".join(
    f"embedding[{b}] emb_band{b}" for b in BANDS) + " from embeddings")
def multiband_to_columns(spark: SparkSession, sf: str) -> DataFrame:
    emb = fx.table(spark, sf, "embeddings").select(F.col("label").alias("tile"), "vec_id", F.lit("emb").alias("var"), "embedding")
    return RS.band_columns(emb, keys=["vec_id"], data="embedding", names=[f"emb_band{b}" for b in BANDS])


@query("align_columns", ids="J1", sql=W("select tile, rn, " + ", ".join(
    f"max(case when col = {c} then v end) c{c}" for c in range(fx.RAS_WIDTH)) + " from ras group by tile, rn", "ras"))
def align_columns(spark: SparkSession, sf: str) -> DataFrame:
    return RS.band_columns(fx.ras_rows(spark, sf), keys=["tile", "rn"], data="embedding", names=[f"c{c}" for c in range(fx.RAS_WIDTH)])


@query("lines_to_columns", ids="S5 S6 J1", sql=W("""
select a.tile, a.pixel_idx, a.v emb_band1, b.v emb_band2, abs(a.v) mag
from ras a join ras b on a.tile = b.tile and a.rn = b.rn and b.col = 63 - a.col""", "ras"))
def lines_to_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of a variable with two bands and of one with a single band, zipped into a wide pixel table."""
    rows = fx.ras_rows(spark, sf).select("tile", "rn", "embedding")
    line = lambda var, band, data: F.struct(F.lit(var).alias("var"), F.lit(band).alias("band"), data.alias("data"))
    bands = F.array(line("emb", 1, F.col("embedding")), line("emb", 2, F.reverse("embedding")),
                    line("mag", 1, F.transform("embedding", lambda x: F.abs(x))))
    lines = RS.band_names(rows.select("tile", "rn", F.explode(bands).alias("b")).select("tile", "rn", "b.*"))
    return RS.lines_to_columns(lines, width=fx.RAS_WIDTH, row="rn", names=["emb_band1", "emb_band2", "mag"])


@query("nodata_to_null", ids="P11", sql=W("""
select tile, cast(count(*) as bigint) n,
       cast(count(*) filter (where abs(cast(v as double)) < 0.01) as bigint) n_null
from ras group by tile""", "ras"))
def nodata_to_null(spark: SparkSession, sf: str) -> DataFrame:
    r = fx.ras(spark, sf)
    marked = F.when(F.abs(F.col("v").cast("double")) < 0.01, F.lit(-9999.0)).otherwise(F.col("v").cast("double"))
    v = RS.nodata_to_null(marked, -9999.0)
    return r.groupBy("tile").agg(F.count(F.lit(1)).cast("long").alias("n"),
                                 F.count(F.when(v.isNull(), 1)).cast("long").alias("n_null"))


GRID_CHECK_SQL = """select c.tile, c.n, g.width * g.height expected, c.n = g.width * g.height ok
from (select tile, cast(count(*) as bigint) n from ras group by tile) c left join ras_grid g on c.tile = g.tile"""


@query("grid_check", ids="P8", sql=W(GRID_CHECK_SQL, "ras", "ras_grid"))
def grid_check(spark: SparkSession, sf: str) -> DataFrame:
    return RS.grid_check(fx.ras(spark, sf), fx.ras_grid(spark, sf))


@query("ingest_with_quarantine", ids="S8 P9", sql=W(f"""
select tile, status, reason, n, v_sum from (
  select coalesce(g.tile, -1) tile, case when g.reason is not null and g.reason <> 'grid unknown' then 'quarantined' else 'ingested' end status, g.reason,
         case when g.reason is null or g.reason = 'grid unknown' then p.n else 0 end n,
         case when g.reason is null or g.reason = 'grid unknown' then p.v_sum end v_sum
  from (select tile, case when tile = 3 then 'unreadable file' when n = 0 then 'no rows'
               when ok = false then 'rows ' || cast(n as varchar) || ' != expected ' || cast(expected as varchar)
               when ok is null then 'grid unknown' end reason
        from (select g.tile, coalesce(c.n, 0) n, g.width * g.height expected, coalesce(c.n, 0) = g.width * g.height ok
              from (select * from ras_grid union all select 1000, 64, 2) g
                   left join (select tile, cast(count(*) as bigint) n from ras group by tile) c on c.tile = g.tile)) g
  left join (select tile, cast(count(*) as bigint) n, round(sum(round(cast(v as double), 4)), 4) v_sum from ras group by tile) p
       on p.tile = g.tile)""", "ras", "ras_grid"))
def ingest_with_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """A tile with wrong rows, one whose file isn't Parquet, one without rows: found while the files are read."""
    from tessera.session import scratch_path
    root, schema = scratch_path(spark, "ingest"), "pixel_idx long, v float"
    grid = fx.ras_grid(spark, sf)
    empty = grid.limit(1).select(F.lit(1000).alias("tile"), F.lit(64).cast("long").alias("width"), F.lit(2).cast("long").alias("height"))
    fx.ras(spark, sf).where("tile <> 3").select("tile", "pixel_idx", "v").write.partitionBy("tile").parquet(root)
    grid.where("tile = 3").select(F.lit("no raster").alias("value")).write.text(f"{root}/tile=3")
    spark.createDataFrame([], schema).write.parquet(f"{root}/tile=1000")
    good, status = FI.ingest_files(spark, root, schema, grid.unionByName(empty), tile=F.regexp_extract("path", r"/tile=(-?\d+)/", 1).cast("int"))
    kept = good.groupBy("tile").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(F.round(F.col("v").cast("double"), 4)), 4).alias("v_sum"))
    return status.join(kept, "tile", "left").select("tile", "status", "reason", F.coalesce("n", F.lit(0)).cast("long").alias("n"), "v_sum")


@query("pixel_blocks", ids="S10", sql=W("""
select b.tile, b.brow, b.bcol, b.h, b.w, b.n, b.data from (
select tile, rn // 24 brow, cast(col // 24 as bigint) bcol, cast(max(rn) - min(rn) + 1 as bigint) h,
       cast(max(col) - min(col) + 1 as bigint) w, cast(count(*) as bigint) n,
       array_to_string(list(cast(round(cast(v as double) * 10000) as bigint) order by rn, col), ',') data
from ras group by all) b""", "ras"))
def pixel_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks written and read again; ``data`` lists the cells in order, as ten-thousandths."""
    from tessera.session import scratch_path
    pixels = fx.ras(spark, sf).join(fx.ras_grid(spark, sf, wrong_mod=None), "tile")
    blocks = SK.pixel_blocks(pixels, width="width", height="height", block=24, value="v")
    out = scratch_path(spark, "blocks")
    SK.write_blocks(blocks, out)
    cells = F.concat_ws(",", F.transform("data", lambda x: F.round(x.cast("double") * 10000).cast("long").cast("string")))
    return spark.read.parquet(out).select("tile", "brow", "bcol", "h", "w", "n", cells.alias("data"))


@query("clustered_blocks", ids="S7 S10", sql=W("""
select b.tile, b.brow, b.bcol, b.h, b.w, b.n, b.data from (
select tile, rn // 24 brow, cast(col // 24 as bigint) bcol, cast(max(rn) - min(rn) + 1 as bigint) h,
       cast(max(col) - min(col) + 1 as bigint) w, cast(count(*) as bigint) n,
       array_to_string(list(cast(round(cast(v as double) * 10000) as bigint) order by rn, col), ',') data
from ras group by all) b""", "ras"))
def clustered_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks made in place from a table clustered by (tile, block row)."""
    from tessera.session import scratch_path
    pixels = fx.ras(spark, sf).select("tile", "pixel_idx", "v").join(fx.ras_grid(spark, sf, wrong_mod=None), "tile")
    name = CL.write_clustered(pixels, scratch_path(spark, "clustered"), block=24 * fx.RAS_WIDTH, buckets=8)
    blocks = SK.pixel_blocks(CL.read_clustered(spark, name), width=fx.RAS_WIDTH, height="height", block=24, slab=CL.SLAB)
    cells = F.concat_ws(",", F.transform("data", lambda x: F.round(x.cast("double") * 10000).cast("long").cast("string")))
    return blocks.select("tile", "brow", "bcol", "h", "w", "n", cells.alias("data"))


@query("clustered_fill", ids="S7 W1 I2", sql=W(f"""
with f as ({W1_SQL.format(src='ev')}), m as (select tile, avg(v) mean from ev group by tile)
select f.tile, f.pixel_idx, f.v, round(coalesce(e.v, mean), 4) by_mean
from f join ev e on f.tile = e.tile and f.pixel_idx = e.pixel_idx join m on m.tile = f.tile""", "ev"))
def clustered_fill(spark: SparkSession, sf: str) -> DataFrame:
    """Neighbour fill and tile means on a table clustered by (tile, slab)."""
    from tessera.session import scratch_path
    name = CL.write_clustered(fx.ev(spark, sf).select("tile", "pixel_idx", "v"), scratch_path(spark, "clustered"), block=512, buckets=8)
    rows = CL.read_clustered(spark, name).withColumn("by_mean", F.col("v"))
    out = I.fill_per_tile(neighbour_fill(rows, ["v"], slab=CL.SLAB), ["by_mean"])
    return out.select("tile", "pixel_idx", "v", F.round("by_mean", 4).alias("by_mean"))


@query("grid_check_footers", ids="P8 A2", sql=W(GRID_CHECK_SQL, "ras", "ras_grid"))
def grid_check_footers(spark: SparkSession, sf: str) -> DataFrame:
    """The grid check from the footers of a table partitioned by tile: no pixel is read."""
    from tessera.session import scratch_path
    out = scratch_path(spark, "by_tile")
    pixels = fx.ras(spark, sf).select("tile", "pixel_idx", "v")
    pixels.write.partitionBy("tile").parquet(out)
    return RS.grid_check(pixels, fx.ras_grid(spark, sf), counts=CL.footer_counts(spark, out).select("tile", "n"))


@query("sketch_bounds", ids="A6 O3")
def sketch_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """Approximate percentile bounds of all tiles and of one region's, from one table of sketches."""
    px = fx.px(spark, sf).select("roi", "tile", "edem", "f_qty")
    sketches = CL.tile_sketches(px.withColumn("tile", F.struct("roi", "tile")), ["edem", "f_qty"])
    probs = [0.01, 0.25, 0.5, 0.75, 0.99]
    both = None
    for name, part in (("all", sketches), ("ASIA", sketches.where(F.col("tile.roi") == "ASIA"))):
        one = CL.sketch_bounds(part, probs).withColumn("region", F.lit(name))
        both = one if both is None else both.unionByName(one)
    return both.select("region", "column", "n", F.posexplode("quantiles").alias("i", "value")).select(
        "region", "column", "n", F.element_at(F.array(*[F.lit(p) for p in probs]), F.col("i") + 1).alias("p"), "value")


@query("write_tiles", ids="S7", sql=W("select tile, cast(count(*) as bigint) n from px group by tile", "px"))
def write_tiles(spark: SparkSession, sf: str) -> DataFrame:
    from tessera.session import scratch_path
    out = scratch_path(spark, "tiles")
    SK.write_tiles(fx.px(spark, sf), out, key="pix")
    return spark.read.parquet(out).groupBy("tile").agg(F.count(F.lit(1)).cast("long").alias("n"))


@query("scan_regions", ids="U3 S1 S7", sql=W("select roi, cast(count(*) as bigint) n, "
                                               "cast(count(distinct tile) as bigint) n_tiles from px group by roi",
                                               "px"))
def scan_regions(spark: SparkSession, sf: str) -> DataFrame:
    """All regions in one training set: one scan of a roi/tile partitioned table."""
    from tessera.session import scratch_path
    out = scratch_path(spark, "regions")
    SK.write_tiles(fx.px(spark, sf), out, key="pix", partition_by=["roi", "tile"])
    df = spark.read.parquet(out)  # roi and tile come back from the directory names
    return df.groupBy("roi").agg(F.count(F.lit(1)).cast("long").alias("n"),
                                 F.countDistinct("tile").cast("long").alias("n_tiles"))


@query("chunk_assign", ids="S9 W5", sql="""
select chunk, cast(count(*) as bigint) n, min(event_id) min_id, max(event_id) max_id
from (select event_id, cast((row_number() over (order by event_id) - 1) // 3000 as bigint) chunk from events)
group by chunk""")
def chunk_assign(spark: SparkSession, sf: str) -> DataFrame:
    ev = fx.table(spark, sf, "events").select("event_id")
    ch = S.chunk_ids(ev, 3000, order_key="event_id")
    return ch.groupBy("chunk").agg(F.count(F.lit(1)).cast("long").alias("n"),
                                   F.min("event_id").alias("min_id"), F.max("event_id").alias("max_id"))


# ------------------------------------------------------------------------- cleaning

def _p1(c: str) -> str:
    return f"case when {c} <> -9999 and {c} between {LO} and {HI} then {c} end"


CLEAN_WHERE = f"edem <> -9999 and edem between {LO} and {HI} and ldem <> -9999 and ldem between {LO} and {HI}"


@query("encode_nulls_bycol", ids="P1", sql=W(f"select pix, {_p1('edem')} edem, {_p1('ldem')} ldem from pxs", "pxs"))
def encode_nulls_bycol(spark: SparkSession, sf: str) -> DataFrame:
    d = C.encode_nulls_bycol(fx.pxs(spark, sf), "edem", LO, HI)
    return C.encode_nulls_bycol(d, "ldem", LO, HI).select("pix", "edem", "ldem")


def _p2(c: str) -> str:
    return f"case when {c} between 0.03 and 400000 then {c} end {c}"


@query("assign_nulls", ids="P2", sql=W(
    "select pix, " + ", ".join(_p2(c) for c in ["edem", "ldem", "f_qty", "f_disc", "f_tax"]) + " from px", "px"))
def assign_nulls(spark: SparkSession, sf: str) -> DataFrame:
    d = C.assign_nulls(fx.px(spark, sf), 0.03, 400000, exclude=["pix"])
    return d.select("pix", "edem", "ldem", "f_qty", "f_disc", "f_tax")


@query("dropnulls_bycol", ids="P3", sql=W("select pix, ldem from px where ldem is not null", "px"))
def dropnulls_bycol(spark: SparkSession, sf: str) -> DataFrame:
    return C.dropnulls_bycol(fx.px(spark, sf), "ldem").select("pix", "ldem")


@query("target_difference", ids="P4", sql=W("select pix, edem - ldem zdif from px", "px"))
def target_difference(spark: SparkSession, sf: str) -> DataFrame:
    return C.target_difference(fx.px(spark, sf), "edem", "ldem").select("pix", "zdif")


HARMONISE_SRC = """select roi, pix, case when roi = 'ASIA' then null else ldem end ldem,
       case when roi = 'ASIA' then ldem end pdem from px"""


@query("harmonise_roi", ids="P7 P14", sql=W(f"""
select roi, pix, case when roi = 'ASIA' then pdem else ldem end ldem from ({HARMONISE_SRC})
where (case when roi = 'ASIA' then pdem else ldem end) is not null""", "px"))
def harmonise_roi(spark: SparkSession, sf: str) -> DataFrame:
    p = fx.px(spark, sf)
    asia = F.col("roi") == "ASIA"
    src = p.select("roi", "pix", F.when(~asia, F.col("ldem")).alias("ldem"), F.when(asia, F.col("ldem")).alias("pdem"))
    return C.harmonise_roi(src, substitute={"ASIA": "pdem"}).select("roi", "pix", "ldem")


@query("concat_tiles", ids="U1", sql=W("""
select roi, cast(count(*) as bigint) n, cast(count(case when roi <> 'EUROPE' then f_tax end) as bigint) n_f_tax
from px group by roi""", "px"))
def concat_tiles(spark: SparkSession, sf: str) -> DataFrame:
    p = fx.px(spark, sf)
    frames = [p.where(F.col("roi") != "EUROPE"), p.where(F.col("roi") == "EUROPE").drop("f_tax")]
    u = C.concat_tiles(frames)
    return u.groupBy("roi").agg(F.count(F.lit(1)).cast("long").alias("n"), F.count("f_tax").cast("long").alias("n_f_tax"))


PX_COLS = ["roi", "tile", "pix", "edem", "ldem", "f_qty", "f_disc", "f_tax", "f_n", "cls"]


@query("null_profile", ids="A1", sql=W(" union all ".join(
    f"select '{c}' column_name, cast(count(*) filter (where {c} is null) as bigint) n_null from px" for c in PX_COLS), "px"))
def null_profile(spark: SparkSession, sf: str) -> DataFrame:
    return C.null_profile(fx.px(spark, sf))


@query("tile_counts", ids="A2", sql=W("select tile, cast(count(*) as bigint) n from px group by tile", "px"))
def tile_counts(spark: SparkSession, sf: str) -> DataFrame:
    return C.tile_counts(fx.px(spark, sf))


# ----------------------------------------------------------------------- imputation

@query("fill_mean", ids="I1 A3", sql=W(
    "select pix, " + ", ".join(f"round(coalesce({c}, (select avg({c}) from px)), 4) {c}"
                               for c in ["ldem", "f_qty", "f_disc", "f_tax"]) + " from px", "px"))
def fill_mean(spark: SparkSession, sf: str) -> DataFrame:
    d = I.fill_nulls(fx.px(spark, sf), ["edem", "ldem", "f_qty", "f_disc", "f_tax", "f_n"])
    return round_all(d.select("pix", "ldem", "f_qty", "f_disc", "f_tax"), ["ldem", "f_qty", "f_disc", "f_tax"])


MODE_SQL = "(select cls from {src} where cls is not null group by cls order by count(*) desc, cls limit 1)"


@query("fill_mode", ids="I1 A4", sql=W(f"select pix, coalesce(cls, {MODE_SQL.format(src='px')}) cls from px", "px"))
def fill_mode(spark: SparkSession, sf: str) -> DataFrame:
    return I.fill_nulls(fx.px(spark, sf), ["cls"]).select("pix", "cls")


@query("fill_features_per_tile", ids="I2", sql=W(
    "select tile, pix, " + ", ".join(f"round(coalesce({c}, avg({c}) over (partition by tile)), 4) {c}"
                                     for c in ["f_qty", "f_disc", "f_tax"]) + " from px", "px"))
def fill_features_per_tile(spark: SparkSession, sf: str) -> DataFrame:
    d = I.fill_per_tile(fx.px(spark, sf), ["f_qty", "f_disc", "f_tax"])
    return round_all(d.select("tile", "pix", "f_qty", "f_disc", "f_tax"), ["f_qty", "f_disc", "f_tax"])


@query("neighbour_fill", ids="W1", sql=W(W1_SQL.format(src="ev"), "ev"))
def neighbour_fill_q(spark: SparkSession, sf: str) -> DataFrame:
    e = fx.ev(spark, sf).select("tile", "pixel_idx", "v")
    return neighbour_fill(e, ["v"], key="pixel_idx", tile="tile", block=1024)


@query("preprocess_chain", ids="I3", sql=W(f"""
with w as ({W1_SQL.format(src="(select tile, pixel_idx, case when v between 10 and 150 then v end v from ev)")})
select tile, pixel_idx, round(coalesce(v, (select avg(v) from w)), 4) v from w""", "ev"))
def preprocess_chain(spark: SparkSession, sf: str) -> DataFrame:
    e = fx.ev(spark, sf).select("tile", "pixel_idx", "v")
    out = I.preprocess_chain(e, lval=10, hval=150, fill_groups=[["v"]], block=1024)
    return round_all(out, ["v"])


CLEAN_FILL_SQL = """select roi, tile, pix, edem, ldem,
  coalesce(f_qty, (select avg(f_qty) from {src})) f_qty, coalesce(f_disc, (select avg(f_disc) from {src})) f_disc,
  coalesce(f_tax, (select avg(f_tax) from {src})) f_tax, cast(coalesce(f_n, (select avg(f_n) from {src})) as double) f_n,
  coalesce(cls, {mode}) cls from {src}"""


@query("clean_tiles", ids="N2", sql=W(
    f"with c as (select * from pxs where {CLEAN_WHERE})\n" + CLEAN_FILL_SQL.format(src="c", mode=MODE_SQL.format(src="c")),
    "pxs"))
def clean_tiles(spark: SparkSession, sf: str) -> DataFrame:
    d = S.clean_tiles(fx.pxs(spark, sf), tcol="edem", rcol="ldem", lval=LO, hval=HI, exclude=["roi", "tile", "pix"])
    return d.select(*PX_COLS)


# ------------------------------------------------------------------------- sampling

@query("sample_per_tile", ids="W2", sql=W(f"""
select tile, pix from px qualify row_number() over (partition by tile order by {md5('pix', 43)}, pix) <= 100""", "px"))
def sample_per_tile(spark: SparkSession, sf: str) -> DataFrame:
    px = materialize(fx.px(spark, sf).select("tile", "pix"), "px_keys")  # the passes read a table, not a join of five
    return S.sample_per_group(px, 100, key="pix", seed=43, group=["tile"]).select("tile", "pix")


@query("sample_per_tile_large", ids="W2", sql=W(f"""
select tile, pix from px qualify row_number() over (partition by tile order by {md5('pix', 7)}, pix) <= 450""", "px"))
def sample_per_tile_large(spark: SparkSession, sf: str) -> DataFrame:
    """Same operator through the histogram-threshold path (used when N is large)."""
    px = materialize(fx.px(spark, sf).select("tile", "pix"), "px_keys")
    return S.sample_per_group(px, 450, key="pix", seed=7, group=["tile"]).select("tile", "pix")


@query("sample_n", ids="N3", sql=W(f"select pix from px order by {md5('pix', 43)}, pix limit 1000", "px"))
def sample_n(spark: SparkSession, sf: str) -> DataFrame:
    return S.sample_n(materialize(fx.px(spark, sf).select("pix"), "px_keys"), 1000, key="pix", seed=43).select("pix")


@query("clean_sample_tiles", ids="N1", sql=W(
    f"""with c as (select * from pxs where {CLEAN_WHERE}
              qualify row_number() over (partition by tile order by {md5('pix', 43)}, pix) <= 200)\n"""
    + CLEAN_FILL_SQL.format(src="c", mode=MODE_SQL.format(src="c")), "pxs"))
def clean_sample_tiles(spark: SparkSession, sf: str) -> DataFrame:
    d = S.clean_sample_tiles(materialize(fx.pxs(spark, sf), "pxs"), 200, tcol="edem", rcol="ldem", key="pix", lval=LO, hval=HI,
                             exclude=["roi"])
    return d.select(*PX_COLS)


@query("split_train_valid", ids="N4", sql=W(f"""
select pix, case when row_number() over (order by {md5('pix', 43)}, pix) <= ceil(0.1::double * count(*) over ())
                 then 'valid' else 'train' end part from px""", "px"))
def split_train_valid(spark: SparkSession, sf: str) -> DataFrame:
    return S.split_by_share(fx.px(spark, sf).select("pix"), 0.1, key="pix", seed=43)


@query("split_three_way", ids="N5", sql=W(f"""
with r as (select pix, row_number() over (order by {md5('pix', 43)}, pix) rn, count(*) over () n from px)
select pix, case when rn <= ceil(0.5::double * ceil(0.3::double * n)) then 'test'
                 when rn <= ceil(0.3::double * n) then 'valid' else 'train' end part from r""", "px"))
def split_three_way(spark: SparkSession, sf: str) -> DataFrame:
    return S.split_three_way(fx.px(spark, sf).select("pix"), key="pix", seed=43)


@query("split_files", ids="N6", sql=f"""
with ch as (select distinct cast((row_number() over (order by event_id) - 1) // 500 as bigint) chunk from events),
r as (select chunk, row_number() over (order by {md5('chunk', 42)}, chunk) rn, count(*) over () n from ch)
select chunk, case when rn <= ceil(0.1::double * n) then 'test'
                   when rn <= ceil(0.1::double * n) + ceil(0.1::double * (n - ceil(0.1::double * n))) then 'valid'
                   else 'train' end part from r""")
def split_files(spark: SparkSession, sf: str) -> DataFrame:
    ev = S.chunk_ids(fx.table(spark, sf, "events").select("event_id"), 500, order_key="event_id")
    return S.split_files(ev, file_col="chunk", seed=42)


def _plan_values() -> str:
    rows = []
    for res, (target, mults) in S.RESOLUTION_PLAN.items():
        for m in mults:
            rows.append(f"({res}, cast({target} as double), cast({float(m)!r} as double))")
    return ", ".join(rows)


@query("sample_plan", ids="X6 X7", sql=W(f"""
with t as (select res, count(distinct tile) n_tiles from cat group by res)
select t.res, p.multiplier, cast(floor(floor(p.target / t.n_tiles) * p.multiplier) as bigint) n
from t join (values {_plan_values()}) p(res_, target, multiplier) on t.res = p.res_""", "cat"))
def sample_plan(spark: SparkSession, sf: str) -> DataFrame:
    tiles = fx.cat(spark, sf).groupBy("res").agg(F.countDistinct("tile").alias("n_tiles"))
    return S.sample_plan(tiles)


REGION_CHUNK = 1000


@query("region_chunks", ids="N2 P7 S9 W5", sql=W(f"""
with c as (select roi, tile, pix, edem, ldem, f_qty from px
           where edem between {LO} and {HI} and edem <> -9999 and ldem between {LO} and {HI} and ldem <> -9999),
f as (select roi, pix, edem, ldem, coalesce(f_qty, avg(f_qty) over (partition by roi)) f_qty from c),
n as (select roi, pix, edem - ldem zdif, f_qty, cast((row_number() over (partition by roi order by pix) - 1) // {REGION_CHUNK} as bigint) chunk from f)
select roi, chunk, cast(count(*) as bigint) n, min(pix) min_pix, max(pix) max_pix, round(sum(zdif), 2) zdif, round(sum(f_qty), 2) f_qty
from n group by all""", "px"))
def region_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """The region cleaning job: clean (N2) with the regions' own means, align the columns (P7), write chunks of fixed size (S9), read back."""
    from tessera.operators.numbering import index_ordered
    from tessera.session import scratch_path
    px = fx.px(spark, sf).select("roi", "tile", "pix", "edem", "ldem", "f_qty")
    cleaned = I.fill_per_tile(C.clean_filter(px, ["edem", "ldem"], LO, HI), ["f_qty"], tile="roi")
    numbered = index_ordered(cleaned, order_keys=["pix"], group=["roi"], out="_i")
    chunks = numbered.select("roi", F.expr(f"_i div {REGION_CHUNK}").alias("chunk"), "pix", (F.col("edem") - F.col("ldem")).alias("zdif"), "f_qty")
    out = scratch_path(spark, "region_chunks")
    SK.write_chunks(chunks.repartition("roi", "chunk"), out, rows_per_file=REGION_CHUNK, chunk=["roi", "chunk"])
    back = spark.read.parquet(out)
    return back.groupBy("roi", F.col("chunk").cast("long").alias("chunk")).agg(
        F.count(F.lit(1)).alias("n"), F.min("pix").alias("min_pix"), F.max("pix").alias("max_pix"),
        F.round(F.sum("zdif"), 2).alias("zdif"), F.round(F.sum("f_qty"), 2).alias("f_qty"))


@query("catalog_union", ids="U2 S4", sql=W("""
select res, tile, cast(count(*) as bigint) n, min(path) first_path, max(path) last_path from cat group by res, tile
union all select 12, 'extra', 1, '/data/TILES/extra/extra_edem_W84.tif', '/data/TILES/extra/extra_edem_W84.tif' from region where r_regionkey = 0""", "cat"))
def catalog_union(spark: SparkSession, sf: str) -> DataFrame:
    """Catalogues of two listings as one, rasters of a tile as a sorted list."""
    extra = fx.table(spark, sf, "region").where("r_regionkey = 0").select(
        F.lit(12).alias("res"), F.lit("extra").alias("tile"), F.lit("/data/TILES/extra/extra_edem_W84.tif").alias("path"))
    lists = K.rasters_by_tile(K.union_catalogs([fx.cat(spark, sf), extra]))
    return lists.select("res", "tile", F.size("paths").cast("long").alias("n"), F.element_at("paths", 1).alias("first_path"),
                        F.element_at("paths", -1).alias("last_path"))
