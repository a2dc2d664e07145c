"""Stand-in pixel tables over the supplied test tables (FIXTURES.md part B).

Every fixture is derived from the given Parquet tables by Spark, so its size
grows with them:

* ``px``  pixel table: one row per order, region/nation as roi/tile, line
  aggregates as reference and features.
* ``pxs`` ``px`` with -9999 sentinels in ``edem``.
* ``ev``  ordered column with gaps (events by type).
* ``ras`` raster cells from embedding arrays (64 wide).
* ``cat`` raster file catalogue over nations.
* ``mdl`` predictions of seven linear "models" per pixel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.columns import nan_to_null
from tessera.operators.numbering import index_within
from tessera.sources.raster import raster_to_pixels

RAS_WIDTH = 64
CAT_ROOT = "/data/TILES/"
# Fixed values of the fixtures: variables per tile, P13 suffixes, model table.
CAT_VARS = ["edem_W84", "EGM08", "multi_S1_12", "multi_DTM_LiDAR"]
CAT_SUFFIXES = ["edem_W84.tif", "LiDAR.tif", ".tif"]
MODELS = [(1, "gbt_100_21", 90000.0, -1500.0),
          (2, "gbt_100_43", 110000.0, -1600.0),
          (3, "rf_50_42", 60000.0, -1200.0),
          (4, "gbt_200_21", 95000.0, -1450.0),
          (5, "gbt_200_43", 105000.0, -1700.0),
          (6, "rf_100_42", 70000.0, -1000.0),
          (7, "gbt_400_13", 100000.0, -1550.0)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; NaN -> NULL at the source."""
    return nan_to_null(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def px(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    lines = (table(spark, sf_dir, "lineitem")
             .groupBy("l_orderkey")
             .agg(F.round(F.sum("l_extendedprice"), 2).alias("ldem"),
                  F.sum("l_quantity").alias("f_qty"),
                  F.max("l_discount").alias("f_disc"),
                  F.max("l_tax").alias("f_tax"),
                  F.count(F.lit(1)).cast("long").alias("f_n")))
    joined = (orders.join(customer, orders.o_custkey == customer.c_custkey)
              .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
              .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
              .join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left"))
    return joined.select(
        F.col("r_name").alias("roi"), F.col("n_name").alias("tile"), F.col("o_orderkey").alias("pix"),
        F.col("o_totalprice").alias("edem"), "ldem", "f_qty", "f_disc", "f_tax", "f_n",
        F.when(F.col("o_orderkey") % 7 == 0, F.lit(None)).otherwise(F.col("o_orderpriority")).alias("cls"))


def pxs(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = px(spark, sf_dir)
    return p.withColumn("edem", F.when(F.col("pix") % 11 == 0, F.lit(-9999.0)).otherwise(F.col("edem")))


def ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("tile"), "event_id",
        F.when((F.col("value") < 10) | (F.col("value") > 150), F.lit(None)).otherwise(F.col("value")).alias("v"))
    return index_within(events, order_key="event_id", group=["tile"], out="pixel_idx") \
        .select("tile", "pixel_idx", "event_id", "v")


def ras_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raster-row table: one embedding array = one raster line of a tile."""
    emb = table(spark, sf_dir, "embeddings").select(F.col("label").alias("tile"), "vec_id", "embedding")
    return index_within(emb, order_key="vec_id", group=["tile"], out="rn")


def ras(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ras_rows(spark, sf_dir)
    pix = raster_to_pixels(rows, width=RAS_WIDTH, data="embedding", row="rn", keep=("tile",), value="v")
    return pix.select("tile", (F.col("pixel_idx") / RAS_WIDTH).cast("long").alias("rn"),
                      (F.col("pixel_idx") % RAS_WIDTH).cast("int").alias("col"),
                      F.when(~F.isnan("v"), F.col("v")).alias("v"), "pixel_idx")


def ras_grid(spark: SparkSession, sf_dir: str, *, wrong_mod: int | None = 3) -> DataFrame:
    """Grid table of ``ras``: width 64, height = raster lines of the tile.

    With ``wrong_mod`` the expected height is one line too many for tiles
    divisible by it, which makes those tiles fail the grid check.
    """
    rows = table(spark, sf_dir, "embeddings").groupBy(F.col("label").alias("tile")) \
        .agg(F.count(F.lit(1)).cast("long").alias("height"))
    height = F.col("height")
    if wrong_mod:
        height = F.when(F.col("tile") % wrong_mod == 0, height + 1).otherwise(height)
    return rows.select("tile", F.lit(RAS_WIDTH).cast("long").alias("width"), height.alias("height"))


def cat(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    res = (F.when(F.col("n_regionkey") == 0, F.lit(90))
           .when(F.col("n_regionkey").isin(1, 2), F.lit(30)).otherwise(F.lit(12)))
    rows = nation.select(res.alias("res"), F.col("n_name").alias("tile"), "n_nationkey",
                         F.explode(F.array(*[F.lit(v) for v in CAT_VARS])).alias("var"))
    rows = rows.where(~((F.col("var") == "edem_W84") & (F.col("n_nationkey") % 6 == 0)))
    return rows.select("res", "tile",
                       F.concat(F.lit(CAT_ROOT), F.col("tile"), F.lit("/"), F.col("tile"), F.lit("_"),
                                F.col("var"), F.lit(".tif")).alias("path"))


def cat_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles whose output already exists."""
    return table(spark, sf_dir, "nation").where(F.col("n_nationkey") % 4 == 1).select(F.col("n_name").alias("tile"))


def mdl(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = F.array(*[F.struct(F.lit(p).alias("pos"), F.lit(m).alias("model"), F.lit(a).alias("a"),
                                F.lit(b).alias("b")) for p, m, a, b in MODELS])
    base = px(spark, sf_dir).where(F.col("ldem").isNotNull())
    ex = base.select("pix", "tile", "edem", (F.col("edem") - F.col("ldem")).alias("zdif"), "f_qty",
                     F.explode(models).alias("m"))
    return ex.select("pix", "tile", "edem", "zdif", F.col("m.pos").alias("pos"), F.col("m.model").alias("model"),
                     (F.col("m.a") + F.col("m.b") * F.col("f_qty")).alias("pred"))


def mdl_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``mdl`` with one prediction column per model (``p1`` ...): k models on one scan."""
    base = px(spark, sf_dir).where(F.col("ldem").isNotNull())
    preds = [(F.lit(a) + F.lit(b) * F.col("f_qty")).alias(f"p{p}") for p, _, a, b in MODELS]
    return base.select("pix", "tile", "edem", (F.col("edem") - F.col("ldem")).alias("zdif"), *preds)


# DuckDB spellings of the same fixtures, used as a WITH prefix by the oracles.
FIXTURE_SQL = {
    "px": """
select r_name roi, n_name tile, o_orderkey pix, o_totalprice edem, l.ldem,
       l.f_qty, l.f_disc, l.f_tax, l.f_n,
       case when o_orderkey % 7 = 0 then null else o_orderpriority end cls
from orders join customer on o_custkey = c_custkey
  join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
  left join (select l_orderkey, round(sum(l_extendedprice), 2) ldem, sum(l_quantity) f_qty,
                    max(l_discount) f_disc, max(l_tax) f_tax, cast(count(*) as bigint) f_n
             from lineitem group by l_orderkey) l on l_orderkey = o_orderkey""",
    "pxs": """
select roi, tile, pix, case when pix % 11 = 0 then -9999.0 else edem end edem, ldem,
       f_qty, f_disc, f_tax, f_n, cls from px""",
    "ev": """
select event_type tile, cast(row_number() over (partition by event_type order by event_id) - 1 as bigint) pixel_idx,
       event_id, case when value < 10 or value > 150 then null else value end v
from events""",
    "ras": """
select label tile, rn, col, v, rn*64+col pixel_idx
from (select label, cast(row_number() over (partition by label order by vec_id) - 1 as bigint) rn,
             cast(generate_subscripts(embedding,1) - 1 as integer) col, unnest(embedding) v from embeddings)""",
    "ras_grid": """
select label tile, cast(64 as bigint) width,
       cast(count(*) + case when label % 3 = 0 then 1 else 0 end as bigint) height
from embeddings group by label""",
    "cat": """
select case when n_regionkey = 0 then 90 when n_regionkey in (1,2) then 30 else 12 end res,
       n_name tile, concat('/data/TILES/', n_name, '/', n_name, '_', var, '.tif') path
from nation cross join (values ('edem_W84'),('EGM08'),('multi_S1_12'),('multi_DTM_LiDAR')) as t(var)
where not (var = 'edem_W84' and n_nationkey % 6 = 0)""",
    "cat_existing": "select n_name tile from nation where n_nationkey % 4 = 1",
    "mdl": """
select pix, tile, edem, edem - ldem zdif, pos, model, a + b*f_qty pred
from px cross join (values
  (1,'gbt_100_21',cast(90000.0 as double), cast(-1500.0 as double)),
  (2,'gbt_100_43',cast(110000.0 as double),cast(-1600.0 as double)),
  (3,'rf_50_42',  cast(60000.0 as double), cast(-1200.0 as double)),
  (4,'gbt_200_21',cast(95000.0 as double), cast(-1450.0 as double)),
  (5,'gbt_200_43',cast(105000.0 as double),cast(-1700.0 as double)),
  (6,'rf_100_42', cast(70000.0 as double), cast(-1000.0 as double)),
  (7,'gbt_400_13',cast(100000.0 as double),cast(-1550.0 as double))) as m(pos,model,a,b)
where ldem is not null""",
}


def with_fixtures(body: str, *names: str) -> str:
    """Prefix ``body`` with the fixture CTEs it needs (dependencies included)."""
    deps = {"pxs": ["px"], "mdl": ["px"]}
    order: list[str] = []
    for n in names:
        for d in deps.get(n, []):
            if d not in order:
                order.append(d)
        if n not in order:
            order.append(n)
    ctes = ",\n".join(f"{n} AS ({FIXTURE_SQL[n]})" for n in order)
    text = body.lstrip()
    if text[:5].lower() == "with ":
        return f"WITH {ctes},\n{text[5:]}"
    return f"WITH {ctes}\n{text}"
