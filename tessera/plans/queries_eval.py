"""Registered queries: flagship pipeline, outliers, scores, predictions, runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions import paths as X
from tessera.functions.columns import round_all
from tessera.ml.baseline import fit_baseline, fit_score, predict_baseline
from tessera.operators import clean as C
from tessera.operators import impute as I
from tessera.operators import metrics as M
from tessera.operators import sample as S
from tessera.sources import sinks as SK
from tessera.operators.outliers import remove_outlier
from tessera.plans import fixtures as fx
from tessera.plans.fixtures import with_fixtures as W
from tessera.plans.queries_data import CLEAN_WHERE, HI, LO, md5
from tessera.plans.registry import query
from tessera.session import materialize
from tessera.sources import catalog as K


def _err2(y: str, p: str) -> str:
    return f"({y} - ({p})) * ({y} - ({p}))"


def _score_sql(y: str, p: str) -> str:
    """n, rmse, r2 as DuckDB aggregates, same formulas as ``rmse_r2_aggs``."""
    e = _err2(y, p)
    return (f"cast(count(*) as bigint) n, round(sqrt(avg({e})), 4) rmse, "
            f"round(1 - sum({e}) / (var_pop({y}) * count(*)), 4) r2")


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    """px rows with a reference, labelled zdif = edem - ldem."""
    p = C.dropnulls_bycol(fx.px(spark, sf), "ldem")
    return C.target_difference(p, "edem", "ldem")


LABELLED_SQL = "select *, edem - ldem zdif from px where ldem is not null"


# ------------------------------------------------------------------ flagship

def flagship(spark: SparkSession, sf: str) -> DataFrame:
    d = fx.pxs(spark, sf)
    d = C.clean_filter(d, ["edem", "ldem"], LO, HI)          # P1 + P3, pushed to the scan
    d = C.target_difference(d, "edem", "ldem", "zdif")        # P4
    d = I.fill_nulls(d, exclude=["roi", "tile", "pix"])       # I1
    d = materialize(d, "flagship_clean")                      # read by the split jobs and both fits
    d = S.split_by_share(d, 0.1, key="pix", seed=43)          # N4
    train, valid = d.where(F.col("part") == "train"), d.where(F.col("part") == "valid")
    res = fit_score(train, valid, label="zdif", feature="f_qty")  # M0 + A7
    return res.select("n", F.round("rmse", 4).alias("rmse"), F.round("r2", 4).alias("r2"))


query("flagship_pipeline", ids="P1 P3 P4 I1 N4 M0 A7", sql=W(f"""
with c as (select *, edem - ldem zdif from pxs where {CLEAN_WHERE}),
r as (select *, row_number() over (order by {md5('pix', 43)}, pix) rn, count(*) over () nn from c),
m as (select regr_slope(zdif, f_qty) s, regr_intercept(zdif, f_qty) i from r where rn > ceil(0.1::double * nn))
select {_score_sql('zdif', 'i + s * f_qty')} from r, m where rn <= ceil(0.1::double * nn)""", "pxs"))(flagship)


# --------------------------------------------------------------------------- outliers

@query("outlier_zscore", ids="O1 A5", sql="""
select event_id, value from events, (select avg(value) mu, stddev_pop(value) sd from events) s
where abs((value - mu) / sd) <= 3""")
def outlier_zscore(spark: SparkSession, sf: str) -> DataFrame:
    ev = fx.table(spark, sf, "events").select("event_id", "value")
    return remove_outlier(ev, "value", "zscore", threshold=3)


@query("outlier_iqr", ids="O2 A6", sql="""
select event_id, value from events,
  (select quantile_cont(value, 0.25) q1, quantile_cont(value, 0.75) q3 from events) q
where value >= q1 - 1.5 * (q3 - q1) and value <= q3 + 1.5 * (q3 - q1)""")
def outlier_iqr(spark: SparkSession, sf: str) -> DataFrame:
    ev = fx.table(spark, sf, "events").select("event_id", "value")
    return remove_outlier(ev, "value", "iqr")


@query("outlier_percentile", ids="O3 A6", sql="""
select event_id, value from events,
  (select quantile_cont(value, 0.05) lo, quantile_cont(value, 0.95) hi from events) q
where value >= lo and value <= hi""")
def outlier_percentile(spark: SparkSession, sf: str) -> DataFrame:
    ev = fx.table(spark, sf, "events").select("event_id", "value")
    return remove_outlier(ev, "value", "percentile", lower_percentile=0.05, upper_percentile=0.95)


def _compare_sql() -> str:
    split = f"""r as (select *, row_number() over (order by {md5('pix', 43)}, pix) rn, count(*) over () nn from b),
tr as (select * from r where rn > ceil(0.1::double * nn)), va as (select * from r where rn <= ceil(0.1::double * nn)),
z as (select tr.* from tr, (select avg(zdif) mu, stddev_pop(zdif) sd from tr) s where abs((zdif - mu) / sd) <= 3),
iq as (select tr.* from tr, (select quantile_cont(zdif, 0.25) q1, quantile_cont(zdif, 0.75) q3 from tr) q
       where zdif >= q1 - 1.5 * (q3 - q1) and zdif <= q3 + 1.5 * (q3 - q1)),
pc as (select tr.* from tr, (select quantile_cont(zdif, 0.05) lo, quantile_cont(zdif, 0.95) hi from tr) q
       where zdif >= lo and zdif <= hi),
sets as (select 'Original' data, * from tr union all select 'Z-Score', * from z
         union all select 'IQR', * from iq union all select 'Percentile', * from pc),
m as (select data, cast(count(*) as bigint) n, regr_slope(zdif, f_qty) s, regr_intercept(zdif, f_qty) i
      from sets group by data)"""
    e = _err2("va.zdif", "m.i + m.s * va.f_qty")
    return W(f"""with b as ({LABELLED_SQL}),
{split}
select m.data, m.n, round(sqrt(avg({e})), 4) rmse,
       round(1 - sum({e}) / (var_pop(va.zdif) * count(*)), 4) r2
from m cross join va group by m.data, m.n""", "px")


@query("compare_outliers", ids="O5 M0 A7", sql=_compare_sql())
def compare_outliers(spark: SparkSession, sf: str) -> DataFrame:
    base = materialize(labelled(spark, sf).select("pix", "zdif", "f_qty"), "labelled")
    d = materialize(S.split_by_share(base, 0.1, key="pix", seed=43), "split")
    train, valid = d.where(F.col("part") == "train"), d.where(F.col("part") == "valid")
    sets = [("Original", train),
            ("Z-Score", remove_outlier(train, "zdif", "zscore", threshold=3)),
            ("IQR", remove_outlier(train, "zdif", "iqr")),
            ("Percentile", remove_outlier(train, "zdif", "percentile", lower_percentile=0.05, upper_percentile=0.95))]
    stacked = None
    for name, frame in sets:
        part = frame.select(F.lit(name).alias("data"), "zdif", "f_qty")
        stacked = part if stacked is None else stacked.unionByName(part)
    model = fit_baseline(stacked, label="zdif", feature="f_qty", by=["data"])
    sizes = stacked.groupBy("data").agg(F.count(F.lit(1)).cast("long").alias("n"))
    # the four fitted models travel as one array row; each validation row is
    # scored by all of them (a fixed fan-out of 4, not a join with the data)
    models = model.agg(F.collect_list(F.struct("data", "slope", "intercept")).alias("_m"))
    scored = (valid.select("zdif", "f_qty").crossJoin(F.broadcast(models))
              .select("zdif", "f_qty", F.explode("_m").alias("_one"))
              .select("zdif", F.col("_one.data").alias("data"),
                      (F.col("_one.intercept") + F.col("_one.slope") * F.col("f_qty")).alias("pred")))
    metrics = scored.groupBy("data").agg(*M.rmse_r2_aggs("zdif", "pred"))
    return (sizes.join(metrics.drop("n"), on="data")
            .select("data", "n", F.round("rmse", 4).alias("rmse"), F.round("r2", 4).alias("r2")))


# ------------------------------------------------------------------------ baseline M0

@query("baseline_fit_score", ids="M0 A7", sql=W(f"""
with b as ({LABELLED_SQL}),
m as (select roi, regr_slope(zdif, f_qty) s, regr_intercept(zdif, f_qty) i from b group by roi)
select b.roi, round(any_value(m.s), 4) slope, round(any_value(m.i), 4) intercept,
       round(sqrt(avg({_err2('zdif', 'm.i + m.s * f_qty')})), 4) rmse,
       round(1 - sum({_err2('zdif', 'm.i + m.s * f_qty')}) / (var_pop(zdif) * count(*)), 4) r2
from b join m on b.roi = m.roi group by b.roi""", "px"))
def baseline_fit_score(spark: SparkSession, sf: str) -> DataFrame:
    b = labelled(spark, sf)
    res = fit_score(b, b, label="zdif", feature="f_qty", by=["roi"])
    return round_all(res.select("roi", "slope", "intercept", "rmse", "r2"), ["slope", "intercept", "rmse", "r2"])


@query("sample_size_study", ids="M4 W2 N4 M0", sql=W(f"""
with b as ({LABELLED_SQL}),
r as (select *, row_number() over (partition by tile order by {md5('pix', 43)}, pix) rk from b),
s as (select r.*, k.n_per_tile from r join (values (50), (100), (200)) k(n_per_tile) on r.rk <= k.n_per_tile),
q as (select *, row_number() over (partition by n_per_tile order by {md5('pix', 43)}, pix) r2,
             count(*) over (partition by n_per_tile) nn from s),
m as (select n_per_tile, regr_slope(zdif, f_qty) sl, regr_intercept(zdif, f_qty) ic
      from q where r2 > ceil(0.1::double * nn) group by n_per_tile)
select q.n_per_tile, {_score_sql('zdif', 'm.ic + m.sl * f_qty')}
from q join m on q.n_per_tile = m.n_per_tile where r2 <= ceil(0.1::double * nn) group by q.n_per_tile""", "px"))
def sample_size_study(spark: SparkSession, sf: str) -> DataFrame:
    sizes = [50, 100, 200]
    b = labelled(spark, sf)
    # one hash rank per tile serves every N; smaller samples are prefixes of larger ones
    nested = S.nested_samples(b, sizes, key="pix", seed=43, group=["tile"], out="n_per_tile")
    nested = materialize(nested.select("n_per_tile", "pix", "zdif", "f_qty"), "nested_samples")
    split = S.split_by_share(nested, 0.1, key="pix", seed=43, group=["n_per_tile"])
    train, valid = split.where(F.col("part") == "train"), split.where(F.col("part") == "valid")
    res = fit_score(train, valid, label="zdif", feature="f_qty", by=["n_per_tile"])
    return res.select("n_per_tile", "n", F.round("rmse", 4).alias("rmse"), F.round("r2", 4).alias("r2"))


# ------------------------------------------------------------------ model tables (mdl)

def _scores(spark: SparkSession, sf: str) -> DataFrame:
    return M.score(fx.mdl(spark, sf), "zdif", "pred", by=["model"])


SCORES_SQL = f"select model, {_score_sql('zdif', 'pred')} from mdl group by model"
SCORES_RAW_SQL = "select model, sqrt(avg((zdif - pred) * (zdif - pred))) rmse from mdl group by model"


@query("metrics_rmse_r2", ids="A7", sql=W(SCORES_SQL, "px", "mdl"))
def metrics_rmse_r2(spark: SparkSession, sf: str) -> DataFrame:
    return round_all(_scores(spark, sf), ["rmse", "r2"])


@query("metrics_table", ids="S11", sql=W(f"""
select cast(string_split(model, '_')[-1] as integer) seed, rmse, r2, model || '_model.txt' model_path
from ({SCORES_SQL})""", "px", "mdl"))
def metrics_table(spark: SparkSession, sf: str) -> DataFrame:
    s = round_all(_scores(spark, sf), ["rmse", "r2"])
    return s.select(F.element_at(F.split("model", "_"), -1).cast("int").alias("seed"), "rmse", "r2",
                    F.concat("model", F.lit("_model.txt")).alias("model_path"))


@query("leaderboard", ids="M8 W6", sql=W(f"""
select cast(rank() over (order by rmse, model) as bigint) rank, model, round(rmse, 4) rmse
from ({SCORES_RAW_SQL})""", "px", "mdl"))
def leaderboard(spark: SparkSession, sf: str) -> DataFrame:
    lb = M.leaderboard(_scores(spark, sf))
    return lb.select("rank", "model", F.round("rmse", 4).alias("rmse"))


@query("ensemble_mean", ids="A10 R2", sql=W("""
select pix, round(avg(pred), 4) ml_zdif, round(any_value(edem) - avg(pred), 4) ml_edem from mdl group by pix""",
                                            "px", "mdl"))
def ensemble_mean(spark: SparkSession, sf: str) -> DataFrame:
    e = M.ensemble_mean_wide(fx.mdl_wide(spark, sf), [f"p{m[0]}" for m in fx.MODELS])
    return e.select("pix", F.round("ml_zdif", 4).alias("ml_zdif"),
                    F.round(F.col("edem") - F.col("ml_zdif"), 4).alias("ml_edem"))


@query("last_model_wins", ids="R3", sql=W("select pix, round(arg_max(pred, pos), 4) ml_zdif from mdl group by pix",
                                          "px", "mdl"))
def last_model_wins(spark: SparkSession, sf: str) -> DataFrame:
    cols = [f"p{m[0]}" for m in sorted(fx.MODELS)]
    return round_all(M.last_model_wide(fx.mdl_wide(spark, sf), cols).select("pix", "ml_zdif"), ["ml_zdif"])


@query("corrected_surface", ids="P5", sql=W("select pix, model, round(edem - pred, 4) ml_edem from mdl", "px", "mdl"))
def corrected_surface(spark: SparkSession, sf: str) -> DataFrame:
    d = C.corrected_surface(fx.mdl(spark, sf), "edem", "pred", "ml_edem").select("pix", "model", "ml_edem")
    return round_all(d, ["ml_edem"])


def _top(spark: SparkSession, sf: str, k: int) -> DataFrame:
    """The k best models by the leaderboard, averaged as columns of one scan."""
    wide = fx.mdl_wide(spark, sf)
    scored = wide.agg(*[M.rmse_r2_aggs("zdif", f"p{p}")[1].alias(m) for p, m, _, _ in fx.MODELS]).first()  # one row
    best = sorted((scored[m], m, p) for p, m, _, _ in fx.MODELS)[:k]
    e = M.ensemble_mean_wide(wide, [f"p{p}" for _, _, p in best])
    return e.select("pix", F.round(F.col("edem") - F.col("ml_zdif"), 4).alias("ml_edem"))


def _top_sql(k: int) -> str:
    return W(f"""
with lb as (select model, rank() over (order by rmse, model) rk from ({SCORES_RAW_SQL}))
select pix, round(any_value(edem) - avg(pred), 4) ml_edem from mdl
where model in (select model from lb where rk <= {k}) group by pix""", "px", "mdl")


@query("predict_best", ids="R4 W6", sql=_top_sql(1))
def predict_best(spark: SparkSession, sf: str) -> DataFrame:
    return _top(spark, sf, 1)


@query("predict_top5", ids="R5 W6 A10", sql=_top_sql(5))
def predict_top5(spark: SparkSession, sf: str) -> DataFrame:
    return _top(spark, sf, 5)


@query("predict_surface", ids="R1 R7 I2 P5", sql=W(f"""
with tr as (select r.roi, edem - ldem zdif, f_qty from px join (select distinct roi from px) r on px.roi <> r.roi where ldem is not null),
m as (select roi, regr_slope(zdif, f_qty) s, regr_intercept(zdif, f_qty) i from tr group by roi),
sc as (select roi, tile, pix, edem, coalesce(f_qty, avg(f_qty) over (partition by tile)) f_qty from px)
select sc.roi, tile, pix, round(edem - (i + s * f_qty), 4) ml_edem from sc left join m on sc.roi = m.roi""", "px"))
def predict_surface(spark: SparkSession, sf: str) -> DataFrame:
    """Every pixel of every region, each region by the model of all the others."""
    p = materialize(fx.px(spark, sf).select("roi", "tile", "pix", "edem", "ldem", "f_qty"), "px_regions")
    regions = p.select("roi").distinct()
    train = C.target_difference(C.dropnulls_bycol(p, "ldem"), "edem", "ldem").select(F.col("roi").alias("_own"), "zdif", "f_qty")
    # one aggregate over rows times regions (a handful), combined before the shuffle
    others = train.join(F.broadcast(materialize(regions, "regions")), F.col("_own") != F.col("roi"))
    model = fit_baseline(others, label="zdif", feature="f_qty", by=["roi"])
    todo = I.fill_per_tile(p.select("roi", "tile", "pix", "edem", "f_qty"), ["f_qty"])
    scored = predict_baseline(todo, model, feature="f_qty", out="ml_zdif", by=["roi"])
    out = C.corrected_surface(scored, "edem", "ml_zdif", "ml_edem")
    return round_all(out.select("roi", "tile", "pix", "ml_edem"), ["ml_edem"])


@query("model_files", ids="S13", sql=W("""
select path from (select '/models/' || model || '/' || model || f path
                  from (select distinct model from mdl) m,
                       (values ('_model.txt'), ('_importance.csv'), ('_model.txt.bak')) t(f))
where suffix(path, '_model.txt')""", "px", "mdl"))
def model_files(spark: SparkSession, sf: str) -> DataFrame:
    models = fx.mdl(spark, sf).select("model").distinct()
    files = models.select(F.explode(F.array(
        *[F.concat(F.lit("/models/"), F.col("model"), F.lit("/"), F.col("model"), F.lit(f))
          for f in ["_model.txt", "_importance.csv", "_model.txt.bak"]])).alias("path"))
    return K.model_files(files)


# ------------------------------------------------------------------ registry and runs

@query("registry_status", ids="R6 P15", sql="""
select n_name expname, case when n_nationkey % 3 <> 0 then 1 else 0 end status from nation""")
def registry_status(spark: SparkSession, sf: str) -> DataFrame:
    n = fx.table(spark, sf, "nation")
    return n.select(F.col("n_name").alias("expname"),
                    F.when(F.col("n_nationkey") % 3 != 0, F.lit(1)).otherwise(F.lit(0)).alias("status"))


@query("registry_counts", ids="A11 P15", sql="""
select case when n_nationkey % 3 <> 0 then 1 else 0 end status, cast(count(*) as bigint) n from nation group by 1""")
def registry_counts(spark: SparkSession, sf: str) -> DataFrame:
    return registry_status(spark, sf).groupBy("status").agg(F.count(F.lit(1)).cast("long").alias("n"))


@query("run_time_summary", ids="S14 S11 A8 X10", sql="""
select event_type tile, round(sum(value), 4) total_s, round(sum(value) / 60, 4) total_min,
       round(sum(value) / 3600, 4) total_h, round(sum(value) / 86400, 4) total_d
from events group by event_type""")
def run_time_summary(spark: SparkSession, sf: str) -> DataFrame:
    """A runs table, appended day by day as runs end, summed over all of them."""
    from tessera.session import scratch_path
    runs = fx.table(spark, sf, "events").select(F.col("event_type").alias("tile"), F.col("value").alias("elapsed_s"),
                                                F.coalesce(F.dayofmonth("ts") % 2, F.lit(0)).alias("half"))
    path = scratch_path(spark, "runs")
    for half in (0, 1):
        SK.append_table(runs.where(F.col("half") == half).drop("half"), path)
    agg = spark.read.parquet(path).groupBy("tile").agg(F.sum("elapsed_s").alias("_s"))
    return agg.select("tile", F.round("_s", 4).alias("total_s"),
                      *[F.round(F.col("_s") / n, 4).alias(f"total_{u}") for u, n in (("min", 60), ("h", 3600), ("d", 86400))])


CURVE_SQL = "select event_type tile, cast(day(ts) as bigint) iteration, avg(value) rmse from events group by all"


@query("early_stop", ids="W4 A9", sql=f"""
with c as ({CURVE_SQL}),
r as (select *, case when rmse < coalesce(min(rmse) over (partition by tile order by iteration
                                       rows between unbounded preceding and 1 preceding), 'infinity'::double)
                     then iteration end rec from c),
b as (select *, max(rec) over (partition by tile order by iteration
                               rows between unbounded preceding and current row) best from r),
s as (select tile, min(iteration) filter (where iteration - best >= 4) stop, max(iteration) last from b group by tile)
select b.tile, b.best best_iteration from b join s on b.tile = s.tile and b.iteration = coalesce(s.stop, s.last)""")
def early_stop(spark: SparkSession, sf: str) -> DataFrame:
    ev = fx.table(spark, sf, "events")
    curve = ev.groupBy(F.col("event_type").alias("tile"), F.dayofmonth("ts").cast("long").alias("iteration")) \
        .agg(F.avg("value").alias("rmse"))
    return M.patience_stop(curve, 4, run=["tile"]).select("tile", "best_iteration")


@query("early_stop_rounds", ids="X8", sql="""
select rounds, cast(case when rounds > 1000 then greatest(50, floor(rounds * 0.05))
                         when rounds < 500 then greatest(20, floor(rounds * 0.1))
                         else greatest(100, floor(rounds * 0.1)) end as bigint) esr
from (select distinct cast(floor(value) as bigint) * 10 rounds from events)""")
def early_stop_rounds(spark: SparkSession, sf: str) -> DataFrame:
    rounds = fx.table(spark, sf, "events").select((F.floor("value").cast("long") * 10).alias("rounds")).distinct()
    return rounds.select("rounds", M.early_stopping_rounds(F.col("rounds")).alias("esr"))


@query("group_models", ids="W3", sql="""
select grp, cast(count(*) as bigint) n, min(n_name) first_name
from (select n_name, cast((row_number() over (order by n_name) - 1) // 3 as bigint) grp from nation)
group by grp""")
def group_models(spark: SparkSession, sf: str) -> DataFrame:
    names = fx.table(spark, sf, "nation").select("n_name")
    # a model listing: one row per model file, bounded by the number of models
    w = Window.orderBy("n_name")
    g = names.withColumn("grp", F.floor((F.row_number().over(w) - 1) / 3).cast("long"))
    return g.groupBy("grp").agg(F.count(F.lit(1)).cast("long").alias("n"), F.min("n_name").alias("first_name"))


ROUNDS = [1000, 20000]


def _runs(spark: SparkSession, sf: str) -> DataFrame:
    tiles = fx.cat(spark, sf).groupBy("res").agg(F.countDistinct("tile").alias("n_tiles"))
    plan = S.sample_plan(tiles).select("n", F.col("multiplier").alias("m"))
    full = fx.px(spark, sf).agg(F.count(F.lit(1)).cast("long").alias("n")).select("n", F.lit(None).cast("double").alias("m"))
    runs = plan.unionByName(full)
    return runs.withColumn("rounds", F.explode(F.array(*[F.lit(r).cast("long") for r in ROUNDS])))


def _runs_sql() -> str:
    from tessera.plans.queries_data import _plan_values
    return f"""runs as (
  select r.rounds, q.n, q.m from
   (select cast(floor(floor(p.target / t.n_tiles) * p.multiplier) as bigint) n, p.multiplier m
    from (select res, count(distinct tile) n_tiles from cat group by res) t
    join (values {_plan_values()}) p(res_, target, multiplier) on t.res = p.res_
    union all select cast(count(*) as bigint) n, cast(null as double) m from px) q,
   (values {", ".join(f"(cast({r} as bigint))" for r in ROUNDS)}) r(rounds)),
ids as (select 'iter' || cast(rounds as varchar) || '_n' || cast(n as varchar) || '_eq' ||
        coalesce(replace(case when m = floor(m) then cast(cast(m as bigint) as varchar) else cast(m as varchar) end,
                         '.', 'p'), 'None') || 'xtile' run_id from runs)"""


@query("run_id", ids="X1 X2", sql=W(f"with {_runs_sql()} select run_id from ids", "px", "cat")
       )
def run_id(spark: SparkSession, sf: str) -> DataFrame:
    return _runs(spark, sf).select(X.run_id("rounds", "n", "m").alias("run_id"))


@query("run_id_parse", ids="X5", sql=W(f"""with {_runs_sql()}
select cast(regexp_extract(run_id, '^iter(\\d+)_n(\\d+)_eq(.+)xtile$', 1) as bigint) rounds,
       cast(regexp_extract(run_id, '^iter(\\d+)_n(\\d+)_eq(.+)xtile$', 2) as bigint) n,
       case when regexp_extract(run_id, '^iter(\\d+)_n(\\d+)_eq(.+)xtile$', 3) <> 'None'
            then cast(replace(regexp_extract(run_id, '^iter(\\d+)_n(\\d+)_eq(.+)xtile$', 3), 'p', '.') as double) end m
from ids""", "px", "cat"))
def run_id_parse(spark: SparkSession, sf: str) -> DataFrame:
    ids = run_id(spark, sf)
    rounds, n, m = X.parse_run_id("run_id")
    return ids.select(rounds.alias("rounds"), n.alias("n"), m.alias("m"))


@query("head_rows", ids="T1", sql=W("select event_id, v from ev order by event_id limit 10", "ev"))
def head_rows(spark: SparkSession, sf: str) -> DataFrame:
    return fx.ev(spark, sf).select("event_id", "v").orderBy("event_id").limit(10)


@query("feature_schema_check", ids="P10", sql=W("""
select feature, present, case when present then n_null end n_null from (
  select unnest(['f_qty', 'f_disc', 'f_x']) feature, unnest([true, true, false]) present,
         unnest([count(*) filter (where f_qty is null), count(*) filter (where f_disc is null), 0]) n_null from px)""", "px"))
def feature_schema_check(spark: SparkSession, sf: str) -> DataFrame:
    """The schema answers first; only features that exist are then counted for nulls."""
    p, required = fx.px(spark, sf), ["f_qty", "f_disc", "f_x"]
    have = [c for c in required if c in p.columns]
    nulls = p.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in have])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.lit(c in have).alias("present"),
                              (F.col(c) if c in have else F.lit(None).cast("long")).alias("n_null")) for c in required])
    return nulls.select(F.inline(rows))


FEATURES = ["f_qty", "f_disc", "f_tax"]


@query("feature_ranking", ids="F8 T2", sql=W(f"""
with b as ({LABELLED_SQL}),
s as ({" union all ".join(f"select '{f}' feature, abs(corr(zdif, {f})) sc from b" for f in FEATURES)})
select feature, round(sc, 4) score, cast(rank() over (order by sc desc, feature) as bigint) rank from s""", "px"))
def feature_ranking(spark: SparkSession, sf: str) -> DataFrame:
    b = labelled(spark, sf)
    wide = b.agg(*[F.abs(F.corr("zdif", f)).alias(f) for f in FEATURES])
    long = wide.unpivot([], FEATURES, "feature", "sc")
    w = Window.orderBy(F.col("sc").desc(), F.col("feature"))  # one row per feature
    return long.select("feature", F.round("sc", 4).alias("score"), F.rank().over(w).cast("long").alias("rank"))


def _permutation_sql(f: str) -> str:
    return f"""(
with a as (select pix, zdif, row_number() over (order by pix) i from b),
h as (select {f} x, row_number() over (order by {md5('pix', 43)}, pix) i from b),
m as (select regr_slope(zdif, {f}) s, regr_intercept(zdif, {f}) ic from b),
o as (select sqrt(avg({_err2('zdif', f'ic + s * {f}')})) r from b, m),
p as (select sqrt(avg({_err2('a.zdif', 'ic + s * h.x')})) r from a join h on a.i = h.i, m)
select '{f}' feature, round(p.r - o.r, 4) delta_rmse from o, p)"""


@query("permutation_importance", ids="F7 F6 M0", sql=W(f"""
with b as ({LABELLED_SQL})
select * from (""" + " union all ".join(_permutation_sql(f) for f in FEATURES) + ")", "px"))
def permutation_importance(spark: SparkSession, sf: str) -> DataFrame:
    from tessera.ml.select import permuted_columns
    # written once, with every feature's permutation beside it
    b = materialize(labelled(spark, sf).select("pix", "zdif", *FEATURES), "permutation_input")
    shuffled = materialize(permuted_columns(b, {f: 43 for f in FEATURES}, key="pix", suffix="_perm"), "permuted")
    fits = b.agg(*[F.struct(F.regr_slope("zdif", f).alias("s"), F.regr_intercept("zdif", f).alias("i")).alias(f"m_{f}") for f in FEATURES])
    both = shuffled.crossJoin(F.broadcast(fits))  # one row
    rmse = lambda f, x: F.sqrt(F.avg(F.pow(F.col("zdif") - (F.col(f"m_{f}.i") + F.col(f"m_{f}.s") * F.col(x)), 2)))
    deltas = both.agg(*[F.round(rmse(f, f"{f}_perm") - rmse(f, f), 4).alias(f) for f in FEATURES])
    return deltas.select(F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("delta_rmse")) for f in FEATURES])))


@query("incremental_clean", ids="ST1 P1 P3 P4", sql=W(f"""
select pix, edem - ldem zdif from px
where edem <> -9999 and edem between {LO} and {HI} and ldem <> -9999 and ldem between {LO} and {HI}""", "px"))
def incremental_clean(spark: SparkSession, sf: str) -> DataFrame:
    from tessera.streaming.incremental import incremental_clean as run
    return run(spark, fx.px(spark, sf), tcol="edem", rcol="ldem", lval=LO, hval=HI, key="pix")
