"""Registered queries: Spark ML training, search and selection (M1-M11, F1-F6); rows only, where a fit can't be written in SQL.

All fits use the whole labelled pixel table (px rows with a reference),
imputed (I1) and split exactly by seeded hash (N4/N5/N6). Rounds are enough for
the patience of X8 (20 rounds below 200) to act; results are one row per fit,
curve point or feature.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.columns import seeded_hash
from tessera.ml import predict as PR
from tessera.ml import search as SE
from tessera.ml import train as T
from tessera.ml.boost import Lines, boost
from tessera.operators import impute as I
from tessera.operators import sample as S
from tessera.operators.metrics import ensemble_mean_wide, rmse_r2_aggs
from tessera.plans.fixtures import with_fixtures as W
from tessera.plans.queries_data import md5
from tessera.plans.queries_eval import LABELLED_SQL, labelled
from tessera.plans.registry import query
from tessera.session import materialize, scratch_path, scratch_scope

FEATURES = ["f_qty", "f_disc", "f_tax", "f_n"]
LABEL = "zdif"
ROUNDS = 40
SEARCH_ROUNDS = 10
#: Bound and patience of a candidate's fit in the searches.
CANDIDATE_ROUNDS, CANDIDATE_PATIENCE = 15, 10
GBT_PARAMS = {"maxDepth": 4, "subsamplingRate": 0.8, "stepSize": 0.3}


def _prepared(spark: SparkSession, sf: str) -> DataFrame:
    b = labelled(spark, sf).select("tile", "pix", "edem", "ldem", LABEL, *FEATURES)
    # kept for the fill statistics and the fill, then written once: every fit, split job and score reads that table
    b = b.persist()
    try:
        return materialize(I.fill_nulls(b, exclude=["tile", "pix"]), "ml_input")
    finally:
        b.unpersist()


@contextmanager
def _split(spark: SparkSession, sf: str, share: float = 0.1, seed: int = 43, features=FEATURES, data: DataFrame | None = None):
    with scratch_scope(spark):  # results are metrics and models: nothing reads the input afterwards
        d = S.split_by_share(_prepared(spark, sf) if data is None else data, share, key="pix", seed=seed)
        train, valid = (T.assemble(d.where(F.col("part") == p), features).select(LABEL, T.FEATURES_COL).persist() for p in ("train", "valid"))
        try:
            yield train, valid
        finally:
            train.unpersist()
            valid.unpersist()


FIT_SCHEMA = ("learner string, seed int, rmse double, r2 double, best_iter string, stop_iter int, n_valid long, "
              "model_path string")


@query("train_gbt", ids="M1 M11 P6 X8")
def train_gbt(spark: SparkSession, sf: str) -> DataFrame:
    with _split(spark, sf) as (train, valid):
        res = T.train_model(train, valid, label=LABEL, rounds=ROUNDS, seed=42,
                            patience=T.early_stopping_rounds(ROUNDS), params=GBT_PARAMS)
        path = T.save_model(res.model, scratch_path(spark, f"gbt_{ROUNDS}_42_model"))
    return T.results_frame(spark, [{**res.metrics_row(), "model_path": path}], FIT_SCHEMA)


#: Bound, patience and step of the boosted lines.
LINE_ROUNDS, LINE_PATIENCE, LINE_STEP = 400, 8, 1.0


def _boosted_lines_sql() -> str:
    """The rounds on means and covariances instead of rows: a line a round, the features in turn."""
    n = len(FEATURES)
    xs = [f"x{i}" for i in range(n)]
    cov = lambda a, b: f"c_{min(a, b)}_{max(a, b)}"
    moments = ", ".join(["avg(y) m_y", "var_pop(y) c_y_y", *[f"avg({x}) m_{x}" for x in xs], *[f"covar_pop({x}, y) {cov(x, 'y')}" for x in xs],
                         *[f"covar_pop({a}, {b}) {cov(a, b)}" for i, a in enumerate(xs) for b in xs[i:]]])
    slopes = " ".join(
        f"when {j} then ({cov(x, 'y')} - ({' + '.join(f'b{k} * {cov(z, x)}' for k, z in enumerate(xs))})) / nullif({cov(x, x)}, 0)"
        for j, x in enumerate(xs))
    slope = f"coalesce(case i % {n} {slopes} end, 0)"
    mean_x = f"case i % {n} {' '.join(f'when {j} then m_{x}' for j, x in enumerate(xs))} end"
    left = f"(m_y - c - ({' + '.join(f'b{k} * m_{x}' for k, x in enumerate(xs))}))"
    spread = (f"v.c_y_y - 2 * ({' + '.join(f'b{k} * v.{cov(x, chr(121))}' for k, x in enumerate(xs))}) + "
              f"{' + '.join(f'b{k} * b{l} * v.{cov(x, z)}' for k, x in enumerate(xs) for l, z in enumerate(xs))}")
    off = f"(v.m_y - c - ({' + '.join(f'b{k} * v.m_{x}' for k, x in enumerate(xs))}))"
    body = f"""
with b as ({LABELLED_SQL}),
q as (select zdif y, {", ".join(f"cast({f} as double) {x}" for f, x in zip(FEATURES, xs))},
             row_number() over (order by {md5('pix', 43)}, pix) <= ceil(0.1::double * count(*) over ()) held from b),
t as (select {moments} from q where not held), v as (select {moments} from q where held),
r(i, c, {", ".join(f"b{k}" for k in range(n))}) as (
  select 0, 0.0::double, {", ".join("0.0::double" for _ in xs)}
  union all
  select i + 1, c + {LINE_STEP}::double * ({left} - {slope} * {mean_x}),
         {", ".join(f"case when i % {n} = {k} then b{k} + {LINE_STEP}::double * {slope} else b{k} end" for k in range(n))}
  from r, t where i < {LINE_ROUNDS}),
e as (select i iteration, round(sqrt({spread} + {off} * {off}), 1) rmse from r, v where i > 0),
w as (select *, arg_min(iteration, struct_pack(m := rmse, i := iteration)) over (order by iteration) best from e),
z as (select min(iteration) stop_iteration from w where iteration - best >= {LINE_PATIENCE})
select cast(iteration as integer) iteration, rmse, cast(max(best) over () as integer) best_iteration, cast(stop_iteration as integer) stop_iteration
from w, z where iteration <= coalesce(stop_iteration, {LINE_ROUNDS})"""
    return W(body, "px").replace("WITH", "WITH RECURSIVE", 1)


@query("boosted_lines", ids="M1 M5 M10 W4 A9", sql=_boosted_lines_sql())
def boosted_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Boosted least-squares lines on the labelled pixels: the curve up to where the patience ends the fit."""
    with scratch_scope(spark):
        b = materialize(labelled(spark, sf).select("pix", LABEL, *FEATURES), "lines_input")
        d = S.split_by_share(b, 0.1, key="pix", seed=43)
        res = boost(d.where(F.col("part") == "train"), d.where(F.col("part") == "valid"), label=LABEL, learner=Lines(FEATURES, LINE_STEP),
                    rounds=LINE_ROUNDS, patience=LINE_PATIENCE, digits=1)
    rows = [{"iteration": i, "rmse": v, "best_iteration": res.best_iter, "stop_iteration": res.stop_iter} for i, v in enumerate(res.curve, start=1)]
    return T.results_frame(spark, rows, "iteration int, rmse double, best_iteration int, stop_iteration int")


@query("learning_curve", ids="M10")
def learning_curve(spark: SparkSession, sf: str) -> DataFrame:
    with _split(spark, sf) as (train, valid):
        res = T.train_model(train, valid, label=LABEL, rounds=ROUNDS, seed=42, params=GBT_PARAMS)
    rows = [{"iteration": i, "rmse": v} for i, v in enumerate(res.curve, start=1)]
    return T.results_frame(spark, rows, "iteration int, rmse double")


@query("feature_importance", ids="M9 T3")
def feature_importance(spark: SparkSession, sf: str) -> DataFrame:
    with _split(spark, sf) as (train, valid):
        res = T.train_model(train, valid, label=LABEL, rounds=ROUNDS, seed=42, params=GBT_PARAMS)
    rows = [{"feature": f, "importance": v} for f, v in T.feature_importance(res.model, FEATURES)]
    return T.results_frame(spark, rows, "feature string, importance double")


@query("seed_ensemble", ids="M2 R2 A10")
def seed_ensemble(spark: SparkSession, sf: str) -> DataFrame:
    seeds = [21, 43, 13]
    rows = []
    with _split(spark, sf) as (train, valid):
        scored, bins = valid, T.large_bins(train, valid, label=LABEL, params=GBT_PARAMS)
        for s in seeds:
            res = T.train_model(train, valid, label=LABEL, rounds=ROUNDS, seed=s,
                                patience=T.early_stopping_rounds(ROUNDS), params=GBT_PARAMS, bins=bins)
            rows.append(res.metrics_row())
            scored = res.model.setPredictionCol(f"p_{s}").transform(scored)
        # k predictions as columns of one scan, averaged without a join
        ens = ensemble_mean_wide(scored, [f"p_{s}" for s in seeds], out="ml_zdif")
        m = ens.agg(*rmse_r2_aggs(LABEL, "ml_zdif")).collect()[0]
        rows.append({"learner": "ensemble", "seed": None, "rmse": m["rmse"], "r2": m["r2"], "n_valid": m["n"]})
    return T.results_frame(spark, rows, FIT_SCHEMA)


@query("best_iter_chain", ids="M3 W4 A9")
def best_iter_chain(spark: SparkSession, sf: str) -> DataFrame:
    """Seed 42 runs without patience; its best iteration + 10 is the patience of the next seed, whose
    best iteration is the plain patience of the one after, and so on."""
    rows, patience = [], None
    with _split(spark, sf) as (train, valid):
        for s in [42, 43, 44]:
            res = T.train_model(train, valid, label=LABEL, rounds=ROUNDS, seed=s, patience=patience,
                                params=GBT_PARAMS)
            rows.append({"seed": s, "patience": patience, "best_iteration": res.best_iter, "stop_iteration": res.stop_iter,
                         "rmse": res.rmse, "r2": res.r2})
            patience = res.best_iter + (10 if s == 42 else 0)
    return T.results_frame(spark, rows, "seed int, patience int, best_iteration int, stop_iteration int, rmse double, r2 double")


@query("rounds_study", ids="M5 X8 W4")
def rounds_study(spark: SparkSession, sf: str) -> DataFrame:
    study = [10, 20, 40, 80]
    with _split(spark, sf) as (train, valid):
        # one fit at the largest round count: its curve answers every smaller one
        res = T.train_model(train, valid, label=LABEL, rounds=max(study), seed=42, params=GBT_PARAMS)
    rows = []
    for r in study:
        esr = T.early_stopping_rounds(r)
        best, stop = T.best_iteration(res.curve[:r], esr)
        rows.append({"rounds": r, "esr": esr, "best_iteration": best, "stop_iteration": stop,
                     "rmse": res.curve[best - 1]})
    return T.results_frame(spark, rows, "rounds int, esr int, best_iteration int, stop_iteration int, rmse double")


@query("model_variants", ids="M6 N6 W5")
def model_variants(spark: SparkSession, sf: str) -> DataFrame:
    data = materialize(S.chunk_ids(_prepared(spark, sf), 500, order_key="pix"), "chunked")
    parts = S.split_files(data, file_col="chunk", seed=42)
    # one row per chunk (rows / 500): small next to the data
    d = materialize(data.join(parts, on="chunk", how="inner"), "chunk_split")
    variants = {"s1s2": ["f_qty", "f_disc"], "all": FEATURES}
    rows = []
    for vname, feats in variants.items():
        for label in ["zdif", "ldem"]:
            tr = T.assemble(d.where(F.col("part") == "train"), feats)
            va = T.assemble(d.where(F.col("part") == "valid"), feats)
            res = T.train_model(tr, va, label=label, rounds=SEARCH_ROUNDS, seed=42, params=GBT_PARAMS)
            rows.append({"variant": vname, "label": label, "rmse": res.rmse, "r2": res.r2})
    return T.results_frame(spark, rows, "variant string, label string, rmse double, r2 double")


@query("automl_leaderboard", ids="M7 M8 N5 W6")
def automl_leaderboard(spark: SparkSession, sf: str) -> DataFrame:
    d = S.split_three_way(_prepared(spark, sf), key="pix", seed=43)
    parts = {p: T.assemble(d.where(F.col("part") == p), FEATURES).persist() for p in ["train", "valid", "test"]}
    learners = {"gbt": {"maxIter": ROUNDS, **GBT_PARAMS}, "rf": {"numTrees": 20, "maxDepth": 5},
                "dt": {"maxDepth": 5}, "lr": {}, "glr": {"regParam": 10.0}, "fm": {"factorSize": 2, "stepSize": 0.1, "maxIter": 30}}
    try:
        # roles as in the reference: tuning = its test split, holdout = its valid split
        rows = SE.leaderboard_fit(parts["train"], parts["test"], parts["valid"], label=LABEL, learners=learners)
    finally:
        for p in parts.values():
            p.unpersist()
    return T.results_frame(spark, rows, "rank int, model string, rmse_tuning double, rmse_holdout double, "
                                        "r2_holdout double")


GRID = {"stepSize": [0.2, 0.1], "maxDepth": [10, 12], "leaves": [25, 35]}
RANKED = ("rank int, candidate int, stepSize double, maxDepth int, leaves int, columns double, rmse double, r2 double, "
          "best_iter int, stop_iter int")


@query("grid_search", ids="F1")
def grid_search(spark: SparkSession, sf: str) -> DataFrame:
    with _split(spark, sf) as (train, valid):
        rows = SE.search(train, valid, SE.grid_candidates(GRID), label=LABEL, rounds=CANDIDATE_ROUNDS, patience=CANDIDATE_PATIENCE)
    return T.results_frame(spark, rows, RANKED)


@query("random_candidates", ids="F2 F3")
def random_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """Candidates of both spaces, with what their leaves mean for the rows of the labelled table."""
    rows = labelled(spark, sf).agg(F.count(F.lit(1)).alias("n"))
    both = None
    for name in SE.SPACES:
        c = SE.random_candidates(spark, 8, 0, SE.SPACES[name]).withColumn("space", F.lit(name))
        both = c if both is None else both.unionByName(c, allowMissingColumns=True)
    return (both.crossJoin(F.broadcast(rows))  # one row
            .withColumn("minInstancesPerNode", F.greatest(F.lit(1), F.floor(F.col("n") / F.col("leaves"))).cast("int")).drop("n"))


def _random_search(spark: SparkSession, sf: str, space: str) -> DataFrame:
    """Every candidate that ``random_candidates`` lists for the space."""
    cands = [r.asDict() for r in SE.random_candidates(spark, 8, 0, SE.SPACES[space]).orderBy("candidate").drop("candidate").collect()]
    with _split(spark, sf) as (train, valid):
        rows = SE.search(train, valid, cands, label=LABEL, rounds=CANDIDATE_ROUNDS, patience=CANDIDATE_PATIENCE)
    return T.results_frame(spark, rows, RANKED)


@query("random_search", ids="F2")
def random_search(spark: SparkSession, sf: str) -> DataFrame:
    return _random_search(spark, sf, "uniform")


@query("random_search_log", ids="F3")
def random_search_log(spark: SparkSession, sf: str) -> DataFrame:
    return _random_search(spark, sf, "log")


def _raw_split(spark: SparkSession, sf: str):
    d = S.split_by_share(_prepared(spark, sf), 0.1, key="pix", seed=43)
    return d.where(F.col("part") == "train").persist(), d.where(F.col("part") == "valid").persist()


@query("rfe", ids="F4 F8")
def rfe(spark: SparkSession, sf: str) -> DataFrame:
    """Every feature with its elimination rank and whether the best subset has it."""
    train, valid = _raw_split(spark, sf)
    try:
        rows = SE.rfe(train, valid, FEATURES, label=LABEL, rounds=SEARCH_ROUNDS, params={"maxDepth": 4})
    finally:
        train.unpersist(), valid.unpersist()
    return T.results_frame(spark, SE.ranking_report(rows), "feature string, rank int, selected boolean, n_features int, best_rmse double")


@query("rfa", ids="F5 F8")
def rfa(spark: SparkSession, sf: str) -> DataFrame:
    train, valid = _raw_split(spark, sf)
    try:
        rows = SE.rfa(train, valid, FEATURES, label=LABEL, rounds=SEARCH_ROUNDS, params={"maxDepth": 4})
    finally:
        train.unpersist(), valid.unpersist()
    return T.results_frame(spark, rows, "n_features int, added string, features string, rmse double, best boolean")


@query("boruta", ids="F6")
def boruta(spark: SparkSession, sf: str) -> DataFrame:
    with scratch_scope(spark):
        rows = SE.boruta(_prepared(spark, sf), FEATURES, label=LABEL, key="pix", max_iter=200, seed=42)
    return T.results_frame(spark, rows, "feature string, hits int, tried int, p_confirm double, decision string")


JOINT = "candidate int, n_features int, features string, rmse double, best boolean"


def _joint(spark: SparkSession, sf: str, how: str) -> DataFrame:
    """Three candidates of the uniform space, raced on all features, then joined with a selection of features."""
    cands = [r.asDict() for r in SE.random_candidates(spark, 3, 0, SE.SPACES["uniform"]).orderBy("candidate").drop("candidate").collect()]
    train, valid = _raw_split(spark, sf)
    try:
        memo = SE.FitMemo(train, valid, label=LABEL, rounds=SEARCH_ROUNDS // 2, path=scratch_path(spark, f"memo_{how}"))
        if how == "boruta":
            rows = SE.search_boruta(memo, train, FEATURES, cands, key="pix", max_iter=12)
        else:
            rows = SE.search_select(memo, FEATURES, cands, how=how)
    finally:
        train.unpersist(), valid.unpersist()
    return T.results_frame(spark, rows, JOINT)


@query("search_rfe", ids="F4 F2")
def search_rfe(spark: SparkSession, sf: str) -> DataFrame:
    return _joint(spark, sf, "rfe")


@query("search_rfa", ids="F5 F2")
def search_rfa(spark: SparkSession, sf: str) -> DataFrame:
    return _joint(spark, sf, "rfa")


@query("search_boruta", ids="F6 F2")
def search_boruta(spark: SparkSession, sf: str) -> DataFrame:
    return _joint(spark, sf, "boruta")


@query("leaderboard_budget", ids="M8 M4 W6")
def leaderboard_budget(spark: SparkSession, sf: str) -> DataFrame:
    """Learner families within a budget of rows x rounds: a third of what fitting all of them on all rows costs."""
    from tessera.operators.numbering import index_ordered
    learners = {"gbt": {"maxIter": 20, **GBT_PARAMS}, "rf": {"numTrees": 20, "maxDepth": 5}, "dt": {"maxDepth": 5}, "lr": {}}
    with scratch_scope(spark):
        d = materialize(S.split_three_way(_prepared(spark, sf), key="pix", seed=43), "three_ways")
        own = d.where(F.col("part") == "train").withColumn("_h", seeded_hash("pix", 43))
        train = T.assemble(index_ordered(own, order_keys=["_h", "pix"], out="_rank"), FEATURES).persist()
        tuning, holdout = (T.assemble(d.where(F.col("part") == p), FEATURES) for p in ("test", "valid"))
        budget = train.count() * (20 + 20 + 1 + 1) / 3
        rows = SE.leaderboard_halving(train, tuning, holdout, label=LABEL, learners=learners, budget=budget, rank="_rank")
        train.unpersist()
    return T.results_frame(spark, rows, "rung int, rows long, model string, rmse_tuning double, place int, kept boolean, cost double, "
                                        "spent double, rmse_holdout double")


def _saved(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, str]:
    """(pixels to predict, registry, root): seven small models trained, saved, found again and tried."""
    root = scratch_path(spark, "saved_models")
    rows, pixels = [], _prepared(spark, sf)
    learners = [("gbt", 21, {**GBT_PARAMS}), ("gbt", 43, {**GBT_PARAMS}), ("gbt", 13, {"maxDepth": 3}), ("rf", 42, {"numTrees": 10}),
                ("rf", 7, {"numTrees": 5, "maxDepth": 6}), ("dt", 42, {"maxDepth": 5}), ("lr", None, {})]
    with _split(spark, sf, data=pixels) as (train, valid):
        for name, seed, params in learners:
            res = T.train_model(train, valid, label=LABEL, learner=name, rounds=SEARCH_ROUNDS, seed=seed, params=params)
            model = f"{name}_{SEARCH_ROUNDS}_{seed or 0}_model"
            T.save_model(res.model, f"{root}/{model}")
            rows.append((model, FEATURES, res.rmse))
    # one registered directory whose model is incomplete
    spark.createDataFrame([("{}",)], "value string").write.text(f"{root}/gbt_broken_model/metadata")
    scores = spark.createDataFrame(rows, "model string, features array<string>, rmse double")
    registry = PR.try_models(spark, PR.saved_models(spark, root)).join(scores, "model", "left").select(
        "model", "path", "features", "status", "rmse")
    return pixels, materialize(registry, "registry"), root


@query("predict_saved_models", ids="R1 R2 R7 S13 M11 P5 P10 P15")
def predict_saved_models(spark: SparkSession, sf: str) -> DataFrame:
    """Mean of all saved models that load, and the corrected surface, for every labelled pixel."""
    pixels, registry, _ = _saved(spark, sf)
    return PR.predict_surface(pixels, registry, target="edem").select("tile", "pix", "ml_zdif", "ml_edem")


@query("predict_best_model", ids="R4 R5 R6 W6")
def predict_best_model(spark: SparkSession, sf: str) -> DataFrame:
    """The best saved model's and the five best models' surfaces."""
    pixels, registry, _ = _saved(spark, sf)
    one = PR.predict_surface(pixels, registry, target="edem", best=1, surface="ml_best").drop("ml_zdif")
    both = PR.predict_surface(one, registry, target="edem", best=5, surface="ml_top5")
    return both.select("tile", "pix", "ml_best", "ml_top5")


@query("model_registry", ids="R6 P15 A11 S13")
def model_registry(spark: SparkSession, sf: str) -> DataFrame:
    """Every model directory with its status; a broken one has status 0."""
    return _saved(spark, sf)[1].select("model", "status", F.size(F.coalesce("features", F.array())).alias("n_features"), "rmse")


@query("predict_tiles", ids="R7 S10 S12 P8")
def predict_tiles(spark: SparkSession, sf: str) -> DataFrame:
    """Surfaces of the tiles that aren't done yet, written as blocks over a grid of 16 columns; null cells fill a tile's last line."""
    pixels, registry, _ = _saved(spark, sf)
    lines = S.index_ordered(pixels, order_keys=["pix"], group=["tile"], out="pixel_idx")
    grid = lines.groupBy("tile").agg(F.lit(16).cast("long").alias("width"), F.ceil(F.count(F.lit(1)) / 16).cast("long").alias("height"),
                                     F.count(F.lit(1)).alias("n"))
    grid = materialize(grid, "grid")
    # models take no null features; without edem the surface is null
    rest = (grid.where("n < width * height").select("tile", F.explode(F.sequence(F.col("n"), F.col("width") * F.col("height") - 1)).alias("pixel_idx"))
            .select("*", *[F.lit(0.0).alias(f) for f in FEATURES]))
    whole = lines.unionByName(rest, allowMissingColumns=True)
    done = grid.orderBy("tile").limit(3).select("tile")
    out = scratch_path(spark, "predicted")
    PR.predict_tiles(materialize(whole, "whole"), grid, registry, out, target="edem", best=5, block=8, done=materialize(done, "done"))
    return spark.read.parquet(out).groupBy("tile").agg(F.count(F.lit(1)).alias("blocks"), F.sum("n").alias("cells"))
