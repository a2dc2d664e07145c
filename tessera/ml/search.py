"""Hyper-parameter search and feature selection loops.

The loops are over fits (a handful of candidates or features); each fit and
each score is a distributed Spark job on the same cached, assembled data.
"""

from __future__ import annotations

import itertools
import json
import math
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.ml import cells as CE
from tessera.ml.select import bin_ends, numbered_rows, shuffled_bins, shuffled_columns
from tessera.ml.train import FEATURES_COL, assemble, feature_importance, make_learner, score, train_model
from tessera.session import materialize


def grid_candidates(grid: dict[str, Sequence]) -> list[dict]:
    """every combination of the grid, in a stable order."""
    keys = list(grid)
    return [dict(zip(keys, vals)) for vals in itertools.product(*[grid[k] for k in keys])]


def uniform(lo: float, hi: float):
    """A number between lo and hi."""
    return lambda u: F.lit(lo) + u * F.lit(hi - lo)


def log_uniform(lo: float, hi: float):
    return lambda u: F.exp(F.lit(math.log(lo)) + u * F.lit(math.log(hi) - math.log(lo)))


def randint(lo: int, hi: int):
    """An integer from lo to hi, both included."""
    return lambda u: (F.lit(lo) + F.floor(u * F.lit(hi - lo + 1))).cast("int")


def choice(values: Sequence):
    return lambda u: F.element_at(F.array(*[F.lit(v) for v in values]), (F.floor(u * F.lit(len(values))) + 1).cast("int"))


# F2 and F3, fixed values of the searches: the learning rate uniform or log-uniform, the depth a choice
# or an integer, leaves, and the share of columns a tree sees. A Spark tree has no leaf limit:
# minInstancesPerNode bounds the leaves to rows / minInstancesPerNode, so ``leaves`` is turned into it
# when a candidate is fitted.
SPACES = {
    "uniform": {"stepSize": uniform(0.09, 0.34), "maxDepth": choice([10, 12]), "leaves": randint(20, 39)},
    "log": {"stepSize": log_uniform(0.01, 0.2), "maxDepth": randint(15, 19), "columns": uniform(0.6, 1.0), "leaves": choice([31])},
}


def random_candidates(spark: SparkSession, n_iter: int, seed: int, space: dict | None = None) -> DataFrame:
    """``candidate`` and one column per parameter of the space, drawn by Spark.

    One partition keeps ``rand(seed)`` reproducible; every parameter has a seed of its own.
    """
    space = space or SPACES["log"]
    base = spark.range(0, n_iter, numPartitions=1)
    return base.select(F.col("id").alias("candidate"),
                       *[draw(F.rand(seed + 7919 * i)).alias(name) for i, (name, draw) in enumerate(space.items())])


def fit_params(candidate: dict, rows: int) -> dict:
    """Learner parameters of a candidate for a training set of ``rows``."""
    params = {k: v for k, v in candidate.items() if k not in ("candidate", "leaves", "columns") and v is not None}
    if candidate.get("leaves"):
        params["minInstancesPerNode"] = max(1, rows // int(candidate["leaves"]))
    if candidate.get("columns"):
        params["featureSubsetStrategy"] = str(min(1.0, float(candidate["columns"])))
    return params


def search(train: DataFrame, valid: DataFrame, candidates: list[dict], *, label: str, learner: str = "gbt",
           rounds: int = 20, seed: int = 42, patience: int | None = None) -> list[dict]:
    """Fit every candidate on ``train`` (assembled), up to ``rounds`` with a ``patience``, score on ``valid``; rows sorted by rmse.

    Candidates that take every row are fitted on the cells of a large ``train`` (``ml.cells``), once for all.
    """
    rows, n, small = [], train.count(), None
    for i, params in enumerate(candidates):
        own, parts = fit_params(params, n), (train, valid)
        if n >= CE.LEAST_ROWS and CE.countable(learner, own):
            if small is None:
                small = _vector_cells(train, valid, label=label, rows=n)
            own, parts = CE.weighted_params(own, n), (assemble(small.train, small.features), assemble(small.valid, small.features))
        res = train_model(*parts, label=label, learner=learner, rounds=rounds, seed=seed, patience=patience, params=own)
        rows.append({"candidate": i, **params, "rmse": res.rmse, "r2": res.r2, "best_iter": res.best_iter, "stop_iter": res.stop_iter})
    if small is not None:
        small.unpersist()
    rows.sort(key=lambda r: (r["rmse"], r["candidate"]))
    for rank, r in enumerate(rows, start=1):
        r["rank"] = rank
    return rows


def _vector_cells(train: DataFrame, valid: DataFrame, *, label: str, rows: int) -> CE.Cells:
    """Cells of assembled splits."""
    flat, names = CE.scalars(train, FEATURES_COL, label=label)
    return CE.cells(flat, CE.scalars(valid, FEATURES_COL, label=label)[0], names, label=label, rows=rows)


def _large(train: DataFrame, valid: DataFrame, features: Sequence[str], *, label: str, learner: str, params: dict) -> CE.Cells | None:
    """Cells for fits on these features and on parts of them, where the table is large and the learner takes every row."""
    if not CE.countable(learner, params):
        return None
    n = train.count()
    return CE.cells(train, valid, features, label=label, rows=n) if n >= CE.LEAST_ROWS else None


def _fit_subset(train: DataFrame, valid: DataFrame, features: Sequence[str], *, label: str, learner: str,
                rounds: int, seed: int, params: dict, small: CE.Cells | None = None):
    """A fit on some features and its score; with ``small``, on the cells of the same splits."""
    if small is not None and CE.countable(learner, params):
        train, valid, params = small.train, small.valid, CE.weighted_params(params, small.rows)
    tr, va = assemble(train, features), assemble(valid, features)
    est = make_learner(learner, label=label, seed=seed, **({"maxIter": rounds} if learner == "gbt" else {}),
                       **params)
    model = est.fit(tr)
    return model, score(model.transform(va), label)


def rfe(train: DataFrame, valid: DataFrame, features: Sequence[str], *, label: str, learner: str = "gbt",
        rounds: int = 20, seed: int = 42, min_features: int = 1, step: int = 1, params: dict | None = None
        ) -> list[dict]:
    """drop the least important feature(s) per step down to ``min_features``.

    Rows: (step, n_features, features, dropped, rmse, best); ``best`` marks the
    subset with the smallest rmse (the smaller one on ties). ``ranking`` orders
    the features by elimination (``ranking_report``).
    """
    current = list(features)
    rows, step_no = [], 0
    small = _large(train, valid, features, label=label, learner=learner, params=params or {})
    while True:
        model, m = _fit_subset(train, valid, current, label=label, learner=learner, rounds=rounds, seed=seed,
                               params=params or {}, small=small)
        imp = feature_importance(model, current)
        n_drop = min(step, len(current) - min_features)
        dropped = [f for f, _ in sorted(imp, key=lambda t: (t[1], t[0]))[:n_drop]] if n_drop > 0 else []
        rows.append({"step": step_no, "n_features": len(current), "features": ",".join(current),
                     "dropped": ",".join(dropped) or None, "rmse": m["rmse"]})
        if not dropped:
            return _mark_best(rows)
        current = [f for f in current if f not in dropped]
        step_no += 1


def rfa(train: DataFrame, valid: DataFrame, features: Sequence[str], *, label: str, learner: str = "gbt",
        rounds: int = 20, seed: int = 42, params: dict | None = None) -> list[dict]:
    """add features in importance order (of a fit on all), one at a time; ``best`` marks the best subset."""
    small = _large(train, valid, features, label=label, learner=learner, params=params or {})
    model, _ = _fit_subset(train, valid, features, label=label, learner=learner, rounds=rounds, seed=seed,
                           params=params or {}, small=small)
    order = [f for f, _ in feature_importance(model, features)]
    rows = []
    for k in range(1, len(order) + 1):
        _, m = _fit_subset(train, valid, order[:k], label=label, learner=learner, rounds=rounds, seed=seed,
                           params=params or {}, small=small)
        rows.append({"n_features": k, "added": order[k - 1], "features": ",".join(order[:k]), "rmse": m["rmse"]})
    return _mark_best(rows)


def _mark_best(rows: list[dict]) -> list[dict]:
    best = min(rows, key=lambda r: (r["rmse"], r["n_features"]))
    for r in rows:
        r["best"] = r is best
    return rows


def ranking_report(rows: list[dict]) -> list[dict]:
    """feature, its rank by elimination (1 = kept last), whether the best subset has it, that subset's size and rmse."""
    best = next(r for r in rows if r["best"])
    order = [f for r in reversed(rows) for f in (r["dropped"] or r["features"]).split(",")]
    kept = set(best["features"].split(","))
    return [{"feature": f, "rank": i, "selected": f in kept, "n_features": best["n_features"], "best_rmse": best["rmse"]}
            for i, f in enumerate(order, start=1)]


def _binom_sf(k: int, n: int) -> float:
    """P(X >= k) for X ~ Binomial(n, 1/2)."""
    return sum(math.comb(n, i) for i in range(k, n + 1)) / 2 ** n


def _numbered_bins(df: DataFrame, features: Sequence[str], *, label: str, key: str, rows: int) -> DataFrame:
    """A large table's rows with their position in key order, their label and every feature as the number of its bin."""
    numbered = numbered_rows(df.select(key, label, *features), key=key)
    own = CE.binned(numbered.select("_pos", CE.given(label), *features), features, CE.grid(df, features, rows=rows))
    return materialize(own.repartition(max(df.sparkSession.sparkContext.defaultParallelism, 1)), "boruta")


def boruta(df: DataFrame, features: Sequence[str], *, label: str, key: str, max_iter: int = 20,
           seed: int = 42, alpha: float = 0.05, num_trees: int = 20, max_depth: int = 5) -> list[dict]:
    """shadow features (seeded permutations) vs real ones, random-forest importance.

    A feature scores a hit in an iteration when its importance beats the best
    shadow (perc 100). After each iteration a binomial test at ``alpha``
    (Bonferroni over the features) confirms or rejects; rejected features leave
    the fits, confirmed ones stay without being tested again, and the loop ends when
    nothing is open. ``max_iter`` must be large enough to decide at all.

    A large table is numbered, binned and dealt out evenly once (``_numbered_bins``); the shadows of its bins need no
    row to move, so an iteration costs the forest's own passes.
    """
    level = alpha / len(features)
    if 0.5 ** max_iter >= level:
        raise ValueError(f"{max_iter} iterations can't decide at a level of {level:g}: take {math.ceil(-math.log2(level)) + 1} or more")
    hits, tried = {f: 0 for f in features}, {f: 0 for f in features}
    decision = {f: "tentative" for f in features}
    n = df.count()
    if n >= CE.LEAST_ROWS:
        rows = _numbered_bins(df, features, label=label, key=key, rows=n)
        ends = bin_ends(rows, features)
    else:
        rows, ends = materialize(numbered_rows(df.select(key, label, *features), key=key), "boruta"), None
    for it in range(max_iter):
        live = [f for f in features if decision[f] != "rejected"]
        if not any(decision[f] == "tentative" for f in live):
            break
        seeds = {f: seed + 1000 * it + j for j, f in enumerate(features) if f in live}
        shadowed = shuffled_columns(rows, seeds, n=n) if ends is None else shuffled_bins(rows, seeds, ends, n=n)
        cols = live + [f"{f}_shadow" for f in live]
        rf = make_learner("rf", label=label, seed=seed + it, numTrees=num_trees, maxDepth=max_depth)
        imp = dict(feature_importance(rf.fit(assemble(shadowed, cols)), cols))
        best_shadow = max(imp[f"{f}_shadow"] for f in live)
        for f in live:
            if decision[f] != "tentative":
                continue
            tried[f] += 1
            hits[f] += imp[f] > best_shadow
            if _binom_sf(hits[f], tried[f]) < level:
                decision[f] = "confirmed"
            elif _binom_sf(tried[f] - hits[f], tried[f]) < level:
                decision[f] = "rejected"
    return [{"feature": f, "hits": hits[f], "tried": tried[f], "p_confirm": _binom_sf(hits[f], tried[f]), "decision": decision[f]}
            for f in features]


def halving_plan(rows: int, cost: dict[str, float], budget: float, rungs: int) -> list[float]:
    """Shares of the rows at each rung, the last one the largest, whose cost stays within the budget.

    A fit costs rows x rounds. Half of the learners (the dearest, at worst) go on from rung to rung,
    on twice the share; the shares are as large as the budget allows, and 1 at most.
    """
    dear = sorted(cost.values(), reverse=True)
    per_share, left = 0.0, len(dear)
    for r in range(rungs):
        per_share += 2.0**r * sum(dear[:left]) * rows
        left = max(1, -(-left // 2))
    first = budget / per_share
    if first * rows < 1:
        raise ValueError("the budget doesn't pay for a single row a learner")
    return [min(1.0, first * 2.0**r) for r in range(rungs)]


def leaderboard_halving(train: DataFrame, tuning: DataFrame, holdout: DataFrame, *, label: str, learners: dict[str, dict],
                        budget: float, rank: str, seed: int = 42) -> list[dict]:
    """M8 within a budget of rows x rounds: successive halving over nested samples.

    ``rank`` is each training row's position in a seeded order from 0 (so samples of growing share
    are prefixes of each other). Every rung fits the learners that are left, scores them on
    ``tuning`` and drops the worse half; the winner is scored on ``holdout``. Returns the
    elimination table: a row per fit, with what it cost.
    """
    rounds = {name: float(params.get("maxIter", params.get("numTrees", 1))) for name, params in learners.items()}
    n, left, table = train.count(), sorted(learners), []
    rungs = max(1, math.ceil(math.log2(len(learners)))) if len(learners) > 1 else 1
    shares = halving_plan(n, rounds, budget, rungs)
    spent, model = 0.0, None
    for rung, share in enumerate(shares, start=1):
        take = max(1, math.floor(share * n))
        part = train.where(F.col(rank) < take)
        scored = []
        for name in left:
            spent += take * rounds[name]
            model = make_learner(name, label=label, seed=seed, **learners[name]).fit(part)
            scored.append((score(model.transform(tuning), label)["rmse"], name, model))
        scored.sort(key=lambda s: s[:2])
        keep = max(1, -(-len(left) // 2)) if rung < len(shares) else 1
        for place, (rmse, name, _) in enumerate(scored, start=1):
            table.append({"rung": rung, "rows": take, "model": name, "rmse_tuning": rmse, "place": place, "kept": place <= keep,
                          "cost": take * rounds[name], "spent": spent, "rmse_holdout": None})
        left = [name for _, name, _ in scored[:keep]]
        model = scored[0][2]
    best = next(r for r in table if r["rung"] == len(shares) and r["place"] == 1)
    best["rmse_holdout"] = score(model.transform(holdout), label)["rmse"]
    return table


def leaderboard_fit(train: DataFrame, tuning: DataFrame, holdout: DataFrame, *, label: str,
                    learners: dict[str, dict], seed: int = 42) -> list[dict]:
    """M8: fit each learner family, score on the tuning and the holdout split, rank by tuning rmse."""
    rows = []
    for name, params in learners.items():
        est = make_learner(name, label=label, seed=seed, **params)
        model = est.fit(train)
        tun = score(model.transform(tuning), label)
        hold = score(model.transform(holdout), label)
        rows.append({"model": name, "rmse_tuning": tun["rmse"], "rmse_holdout": hold["rmse"], "r2_holdout": hold["r2"]})
    rows.sort(key=lambda r: (r["rmse_tuning"], r["model"]))
    for rank, r in enumerate(rows, start=1):
        r["rank"] = rank
    return rows


class FitMemo:
    """Results of fits, keyed by features and parameters: every work item is fitted once, also after a restart.

    With a ``path``, each new result is one small file below it, which a later memo reads again.
    """

    def __init__(self, train: DataFrame, valid: DataFrame, *, label: str, rounds: int, seed: int = 42, path: str | None = None):
        self.train, self.valid, self.label, self.rounds, self.seed, self.path = train, valid, label, rounds, seed, path
        self.spark, self.results, self.fits, self.hits = train.sparkSession, {}, 0, 0
        self.n, self.small = train.count(), None
        if path is not None:
            try:
                for r in self.spark.read.schema(_MEMO).parquet(f"{path}/*").collect():  # one row per fit
                    self.results[r["item"]] = (r["rmse"], json.loads(r["importances"]))
            except AnalysisException:
                pass  # nothing there yet

    def item(self, features: Sequence[str], candidate: dict) -> str:
        return json.dumps([sorted(features), sorted(candidate.items()), self.label, self.rounds, self.seed], default=str)

    def cells(self, features: Sequence[str]) -> CE.Cells | None:
        """Cells of a large table, made for the first features asked for and kept for parts of them.

        The memo's candidates all take every row.
        """
        if self.n >= CE.LEAST_ROWS and (self.small is None or not set(features) <= set(self.small.features)):
            self.small = CE.cells(self.train, self.valid, sorted(features), label=self.label, rows=self.n)
        return self.small

    def fit(self, features: Sequence[str], candidate: dict):
        """(model, scores) of the candidate."""
        return _fit_subset(self.train, self.valid, sorted(features), label=self.label, learner="gbt", rounds=self.rounds, seed=self.seed,
                           params=fit_params(candidate, self.n), small=self.cells(features))

    def predicted(self, features: Sequence[str], candidates: Sequence[dict]) -> DataFrame:
        """The validation rows with every candidate's prediction, ``_p0`` and so on, as columns of one scan."""
        small = self.cells(features)
        scored = assemble(self.valid if small is None else small.valid, sorted(features))
        for i, c in enumerate(candidates):
            scored = self.fit(features, c)[0].setPredictionCol(f"_p{i}").transform(scored)
        return scored

    def __call__(self, features: Sequence[str], candidate: dict) -> tuple[float, dict[str, float]]:
        """(validation RMSE, importance per feature) of the candidate on these features."""
        item = self.item(features, candidate)
        if item in self.results:
            self.hits += 1
            return self.results[item]
        self.fits += 1
        model, m = self.fit(features, candidate)
        self.results[item] = m["rmse"], dict(feature_importance(model, sorted(features)))
        if self.path is not None:
            row = (item, m["rmse"], json.dumps(self.results[item][1]))
            self.spark.createDataFrame([row], _MEMO).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{uuid.uuid5(uuid.NAMESPACE_OID, item)}")
        return self.results[item]


_MEMO = "item string, rmse double, importances string"


def race(memo: FitMemo, features: Sequence[str], candidates: Sequence[dict], z: float = 2.58) -> list[dict]:
    """Paired elimination: candidates whose errors on the same rows are worse than the best one's beyond doubt are out.

    All candidates are fitted on all features and predict the validation rows as columns of one scan;
    per candidate the mean and deviation of its squared errors' difference to the best one's decide.
    """
    scored = memo.predicted(features, candidates)
    errors = [(F.col(memo.label) - F.col(f"_p{i}")) ** 2 for i in range(len(candidates))]
    mean = scored.agg(*[F.avg(e).alias(f"m{i}") for i, e in enumerate(errors)]).first()
    best = min(range(len(candidates)), key=lambda i: (mean[f"m{i}"], i))
    gaps = [e - errors[best] for e in errors]
    got = scored.agg(F.count(F.lit(1)).alias("n"), *[F.avg(g).alias(f"d{i}") for i, g in enumerate(gaps)],
                     *[F.stddev_samp(g).alias(f"s{i}") for i, g in enumerate(gaps)]).first()
    rows = []
    for i, c in enumerate(candidates):
        error = (got[f"s{i}"] or 0.0) / math.sqrt(got["n"])
        rows.append({"candidate": i, "params": c, "rmse": math.sqrt(mean[f"m{i}"]), "gap": got[f"d{i}"], "error": error,
                     "kept": i == best or got[f"d{i}"] <= z * error})
    return rows


def search_select(memo: FitMemo, features: Sequence[str], candidates: Sequence[dict], *, how: str, min_features: int = 1) -> list[dict]:
    """F4/F5 joined with a search: each candidate that survives the race eliminates (``rfe``) or adds (``rfa``) features.

    Rows: one per candidate and subset, ``best`` marks the pair with the smallest RMSE (fewer features
    on ties). Subsets that several candidates or methods meet with the same parameters are fitted once.
    """
    rows = []
    for r in race(memo, features, candidates):
        if not r["kept"]:
            continue
        c, tried = r["params"], []
        _, imp = memo(features, c)
        order = sorted(features, key=lambda f: (-imp[f], f))
        if how == "rfa":
            tried = [order[:k] for k in range(1, len(order) + 1)]
        elif how == "rfe":
            current = list(order)
            while True:
                tried.append(current)
                if len(current) <= min_features:
                    break
                _, imp = memo(current, c)
                current = sorted(current, key=lambda f: (-imp[f], f))[:-1]
        else:
            raise ValueError("how is 'rfe' or 'rfa'")
        rows += [{"candidate": r["candidate"], "n_features": len(s), "features": ",".join(sorted(s)), "rmse": memo(s, c)[0]} for s in tried]
    best = min(rows, key=lambda r: (r["rmse"], r["n_features"], r["candidate"]))
    return [{**r, "best": r is best} for r in rows]


def search_boruta(memo: FitMemo, df: DataFrame, features: Sequence[str], candidates: Sequence[dict], *, key: str, **params) -> list[dict]:
    """F6 joined with a search: Boruta's features (confirmed or undecided; all, if none is), then the candidates on these."""
    chosen = [r["feature"] for r in boruta(df, features, label=memo.label, key=key, **params) if r["decision"] != "rejected"] or list(features)
    rows = [{"candidate": r["candidate"], "n_features": len(chosen), "features": ",".join(sorted(chosen)), "rmse": memo(chosen, r["params"])[0]}
            for r in race(memo, chosen, candidates) if r["kept"]]
    best = min(rows, key=lambda r: (r["rmse"], r["candidate"]))
    return [{**r, "best": r is best} for r in rows]
