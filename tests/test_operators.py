"""Unit and property tests on hand-made frames (edge cases of SURVEY §5)."""

from __future__ import annotations

import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.operators import clean as C
from tessera.operators import impute as I
from tessera.operators import metrics as M
from tessera.operators import sample as S
from tessera.operators.neighbour import neighbour_fill
from tessera.operators.numbering import index_within
from tessera.operators.outliers import remove_outlier
from tessera.sources import catalog as K
from tessera.sources import sinks as SK


# ----------------------------------------------------------------- reference loops

def run_fill(values):
    """What W1 promises, run by run: k nulls between a and b become a, ..., a, (a + b) / 2; a leading
    run keeps its nulls but for the last, which becomes b; a trailing run repeats a."""
    out, i = list(values), 0
    while i < len(values):
        if values[i] is not None:
            i += 1
            continue
        j = i
        while j < len(values) and values[j] is None:
            j += 1
        a, b = (values[i - 1] if i else None), (values[j] if j < len(values) else None)
        if a is not None:
            out[i:j] = [a] * (j - i)
            if b is not None:
                out[j - 1] = (a + b) / 2
        elif b is not None:
            out[j - 1] = b
        i = j
    return out


def patience_loop(curve, patience):
    best_i, best_v = 0, math.inf
    for i, x in enumerate(curve, start=1):
        if x < best_v:
            best_i, best_v = i, x
        if i - best_i >= patience:
            break
    return best_i


# --------------------------------------------------------------------------- P1-P3

def test_encode_nulls_bounds_inclusive(spark):
    df = spark.createDataFrame([(1, -9999.0), (2, -40.0), (3, 1000.0), (4, 1000.5), (5, None), (6, -41.0)],
                               "k int, v double")
    out = dict(C.encode_nulls_bycol(df, "v").select("k", "v").collect())
    assert out == {1: None, 2: -40.0, 3: 1000.0, 4: None, 5: None, 6: None}


def test_assign_nulls_inf_and_keys(spark):
    df = spark.createDataFrame([(1, float("-inf"), "a"), (2, float("inf"), "b"), (3, 5.0, "c")],
                               "pix long, v double, s string")
    out = {r.pix: r.v for r in C.assign_nulls(df, 0, 10, exclude=["pix"]).collect()}
    assert out == {1: None, 2: None, 3: 5.0}


def test_dropnulls_missing_column(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError):
        C.dropnulls_bycol(df, "b")


def test_clean_filter_pushed_down(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, 10.0, 20.0)], "pix long, edem double, ldem double").write.parquet(path)
    plan = C.clean_filter(spark.read.parquet(path), ["edem", "ldem"], 0, 100)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(edem,0.0)" in plan and "LessThanOrEqual(edem,100.0)" in plan


# ---------------------------------------------------------------------------- I1 I2

def test_fill_mean_mode_and_all_null(spark):
    df = spark.createDataFrame([(1, 1.0, None, "b"), (2, None, None, "a"), (3, 3.0, None, "a"),
                                (4, 5.0, None, "b"), (5, 5.0, None, None)],
                               "k int, x double, allnull double, c string")
    out = {r.k: r for r in I.fill_nulls(df, exclude=["k"]).collect()}
    assert out[2].x == pytest.approx(3.5)
    assert out[1].allnull is None  # all-null numeric stays null
    assert out[5].c == "a"  # tie between a and b -> smallest


def test_fill_integral_becomes_double(spark):
    df = spark.createDataFrame([(1, 1), (2, None), (3, 2)], "k int, n long")
    out = I.fill_nulls(df, ["n"])
    assert dict(out.dtypes)["n"] == "double"
    assert {r.k: r.n for r in out.collect()}[2] == pytest.approx(1.5)


def test_fill_per_tile(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, None), ("b", 3, 10.0), ("b", 4, None)],
                               "tile string, pix int, f double")
    out = {r.pix: r.f for r in I.fill_per_tile(df, ["f"]).collect()}
    assert out == {1: 1.0, 2: 1.0, 3: 10.0, 4: 10.0}


# ------------------------------------------------------------------------------- W1

@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50)), min_size=1, max_size=60),
       st.integers(2, 9))
def test_neighbour_fill_matches_loop(spark, values, block):
    rows = [("t", i, None if v is None else float(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "tile string, pixel_idx long, v double")
    want = run_fill([r[2] for r in rows])
    for blk in (None, block):
        got = {r.pixel_idx: r.v for r in neighbour_fill(df, ["v"], block=blk).collect()}
        assert [got[i] for i in range(len(values))] == want  # halves of integers: exact


def test_neighbour_fill_unknown_column_ignored(spark):
    df = spark.createDataFrame([("t", 0, 1.0)], "tile string, pixel_idx long, v double")
    assert neighbour_fill(df, ["nope"]).collect() == df.collect()


# -------------------------------------------------------------------- numbering W5

def test_index_within_blocks(spark):
    keys = random.Random(1).sample(range(10_000), 500)
    df = spark.createDataFrame([(k % 3, k) for k in keys], "g int, k long")
    out = index_within(df, order_key="k", group=["g"], block=64, out="i").collect()
    for g in range(3):
        ks = sorted(r.k for r in out if r.g == g)
        assert [r.i for r in sorted((r for r in out if r.g == g), key=lambda r: r.k)] == list(range(len(ks)))


# ----------------------------------------------------------------- samples, splits

@pytest.fixture(scope="module")
def keyed(spark):
    rows = [(f"t{i % 4}", i) for i in range(1, 2001)]
    return spark.createDataFrame(rows, "tile string, pix long")


def _hash_order(spark, df, n, seed):
    from pyspark.sql import Window
    w = Window.partitionBy("tile").orderBy(F.md5(F.concat_ws(":", F.col("pix").cast("string"), F.lit(str(seed)))),
                                           "pix")
    return {(r.tile, r.pix) for r in df.withColumn("r", F.row_number().over(w)).where(F.col("r") <= n).collect()}


@pytest.mark.parametrize("n", [0, 1, 100, 499, 500, 800])
def test_sample_threshold_equals_window(spark, keyed, n):
    got = {(r.tile, r.pix) for r in S.sample_per_group(keyed, n, key="pix", seed=5).collect()}
    assert got == _hash_order(spark, keyed, n, 5)
    assert len(got) == 4 * min(n, 500)


def test_nested_samples(spark, keyed):
    small = {r.pix for r in S.sample_per_group(keyed, 50, key="pix", seed=9).collect()}
    big = {r.pix for r in S.sample_per_group(keyed, 120, key="pix", seed=9).collect()}
    assert small < big


@pytest.mark.parametrize("share", [0.0, 0.1, 0.333, 1.0])
def test_split_exact_sizes(spark, keyed, share):
    rows = S.split_by_share(keyed, share, key="pix", seed=43).collect()
    assert len(rows) == 2000 and len({r.pix for r in rows}) == 2000
    assert sum(r.part == "valid" for r in rows) == math.ceil(share * 2000)


def test_split_three_way_sizes(spark, keyed):
    rows = S.split_three_way(keyed, key="pix", seed=43).collect()
    held = math.ceil(0.3 * 2000)
    counts = {p: sum(r.part == p for r in rows) for p in ("train", "valid", "test")}
    assert counts == {"train": 2000 - held, "test": math.ceil(0.5 * held), "valid": held - math.ceil(0.5 * held)}


def test_sample_n_global(spark, keyed):
    got = [r.pix for r in S.sample_n(keyed, 37, key="pix", seed=1).collect()]
    assert len(got) == 37 and len(set(got)) == 37


def test_sample_plan_truncates(spark):
    tiles = spark.createDataFrame([(12, 6), (30, 7), (1, 3)], "res int, n_tiles long")
    rows = S.sample_plan(tiles).collect()
    assert {r.res for r in rows} == {12, 30}  # unknown resolution: no plan
    got = {(r.res, r.multiplier): r.n for r in rows}
    assert got[(12, 0.1)] == 1_350_000  # 81,000,000 over 6 tiles, a tenth
    assert got[(30, 0.5)] == 925_714  # 12,960,000 over 7 tiles is 1,851,428; half of it


# ----------------------------------------------------------------------- outliers

def test_outlier_unknown_method(spark):
    df = spark.createDataFrame([(1.0,)], "v double")
    with pytest.raises(ValueError):
        remove_outlier(df, "v", "median")
    with pytest.raises(ValueError):
        remove_outlier(df, "w", "zscore")


def test_outlier_zero_sigma_keeps_nothing(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (None,)], "v double")
    assert remove_outlier(df, "v", "zscore").count() == 0
    assert remove_outlier(df, "v", "iqr").count() == 2  # nulls are dropped


# ----------------------------------------------------------------- metrics, W4, X8

@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(0, 6), min_size=1, max_size=25), st.integers(1, 5))
def test_patience_matches_loop(spark, curve, patience):
    rows = [("r", i, float(v)) for i, v in enumerate(curve, start=1)]
    df = spark.createDataFrame(rows, "run string, iteration long, rmse double")
    got = M.patience_stop(df, patience).collect()[0].best_iteration
    assert got == patience_loop([float(v) for v in curve], patience)


def test_early_stopping_rounds(spark):
    df = spark.createDataFrame([(n,) for n in [100, 499, 500, 1000, 1001, 20000]], "n long")
    got = [r.esr for r in df.select(M.early_stopping_rounds(F.col("n")).alias("esr")).collect()]
    assert got == [20, 49, 100, 100, 50, 1000]


def test_r2_null_when_constant_label(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "y double, p double")
    row = M.score(df, "y", "p").collect()[0]
    assert row.r2 is None and row.rmse == pytest.approx(math.sqrt(0.5))


# --------------------------------------------------------------------------- S10

def test_blocks_round_trip_ragged(spark):
    width, height, block = 10, 7, 4
    rows = [("t", r * width + c, float(r * 100 + c)) for r in range(height) for c in range(width)]
    df = spark.createDataFrame(rows, "tile string, pixel_idx long, v double")
    blocks = SK.pixel_blocks(df, width=width, height=height, block=block)
    shapes = {(b.brow, b.bcol): (b.h, b.w) for b in blocks.collect()}
    assert shapes[(1, 2)] == (3, 2) and shapes[(0, 0)] == (4, 4)
    back = {(r.pixel_idx, r.v) for r in SK.blocks_to_pixels(blocks, width=width, block=block).collect()}
    assert back == {(i, v) for _, i, v in rows}


@pytest.mark.parametrize("n", [1, 250, 499])
def test_sample_threshold_two_level_path(spark, keyed, n, monkeypatch):
    import tessera.operators.numbering as N
    monkeypatch.setattr(N, "DIRECT_RANK_LIMIT", 0)  # force the second histogram level
    got = {(r.tile, r.pix) for r in S.sample_per_group(keyed, n, key="pix", seed=5).collect()}
    assert got == _hash_order(spark, keyed, n, 5)


def test_exact_quantiles_match_pandas(spark):
    import pandas as pd
    from tessera.operators.outliers import exact_quantiles
    vals = [float((i * 7919) % 1013) / 7.0 for i in range(3000)] + [None] * 5
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
    want = pd.Series([v for v in vals if v is not None]).quantile(probs).tolist()
    assert exact_quantiles(df, "v", probs) == pytest.approx(want, rel=1e-12)
    assert exact_quantiles(df, "v", probs, accuracy=50) == pytest.approx(want, rel=1e-12)  # widening path


def test_exact_quantiles_resketch_and_missed_bracket(spark, monkeypatch):
    import pandas as pd
    import tessera.operators.outliers as O
    vals = [float((i * 104729) % 4999) / 3.0 for i in range(4000)]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    probs = [0.1, 0.5, 0.9]
    want = pd.Series(vals).quantile(probs).tolist()
    # a count that asks for more accuracy than the first sketch: second sketch pass
    monkeypatch.setattr(O, "BRACKET_ROWS", 100)
    monkeypatch.setattr(O, "MIN_ACCURACY", 20)
    assert O.exact_quantiles(df, "v", probs) == pytest.approx(want, rel=1e-12)
    # a first bracket that misses every order statistic: the pick job proves nothing, widen
    real = O._brackets
    calls = []

    def narrow_first(x, ps, margin, acc):
        n, lo, hi = real(x, ps, margin, acc)
        calls.append(margin)
        return (n, [10 ** 9] * len(ps), [10 ** 9 + 1] * len(ps)) if len(calls) == 1 else (n, lo, hi)

    monkeypatch.setattr(O, "_brackets", narrow_first)
    monkeypatch.setattr(O, "BRACKET_ROWS", 100_000)
    monkeypatch.setattr(O, "MIN_ACCURACY", 10_000)
    assert O.exact_quantiles(df, "v", probs) == pytest.approx(want, rel=1e-12)
    assert len(calls) == 2 and calls[1] > calls[0]


@pytest.mark.parametrize("sizes", [[50, 120, 600], [1, 499, 500]])
def test_nested_samples_are_prefixes(spark, keyed, sizes):
    rows = {(r.n_per_group, r.tile, r.pix) for r in S.nested_samples(keyed, sizes, key="pix", seed=9).collect()}
    for n in sizes:
        assert {(t, p) for k, t, p in rows if k == n} == _hash_order(spark, keyed, n, 9)


@pytest.fixture(scope="module")
def tiled(spark):
    """Keys unique only with their tile; one tile and some keys are null."""
    rows = [(None if t == 3 else f"t{t}", i) for t in range(4) for i in range(250)] + [("t0", None)]
    return spark.createDataFrame(rows, "tile string, pixel_idx long")


KEY = ["tile", "pixel_idx"]


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_composite_keys_and_null_tiles_lose_nothing(spark, tiled, limit, monkeypatch):
    import tessera.operators.numbering as N
    monkeypatch.setattr(N, "DIRECT_RANK_LIMIT", limit)
    rows = S.split_by_share(tiled, 0.1, key=KEY, group=["tile"]).collect()
    assert len(rows) == 1001
    for t in (None, "t0", "t1", "t2"):
        own = [r for r in rows if r.tile == t]
        assert sum(r.part == "valid" for r in own) == math.ceil(0.1 * len(own))
    sampled = S.sample_per_group(tiled, 200, key=KEY).collect()
    assert sorted((r.tile or "", r.pixel_idx is None) for r in sampled if r.tile is None) == [("", False)] * 200
    assert len(sampled) == 800 and len({(r.tile, r.pixel_idx) for r in sampled}) == 800
    assert S.sample_n(tiled, 30, key=KEY).count() == 30
    three = S.split_three_way(tiled, key=KEY).collect()
    held = math.ceil(0.3 * 1001)
    assert sum(r.part == "test" for r in three) == math.ceil(0.5 * held) and sum(r.part == "train" for r in three) == 1001 - held


def test_keys_that_name_no_row_raise(spark, tiled):
    with pytest.raises(Exception, match="does not name a row"):
        S.sample_n(tiled, 30, key="pixel_idx").collect()


def test_numbering_of_sparse_null_and_composite_keys(spark, tiled):
    from tessera.operators.numbering import index_ordered
    keys = [hash((i, "x")) for i in range(500)]
    df = spark.createDataFrame([(None if i % 3 == 0 else "g", k) for i, k in enumerate(keys)] + [("g", None)], "g string, k long")
    out = index_ordered(df, order_keys=["k"], group=["g"], rows_per_block=37, out="i").collect()
    for g in (None, "g"):
        own = sorted((r for r in out if r.g == g), key=lambda r: r.i)
        assert [r.i for r in own] == list(range(len(own)))
        assert [r.k for r in own] == sorted((r.k for r in own), key=lambda k: (k is not None, k or 0))
    dense = index_within(tiled, order_key="pixel_idx", group=["tile"], block=64, out="i").collect()
    assert len(dense) == 1001 and sorted(r.i for r in dense if r.tile is None) == list(range(250))
    chunks = S.chunk_ids(tiled, 100, order_key=KEY, block=64).collect()
    assert len(chunks) == 1001 and all(len({r.tile for r in chunks if r.chunk == c}) <= 2 for c in range(11))


def test_blocks_raise_on_a_wrong_length(spark):
    rows = [("t", i, float(i)) for i in range(16)]
    for wrong in (rows[:5] + rows[6:], [*rows, ("t", 5, 1.0)], rows[:5] + rows[6:] + [rows[7]]):
        df = spark.createDataFrame(wrong, "tile string, pixel_idx long, v double")
        with pytest.raises(Exception, match="where the grid has"):
            SK.pixel_blocks(df, width=4, height=4, block=2).collect()


def test_grid_check_reports_every_tile(spark):
    from tessera.sources import raster as RS
    pixels = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("x", 1), (None, 1)], "tile string, pixel_idx int")
    grid = spark.createDataFrame([("a", 2, 1), ("b", 2, 1), ("c", 2, 1), ("d", 2, 1)], "tile string, width int, height int")
    got = {r.tile: (r.n, r.ok) for r in RS.grid_check(pixels, grid).collect()}
    assert got == {"a": (2, True), "b": (1, False), "c": (0, False), "d": (0, False), "x": (1, None), None: (1, None)}
    cat = spark.createDataFrame([("a", "/a_ref.tif"), ("b", "/b.tif"), ("c", "/c_ref.tif"), ("c", "/c2_ref.tif")], "tile string, path string")
    failed = RS.missing_inputs(cat, grid, suffix="ref.tif")
    assert {r.tile: r.reason for r in failed.collect()} == {
        "b": "no reference raster", "c": "several reference rasters", "d": "no rasters"}
    good, status = RS.ingest_with_quarantine(pixels, grid, failed=failed)
    assert {r.tile: (r.status, r.reason) for r in status.collect()} == {
        "a": ("ingested", None), "b": ("quarantined", "no reference raster"), "c": ("quarantined", "several reference rasters"),
        "d": ("quarantined", "no rasters"), "x": ("ingested", "grid unknown"), None: ("ingested", "grid unknown")}
    assert sorted((r.tile or "") for r in good.collect()) == ["", "a", "a", "x"]


def test_quantiles_of_tied_values(spark):
    import pandas as pd
    from tessera.operators.outliers import exact_quantiles
    vals = [0.0] * 800 + [float(i) / 3 for i in range(1200)] + [float("nan"), None]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    probs = [0.0, 0.05, 0.25, 0.4, 0.401, 0.75, 1.0]
    want = pd.Series(vals[:2000]).quantile(probs).tolist()
    assert exact_quantiles(df, "v", probs) == pytest.approx(want, rel=1e-12)


def test_outliers_ignore_nan(spark):
    df = spark.createDataFrame([(float(i),) for i in range(10)] + [(float("nan"),), (None,)], "v double")
    for how in ("zscore", "iqr"):
        assert remove_outlier(df, "v", how).count() == 10


def test_neighbour_fill_paths_agree_on_null_tiles(spark):
    rows = [(t, i, None if i in (0, 3, 4, 7, 8) else float(i)) for t in (None, "a") for i in range(10)]
    df = spark.createDataFrame(rows, "tile string, pixel_idx long, v double")
    one, two = ({(r.tile, r.pixel_idx): r.v for r in neighbour_fill(df, ["v"], block=b).collect()} for b in (None, 4))
    assert one == two and all(one[None, i] == one["a", i] for i in range(10))


def test_baseline_keeps_groups_without_a_model(spark):
    from tessera.ml.baseline import fit_baseline, predict_baseline
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 2.0, 4.0), (None, 1.0, 1.0), (None, 2.0, 3.0)], "g string, x double, y double")
    model = fit_baseline(df.where("x > 0"), label="y", feature="x", by=["g"])
    out = predict_baseline(df.unionByName(spark.createDataFrame([("new", 1.0, 1.0)], df.schema)), model, feature="x", by=["g"]).collect()
    assert len(out) == 5 and [r.pred for r in out if r.g == "new"] == [None] and all(r.pred is not None for r in out if r.g != "new")


def test_scratch_scope_deletes_what_it_wrote(spark):
    from tessera import session
    outer = session.materialize(spark.range(3), "outer")
    with session.scratch_scope(spark):
        inner = session.materialize(spark.range(4), "inner")
        files = inner.inputFiles()
        assert inner.count() == 4
    import os
    assert files and not any(os.path.exists(f.removeprefix("file://")) for f in files)
    assert outer.count() == 3


def test_union_of_listings_that_overlap(spark):
    one = spark.createDataFrame([(12, "t", "a.tif"), (12, "t", "b.tif"), (12, "t", "b.tif")], "res int, tile string, path string")
    two = spark.createDataFrame([("b.tif", "t", 12), ("c.tif", "u", 12)], "path string, tile string, res int")
    assert sorted(r.path for r in K.union_catalogs([one, two]).collect()) == ["a.tif", "b.tif", "b.tif", "b.tif", "c.tif"]
    assert sorted(r.path for r in K.union_catalogs([one, two], distinct=True).collect()) == ["a.tif", "b.tif", "c.tif"]


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    from tessera import session

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext, conf = Context(), {}
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_fill_statistics_mode_ties_nulls_and_types(spark):
    import datetime as dt
    from tessera.operators.impute import fill_statistics
    d1, d2 = dt.date(2024, 1, 2), dt.date(2023, 5, 6)
    rows = [("b", True, d1, None, 1.0), ("a", False, d2, None, 3.0), ("b", False, d1, None, None),
            ("a", True, d2, None, 2.0), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "s string, f boolean, d date, e string, x double")
    got = fill_statistics(df).collect()
    assert len(got) == 1
    r = got[0]
    # every categorical column is a tie of two values: the smallest wins
    assert (r.s, r.f, r.d, r.e, r.x) == ("a", False, d2, None, 2.0)
    assert fill_statistics(df, ["s", "e"]).columns == ["s", "e"]
    assert fill_statistics(df.where("x > 100")).collect()[0].asDict() == \
        {"s": None, "f": None, "d": None, "e": None, "x": None}
