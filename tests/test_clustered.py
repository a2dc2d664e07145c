"""Clustered tile tables need no exchange of pixels; counts from footers; mergeable sketches."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators.impute import fill_per_tile
from tessera.operators.neighbour import neighbour_fill
from tessera.sources import clustered as CL
from tessera.sources import sinks as SK


def _plan(df):
    return df.select("*")._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    rng = random.Random(4)
    rows = [(t, i, None if rng.random() < 0.4 else rng.random()) for t in ("a", "b", None) for i in range(6 * 35)]
    df = spark.createDataFrame(rows, "tile string, pixel_idx long, v double")
    name = CL.write_clustered(df, f"file://{tmp_path_factory.mktemp('clustered')}/t", block=6 * 4, buckets=5)
    return df, CL.read_clustered(spark, name)


def test_neighbour_fill_in_place(table):
    df, held = table
    out = neighbour_fill(held, ["v"], slab=CL.SLAB)
    assert "Exchange hashpartitioning" not in _plan(out) and "Exchange rangepartitioning" not in _plan(out)
    key = lambda r: (str(r.tile), r.pixel_idx, r.v)
    want = neighbour_fill(df, ["v"], block=None).collect()
    assert sorted(map(key, out.collect())) == sorted(map(key, want))


def test_tile_means_in_place(table):
    df, held = table
    out = fill_per_tile(held, ["v"])
    assert "Exchange hashpartitioning" not in _plan(out)
    key = lambda r: (str(r.tile), r.pixel_idx, round(r.v, 9))
    assert sorted(map(key, out.collect())) == sorted(map(key, fill_per_tile(df, ["v"]).collect()))


def test_blocks_in_place(table, tmp_path):
    df, held = table
    blocks = SK.pixel_blocks(held, width=6, height=35, block=4, slab=CL.SLAB)
    assert "Exchange" not in _plan(blocks)
    key = lambda r: (str(r.tile), r.brow, r.bcol, r.h, r.w, r.n, str(r.data))
    assert sorted(map(key, blocks.collect())) == sorted(map(key, SK.pixel_blocks(df, width=6, height=35, block=4).collect()))
    SK.write_blocks(blocks.where("tile IS NOT NULL"), f"file://{tmp_path}/b", dealt=True)


def test_counts_come_from_footers(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    spark.range(1000).select((F.col("id") % 3).alias("tile"), F.col("id").alias("pixel_idx"), F.rand(1).alias("v")).write.partitionBy("tile").parquet(path)
    got = sorted(map(tuple, CL.footer_counts(spark, path).collect()))
    assert got == [(0, 334, 0, 999), (1, 333, 1, 997), (2, 333, 2, 998)]
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    plan = CL.footer_plan(own, path, tile="tile", key="pixel_idx")._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(pixel_idx), MAX(pixel_idx)]" in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"  # the caller's session is as it was


@pytest.mark.parametrize("seed", [1, 2])
def test_sketches_merge_within_their_error(spark, seed):
    rng = random.Random(seed)
    values = [(t, rng.gauss(t, 1 + t)) for t in range(6) for _ in range(4000)]
    df = spark.createDataFrame([*values, (7, None)], "tile int, v double").repartition(5)
    sketches = CL.tile_sketches(df, ["v"])
    assert {r.tile: r.n for r in sketches.collect()} == {**{t: 4000 for t in range(6)}, 7: 0}
    probs = [0.001, 0.1, 0.25, 0.5, 0.9, 0.999]
    for tiles in ((0, 1, 2, 3, 4, 5), (2, 5), (3,)):
        own = sorted(v for t, v in values if t in tiles)
        row = CL.sketch_bounds(sketches.where(F.col("tile").isin(*tiles)), probs).first()
        assert row.n == len(own)
        for p, q in zip(probs, row.quantiles):
            assert abs(sum(v <= q for v in own) / len(own) - p) < 0.01
    assert CL.sketch_bounds(sketches.where("tile = 7"), probs).count() == 0
