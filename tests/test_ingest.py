"""Broken files, line-wise ingest and blocks made of lines."""

from __future__ import annotations

import os
import shutil

import pytest
from pyspark.sql import functions as F

from tessera.sources import files as FI
from tessera.sources import raster as RS
from tessera.sources import sinks as SK

SCHEMA = "pixel_idx long, v float"


@pytest.fixture()
def folder(spark, tmp_path):
    """Tiles 0-6: sound, cut short, empty file, a flipped byte in the data, no rows, sound in two files, no Parquet at all."""
    root = tmp_path / "tiles"
    for t in range(6):
        rows = [] if t == 4 else [(i, float(i % 97) * 1.7) for i in range(6000)]
        spark.createDataFrame(rows, SCHEMA).repartition(2 if t == 5 else 1).write.parquet(f"file://{root}/tile={t}")
    one = lambda t: next((root / f"tile={t}").glob("part-*.parquet"))
    for crc in root.glob("tile=*/.*.crc"):
        crc.unlink()
    one(1).write_bytes(one(1).read_bytes()[:-200])
    one(2).write_bytes(b"")
    data = bytearray(one(3).read_bytes())
    data[len(data) // 3] ^= 255
    one(3).write_bytes(bytes(data))
    os.mkdir(root / "tile=6")
    (root / "tile=6" / "part-0.parquet").write_text("no raster")
    return f"file://{root}"


def test_broken_files_are_told_apart(spark, folder):
    tile = F.regexp_extract("path", r"/tile=(\d+)/", 1).cast("int")
    got = FI.check_files(spark, folder, SCHEMA).withColumn("tile", tile)
    why = {r.tile: r.reason for r in got.collect()}
    assert why == {0: None, 1: "unreadable file", 2: "empty file", 3: "damaged rows", 4: "no rows", 5: None, 6: "unreadable file"}
    sound = {r.path: (r.rows, r.arrived) for r in got.where("reason IS NULL").collect()}
    assert len(sound) == 3 and all(a == b for a, b in sound.values()) and sum(a for a, _ in sound.values()) == 12_000
    sums = got.where("tile in (0, 5)").groupBy("tile").agg(F.bit_xor("checksum").alias("x")).collect()
    assert sums[0].x == sums[1].x  # the same rows in one file or in two
    grid = spark.createDataFrame([(t, 60, 100) for t in (0, 1, 2, 3, 4, 6)] + [(5, 60, 101), (7, 60, 100)], "tile int, width long, height long")
    pixels, status = FI.ingest_files(spark, folder, SCHEMA, grid, tile=tile)
    assert {r.tile: r.n for r in pixels.groupBy("tile").agg(F.count("*").alias("n")).collect()} == {0: 6000}
    assert {r.tile: r.reason for r in status.collect()} == why | {5: "rows 6000 != expected 6060", 7: "no rows"}


def test_folder_without_broken_files(spark, tmp_path):
    spark.range(10).select(F.col("id").alias("pixel_idx"), F.lit(1.0).cast("float").alias("v")).repartition(3).write.parquet(f"file://{tmp_path}/t")
    assert FI.check_files(spark, f"file://{tmp_path}/t", SCHEMA).where("reason IS NOT NULL").count() == 0
    assert FI.list_files(spark, f"file://{tmp_path}/t", "*.crc").count() == 0


def test_listing_is_the_whole_folder(spark, tmp_path):
    from tessera.plans.queries_data import discover_files
    for name in ("a.parquet", "b.parquet", "notes.txt"):
        (tmp_path / name).write_text(name)
    got = {r["name"]: r.length for r in discover_files(spark, f"file://{tmp_path}").collect()}
    assert got == {"a.parquet": 9, "b.parquet": 9}
    shutil.copy(tmp_path / "a.parquet", tmp_path / "c.parquet")
    assert discover_files(spark, f"file://{tmp_path}").count() == 3


def _lines(spark, rows):
    return spark.createDataFrame(rows, "tile int, row long, name string, data array<float>")


def test_lines_are_zipped_without_a_shuffle_of_cells(spark):
    rows = [(1, 0, "a", [1.0, 2.0, None]), (1, 0, "b", [4.0, 5.0, 6.0]), (1, 1, "a", [7.0, 8.0, 9.0]), (2, 5, "b", [0.5]), (2, 5, "other", [1.0, 2.0])]
    out = RS.lines_to_columns(_lines(spark, rows), width=3, names=["a", "b"])
    assert sorted(map(tuple, out.collect())) == [(1, 0, 1.0, 4.0), (1, 1, 2.0, 5.0), (1, 2, None, 6.0), (1, 3, 7.0, None), (1, 4, 8.0, None),
                                                 (1, 5, 9.0, None), (2, 15, None, 0.5)]
    plan = out.select("*")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("Exchange")  # cells are made above the only exchange
    assert plan.count("Exchange hashpartitioning") == 1
    for bad, why in (([(1, 0, "a", [1.0]), (1, 0, "a", [2.0])], "duplicate line"), ([(1, 0, "a", [1.0]), (1, 0, "b", [2.0, 3.0])], "unequal length")):
        with pytest.raises(Exception, match=why):
            RS.lines_to_columns(_lines(spark, bad), width=3, names=["a", "b"]).collect()
    assert RS.lines_to_columns(_lines(spark, []), width=3, names=["a", "b"]).count() == 0


def test_bands_of_a_line_as_columns(spark):
    rows = [(1, 0, "a", [1.0, float("nan")]), (1, 1, "a", [None, 4.0])]
    out = RS.band_columns(_lines(spark, rows), keys=["tile", "row"], data="data", names=["x", "y"])
    assert sorted(map(tuple, out.collect())) == [(1, 0, 1.0, None), (1, 1, None, 4.0)]
    for bad, why in ((rows + rows[:1], "several lines"), ([(1, 0, "a", [1.0])], "without 2 values")):
        with pytest.raises(Exception, match=why):
            RS.band_columns(_lines(spark, bad), keys=["tile", "row"], data="data", names=["x", "y"]).collect()


@pytest.mark.parametrize("width,height,block", [(7, 5, 3), (4, 4, 4), (1, 3, 2), (5, 1, 9)])
def test_blocks_of_lines(spark, width, height, block):
    cells = spark.range(width * height).select(F.lit("t").alias("tile"), F.col("id").alias("pixel_idx"), (F.col("id") * 2.0).alias("v"))
    out = SK.pixel_blocks(cells, width=width, height=height, block=block)
    got = {(r.brow, r.bcol): (r.h, r.w, r.n, r.data) for r in out.collect()}
    want = {}
    for br in range(-(-height // block)):
        for bc in range(-(-width // block)):
            rs, cs = range(br * block, min(height, br * block + block)), range(bc * block, min(width, bc * block + block))
            want[br, bc] = (len(rs), len(cs), len(rs) * len(cs), [2.0 * (r * width + c) for r in rs for c in cs])
    assert got == want
    back = SK.blocks_to_pixels(out, width=width, block=block)
    assert back.join(cells.withColumnRenamed("v", "_v"), ["tile", "pixel_idx"]).where("v = _v").count() == width * height
    wrong = [cells.where("pixel_idx > 0"), cells.unionAll(cells.limit(1))]
    if (height - 1) % block:  # a block that is wholly absent is the grid check's
        wrong.append(cells.where(F.col("pixel_idx") < width * (height - 1)))
    for some in wrong:
        with pytest.raises(Exception, match="line of|block of"):
            SK.pixel_blocks(some, width=width, height=height, block=block).collect()
