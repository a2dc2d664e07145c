"""Connected components by union-find: within tasks first, then stars across them.

Each task joins its own edges by union-find and passes on one edge per node. The rest alternates
two star operations (Kiveris et al., 2014) on DataFrames: every node hands its larger neighbours
(large star) or smaller ones (small star) to the least node around it. Neighbourhoods are never
collected: the least neighbour is an aggregate that is joined back. Every round is written, so a
lost executor repeats one round at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written
from tessera.llm.texts import releasing


class UnionFind:
    """Integers joined into sets; a set's name is its least member."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        path = []
        while (y := self.up.get(x, x)) != x:
            path.append(x)
            x = y
        for p in path:
            self.up[p] = x
        return x

    def join(self, a: int, b: int) -> bool:
        """True if they were apart."""
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's edges as (node, root) pairs, in runs of bounded size."""
    sets, held = UnionFind(), 0

    def out() -> pa.RecordBatch:
        nodes = np.fromiter(sets.up, np.int64, len(sets.up))
        roots = np.fromiter((sets.find(int(x)) for x in nodes), np.int64, len(nodes))
        return pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(roots)], ["u", "v"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            sets.join(a, b)
        held += batch.num_rows
        if held > 2_000_000:
            yield out()
            sets, held = UnionFind(), 0
    yield out()


def _stars(edges: DataFrame, small: bool) -> DataFrame:
    """Edges (u > v) after one star operation."""
    if small:
        sides = edges.select("u", "v")
    else:
        sides = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = sides.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m")).withColumn("m", F.least("m", "c"))
    near = sides.join(least, F.col("u") == F.col("c"))
    if small:
        out = near.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select(F.col("c").alias("u"), F.col("m").alias("v")))
    else:
        out = near.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.where("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the edges (a, b): root is the least node it can reach."""
    forest = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b").mapInArrow(releasing(_forest), "u long, v long")
    stars = written(forest.where("u <> v").distinct(), "forest")
    if stars.isEmpty():
        return stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
    mark = lambda df: df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    before = mark(stars)
    while True:
        stars = written(_stars(_stars(stars, small=False), small=True), "stars")
        now = mark(stars)
        if now == before:
            break
        before = now
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)
