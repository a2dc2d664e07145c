"""Integer vectors in cells of bounded memory: what the exact searches share.

A component x becomes floor(256 * x), x as double. Vectors that are null or hold a null or a
non-finite component take no part; a component that does not fit in 63 bits raises. Query blocks
times candidate blocks form a grid of cells; a block has as many rows as the cell's memory allows
(a bounded number of vector components), and fewer where that leaves cores idle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Vector components in a block, and rows below which a block isn't split for more cores.
BLOCK_VALUES, LEAST_ROWS = 1 << 22, 1024
#: Stands for scores below the range of a long; an error if one is among the results.
TOO_LOW = -(1 << 63)


def quantised(vector: Column) -> Column:
    """floor(256 * x) per component; null where the vector takes no part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))

    def whole(x: Column) -> Column:
        scaled = x.cast("double") * 256.0
        too_big = F.raise_error(F.lit("a component does not fit in 63 bits")).cast("long")
        return F.when(F.abs(scaled) >= 2.0**63, too_big).otherwise(F.floor(scaled).cast("long"))
    return F.when(vector.isNotNull() & ~F.coalesce(bad, F.lit(False)), F.transform(vector, whole))


def block_count(spark, rows: int, width: int) -> int:
    """Blocks of ``rows`` vectors of up to ``width`` components."""
    most = max(1, BLOCK_VALUES // max(1, width))
    own = min(most, max(LEAST_ROWS, -(-rows // (4 * spark.sparkContext.defaultParallelism))))
    return max(1, -(-rows // own))


def block_of(row: str, blocks: int, seed: int) -> Column:
    return F.pmod(F.xxhash64(row, F.lit(seed)), F.lit(blocks)).cast("int")


def each(blocks: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))


def flat(table: pa.Table, column: str) -> tuple[np.ndarray, np.ndarray]:
    """The lists of a column as one value array with offsets."""
    lists = table[column].combine_chunks() if table.num_rows else pa.array([], pa.list_(pa.int64()))
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks)
    sizes = np.diff(lists.offsets.to_numpy())
    return lists.flatten().to_numpy(zero_copy_only=False), np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)


def largest_product(one: np.ndarray, other: np.ndarray, width: int) -> int:
    """A bound on the size of inner products, and of their partial sums."""
    size = lambda v: max(abs(int(v.min(initial=0))), abs(int(v.max(initial=0))))
    return size(one) * size(other) * max(1, width)


def as_long(scores: np.ndarray) -> np.ndarray:
    """Scores as 64-bit integers: too high ones raise, too low ones become TOO_LOW."""
    if scores.dtype != object:
        return scores.astype(np.int64)
    if any(s >= 2**63 for s in scores):
        raise OverflowError("a score does not fit in 63 bits")
    return np.array([max(int(s), TOO_LOW) for s in scores], np.int64)


def in_range(score: str) -> Column:
    """The score, or an error where it lies below the range of a long."""
    low = F.raise_error(F.lit("a score does not fit in 63 bits")).cast("long")
    return F.when(F.col(score) == TOO_LOW, low).otherwise(F.col(score))


def sizes_of(v: DataFrame, asks: Column, vector: str) -> tuple[int, int, int]:
    """Rows, rows that ask, and the longest vector."""
    got = v.agg(F.count("*").alias("n"), F.count_if(asks).alias("q"), F.max(F.size(vector)).alias("d")).first()
    return got["n"], got["q"] or 0, max(got["d"] or 0, 0)
