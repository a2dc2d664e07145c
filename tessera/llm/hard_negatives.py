"""Hard-negative mining by Fagin's threshold algorithm.

Components become integers floor(256 * x). A block of candidates keeps one list per dimension,
sorted by the component. An anchor reads all lists at once, a dimension with a positive weight
from the top and one with a negative weight from the bottom (sorted access), scores every row it
meets by the whole integer inner product (random access), and after each stretch forms the
threshold: the sum of its weights times the last components read, which no unread row exceeds.

Two searches run that way. The first finds an anchor's positives, its best rows of the same label.
Each positive's score p opens a window of scores [low * p, high * p] (in hundredths), and the
second finds the best rows of other labels in every window. A window is done when the threshold is
strictly below its k-th score (an equal one could belong to a smaller id) or below its lower end;
an anchor stops when all its windows are done or all rows are read. Candidates are dealt into
blocks, so lists, anchors and scores of a task are bounded; the blocks' best rows are merged.

Higher scores come first, ties go to the smaller id. Rows with a null id, a null label or a
vector that is null or holds a null or non-finite component take no part. Shorter vectors are
padded with zeros. An anchor's own id is no candidate; a repeated anchor id is answered once per
row, a repeated candidate counts once per row. A negative p has an empty window, p = 0 takes
scores of 0. A window without rows, an anchor without positives and an empty table give no rows.
Integers beyond 63 bits raise. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import written
from tessera.llm.vectors import as_long, block_count, block_of, each, flat, in_range, largest_product, quantised, sizes_of

#: Rows of every list that the first stretch reads; each further stretch doubles the depth.
FIRST_STRETCH = 16
_FOUND = "anchor_row long, anchor_id long, p long, vec_row long, vec_id long, score long"


def _matrix(values: np.ndarray, offsets: np.ndarray, width: int, kind) -> np.ndarray:
    """Vectors as rows of ``width`` components."""
    sizes = np.diff(offsets)
    if len(sizes) and (sizes == width).all():
        return values.reshape(len(sizes), width).astype(kind)
    out = np.zeros((len(sizes), width), kind)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    out[rows, np.arange(len(values)) - np.repeat(offsets[:-1], sizes)] = values
    return out


class Lists:
    """A block of candidates with one sorted list per dimension."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.order = np.argsort(vectors, axis=0, kind="stable").T.astype(np.int32)  # dimension, place
        self.sorted = np.take_along_axis(vectors, self.order.T, axis=0).T

    def search(self, anchor: np.ndarray, able: np.ndarray, windows: list[tuple[int, int]], k: int, ids: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, int]:
        """Per window the places of its k best able rows; all scores known by then, and rows scored."""
        n = len(self.vectors)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        met, scored = np.zeros(n, bool), np.zeros(n, bool)
        scores = np.zeros(n, self.vectors.dtype)
        open_, depth, stretch = {w for w, (low, high) in enumerate(windows) if low <= high}, 0, FIRST_STRETCH
        if not len(up) and not len(down):
            scored[:], open_ = True, set()  # no weight: every score is 0
        while open_ and depth < n:
            to = min(n, depth + stretch)
            met[self.order[up, n - to:n - depth]] = True
            met[self.order[down, depth:to]] = True
            new = np.flatnonzero(met & ~scored)
            scores[new] = self.vectors[new] @ anchor
            scored[new] = True
            depth, stretch = to, to
            if scored.all():
                break
            threshold = int(self.sorted[up, n - to] @ anchor[up]) + int(self.sorted[down, to - 1] @ anchor[down])
            known = scores[scored & able]
            for w in list(open_):
                low, high = windows[w]
                inside = known[(known >= low) & (known <= high)]
                if threshold < low or len(inside) >= k and np.partition(inside, len(inside) - k)[len(inside) - k] > threshold:
                    open_.discard(w)
        best = []
        for low, high in windows:
            at = np.flatnonzero(scored & able & (scores >= low) & (scores <= high))
            if len(at) > k:
                at = at[scores[at] >= np.partition(scores[at], len(at) - k)[len(at) - k]]
            best.append(np.array(sorted(at.tolist(), key=lambda i: (-scores[i], ids[i]))[:k], np.int64))
        return best, scores, int(scored.sum())


def _cell(k: int, same: bool, low: int, high: int, width: int):
    """Search of a cell's anchors in its candidates: ``same`` label in one window, or others in the windows of ``p``."""
    def search(table: pa.Table) -> pa.Table:
        anchors, held = (table.filter(pc.equal(table["side"], s)).combine_chunks() for s in (0, 1))
        names = [f.split()[0] for f in _FOUND.split(", ")]
        out: list[list] = [[] for _ in names]
        if anchors.num_rows and held.num_rows:
            a, b = flat(anchors, "v"), flat(held, "v")
            most = largest_product(a[0], b[0], width)
            # sums of integers below 2^53 are exact in floating point, whose products are the fast ones
            kind = np.float64 if most < 2**53 else np.int64 if most < 2**63 else object
            asking, lists = _matrix(*a, width, kind), Lists(_matrix(*b, width, kind))
            ids, rows, labels = (held[c].to_numpy() for c in ("id", "row", "label"))
            for i, (row, own, label, scores_p) in enumerate(zip(*(anchors[c].to_pylist() for c in ("row", "id", "label", "p")))):
                able = (labels == label if same else labels != label) & (ids != own)
                windows = [(-most, most)] if same else [(-(-low * p // 100), high * p // 100) for p in scores_p]
                for p, best in zip([None] if same else scores_p, (found := lists.search(asking[i], able, windows, k, ids))[0]):
                    if len(best):
                        out[0] += [row] * len(best)
                        out[1] += [own] * len(best)
                        out[2] += [p] * len(best)
                        out[3] += rows[best].tolist()
                        out[4] += ids[best].tolist()
                        out[5] += as_long(found[1][best]).tolist()
        return pa.table({n: pa.array(x, pa.int64()) for n, x in zip(names, out)})
    return search


def _ranked(found: DataFrame, k: int, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id", "vec_row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, *, row_id: str, vector: str, label: Column, is_anchor: Column,
                   positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    For each anchor and each of its positives the first negatives whose score is from ``low`` to
    ``high`` hundredths of the positive's.
    """
    spark = vectors.sparkSession
    v = written(vectors.select(F.col(row_id).cast("long").alias("id"), label.cast("long").alias("label"),
                               quantised(F.col(vector)).alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("asks"),
                               F.monotonically_increasing_id().alias("row"))
                .where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()), "labelled")
    n, q, width = sizes_of(v, F.col("asks"), "v")
    n_c, n_q = block_count(spark, n, width), max(1, -(-q // max(1, -(-n // block_count(spark, n, width)))))

    def searched(asks: DataFrame, k: int, same: bool) -> DataFrame:
        asking = asks.select(F.lit(0).alias("side"), "row", "id", "label", "v", "p", block_of("row", n_q, 1).alias("qb"), each(n_c).alias("cb"))
        held = v.select(F.lit(1).alias("side"), "row", "id", "label", "v", F.lit(None).cast("array<long>").alias("p"),
                        each(n_q).alias("qb"), block_of("row", n_c, 2).alias("cb"))
        return asking.unionByName(held).groupBy("qb", "cb").applyInArrow(_cell(k, same, low, high, width), _FOUND)

    anchors = v.where("asks")
    near = _ranked(searched(anchors.withColumn("p", F.lit(None).cast("array<long>")), positives, True), positives, "anchor_row")
    near = written(near.select("anchor_row", "anchor_id", F.col("vec_id").alias("positive_id"), "rank", in_range("score").alias("p")), "positives")
    windows = near.groupBy(F.col("anchor_row").alias("row")).agg(F.sort_array(F.collect_set("p")).alias("p"))  # few per anchor
    found = _ranked(searched(anchors.join(windows, "row"), negatives, False), negatives, "anchor_row", "p")
    return (near.withColumnRenamed("rank", "positive_rank").join(found.drop("anchor_id"), ["anchor_row", "p"])
            .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), F.col("p").alias("positive_score"),
                    F.col("score").alias("negative_score"), "positive_rank"))
