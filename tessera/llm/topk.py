"""Exact top-k inner-product search by exhaustive term-at-a-time accumulation.

Components become integers floor(256 * x). A block of candidates is kept as postings, one list
per dimension with the non-zero weights; each sparse query row scatters its weights times the
postings into one dense score array per block, ``argpartition`` selects the block's k best, and
a window merges the blocks. Query blocks times candidate blocks form a grid of cells bounded by
their memory, so no task holds all queries or all candidates.

Vectors that are null or hold a null or a non-finite component take no part; every other vector
does, whatever its size: products beyond 63 bits are formed with Python's integers, and a component
or a result that does not fit in 63 bits raises. Vectors of unequal length count as sparse rows
(missing components are 0; an empty vector scores 0 with all). Ties go to the smaller vec_id. Rows
with a null id take no part. A repeated query id is answered once per row, a repeated candidate
counts once per row; candidates with the query's own id are skipped. An empty table gives no rows.
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

_SCHEMA = "query_row long, query_id long, vec_id long, score long"


def _rows(table: pa.Table, side: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers, ids, and the vectors as one value array with offsets."""
    own = table.filter(pc.equal(table["side"], side)).combine_chunks()
    return own["row"].to_numpy(), own["id"].to_numpy(), *flat(own, "v")


def _postings(values: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray | slice, np.ndarray]]:
    """Per dimension the candidates with a non-zero weight, and the weights.

    A list that covers the block is kept as a column: scattering to every position in order is
    a plain addition.
    """
    lengths = np.diff(offsets)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    dims = np.arange(len(values)) - np.repeat(offsets[:-1], lengths)
    some = values != 0
    rows, dims, values = rows[some], dims[some], values[some]
    order = np.argsort(dims, kind="stable")
    rows, values = rows[order], values[order]
    ends = np.cumsum(np.bincount(dims, minlength=int(lengths.max(initial=0))))
    out: list[tuple[np.ndarray | slice, np.ndarray]] = []
    for a, b in zip(np.concatenate(([0], ends[:-1])), ends):
        at, weight = rows[a:b], values[a:b]
        if 2 * len(at) > len(lengths):
            full = np.zeros(len(lengths), np.int64)
            full[at] = weight
            at, weight = slice(None), full
        out.append((at, weight))
    return out


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best: partition selection on the score, ties at the cut by smaller id."""
    if len(scores) > k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= cut)
    else:
        at = np.arange(len(scores))
    if scores.dtype == object:
        return np.array(sorted(at.tolist(), key=lambda i: (-scores[i], ids[i]))[:k], np.int64)
    return at[np.lexsort((ids[at], -scores[at]))[:k]]


def _cell(k: int):
    def search(table: pa.Table) -> pa.Table:
        q_row, q_id, q_val, q_off = _rows(table, 0)
        _, c_id, c_val, c_off = _rows(table, 1)
        found: dict[str, list] = {"query_row": [], "query_id": [], "vec_id": [], "score": []}
        if len(q_id) and len(c_id):
            most = largest_product(q_val, c_val, int(np.diff(q_off).max(initial=1)))
            # int32 halves the memory traffic where the scores provably fit
            kind = np.int32 if most < 2**31 else np.int64 if most < 2**63 else object
            postings = [(at, w.astype(kind)) for at, w in _postings(c_val, c_off)]
            scores, step = np.empty(len(c_id), kind), np.empty(len(c_id), kind)
            for i in range(len(q_id)):
                scores[:] = 0
                for d, w in enumerate(q_val[q_off[i]:q_off[i + 1]].tolist()[:len(postings)]):
                    if w:
                        at, weight = postings[d]
                        if isinstance(at, slice):
                            scores += np.multiply(weight, w, out=step)
                        else:
                            scores[at] += weight * (w if kind is object else kind(w))
                open_ = np.flatnonzero(c_id != q_id[i])
                if not len(open_):
                    continue
                own = scores if len(open_) == len(c_id) else scores[open_]
                ids = c_id if len(open_) == len(c_id) else c_id[open_]
                top = _best(own if kind is object else own.astype(np.int64), ids, k)
                found["query_row"].append(np.full(len(top), q_row[i]))
                found["query_id"].append(np.full(len(top), q_id[i]))
                found["vec_id"].append(ids[top])
                found["score"].append(as_long(own[top]))
        return pa.table({n: np.concatenate(v) if v else np.array([], np.int64) for n, v in found.items()})
    return search


def top_k(vectors: DataFrame, *, row_id: str, vector: str, is_query: Column, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k best other rows."""
    v = written(vectors.select(F.col(row_id).cast("long").alias("id"), quantised(F.col(vector)).alias("v"),
                               F.monotonically_increasing_id().alias("row"), is_query.alias("asks"))
                .where(F.col("id").isNotNull() & F.col("v").isNotNull()), "vectors")
    n, q, width = sizes_of(v, F.col("asks"), "v")
    n_c = block_count(vectors.sparkSession, n, width)
    n_q = max(1, -(-q // max(1, -(-n // n_c))))  # as many queries as candidates in a cell
    asks = v.where("asks").select(F.lit(0).alias("side"), "row", "id", "v", block_of("row", n_q, 1).alias("qb"), each(n_c).alias("cb"))
    held = v.select(F.lit(1).alias("side"), "row", "id", "v", each(n_q).alias("qb"), block_of("row", n_c, 2).alias("cb"))
    best = asks.unionByName(held).groupBy("qb", "cb").applyInArrow(_cell(k), _SCHEMA)
    by_query = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", in_range("score").alias("score")))
