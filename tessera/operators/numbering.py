"""Scalable row numbering and exact "first k in hash order" selection.

Neither function ever puts a whole group (a tile, or the whole table) into one
window partition:

* ``index_within`` numbers rows of a group by a numeric, unique order key in
  two levels: counts per key block -> prefix sums over the (few) blocks ->
  ``row_number`` inside a block. A block holds at most ``block`` rows.
* ``first_k_thresholds`` finds, per group, the k-th row in seeded-hash order with
  two hex-prefix histograms; the result is one threshold row per group and cut,
  so the final selection is a plain filter behind a broadcastable join. The
  first histogram is written to the shared checkpoint folder (eagerly), which
  keeps later plans small; the thresholds themselves stay lazy.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.columns import seeded_hash
from tessera.session import join_null_safe, materialize, small_side

# Hex digits of the md5 per histogram level: level 1 has 4,096 buckets (small
# enough that map-side partial aggregation shrinks the data), level 2 another
# 65,536. Fixed-length hex prefixes sort like their values, so buckets are
# compared as strings.
_DIGITS1, _DIGITS2 = 3, 4
MOST_BLOCKS = 10_000  # blocks whose offsets one task may sum up, beside four times those of dense keys
DIRECT_RANK_LIMIT = 1_000_000  # rows of one boundary bucket ranked in one task


def key_columns(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def key_struct(key: str | Sequence[str]) -> Column:
    """The whole key as one comparable value; nulls order first and compare."""
    return F.struct(*[F.col(k) for k in key_columns(key)])


def index_within(df: DataFrame, *, order_key: str, group: Sequence[str] = (),
                 block: int = 1 << 20, out: str = "idx", tiebreak: Sequence[str] = (), dense: bool = True) -> DataFrame:
    """0-based position of each row inside ``group`` ordered by ``order_key`` (nulls first).

    ``order_key`` must be an integral column, unique inside a group together
    with ``tiebreak``. Blocks are ranges of its value, so it has to be dense;
    where a caller can't know that (``dense=False``), its least and greatest
    value are looked up, and a sparse key goes to ``index_ordered``, which is
    also the way for composite keys.
    """
    group = list(group)
    if not dense:
        seen = df.agg(F.count(F.lit(1)).alias("n"), F.min(order_key).alias("lo"), F.max(order_key).alias("hi")).first()
        blocks = 0 if seen["lo"] is None else (seen["hi"] - seen["lo"]) // block + 1
        if blocks > MOST_BLOCKS + 4 * (seen["n"] // block):
            return index_ordered(df, order_keys=[order_key, *tiebreak], group=group, rows_per_block=block, out=out)
    blk = F.floor(F.col(order_key) / F.lit(block)).cast("long")
    return _numbered(df.withColumn("_blk", blk), group, [order_key, *tiebreak], out)


def index_ordered(df: DataFrame, *, order_keys: Sequence[str], group: Sequence[str] = (),
                  rows_per_block: int = 1 << 20, out: str = "idx") -> DataFrame:
    """``index_within`` for any keys: blocks are range partitions of about equal row counts.

    The range-partitioned rows are written once, so a restarted task sees the
    same blocks; offsets run over rows / ``rows_per_block`` blocks. The input is
    written first: counting, finding the ranges and dealing the rows read that table.
    """
    group = list(group)
    df = materialize(df, "unranged")
    blocks = max(1, -(-df.count() // rows_per_block))
    ranged = materialize(df.repartitionByRange(blocks, *group, *order_keys)
                         .withColumn("_blk", F.spark_partition_id()), "ranged")
    return _numbered(ranged, group, list(order_keys), out)


def _numbered(blocked: DataFrame, group: list[str], order: list[str], out: str) -> DataFrame:
    """Rows of each ``(group, _blk)`` numbered behind the counts of the blocks before."""
    counts = blocked.groupBy(*group, "_blk").agg(F.count(F.lit(1)).alias("_bn"))
    w_blocks = (Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))) \
        .orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*group, "_blk",
                            F.coalesce(F.sum("_bn").over(w_blocks), F.lit(0)).alias("_off"))
    w_in = Window.partitionBy(*group, "_blk").orderBy(*order)
    numbered = blocked.withColumn("_rn", F.row_number().over(w_in))
    return (join_null_safe(numbered, offsets, [*group, "_blk"])
            .withColumn(out, (F.col("_off") + F.col("_rn") - 1).cast("long"))
            .drop("_blk", "_off", "_rn"))


def _boundary(hist: DataFrame, group: list[str], bucket: str, need: str) -> DataFrame:
    """Per group: the bucket holding the ``need``-th row, and how many to take there."""
    w = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    w_cum = w.orderBy(bucket).rowsBetween(Window.unboundedPreceding, 0)
    cum = hist.withColumn("_cum", F.sum("_c").over(w_cum))
    hit = cum.where((F.col("_cum") >= F.col(need)) & (F.col("_cum") - F.col("_c") < F.col(need)))
    return hit.select(*group, F.col(bucket).alias(bucket + "_at"),
                      (F.col(need) - (F.col("_cum") - F.col("_c"))).alias(need + "_at"),
                      F.col("_c").alias(bucket + "_size"))


def first_k_thresholds(df: DataFrame, *, key: str | Sequence[str], seed: int, group: Sequence[str] = (),
                       needs: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """One row per group and cut: ``(group..., _cut, _n, _k, _th, _tkey)``.

    ``key`` is a column or a list of columns that names a row; if rows that share
    it straddle a cut, the query raises instead of returning too many rows.
    For each cut, rows of the group ordered by ``(md5(key:seed), key)`` whose
    position is < ``_k`` are exactly those with ``(hash, key) <= (_th, _tkey)``.
    ``needs`` maps a cut name to a function of the group size column giving k.
    ``_th`` is null when k <= 0; when k >= n every row qualifies (``_th`` = 'g',
    above any hex digit). All cuts share the same three passes over ``df``.
    """
    group = list(group)
    gc = [*group, "_cut"]
    h = seeded_hash(key, seed)
    hashed = df.select(*group, key_struct(key).alias("_key"), h.alias("_h"))
    hashed = hashed.withColumn("_b1", F.substring(F.col("_h"), 1, _DIGITS1))

    # job 1: prefix histogram (at most 4,096 rows per group), written once
    hist1 = materialize(hashed.groupBy(*group, "_b1").agg(F.count(F.lit(1)).alias("_c")), "hist1")
    totals = hist1.groupBy(*group).agg(F.sum("_c").alias("_n"))
    cut_list = F.array(*[F.struct(F.lit(name).alias("_cut"), need(F.col("_n")).cast("long").alias("_k"))
                         for name, need in needs.items()])
    cuts = totals.select(*group, "_n", F.explode(cut_list).alias("_ck")).select(*group, "_n", "_ck._cut", "_ck._k")
    sized = join_null_safe(hist1, cuts, group)
    partial = sized.where((F.col("_k") > 0) & (F.col("_k") < F.col("_n")))
    # from hist1 only: one row per group and cut, broadcast if that is few
    b1 = small_side(_boundary(partial.withColumnRenamed("_k", "_need"), gc, "_b1", "_need"), "b1")

    # A boundary bucket holds about n / 4,096 rows of its group. When the
    # largest one is small it is ranked directly; otherwise a second 16-bit
    # histogram narrows it to about n / 2^28 rows first (~3,700 rows at 10^12).
    # Either way no task ranks more than ``DIRECT_RANK_LIMIT`` rows of one group.
    largest = b1.agg(F.max("_b1_size")).collect()[0][0] or 0
    join_b1 = join_null_safe(hashed, b1, group)
    edge1 = join_b1.where(F.col("_b1") == F.col("_b1_at"))
    if largest <= DIRECT_RANK_LIMIT:
        edge, need_col = edge1, "_need_at"
    else:
        edge1 = edge1.withColumn("_b2", F.substring(F.col("_h"), 1 + _DIGITS1, _DIGITS2))
        hist2 = edge1.groupBy(*gc, "_b2", "_need_at").agg(F.count(F.lit(1)).alias("_c"))
        b2 = small_side(_boundary(hist2, gc, "_b2", "_need_at"), "b2")
        edge = join_null_safe(edge1, b2.drop("_b2_size"), gc).where(F.col("_b2") == F.col("_b2_at"))
        need_col = "_need_at_at"

    # rank the few rows of the final bucket; one threshold row per group and cut
    w_edge = Window.partitionBy(*gc).orderBy("_h", "_key")
    again = F.lead("_key").over(w_edge).eqNullSafe(F.col("_key"))
    th = (edge.withColumn("_r", F.row_number().over(w_edge)).withColumn("_again", again)
          .where(F.col("_r") == F.col(need_col))
          .select(*gc, F.when(F.col("_again"), F.raise_error(F.lit("the key does not name a row: rows that share it straddle a cut")))
                  .otherwise(F.col("_h")).alias("_th"), F.col("_key").alias("_tkey")))

    out = join_null_safe(cuts, th, gc, "left")
    return out.select(
        *gc, "_n", "_k",
        F.when(F.col("_k") >= F.col("_n"), F.lit("g")).when(F.col("_k") <= 0, F.lit(None))
        .otherwise(F.col("_th")).alias("_th"),
        F.when(F.col("_k") >= F.col("_n"), F.lit(None)).otherwise(F.col("_tkey")).alias("_tkey"))


def first_k_threshold(df: DataFrame, *, key: str | Sequence[str], seed: int, group: Sequence[str] = (),
                      need: Callable[[Column], Column]) -> DataFrame:
    """Single-cut form of ``first_k_thresholds``: ``(group..., _n, _k, _th, _tkey)``."""
    return first_k_thresholds(df, key=key, seed=seed, group=group, needs={"k": need}).drop("_cut")


def thresholds_wide(th: DataFrame, cuts: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """One row per group with ``_th_<cut>``/``_tkey_<cut>`` columns (a tiny pivot)."""
    aggs = []
    for c in cuts:
        hit = F.col("_cut") == F.lit(c)
        aggs += [F.max(F.when(hit, F.col("_th"))).alias(f"_th_{c}"),
                 F.max(F.when(hit, F.col("_tkey"))).alias(f"_tkey_{c}")]
    return th.groupBy(*group).agg(*aggs) if group else th.agg(*aggs)


def within_first_k(h: Column, key: Column, th: Column, tkey: Column) -> Column:
    """Boolean: (h, key) <= (th, tkey), with 'g' meaning 'everything'."""
    return F.coalesce((th == F.lit("g")) | (h < th) | ((h == th) & (key <= tkey)), F.lit(False))
