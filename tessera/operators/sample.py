"""Exact, seeded samples and splits.

Every sample and split is keyed: rows are ordered by ``md5(key:seed)`` then key,
so results do not depend on partitioning and equal DuckDB's
``md5(key::varchar || ':seed')`` order. ``key`` is a column or a list of columns
(``["tile", "pixel_idx"]``) that names a row. There is one way for every size: a
per-group hash threshold from prefix histograms, then a plain filter (see
``numbering.first_k_thresholds``). No operator sorts a whole tile or the whole
table in one task, and no size changes the rows that come out. Null groups are
groups, null keys are keys; rows that share a key raise where a cut would have
to choose among them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import require_columns, seeded_hash
from tessera.operators.clean import ENCODE_RANGE, clean_filter
from tessera.operators.impute import fill_nulls
from tessera.operators.numbering import (first_k_threshold, first_k_thresholds, index_ordered, index_within,
                                         key_columns, key_struct, thresholds_wide, within_first_k)
from tessera.session import join_null_safe, materialize, small_side

Key = str | Sequence[str]


def _within(df: DataFrame, th: DataFrame, *, key: Key, seed: int, group: Sequence[str]) -> DataFrame:
    """``df`` with ``_first``: whether the row lies within its group's threshold."""
    joined = join_null_safe(df, small_side(th, "thresholds"), group)
    return joined.withColumn("_first", within_first_k(seeded_hash(key_columns(key), seed), key_struct(key),
                                                      F.col("_th"), F.col("_tkey")))


def sample_per_group(df: DataFrame, n: int, *, key: Key, seed: int = 43, group: Sequence[str] = ("tile",)) -> DataFrame:
    """Exactly ``min(n, size)`` rows of each group, chosen by seeded hash."""
    group = list(group)
    require_columns(df, [*key_columns(key), *group])
    th = first_k_threshold(df, key=key, seed=seed, group=group, need=lambda _n: F.lit(n))
    return _within(df, th.select(*group, "_th", "_tkey"), key=key, seed=seed, group=group).where("_first") \
        .drop("_first", "_th", "_tkey")


def sample_n(df: DataFrame, n: int, *, key: Key, seed: int = 43) -> DataFrame:
    """A fixed-size sample of the whole frame (reproducible)."""
    return sample_per_group(df, n, key=key, seed=seed, group=())


def nested_samples(df: DataFrame, sizes: Sequence[int], *, key: Key, seed: int = 43,
                   group: Sequence[str] = ("tile",), out: str = "n_per_group") -> DataFrame:
    """For every N in ``sizes``, the W2 sample of N rows per group, stacked.

    The samples are nested (the N-sample is a prefix of every larger one, same
    hash order), so one labelling serves all sizes: each row appears once per N
    whose sample holds it, tagged ``out`` = N.
    """
    group, sizes = list(group), sorted(set(int(n) for n in sizes))
    cuts = [(str(n), (lambda k: lambda _n: F.lit(k))(n)) for n in sizes]
    # label each row with the smallest sample holding it
    labelled = label_by_rank(df, cuts, key=key, seed=seed, rest="", part="_in", group=group) \
        .where(F.col("_in") != "")
    holds = F.filter(F.array(*[F.lit(n) for n in sizes]), lambda n: n >= F.col("_in").cast("int"))
    return labelled.withColumn(out, F.explode(holds)).drop("_in")


def label_by_rank(df: DataFrame, cuts: Sequence[tuple[str, Callable[[Column], Column]]], *, key: Key,
                  seed: int = 43, rest: str = "train", part: str = "part",
                  group: Sequence[str] = ()) -> DataFrame:
    """Label rows by their position in seeded-hash order (within ``group``).

    ``cuts`` is an increasing list of ``(label, k(n))``: rows at positions < k of
    the first cut get its label, the next cut labels the following rows, and so
    on; the remaining rows are ``rest``. One threshold computation for all cuts,
    then a map-only labelling behind one row per group.
    """
    require_columns(df, [*key_columns(key), *group])
    group = list(group)
    names = [f"c{i}" for i in range(len(cuts))]
    th = first_k_thresholds(df, key=key, seed=seed, group=group,
                            needs={n: fn for n, (_, fn) in zip(names, cuts)})
    joined = join_null_safe(df, small_side(thresholds_wide(th, names, group), "thresholds"), group)
    h = seeded_hash(key_columns(key), seed)
    label = F.lit(rest)
    for n, (lab, _) in reversed(list(zip(names, cuts))):
        label = F.when(within_first_k(h, key_struct(key), F.col(f"_th_{n}"), F.col(f"_tkey_{n}")), F.lit(lab)) \
            .otherwise(label)
    return joined.withColumn(part, label).drop(*[f"_th_{n}" for n in names], *[f"_tkey_{n}" for n in names])


def _share_count(share: float):
    # sklearn's test size: ceil(share * n), in double arithmetic
    return lambda n: F.ceil(n.cast("double") * F.lit(float(share)))


def split_by_share(df: DataFrame, share: float, *, key: Key, seed: int = 43,
                   part: str = "part", first: str = "valid", rest: str = "train",
                   group: Sequence[str] = ()) -> DataFrame:
    """The first ``ceil(share * n)`` rows in hash order are ``first``, the rest ``rest``.

    Exact sizes, independent of partitioning (``randomSplit`` is neither).
    """
    return label_by_rank(df, [(first, _share_count(share))], key=key, seed=seed, rest=rest, part=part,
                         group=group)


def split_three_way(df: DataFrame, *, key: Key, seed: int = 43, holdout_share: float = 0.3,
                    test_share: float = 0.5, part: str = "part") -> DataFrame:
    """70/15/15. ``ceil(.3n)`` rows are held out; the first ``ceil(.5m)`` of them
    (same hash order) are test, the others valid; the rest is train.
    """
    held = _share_count(holdout_share)
    test = lambda n: F.ceil(held(n).cast("double") * F.lit(float(test_share)))
    return label_by_rank(df, [("test", test), ("valid", held)], key=key, seed=seed, rest="train", part=part)


def split_files(df: DataFrame, *, file_col: str, seed: int = 42, test_share: float = 0.1,
                valid_share: float = 0.1, part: str = "part") -> DataFrame:
    """Split by file (chunk), not by row -> one row per distinct file with its part.

    test = first ``ceil(.1n)`` files in hash order; valid = the next
    ``ceil(.1(n - test))`` (the second split of the reference ranks the rest
    with the same seed, i.e. continues the same order); the rest train.
    """
    files = df.select(file_col).distinct()
    test = _share_count(test_share)
    valid = lambda n: test(n) + F.ceil((n - test(n)).cast("double") * F.lit(float(valid_share)))
    return label_by_rank(files, [("test", test), ("valid", valid)], key=file_col, seed=seed, rest="train",
                         part=part)


def chunk_ids(df: DataFrame, size: int, *, order_key: Key, chunk: str = "chunk",
              block: int = 1 << 20) -> DataFrame:
    """chunk = position div size in ``order_key`` order, numbered without a global sort.

    One dense integral column is numbered in ranges of its value; a list of
    columns (``["tile", "pixel_idx"]``: chunks run through the tiles) in range
    partitions of equal size.
    """
    numbered = (index_within(df, order_key=order_key, block=block, out="_pos", dense=False) if isinstance(order_key, str)
                else index_ordered(df, order_keys=list(order_key), rows_per_block=block, out="_pos"))
    return numbered.withColumn(chunk, F.floor(F.col("_pos") / F.lit(size)).cast("long")).drop("_pos")


def clean_tiles(df: DataFrame, *, tcol: str, rcol: str, lval: float = ENCODE_RANGE[0],
                hval: float = ENCODE_RANGE[1], exclude: Sequence[str] = ()) -> DataFrame:
    """P1 + P3 on both columns (one pushed-down filter), then I1 over the result."""
    cleaned = clean_filter(df, [tcol, rcol], lval, hval)
    return fill_nulls(cleaned, exclude=exclude)


def clean_sample_tiles(df: DataFrame, n: int, *, tcol: str, rcol: str, key: Key,
                       tile: str = "tile", seed: int = 43, lval: float = ENCODE_RANGE[0],
                       hval: float = ENCODE_RANGE[1], exclude: Sequence[str] = ()) -> DataFrame:
    """Clean each tile, keep n rows per tile (all if fewer), impute over the union."""
    cleaned = clean_filter(df, [tcol, rcol], lval, hval)
    # written once: the statistics and the filled rows both read it
    sampled = materialize(sample_per_group(cleaned, n, key=key, seed=seed, group=[tile]), "sampled")
    return fill_nulls(sampled, exclude=[*key_columns(key), tile, *exclude])


# Fixed values of the reference: target sample sizes and default multipliers
# per resolution (metres); custom multipliers always use the 12 m target.
RESOLUTION_PLAN = {
    12: (9000 * 9000, [0.1, 0.2, 0.3, 0.5, 0.8, 1, 2, 3, 6]),
    30: (3600 * 3600, [0.5, 1, 3, 4, 5, 6]),
    90: (1200 * 1200, [0.01, 0.5, 1, 3, 4, 5, 6]),
}
CUSTOM_TARGET = 9000 * 9000


def sample_plan(tiles_per_res: DataFrame, *, res: str = "res", n_tiles: str = "n_tiles",
                multipliers: Sequence[float] | None = None) -> DataFrame:
    """X6/X7 over a (res, n_tiles) frame -> (res, multiplier, n).

    Resolutions without a plan give no rows (the reference logs an error).
    """
    spark = tiles_per_res.sparkSession
    if multipliers is None:
        rows = [(r, float(t), [float(m) for m in ms]) for r, (t, ms) in RESOLUTION_PLAN.items()]
        plan = spark.createDataFrame(rows, "res_ int, target double, mults array<double>")
        joined = tiles_per_res.join(F.broadcast(plan), F.col(res) == F.col("res_"), "inner")
    else:
        joined = tiles_per_res.withColumn("target", F.lit(float(CUSTOM_TARGET))) \
            .withColumn("mults", F.array(*[F.lit(float(m)) for m in multipliers]))
    per_tile = F.floor(F.col("target") / F.col(n_tiles).cast("double"))
    return (joined.select(F.col(res).alias("res"), per_tile.alias("_pt"),
                          F.posexplode("mults").alias("_pos", "multiplier"))
            .select("res", "multiplier",
                    F.floor(F.col("_pt") * F.col("multiplier")).cast("long").alias("n")))
