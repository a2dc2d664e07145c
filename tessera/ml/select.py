"""Feature selection helpers shared by F4-F7: seeded column permutation.

A permuted (shadow) column gives row i, in key order, the value that row i has
in seeded-hash order. Both positions come from the two-level numbering, and
the two rankings are joined on position (a shuffle join; no group is ever
gathered in one task).
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import seeded_hash
from tessera.operators.numbering import index_ordered, index_within

_HASH_BITS_BLOCK = 1 << 40  # 60-bit hash prefix -> at most 2^20 blocks


def hash_position(df: DataFrame, *, key: str, seed: int, out: str = "_pos") -> DataFrame:
    """0-based position of each row in ``(md5(key:seed), key)`` order."""
    h = seeded_hash(key, seed)
    prefix = F.conv(F.substring(h, 1, 15), 16, 10).cast("long")
    with_h = df.withColumn("_hfull", h).withColumn("_h60", prefix)
    return index_within(with_h, order_key="_h60", tiebreak=["_hfull", key], block=_HASH_BITS_BLOCK,
                        out=out).drop("_hfull", "_h60")


def permuted_column(df: DataFrame, col: str, *, key: str, seed: int, out: str | None = None) -> DataFrame:
    """``df`` with ``col`` (or a new column ``out``) replaced by its seeded permutation."""
    if out is None:
        joined = permuted_columns(df, {col: seed}, key=key, suffix="_perm")
        return joined.drop(col).withColumnRenamed(col + "_perm", col).select(*df.columns)
    joined = permuted_columns(df, {col: seed}, key=key, suffix="_perm")
    return joined.withColumnRenamed(col + "_perm", out)


def permuted_columns(df: DataFrame, seeds: dict[str, int], *, key: str, suffix: str = "_shadow") -> DataFrame:
    """Add ``{col}{suffix}`` for every column of ``seeds``: its permutation with that seed.

    Every shuffled copy is derived from ``df`` itself and joined on position,
    so the plan grows linearly with the number of columns.
    """
    out = index_within(df, order_key=key, out="_pos", dense=False)
    for col, seed in seeds.items():
        by_hash = hash_position(df.select(key, col), key=key, seed=seed).select(
            "_pos", F.col(col).alias(col + suffix))
        out = out.join(by_hash, on="_pos", how="inner")
    return out.drop("_pos")


#: Rounds of the network, and steps in which a position outside [0, n) must have come back inside.
_ROUNDS, _WALK = 4, 16


def _sides(n: int) -> tuple[int, int]:
    a = max(1, math.isqrt(max(0, n - 1)) + 1)
    return a, max(1, -(-n // a))


def _pair(x: Column, n: int) -> list[Column]:
    b = _sides(n)[1]
    return [F.floor(x / F.lit(b)), F.pmod(x, F.lit(b))]


def _turn(left: Column, right: Column, i: int, n: int, seed: int) -> Column:
    """Round i of the network: the new left (even rounds) or right half."""
    own, other, side = (left, right, _sides(n)[0]) if i % 2 == 0 else (right, left, _sides(n)[1])
    return F.pmod(own + F.pmod(F.xxhash64(other, F.lit(seed), F.lit(i)), F.lit(side)), F.lit(side))


def _joined(left: Column, right: Column, n: int) -> Column:
    return (left * _sides(n)[1] + right).cast("long")


def _inside(first: Column, n: int, seed: int) -> Column:
    """``first``, walked on where it lies outside."""
    def step(x: Column) -> Column:
        pair = _pair(x, n)
        for i in range(_ROUNDS):
            pair[i % 2] = _turn(*pair, i, n, seed)
        return _joined(*pair, n)
    walked = F.aggregate(F.sequence(F.lit(2), F.lit(_WALK)), first, lambda x, _: F.when(x < n, x).otherwise(step(x)))
    lost = F.raise_error(F.lit("a position didn't come back inside")).cast("long")
    return F.when(first < n, first).otherwise(F.when(walked < n, walked).otherwise(lost))


def shuffled_position(pos: Column, n: int, seed: int) -> Column:
    """A seeded bijection of [0, n): a Feistel network on pairs, walked on until it lands inside.

    n positions are pairs (l, r) of Z_a x Z_b with a = ceil(sqrt(n)) and a * b the next multiple, so
    fewer than a of them lie outside and a walk of more than one step is rare (one in sqrt(n)). Up
    to n = 225, 16 steps are enough by counting; beyond, a longer walk has a chance below 1e-18 a
    row, and raises.
    """
    pair = _pair(pos.cast("long"), n)
    for i in range(_ROUNDS):
        pair[i % 2] = _turn(*pair, i, n, seed)
    return _inside(_joined(*pair, n), n, seed)


def with_shuffled_positions(df: DataFrame, seeds: dict[str, int], *, n: int, pos: str) -> DataFrame:
    """``df`` with a column ``shuffled_position`` under each name of ``seeds``.

    As one expression the network repeats its halves in every round and is read as often again by the
    walk, which can't be compiled; here each round is a column of its own, computed once a row, and
    only positions outside walk.
    """
    halves = {out: (f"{out}_l", f"{out}_r") for out in seeds}
    df = df.withColumns({h: c for names in halves.values() for h, c in zip(names, _pair(F.col(pos).cast("long"), n))})
    for i in range(_ROUNDS):
        df = df.withColumns({names[i % 2]: _turn(F.col(names[0]), F.col(names[1]), i, n, seeds[out]) for out, names in halves.items()})
    df = df.withColumns({out: _joined(F.col(left), F.col(right), n) for out, (left, right) in halves.items()})
    df = df.drop(*[h for names in halves.values() for h in names])
    return df.withColumns({out: _inside(F.col(out), n, seed) for out, seed in seeds.items()})


def numbered_rows(df: DataFrame, *, key: str, out: str = "_pos") -> DataFrame:
    """``df`` with each row's position in key order, from 0: what ``shuffled_columns`` starts from."""
    return index_ordered(df, order_keys=[key], out=out)


def shuffled_columns(df: DataFrame, seeds: dict[str, int], *, n: int, pos: str = "_pos", suffix: str = "_shadow") -> DataFrame:
    """Add ``{col}{suffix}`` for every column of ``seeds``, each shuffled on its own, with one join for all.

    Each row sends its values to the positions that the columns' bijections give; what arrives at a
    position is one row, which is joined to the row there. Columns travel as doubles.
    """
    cols = list(seeds)
    placed = with_shuffled_positions(df.select(pos, *cols), {f"_to{i}": seeds[c] for i, c in enumerate(cols)}, n=n, pos=pos)
    sent = F.array(*[F.struct(F.col(f"_to{i}").alias("to"), F.lit(i).alias("c"), F.col(c).cast("double").alias("v"))
                     for i, c in enumerate(cols)])
    there = placed.select(F.explode(sent).alias("s")).groupBy(F.col("s.to").alias("_to")).agg(
        *[F.max(F.when(F.col("s.c") == i, F.col("s.v"))).alias(c + suffix) for i, c in enumerate(cols)])
    return df.join(there, F.col(pos) == F.col("_to")).drop("_to")


def bin_ends(df: DataFrame, features: Sequence[str]) -> dict[str, list[int]]:
    """Running row counts of each feature's bins 0, 1, ... of a binned table (``cells.binned``); the last one is the row count."""
    own = F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.col(c).cast("int").alias("b")) for i, c in enumerate(features)]))
    got = df.select(own.alias("s")).groupBy("s.f", "s.b").agg(F.count(F.lit(1)).alias("n")).collect()  # a row per feature and bin
    sizes = {(r["f"], r["b"]): r["n"] for r in got}
    last = {i: max((b for f, b in sizes if f == i), default=0) for i in range(len(features))}
    return {c: list(itertools.accumulate(sizes.get((i, b), 0) for b in range(last[i] + 1))) for i, c in enumerate(features)}


def _bin_at(pos: Column, ends: Sequence[int], first: int = 0) -> Column:
    """The bin that holds a position of the rows lined up by bin; ``ends`` are the running counts of all bins but the last."""
    if not ends:
        return F.lit(float(first))
    m = len(ends) // 2
    return F.when(pos < ends[m], _bin_at(pos, ends[:m], first)).otherwise(_bin_at(pos, ends[m + 1:], first + m + 1))


def shuffled_bins(df: DataFrame, seeds: dict[str, int], ends: dict[str, list[int]], *, n: int, pos: str = "_pos", suffix: str = "_shadow") -> DataFrame:
    """``shuffled_columns`` for a binned table, without moving a row.

    A column lined up by bin is known from its bins' running counts alone, so the bin at the position that
    the column's bijection gives a row is looked up there: every bin is dealt as often as the column has it.
    """
    placed = with_shuffled_positions(df, {f"_to{i}": s for i, s in enumerate(seeds.values())}, n=n, pos=pos)
    return placed.select(*df.columns, *[_bin_at(F.col(f"_to{i}"), ends[c][:-1]).alias(c + suffix) for i, c in enumerate(seeds)])
