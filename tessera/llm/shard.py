"""Sharding by jump consistent hashing (Lamping and Veach, 2014), in SQL expressions only.

A row's shard depends on its key and the shard count alone; there is no ring table, and
appending a shard moves only the rows that the new shard takes. Rows of one shard get gapless
slots by two-level numbering, so that no task ever holds a whole shard.

Null keys share one shard (a null is a key like any other). Null and empty texts have size 8
and CRC 0. Repeated rows each get a slot of their own. An empty table gives no rows. Only the
named columns are read, so extra columns can have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import blocks_of, text_bytes, written

# Multiplier of the published generator, key = key * MULTIPLIER + 1 (mod 2^64).
MULTIPLIER = 2862933555777941757
#: Rows that one numbering task sorts.
SLOT_BLOCK = 1 << 20

_M16, _M32 = (1 << 16) - 1, (1 << 32) - 1


def _next_key(hi: Column, lo: Column) -> tuple[Column, Column]:
    """hi:lo * MULTIPLIER + 1 modulo 2^64 in 32-bit halves: no product passes 2^63, so ANSI mode holds."""
    c_hi, c_lo = MULTIPLIER >> 32, MULTIPLIER & _M32
    low, mid = F.lit(c_lo & _M16), F.lit(c_lo >> 16)
    p0, p1 = lo * low, lo * mid
    carry = p0.bitwiseAND(F.lit(_M32)) + F.shiftleft(p1.bitwiseAND(F.lit(_M16)), 16) + F.lit(1)
    q = (hi * low).bitwiseAND(F.lit(_M32)) + F.shiftleft((hi * mid).bitwiseAND(F.lit(_M16)), 16)
    top = (F.shiftright(p0, 32) + F.shiftright(p1, 16) + F.shiftright(carry, 32)
           + (lo * F.lit(c_hi)).bitwiseAND(F.lit(_M32)) + q)
    return top.bitwiseAND(F.lit(_M32)), carry.bitwiseAND(F.lit(_M32))


#: Jumps that nearly every key needs at most.
STEPS = 64


def jump_state(key: Column, shards: int) -> Column:
    """struct(b, j): b is the shard among ``shards``, j >= shards the next jump of this key."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    key = key.cast("long")
    start = F.struct(F.shiftrightunsigned(key, 32).alias("hi"), key.bitwiseAND(F.lit(_M32)).alias("lo"),
                     F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"))

    def step(s: Column, _: Column) -> Column:
        hi, lo = _next_key(s["hi"], s["lo"])
        # the top 31 bits of the new key drive the jump
        drawn = F.shiftright(hi, 1) + F.lit(1)
        jump = F.floor((s["j"] + F.lit(1)).cast("double") * (F.lit(float(1 << 31)) / drawn.cast("double")))
        moved = F.struct(hi.alias("hi"), lo.alias("lo"), s["j"].alias("b"), jump.cast("long").alias("j"))
        return F.when(s["j"] < F.lit(shards), moved).otherwise(s)

    # A key jumps about ln(shards) times: the chance of more than STEPS is below 1e-20 up to a million shards.
    # Every jump goes forward by one shard at least, so ``shards`` steps always suffice for the rest.
    first = F.aggregate(F.sequence(F.lit(1), F.lit(min(shards, STEPS))), start, step)
    if shards <= STEPS:
        return first
    more = lambda s: F.aggregate(F.sequence(F.lit(STEPS + 1), F.lit(shards)), s, step)
    return F.get(F.transform(F.array(first), lambda s: F.when(s["j"] < F.lit(shards), more(s)).otherwise(s)), F.lit(0))


def jump_hash(key: Column, shards: int) -> Column:
    return jump_state(key, shards)["b"].cast("int")


def jump_shards(df: DataFrame, *, key: str, text: str, shards: int) -> DataFrame:
    """``key, size, text_crc32, law, shard, slot, grown_shard`` for every row.

    ``grown_shard`` is the shard with one more: the state of the last jump already tells it.
    Keys are mixed by xxhash64 first, so keys of any type and pattern spread evenly.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    state = df.select(
        F.col(key).alias("key"), (text_bytes(F.col(text)) + F.lit(8)).alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"), F.monotonically_increasing_id().alias("row"),
        jump_state(F.xxhash64(F.col(key)), shards).alias("state"))
    placed = written(state.select(
        "key", "size", "text_crc32", "row", F.lit("key").alias("law"), F.col("state.b").cast("int").alias("shard"),
        F.when(F.col("state.j") == shards, F.lit(shards)).otherwise(F.col("state.b")).cast("int").alias("grown_shard")),
        "shards")
    return with_slots(placed, shard="shard", order=["key", "row"]).select(
        "key", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def with_slots(placed: DataFrame, *, shard: str, order: list[str], row: str = "row") -> DataFrame:
    """Gapless ``slot`` from 0 within each shard.

    ``placed`` is a written table with a unique ``row`` number, so a lost task counts the same
    rows again. Rows are dealt by a hash of ``row`` into blocks of about SLOT_BLOCK; the block
    sizes (a few per shard) give each block's first slot.
    """
    blocks = blocks_of(placed.count(), SLOT_BLOCK)
    dealt = placed.withColumn("_block", F.pmod(F.xxhash64(F.col(row)), F.lit(blocks)).cast("int"))
    before = Window.partitionBy("_shard").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    first = (dealt.groupBy(F.col(shard).alias("_shard"), F.col("_block").alias("_at")).count()
             .select("_shard", "_at", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_first")))
    inside = Window.partitionBy(shard, "_block").orderBy(*order)
    return (dealt.withColumn("_n", F.row_number().over(inside))
            .join(first, (F.col(shard) == F.col("_shard")) & (F.col("_block") == F.col("_at")))
            .withColumn("slot", F.col("_first") + F.col("_n") - F.lit(1)).drop("_block", "_n", "_shard", "_at", "_first"))


def write_shards(df: DataFrame, path: str, *, key: str, shards: int, files_per_shard: int = 8) -> None:
    """Write every row, all columns, below ``path/shard=k``; a shard is dealt over several files by row."""
    (df.withColumn("shard", jump_hash(F.xxhash64(F.col(key)), shards))
     .withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(files_per_shard)))
     .repartition(shards * files_per_shard, "shard", "_salt").drop("_salt")
     .write.mode("overwrite").partitionBy("shard").parquet(path))
