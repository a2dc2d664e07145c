"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import materialize

#: Bytes that end a word; everything else is part of one.
WORD_BREAKS = "[\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write below the shared checkpoint folder and read back (cuts the lineage)."""
    return materialize(df, f"llm-{name}")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character kept."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """Lower-cased words of a text; null and blank texts have none."""
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), WORD_BREAKS), lambda w: w != "")


def text_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def blocks_of(rows: int, per_block: int) -> int:
    return max(1, -(-rows // per_block))
