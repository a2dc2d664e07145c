"""Column helpers: missing-value normalisation, validation, seeded hashes."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                 T.FloatType, T.DoubleType, T.DecimalType)
FLOATING_TYPES = (T.FloatType, T.DoubleType)
INTEGRAL_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def require_columns(df: DataFrame, cols: Iterable[str]) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"Column(s) {missing} do not exist in the DataFrame.")


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in exclude]


def field_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every floating column (the one missing value here)."""
    exprs = []
    for f in df.schema.fields:
        if isinstance(f.dataType, FLOATING_TYPES):
            c = F.col(f.name)
            exprs.append(F.when(~F.isnan(c), c).alias(f.name))
        else:
            exprs.append(F.col(f.name))
    return df.select(*exprs)


def seeded_hash(key: str | Column | Sequence[str], seed: int) -> Column:
    """md5 of ``key:seed`` as hex; equals DuckDB ``md5(key::varchar || ':seed')``."""
    if isinstance(key, (list, tuple)):
        parts = [F.col(k).cast("string") for k in key]
    else:
        parts = [(F.col(key) if isinstance(key, str) else key).cast("string")]
    return F.md5(F.concat_ws(":", *parts, F.lit(str(seed))))


def round_all(df: DataFrame, cols: Iterable[str], scale: int = 4) -> DataFrame:
    cols = set(cols)
    return df.select(*[F.round(F.col(c).cast("double"), scale).alias(c) if c in cols else F.col(c)
                       for c in df.columns])
