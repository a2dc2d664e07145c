"""ST1: incremental tile cleaning with Structured Streaming.

New Parquet files of a pixel table are picked up, cleaned (P1 + P3 on two
columns), labelled (P4) and appended. The stream is map-only (no state), uses
``trigger(availableNow=True)`` and a checkpoint in the shared checkpoint
folder, so a restart processes only files it has not committed yet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.functions.columns import nan_to_null
from tessera.operators.clean import ENCODE_RANGE, clean_filter, target_difference
from tessera.session import scratch_path


def clean_stream(stream: DataFrame, *, tcol: str, rcol: str, lval: float, hval: float,
                 yvar: str = "zdif") -> DataFrame:
    return target_difference(clean_filter(stream, [tcol, rcol], lval, hval), tcol, rcol, yvar)


def run_incremental_clean(spark: SparkSession, source: str, sink: str, checkpoint: str, schema, *,
                          tcol: str, rcol: str, lval: float = ENCODE_RANGE[0], hval: float = ENCODE_RANGE[1],
                          key: str = "pix", yvar: str = "zdif") -> None:
    """Process every file present in ``source`` now; append the result to ``sink``."""
    stream = nan_to_null(spark.readStream.schema(schema).parquet(source))
    cleaned = clean_stream(stream, tcol=tcol, rcol=rcol, lval=lval, hval=hval, yvar=yvar).select(key, yvar)
    q = (cleaned.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start(sink))
    q.awaitTermination()


def incremental_clean(spark: SparkSession, pixels: DataFrame, *, tcol: str, rcol: str, lval: float,
                      hval: float, key: str = "pix", yvar: str = "zdif") -> DataFrame:
    """Land ``pixels`` as files, stream them through the cleaner, return the sink table."""
    base = scratch_path(spark, "incremental")
    source, sink, ckpt = f"{base}/in", f"{base}/out", f"{base}/ckpt"
    pixels.write.mode("overwrite").parquet(source)
    schema = spark.read.parquet(source).schema
    run_incremental_clean(spark, source, sink, ckpt, schema, tcol=tcol, rcol=rcol, lval=lval, hval=hval,
                          key=key, yvar=yvar)
    return spark.read.parquet(sink)
