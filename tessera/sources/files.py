"""Parquet files that can't be read or not wholly, found at read time.

One broken file must not end the ingest of thousands. Files are listed, then scanned twice with
corrupt files tolerated: a scan without columns, which takes row counts from the footers, and a
scan of the wanted columns with page checksums, which shows the rows that really arrive. What the
two and the listing disagree on is told apart: an empty file, one without a readable footer, one
whose rows break off, and a sound file without rows. Only files that no row came from and that are
small enough to be without rows are opened once more, for their footer.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.session import materialize
from tessera.sources.raster import ingest_with_quarantine

#: A Parquet file without rows has a footer only; a longer one without any readable row is broken.
FOOTER_BYTES = 1 << 26


def list_files(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """``path, length`` of all files below ``root``; no content is read.

    Scans pass over files of length 0; they are in the list that the driver has made for the scan.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    found = reader.load(root)
    # scans write a path without host as file:/..., the list as file:///...
    names = spark.createDataFrame([(re.sub("^([^:/]+):///", r"\1:/", p),) for p in found.inputFiles()], "path string")
    lengths = found.select(F.col("_metadata.file_path").alias("_f"), "length")
    return names.join(lengths, F.col("path") == F.col("_f"), "left").select("path", F.coalesce("length", F.lit(0).cast("long")).alias("length"))


def tolerant_scan(spark: SparkSession, root: str, schema: str | StructType) -> DataFrame:
    """The columns of ``schema`` and ``path`` from every file below ``root``, broken parts left out."""
    return (spark.read.schema(schema).option("recursiveFileLookup", "true").option("ignoreCorruptFiles", "true")
            .option("parquet.page.verify-checksum.enabled", "true").parquet(root).select("*", F.col("_metadata.file_path").alias("path")))


def _sound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Paths of the files whose content has a Parquet footer."""
    import pyarrow.parquet as pq
    for batch in batches:
        ok = []
        for content in batch.column(1):
            try:
                pq.read_metadata(pa.BufferReader(content.as_buffer()))
                ok.append(True)
            except (pa.ArrowInvalid, OSError):
                ok.append(False)
        yield pa.RecordBatch.from_arrays([batch.column(0)], ["path"]).filter(pa.array(ok, pa.bool_()))


def check_files(spark: SparkSession, root: str, schema: str | StructType, pattern: str | None = None) -> DataFrame:
    """``path, length, rows, arrived, checksum, reason`` of every file; the reason is null where all rows arrive.

    ``rows`` is what the footer says (null: none can be read), ``arrived`` what a scan delivers, and
    ``checksum`` sums up their content whatever their order.
    """
    files = list_files(spark, root, pattern)
    scan = tolerant_scan(spark, root, schema)
    said = scan.groupBy(F.col("path").alias("_p")).agg(F.count(F.lit(1)).alias("rows"))
    columns = [c for c in scan.columns if c != "path"]
    arrived = scan.groupBy(F.col("path").alias("_q")).agg(F.count(F.lit(1)).alias("arrived"), F.bit_xor(F.xxhash64(*columns)).alias("checksum"))
    both = (files.join(said, F.col("path") == F.col("_p"), "left").join(arrived, F.col("path") == F.col("_q"), "left").drop("_p", "_q"))
    # the driver lists files anyway: those that need a second look are a part of that list
    silent = [r["path"] for r in both.where(F.col("rows").isNull() & F.col("length").between(1, FOOTER_BYTES)).select("path").collect()]
    if silent:
        content = spark.read.format("binaryFile").load(silent).select(F.col("_metadata.file_path").alias("path"), "content")
        sound = content.mapInArrow(_sound, "path string").select(F.col("path").alias("_s"))
        both = both.join(F.broadcast(sound), F.col("path") == F.col("_s"), "left").withColumn(
            "rows", F.when(F.col("_s").isNotNull(), F.lit(0).cast("long")).otherwise(F.col("rows"))).drop("_s")
    arrived_n = F.coalesce("arrived", F.lit(0)).cast("long")
    reason = (F.when(F.col("length") == 0, F.lit("empty file")).when(F.col("rows").isNull(), F.lit("unreadable file"))
              .when(arrived_n < F.col("rows"), F.lit("damaged rows")).when(F.col("rows") == 0, F.lit("no rows")))
    # written: where a caller drops the checksum, the plan would no longer read the columns
    return materialize(both.select("path", "length", "rows", arrived_n.alias("arrived"), "checksum", reason.alias("reason")), "file_check")


def ingest_files(spark: SparkSession, root: str, schema: str | StructType, grid: DataFrame, *, tile: Column,
                 pattern: str | None = None) -> tuple[DataFrame, DataFrame]:
    """S8 from files: pixels of the tiles whose files are all sound and fill their grid, and the status of every tile.

    ``tile`` makes the tile out of ``path``. Counts come from the file check: pixels aren't scanned for them.
    """
    checked = check_files(spark, root, schema, pattern).withColumn("tile", tile)
    counts = checked.groupBy("tile").agg(F.sum("arrived").cast("long").alias("n"))
    failed = checked.where(F.col("reason").isNotNull()).select("tile", "reason")
    pixels = tolerant_scan(spark, root, schema).withColumn("tile", tile).drop("path")
    return ingest_with_quarantine(pixels, grid, failed=failed, counts=counts)
