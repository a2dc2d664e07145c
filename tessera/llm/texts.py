"""Running a per-text function inside Spark tasks over Arrow batches, in bounded slices."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters of text that a slice holds before it is worked off, and rows at most.
SLICE_CHARS, SLICE_ROWS = 1 << 20, 1024
#: Bytes of a batch that goes from Spark to a Python worker, unless the session sets its own limit (Spark's: 64 MB).
BATCH_BYTES = 4 << 20


_KEPT: dict = {}


def worker_cache(key: tuple, make: Callable[[], object]):
    """What a worker process keeps from task to task: the last thing asked for, under its key, and no other.

    Workers live as long as their executor, so what one operator keeps must not add to another's memory.
    """
    if key not in _KEPT:
        forget()
        _KEPT[key] = make()
    return _KEPT[key]


def forget() -> None:
    """Free what the worker keeps; ``close`` breaks reference cycles that the collector may not look at."""
    for kept in _KEPT.values():
        getattr(kept, "close", lambda: None)()
    _KEPT.clear()
    gc.unfreeze()
    gc.collect()


def release() -> None:
    """Hand freed memory back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def releasing(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task's function that hands freed memory back to the system at its end: workers live on, idle."""
    def task(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            release()
    return task


def releasing_group(run: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """The same for a function of one group; its result is all that the worker still holds."""
    def group(table: pa.Table) -> pa.Table:
        try:
            return run(table)
        finally:
            release()
    return group


def small_batches(spark: SparkSession) -> None:
    """Bound what a task holds of its texts at once: both Spark and the worker have whole batches, and copies of them."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.set(name, spark.conf.get(name, str(BATCH_BYTES)))


def slices(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) runs of a batch, each of about SLICE_CHARS characters; nulls are empty."""
    texts, start, size = [], 0, 0
    for i, value in enumerate(batch.column(column)):
        text = value.as_py() or ""
        texts.append(text)
        size += len(text)
        if size >= SLICE_CHARS or len(texts) >= SLICE_ROWS:
            yield start, texts
            texts, start, size = [], i + 1, 0
    if texts:
        yield start, texts


def map_texts(df: DataFrame, key: str, text: str, make: Callable[[], Callable[[list[str]], dict[str, list]]],
              columns: list[tuple[str, str, pa.DataType]], keeps: bool = False) -> DataFrame:
    """``key`` and new columns per row: ``make()`` runs once a task and gives a function of text lists.

    What it keeps for later tasks goes through ``worker_cache`` (``keeps``); any other task frees what
    an operator before it has left in the worker.
    Other columns of ``df`` are not read, so their names cannot clash.
    """
    small_batches(df.sparkSession)
    kind = df.schema[key].dataType.simpleString()
    schema = f"key {kind}, " + ", ".join(f"{n} {sql}" for n, sql, _ in columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            forget()
        work = make()
        for batch in batches:
            for start, texts in slices(batch, 1):
                out = work(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(texts)), *(pa.array(out[n], t) for n, _, t in columns)],
                    ["key", *(n for n, _, _ in columns)])

    return df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(releasing(run), schema)


class Memo(dict):
    """A bounded memo: up to ``room`` results are kept, later new keys are computed each time.

    Keys over ``longest`` are never kept, so the memo's bytes are bounded, too.
    """

    def __init__(self, compute: Callable, room: int, longest: int = 64):
        super().__init__()
        self.compute, self.room, self.longest = compute, room, longest

    def __missing__(self, key):
        value = self.compute(key)
        if len(self) < self.room and len(key) <= self.longest:
            self[key] = value
        return value
