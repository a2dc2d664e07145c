"""Session construction and shared scratch locations.

Intermediate tables (streaming checkpoints, written tiles, lineage cuts) go
below the cluster's ``spark.checkpoint.dir``. Only when the session has none
(local runs, tests) do we create one.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "tessera", **conf) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _configured_checkpoint_dir(spark: SparkSession) -> str | None:
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    try:
        conf = spark.conf.get("spark.checkpoint.dir", None)
    except Exception:  # pragma: no cover - older confs
        conf = None
    return conf or sc.getConf().get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; set a local one only if unset."""
    current = _configured_checkpoint_dir(spark)
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="tessera-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir() or local


#: Rows up to which a small side is broadcast; beyond it the join is left to Spark.
BROADCAST_ROWS = 1_000_000


def small_side(df: DataFrame, name: str = "small") -> DataFrame:
    """Write a statistics table and hint its broadcast only if its counted rows allow it."""
    df = materialize(df, name)
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def join_null_safe(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Equi-join on ``on`` that also matches nulls; columns of ``left`` and the rest of ``right``."""
    on = list(on)
    if not on:
        return left.crossJoin(right)  # a one-row side: there is no key
    other = right.select(*[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in right.columns])
    cond = None
    for c in on:
        same = left[c].eqNullSafe(other[f"_r_{c}"])
        cond = same if cond is None else cond & same
    return left.join(other, cond, how).drop(*[f"_r_{c}" for c in on])


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str = "stage"):
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage (a restarted stage reads the written table instead of
    recomputing upstream work) and keeps later plans small. Used for small
    statistics tables and for inputs that several jobs read again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of any file system that Spark reaches."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


#: Paths of the tables that ``materialize`` has written, in order.
_WRITTEN: list[str] = []


@contextmanager
def scratch_scope(spark: SparkSession, keep: Sequence[str] = ()):
    """Delete at the end what ``materialize`` wrote inside, but for the tables named in ``keep``.

    For callers whose results no longer read it, or read only what they keep.
    """
    start = len(_WRITTEN)
    try:
        yield
    finally:
        own, _WRITTEN[start:] = _WRITTEN[start:], []
        for path in own:
            if path.rsplit("/", 1)[-1].rsplit("-", 1)[0] in keep:
                _WRITTEN.append(path)
            else:
                delete_path(spark, path)
