"""Spark session defaults and the shared scratch location.

Every job writes intermediate tables (layer materialisations, round-trip
files) below the folder the cluster names in ``spark.checkpoint.dir``: it is
shared by all executors, so a lost executor never takes written results with
it.  Only when that setting is missing (local tests) do we set one ourselves.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on for exact, engine-independent results.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


# Static settings (fixed when the session starts).  A pipeline runs dozens of
# distinct plans; the default cache of 100 generated classes would evict and
# recompile them between models.
STATIC_DEFAULTS = {
    "spark.sql.codegen.cache.maxEntries": "2000",
}


def get_session(master: str | None = None, app: str = "quitanda",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's defaults.

    ``master`` is only for local runs; on a cluster it comes from
    ``spark-submit``.  ``shuffle_partitions`` should be sized so one shuffle
    partition stays around 128-256 MB at the target data volume; AQE then
    coalesces small ones at run time.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.ui.enabled", "false")
    for key, value in {**STATIC_DEFAULTS, **SESSION_DEFAULTS}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key, value in SESSION_DEFAULTS.items():
        spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    return spark


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """While this is open, a query's shuffle files go when the query ends, not when the driver's memory is cleaned.

    For work that writes one table after the other and runs no DataFrame's plan twice.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; only a local master gets one of its own when none is named."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        if not spark.sparkContext.master.startswith("local") or "local-cluster" in spark.sparkContext.master:
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        current = tempfile.mkdtemp(prefix="quitanda-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str, unique: bool = True) -> str:
    """A fresh folder name below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    leaf = f"{name}-{uuid.uuid4().hex[:12]}" if unique else name
    return f"{base}/quitanda/{leaf}"
