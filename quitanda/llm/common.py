"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quitanda.session import scratch_path

#: Java/RE2 pattern of a word; every operator counts words by it.
WORD = r"[^\x20\x09-\x0D]+"
SEPARATOR = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage at a written table, so a lost executor re-reads files
    instead of recomputing everything before.
    """
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def arrays(df: DataFrame) -> dict[str, np.ndarray]:
    """A table of proven small size as numpy columns; Arrow keeps rows out of Python objects."""
    table = df.toArrow()
    return {name: table[name].to_numpy() for name in table.column_names}


def text_key(text: Column) -> Column:
    """Hash that tells rows with one doc_id apart; null and empty texts differ."""
    return F.when(text.isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64(text))


def word_count(text: Column) -> Column:
    """Number of words of a text as long; 0 for null."""
    return F.when(text.isNull(), F.lit(0)).otherwise(
        F.size(F.array_remove(F.split(text, SEPARATOR), ""))).cast("long")


def same(a: Column, b: Column) -> Column:
    """Null-safe equality."""
    return a.eqNullSafe(b)


#: Rows of an Arrow batch; rows are whole documents, so the default of 10 000 would hold tens of MB
#: in each of a task's buffers.
BATCH_ROWS = 1000


def workers_find_package(spark: SparkSession) -> None:
    """Let Python workers import this package where they see the driver's path, and bound their batches.

    Elsewhere the package is shipped with ``--py-files``.  A batch size set by the user stays.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH"), root) if x)
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows, "10000") == "10000":
        spark.conf.set(rows, str(BATCH_ROWS))


def workers_return_memory(spark: SparkSession) -> None:
    """Let Python workers give freed arrays of a megabyte and more back at once.

    For jobs whose stages use workers one after another: idle workers live on beside the next
    stage's, and by default the C library keeps up to 32 MB blocks in each.
    """
    env = spark.sparkContext.environment
    env.setdefault("MALLOC_MMAP_THRESHOLD_", str(1 << 20))
    env.setdefault("MALLOC_TRIM_THRESHOLD_", str(1 << 20))
    env.setdefault("MALLOC_ARENA_MAX", "2")
    env.setdefault("ARROW_DEFAULT_MEMORY_POOL", "system")  # Arrow's own pool keeps what it frees
