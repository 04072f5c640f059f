"""CSV sources: bulk load of a folder of CSV files, and the seed lookup table.

Files are read by executors; the driver only lists file names.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quitanda.schemas import RAW_SCHEMAS

SEED_SCHEMA = RAW_SCHEMAS["product_category_name_translation"]
BOM = "\ufeff"
# Text fields keep their spaces exactly (Spark's CSV writer trims by default).
KEEP_SPACES = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def list_files(spark: SparkSession, folder: str) -> list[str]:
    """Entries directly under ``folder`` (any Hadoop file system), sorted by name."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    return sorted(str(s.getPath().toString()) for s in fs.listStatus(path))


def _file_system(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def delete_folder(spark: SparkSession, folder: str) -> None:
    fs, path = _file_system(spark, folder)
    fs.delete(path, True)


def replace_folder(spark: SparkSession, folder: str, write: Callable[[str], None]) -> None:
    """Replace ``folder`` by what ``write`` puts into a folder beside it.

    Until that is written whole the old files stay as they are, so a failed write
    leaves the old table readable and its own rest is removed.  The switch is two
    renames on the file system; the old folder is moved back if the second fails.
    The name beside begins with an underscore, so readers of a parent folder do not
    see it.
    """
    parent, name = posixpath.split(folder.rstrip("/"))
    mark = uuid.uuid4().hex[:12]
    new, old = f"{parent}/_new-{mark}-{name}", f"{parent}/_old-{mark}-{name}"
    try:
        write(new)
    except BaseException:
        delete_folder(spark, new)
        raise
    fs, target = _file_system(spark, folder)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    had = fs.exists(target)
    if had and not fs.rename(target, path(old)):
        delete_folder(spark, new)
        raise OSError(f"cannot move {folder} aside")
    if not fs.rename(path(new), target):
        if had:
            fs.rename(path(old), target)
        delete_folder(spark, new)
        raise OSError(f"cannot move the new files to {folder}")
    if had:
        delete_folder(spark, old)


def table_name_of(file_path: str) -> str:
    """``shop_orders_dataset.csv`` → ``shop_orders``: no extension, no ``_dataset``."""
    base = posixpath.basename(file_path.rstrip("/"))
    stem = base[:-4] if base.lower().endswith(".csv") else base
    return stem.replace("_dataset", "")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.options(header="true", mode="FAILFAST", **KEEP_SPACES)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", "true")
    return reader.csv(path)


@dataclass
class LoadStatus:
    table: str
    path: str
    status: str          # loaded | failed
    error: str | None = None


def bulk_load_csv(spark: SparkSession, folder: str, target_folder: str,
                  schemas: dict[str, T.StructType] | None = None,
                  name_map: dict[str, str] | None = None) -> list[LoadStatus]:
    """Load every ``*.csv`` under ``folder`` into ``target_folder/<table>`` (replace).

    The table name comes from the file name; a known table gets its typed
    schema, others are inferred.  A failing file is reported and the rest
    still load.
    """
    schemas = RAW_SCHEMAS if schemas is None else schemas
    statuses = []
    for f in list_files(spark, folder):
        if not f.lower().rstrip("/").endswith(".csv"):
            continue
        name = table_name_of(f)
        name = (name_map or {}).get(name, name)
        try:
            df = read_csv(spark, f, schemas.get(name))
            df.write.mode("overwrite").parquet(f"{target_folder.rstrip('/')}/{name}")
            statuses.append(LoadStatus(name, f, "loaded"))
        except Exception as exc:  # noqa: BLE001 — reported per file, the batch goes on
            statuses.append(LoadStatus(name, f, "failed", f"{type(exc).__name__}: {str(exc)[:300]}"))
    return statuses


def write_csv(df: DataFrame, path: str, line_sep: str = "\n") -> None:
    df.write.mode("overwrite").options(header="true", lineSep=line_sep, **KEEP_SPACES).csv(path)


def write_seed_csv(df: DataFrame, path: str) -> None:
    """Write a small lookup table the way spreadsheet tools save it: UTF-8 BOM, CRLF.

    Seeds are bounded lookup tables, so one file is fine; ``repartition(1)``
    (not ``coalesce``) keeps whatever computed ``df`` parallel.
    """
    first = df.columns[0]
    df.withColumnRenamed(first, BOM + first).repartition(1).write.mode("overwrite") \
        .options(header="true", lineSep="\r\n", **KEEP_SPACES).csv(path)


def read_seed(spark: SparkSession, path: str, schema: T.StructType = SEED_SCHEMA) -> DataFrame:
    """Read a seed CSV (header row, optional UTF-8 BOM, CRLF or LF lines)."""
    return (spark.read.options(header="true", encoding="UTF-8", multiLine="true", **KEEP_SPACES)
            .schema(schema).csv(path))
