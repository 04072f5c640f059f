"""Materialise models: views stay lazy, tables are written as Parquet.

Tables go to a folder or, with a database, into the catalog (external tables
below that folder).  A rebuild writes beside the old table and is switched in when
it is whole, so a failed write leaves the old table readable.  Rows are
range-partitioned on (month and) the model's sort key and sorted, so every file
covers one stretch of the key: a hot month spans several files, small months
share a task.  ``write_bounds`` keeps each file's first and last key beside the
files; ``read_range`` opens only the files whose stretch meets the wanted one.
In a catalog the order-grain roll-ups are bucketed on their key, so their joins
need no shuffle of them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quitanda.functions import month_key
from quitanda.plans.core import RowStream
from quitanda.plans.models import ModelSpec
from quitanda.sources.files import delete_folder, list_files, replace_folder

PREFIX_FOLDERS = ("bronze", "silver", "gold")
MONTH_COLUMN = "yyyymm"
# Cap on rows per written file: file size stays bounded (~100-500 MB for these
# row widths) however few write tasks a table ends up with.
MODEL_ROWS_PER_FILE = 5_000_000


def alias_name(model: str, folder: str | None = None, custom_alias: str | None = None) -> str:
    """Physical table name: ``<folder>_<name>`` inside bronze/silver/gold folders."""
    base = (custom_alias if custom_alias is not None else model).strip()
    if folder in PREFIX_FOLDERS:
        return f"{folder}_{base}"
    return base


def database_for(env: str) -> str:
    """Environment → database (prod gets its own, everything else dev)."""
    return "retail_prod" if env == "prod" else "retail_dev"


def with_month_key(df: DataFrame, date_col: str) -> DataFrame:
    return df.withColumn(MONTH_COLUMN, month_key(date_col))


def write_table(df: DataFrame, path: str, sort_by: tuple[str, ...] | list[str] = (),
                month_of: str | None = None, max_records_per_file: int | None = None,
                mode: str = "overwrite", replace_months_only: bool = False,
                table: str | None = None, bucket_by: str | None = None, stream: RowStream | None = None) -> None:
    """Write ``df`` as a Parquet table at ``path``, registered as ``table`` if that is given.

    A model table is a full rebuild (every old file replaced); with
    ``replace_months_only`` only the months present in ``df`` are rewritten.
    ``bucket_by`` needs ``table``; there are as many buckets as shuffle partitions.
    Of a ``stream`` of the same rows only the narrow rows go through the range shuffle.
    """
    month = [MONTH_COLUMN] if month_of else []
    ranged = month + list(sort_by)
    in_ranges = bool(ranged) and not (table and bucket_by)
    rows = stream.rows if stream and in_ranges else df
    if month_of:
        rows = with_month_key(rows, month_of)
    if in_ranges:
        rows = rows.repartitionByRange(*ranged)
        if stream:
            rows = stream.finish(rows).select(*stream.columns, *month)
        rows = rows.sortWithinPartitions(*ranged)
    df = rows
    w = df.write.mode(mode)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    if month_of:
        w = w.option("partitionOverwriteMode", "dynamic" if replace_months_only else "static")
        w = w.partitionBy(MONTH_COLUMN)
    if not table:
        w.parquet(path)
        return
    if bucket_by:
        n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        # one task for each bucket, so that each writes one file
        w = df.repartition(n, bucket_by).write.mode(mode).bucketBy(n, bucket_by).sortBy(bucket_by)
    w.format("parquet").option("path", path).saveAsTable(table)


def write_bounds(spark: SparkSession, path: str, column: str) -> None:
    """Keep the least and greatest ``column`` of each file of a written table in ``path/_bounds``.

    One pass over that column; a file whose rows are all NULL there has NULL bounds.
    """
    files = spark.read.parquet(path).select(F.input_file_name().alias("file"), F.col(column).alias("k"))
    bounds = files.groupBy("file").agg(F.min("k").alias("least"), F.max("k").alias("most"))
    replace_folder(spark, f"{path.rstrip('/')}/_bounds", bounds.repartition(1).write.parquet)


def files_in_range(spark: SparkSession, path: str, least: Column, most: Column) -> list[str]:
    """The files of a table with bounds that can hold keys from ``least`` to ``most``."""
    bounds = spark.read.parquet(f"{path.rstrip('/')}/_bounds")
    return [r.file for r in bounds.where((F.col("least") <= most) & (F.col("most") >= least)).select("file").collect()]


def read_range(spark: SparkSession, path: str, column: str, least, most) -> DataFrame:
    """Rows of a table with bounds whose ``column`` lies from ``least`` to ``most``; other files stay closed."""
    files = files_in_range(spark, path, F.lit(least), F.lit(most))
    schema = spark.read.parquet(path).schema
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*files).where(F.col(column).between(least, most))


def read_table(spark: SparkSession, path: str, spec: ModelSpec | None = None,
               schema: T.StructType | None = None) -> DataFrame:
    """Read a written table back; with ``schema`` an empty table reads as empty."""
    reader = spark.read
    if schema is not None:
        if spec is not None and spec.partition_month_of:
            schema = T.StructType(list(schema.fields) + [T.StructField(MONTH_COLUMN, T.IntegerType())])
        reader = reader.schema(schema)
    df = reader.parquet(path)
    if spec is not None and spec.partition_month_of and MONTH_COLUMN in df.columns:
        df = df.drop(MONTH_COLUMN)
    return df


def model_path(base_path: str, model: str, folder: str | None = None) -> str:
    return f"{base_path.rstrip('/')}/{alias_name(model, folder)}"


def materialize(spark: SparkSession, spec: ModelSpec, df: DataFrame, base_path: str,
                folder: str | None = None, database: str | None = None, stream: RowStream | None = None) -> DataFrame:
    """Materialise one model; return the DataFrame later layers should read.

    ``stream`` has the same rows as ``df`` for the shuffles of the write.
    """
    name = alias_name(spec.name, folder)
    if spec.materialized == "view":
        df.createOrReplaceTempView(name)
        return df
    path = model_path(base_path, spec.name, folder)
    if database:
        _switch_table(spark, spec, df, path, f"{database}.{name}", stream)
    else:
        def write(to: str) -> None:
            write_table(df, to, spec.sort_by, spec.partition_month_of, MODEL_ROWS_PER_FILE, stream=stream)
        replace_folder(spark, path, write)
        spark.catalog.refreshByPath(path)
    return existing(spark, spec, base_path, folder, database, df.schema)


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").select("data_type").collect()
    return rows[0][0]


def _switch_table(spark: SparkSession, spec: ModelSpec, df: DataFrame, path: str, table: str,
                  stream: RowStream | None = None) -> None:
    """Write the new rows as a table of their own folder, then give it the old one's name."""
    mark = uuid.uuid4().hex[:12]
    new, folder = f"{table}_new_{mark}", f"{path}-{mark}"
    try:
        write_table(df, folder, spec.sort_by, spec.partition_month_of, MODEL_ROWS_PER_FILE, table=new,
                    bucket_by=spec.bucket_by, stream=stream)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {new}")
        delete_folder(spark, folder)
        raise
    had = _location(spark, table) if spark.catalog.tableExists(table) else None
    if had:
        spark.sql(f"DROP TABLE {table}")
    spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
    if had:
        delete_folder(spark, had)


def existing(spark: SparkSession, spec: ModelSpec, base_path: str, folder: str | None = None,
             database: str | None = None, schema: T.StructType | None = None) -> DataFrame | None:
    """The written table of a model, None if there is none."""
    if spec.materialized == "view":
        return None
    if database:
        table = f"{database}.{alias_name(spec.name, folder)}"
        if not spark.catalog.tableExists(table):
            return None
        df = spark.table(table)
        return df.drop(MONTH_COLUMN) if spec.partition_month_of else df
    path = model_path(base_path, spec.name, folder)
    if schema is None and not list_files(spark, path):
        return None
    return read_table(spark, path, spec, schema)


def month_slice(spark: SparkSession, path: str, yyyymm: int) -> DataFrame:
    """One month of a month-partitioned table (partition-pruned scan)."""
    return spark.read.parquet(path).where(F.col(MONTH_COLUMN) == F.lit(yyyymm))
