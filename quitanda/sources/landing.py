"""Parquet landing zone and the typed raw layer.

* ``write_landing``   one table's extract → ``<base>/<env>/<table>/year=/month=/day=``
                      (Hive-style load-date folders; writing a day replaces exactly that
                      day's folder, also with nothing when the source is empty; the new
                      day is written beside and switched in, so a failed extract leaves
                      the old one)
* ``extract_to_landing`` the same plus a status row (``success`` / ``empty``)
* ``read_landing``    one load date of a table, partition-pruned, typed
* ``load_raw``        landing → raw table by column position, cast to the registry
                      types; idempotent per load date by default, or append
* ``fill_type_defaults`` NULL → type default for non-nullable columns (opt-in)
* ``create_raw_tables`` / ``run_ddl_folder`` typed table DDL
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quitanda.schemas import RAW_SCHEMAS, ddl_of
from quitanda.sources.files import list_files, replace_folder

LOAD_DATE_COL = "load_date"

# Source DDL marks only these columns nullable; every other column would get
# its type default when loaded with fill_type_defaults.
NULLABLE_COLUMNS = {
    "orders": {"order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date"},
}


def landing_path(base: str, table: str, env: str | None = None) -> str:
    parts = [base.rstrip("/")] + ([env] if env else []) + [table]
    return "/".join(parts)


def _partition_values(load_date: dt.date | str) -> tuple[int, int, int]:
    d = dt.date.fromisoformat(load_date) if isinstance(load_date, str) else load_date
    return d.year, d.month, d.day


def partition_suffix(load_date: dt.date | str) -> str:
    y, m, d = _partition_values(load_date)
    return f"year={y}/month={m:02d}/day={d:02d}"


def write_landing(df: DataFrame, base: str, table: str, load_date: dt.date | str,
                  env: str | None = None, batch_rows: int | None = None) -> str:
    """Replace one load date of a landed table; other dates stay as they are.

    Files are as large as the read splits of the source; ``batch_rows`` cuts
    them at a number of rows (30 000 in the source project).
    """
    path = landing_path(base, table, env)
    writer = df.write
    if batch_rows:
        writer = writer.option("maxRecordsPerFile", str(batch_rows))
    replace_folder(df.sparkSession, f"{path}/{partition_suffix(load_date)}", writer.parquet)
    return path


@dataclass
class ExtractStatus:
    table: str
    status: str          # success | empty
    rows: int
    path: str | None


def extract_to_landing(spark: SparkSession, df: DataFrame, base: str, table: str,
                       load_date: dt.date | str, env: str | None = None,
                       batch_rows: int | None = None) -> ExtractStatus:
    """Extract one table into its load-date folder and report the outcome.

    The source is read once; the write itself counts the rows.
    """
    counted = Observation()
    path = write_landing(df.observe(counted, F.count(F.lit(1)).alias("rows")), base, table, load_date, env, batch_rows)
    rows = counted.get["rows"]
    if rows == 0:
        return ExtractStatus(table, "empty", 0, None)
    return ExtractStatus(table, "success", rows, f"{path}/{partition_suffix(load_date)}")


def read_landing(spark: SparkSession, base: str, table: str, load_date: dt.date | str,
                 schema: T.StructType | None = None, env: str | None = None) -> DataFrame | None:
    """One load date of a landed table (only its folder is listed); None if that day was never landed."""
    path = f"{landing_path(base, table, env)}/{partition_suffix(load_date)}"
    if not list_files(spark, path):
        return None
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def conform_by_position(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``INSERT … SELECT *``: columns are matched by position and cast to the target types."""
    if len(df.columns) != len(schema.fields):
        raise ValueError(f"expected {len(schema.fields)} columns, got {len(df.columns)}")
    return df.select([F.col(f"`{src}`").cast(f.dataType).alias(f.name)
                      for src, f in zip(df.columns, schema.fields)])


def load_raw(df: DataFrame, raw_path: str, table: str, load_date: dt.date | str,
             mode: str = "replace_date") -> DataFrame:
    """Load one landed date into the raw table at ``raw_path``.

    ``replace_date`` (default) replaces that load date's folder, also by no rows,
    so loading a day again never doubles or keeps old rows; ``append`` adds the
    rows again (the plain ``INSERT`` behaviour).
    """
    d = dt.date.fromisoformat(load_date) if isinstance(load_date, str) else load_date
    typed = conform_by_position(df, RAW_SCHEMAS[table])
    folder = f"{raw_path.rstrip('/')}/{LOAD_DATE_COL}={d.isoformat()}"
    if mode == "append":
        typed.write.mode("append").parquet(folder)
    else:
        replace_folder(df.sparkSession, folder, typed.write.parquet)
    return read_raw(df.sparkSession, raw_path, table)


def read_raw(spark: SparkSession, raw_path: str, table: str) -> DataFrame:
    """The raw table at ``raw_path`` with its load date; empty if nothing was loaded."""
    schema = T.StructType([*RAW_SCHEMAS[table].fields, T.StructField(LOAD_DATE_COL, T.DateType())])
    if not list_files(spark, raw_path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(raw_path)


def _default_of(dtype: T.DataType) -> Column | None:
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.lit(0).cast(dtype)
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        return F.lit(0).cast(dtype)
    if isinstance(dtype, T.StringType):
        return F.lit("")
    if isinstance(dtype, T.DateType):
        return F.lit(dt.date(1970, 1, 1))
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType)):
        return F.lit(dt.datetime(1970, 1, 1)).cast(dtype)
    return None


def fill_type_defaults(df: DataFrame, table: str) -> DataFrame:
    """NULL → type default (0, '', epoch) for the table's non-nullable columns."""
    keep_null = NULLABLE_COLUMNS.get(table, set())
    cols = []
    for f in df.schema.fields:
        default = None if f.name in keep_null else _default_of(f.dataType)
        cols.append(F.coalesce(F.col(f.name), default).alias(f.name) if default is not None else F.col(f.name))
    return df.select(cols)


def create_raw_tables(spark: SparkSession, database: str, location: str) -> list[str]:
    """Create the nine typed raw tables if absent, each at ``location/<table>``."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location.rstrip('/')}'")
    made = []
    for table in RAW_SCHEMAS:
        spark.sql(ddl_of(table, f"{database}.{table}", f"{location.rstrip('/')}/{table}"))
        made.append(f"{database}.{table}")
    return made


class DdlError(RuntimeError):
    pass


def run_ddl_folder(spark: SparkSession, folder: str) -> list[str]:
    """Run every ``.sql`` file of ``folder`` in name order (one statement each).

    An empty folder or an empty file is an error, as is a failing statement;
    the file's name is reported with it.
    """
    files = [f for f in list_files(spark, folder) if f.endswith(".sql")]
    if not files:
        raise DdlError(f"no .sql files in {folder}")
    done = []
    for f in files:
        row = spark.read.option("wholetext", "true").text(f).first()  # one small DDL file
        text = (row[0] if row is not None else "").strip()
        if not text:
            raise DdlError(f"empty DDL file {f}")
        try:
            spark.sql(text.rstrip(";"))
        except Exception as exc:  # noqa: BLE001
            raise DdlError(f"{f}: {exc}") from exc
        done.append(f)
    return done
