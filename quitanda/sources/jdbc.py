"""Database extract over JDBC, read in parallel by the executors.

The source table is read as ``(select * from <schema>."<table>") q`` split
into ``num_partitions`` parts, each fetched by one task in ``fetchsize`` row
batches — bounded memory per task, no rows through the driver.  An integer
column is split into ranges, a string key by a hash modulo, a date or timestamp
by ranges of days; only without a split column is the read one task.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from quitanda.sources.landing import ExtractStatus, extract_to_landing

DEFAULT_FETCH_ROWS = 30000
ENV_FETCH_ROWS = 10000


def source_query(table: str, schema: str = "staging") -> str:
    return f'(select * from {schema}."{table}") q'


def hash_predicates(column: str, parts: int) -> list[str]:
    """One WHERE clause for each part of a string key; NULL keys go to the first."""
    # the sign bit is cut off, so that the remainder is never negative
    value = f'(coalesce(hashtext("{column}"::text), 0) & 2147483647) % {parts}'
    return [f"{value} = {i}" for i in range(parts)]


def date_predicates(column: str, first: dt.date, last: dt.date, parts: int) -> list[str]:
    """Day ranges over [first, last]; the outer ones are open, NULL goes to the first."""
    days = (last - first).days + 1
    cuts = sorted({first + dt.timedelta(days=days * i // parts) for i in range(1, parts)} - {first})
    name = f'"{column}"'
    if not cuts:
        return ["1 = 1"]
    middle = [f"{name} >= '{a.isoformat()}' and {name} < '{b.isoformat()}'" for a, b in zip(cuts, cuts[1:])]
    return [f"{name} < '{cuts[0].isoformat()}' or {name} is null", *middle, f"{name} >= '{cuts[-1].isoformat()}'"]


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None,
              schema: str = "staging", partition_column: str | None = None,
              lower_bound: int | dt.date | None = None, upper_bound: int | dt.date | None = None,
              num_partitions: int | None = None, fetch_rows: int = DEFAULT_FETCH_ROWS) -> DataFrame:
    """One table of the source; the kind of split follows the bounds of ``partition_column``."""
    props = dict(properties or {})
    props.setdefault("fetchsize", str(fetch_rows))
    query = source_query(table, schema)
    if not partition_column or not num_partitions or num_partitions < 2:
        return spark.read.jdbc(url, query, properties=props)
    if lower_bound is None or upper_bound is None:
        lower_bound, upper_bound = spark.read.jdbc(
            url, f'(select min("{partition_column}") lo, max("{partition_column}") hi from {schema}."{table}") b',
            properties=props).first()
    if isinstance(lower_bound, (int, Decimal)):
        return spark.read.jdbc(url, query, column=partition_column, lowerBound=int(lower_bound),
                               upperBound=int(upper_bound), numPartitions=num_partitions, properties=props)
    if isinstance(lower_bound, dt.date):  # a datetime is one, too
        days = [x.date() if isinstance(x, dt.datetime) else x for x in (lower_bound, upper_bound)]
        predicates = date_predicates(partition_column, *days, num_partitions)
    else:
        predicates = hash_predicates(partition_column, num_partitions)
    return spark.read.jdbc(url, query, predicates=predicates, properties=props)


def extract_tables(spark: SparkSession, url: str, tables: list[str], landing_base: str,
                   load_date: dt.date | str, env: str | None = None,
                   properties: dict[str, str] | None = None,
                   split_columns: dict[str, str] | None = None,
                   num_partitions: int | None = None, batch_rows: int | None = None) -> list[ExtractStatus]:
    """Fan one extract out over ``tables``; each is one Spark job.  ``split_columns``: the key of each table."""
    fetch_rows = ENV_FETCH_ROWS if env else DEFAULT_FETCH_ROWS
    out = []
    for t in tables:
        df = read_jdbc(spark, url, t, properties, partition_column=(split_columns or {}).get(t),
                       num_partitions=num_partitions, fetch_rows=fetch_rows)
        out.append(extract_to_landing(spark, df, landing_base, t, load_date, env, batch_rows))
    return out
