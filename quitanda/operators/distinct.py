"""Distinct counts and other measures of the same groups, without a table of all pairs in the scanning tasks.

``count(DISTINCT a), count(DISTINCT b), sum(x)`` in one aggregate makes Spark expand every row once a
distinct column and combine the copies in the tasks that read the rows.  Nearly all of them differ, so
these tables hold all rows of a read split several times over, and spill.  ``aggregate_distinct`` sends
narrow rows first and combines behind the shuffle, where a task holds one shuffle partition:

1. a row gives one (key, column, value) entry a distinct column; the first also carries the measures;
2. entries are spread by all three, so a hot key lies in as many tasks as it has values;
3. each (key, column, value) is combined to one row, and these are counted and added up by key.

Where most keys are small (``spread_hot_only``), a first job counts the rows of 65536 hash buckets of the key, as
for ``number_within``.  If none is hot, entries are dealt by the key alone and both steps run behind that one shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quitanda.functions.aggs import EXACT
from quitanda.operators.numbering import hot_buckets, key_bucket

_FIRST = {
    "rows": lambda name: F.count_if(F.col("_column") == 0),
    "count": lambda name: F.count(name),
    "exact": lambda name: F.sum(F.col(name).cast(EXACT)),
    "sum": lambda name: F.sum(name),
    "min": lambda name: F.min(name),
    "max": lambda name: F.max(name),
}


def aggregate_distinct(df: DataFrame, key: str, distinct: dict[str, str],
                       measures: dict[str, tuple[str, Column | None]] | None = None,
                       spread_hot_only: bool = False) -> DataFrame:
    """One row per ``key`` (NULL is one): exact distinct counts of text columns, and ``measures``.

    ``distinct`` names a column for each count; as in SQL, NULL is not counted.  ``measures`` gives each
    name a kind and an expression: ``rows`` (no expression), ``count`` (non-NULL values), ``exact`` (sum
    as decimal), ``sum``, ``min`` or ``max``.  ``spread_hot_only`` is for tables of mostly small keys whose rows
    are cheap to read once more.
    """
    measures = measures or {}
    carried = {name: c for name, (_, c) in measures.items() if c is not None}
    columns = [str(i) for i in range(len(distinct))]
    wide = df.select(F.col(key), *[c.alias(name) for name, c in carried.items()],
                     *[F.col(c).cast("string").alias(i) for i, c in zip(columns, distinct.values())])
    column = F.col("_name").cast("tinyint")
    entries = (wide.unpivot([key, *carried], columns, "_name", "_value")
               .where((F.col("_name") == "0") | F.col("_value").isNotNull())
               .select(key, column.alias("_column"), "_value",
                       *[F.when(F.col("_name") == "0", F.col(name)).alias(name) for name in carried]))
    spread = not spread_hot_only or bool(hot_buckets(df, key_bucket(key)))
    dealt = entries.repartition(key, "_column", "_value") if spread else entries.repartition(key)
    single = (dealt.groupBy(key, "_column", "_value")
              .agg(F.lit(0).alias("_"), *[_FIRST[kind](name).alias(name) for name, (kind, _) in measures.items()]))
    counted = [F.count_if((F.col("_column") == i) & F.col("_value").isNotNull()).alias(name)
               for i, name in enumerate(distinct)]
    merged = [(F.min if kind == "min" else F.max if kind == "max" else F.sum)(name).alias(name)
              for name, (kind, _) in measures.items()]
    return single.groupBy(key).agg(*counted, *merged)
