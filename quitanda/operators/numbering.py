"""Row numbering within a key that stays parallel when one key is huge.

``row_number() over (partition by key order by cols)`` puts every row of a key
into one task.  ``number_within`` cuts keys into ordered slices instead, in one
way for every size:

1. rows are range-partitioned on (key, *order columns) and written once, with
   the number of their partition as slice id, to the shared scratch folder: a
   key of a third of all rows spans many slices, most keys lie in one;
2. rows are numbered inside each (key, slice);
3. the rows of each (key, slice) are counted, and the counts of a key's earlier
   slices are added to the numbers.  Only a slice's first key can have begun in an
   earlier slice, so there are no more of these offsets than slices.

Both 2 and 3 read the written rows, so they see the same slices however often a
lost task is run again.  The write is a job that runs when the function is
called.

Where most keys are small (``hot_only``), only the hot ones go that way.  A first
job counts the rows of 65536 hash buckets of the key; a bucket with more rows than
an even shuffle partition is hot and its keys are sliced.  All other rows are
shuffled once and numbered by the plain window; nothing is written for them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quitanda.session import scratch_path


# Hash buckets of a key, counted to find the hot ones; their counts are small for any table.
BUCKETS = 65536


def key_bucket(key: str) -> Column:
    """The hash bucket of a key."""
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def hot_buckets(df: DataFrame, bucket: Column) -> list[int]:
    """Buckets with more rows than an even shuffle partition (or eight even buckets, if that is more)."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = max(1 / partitions, 8 / BUCKETS)
    counts = df.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    hot = counts.where(F.col("n") > F.lit(share) * counts.agg(F.sum("n")).scalar())
    return [r.bucket for r in hot.select("bucket").collect()]


def number_within(df: DataFrame, key: str, order_cols: list[str], out_col: str,
                  slices: int | None = None, hot_only: bool = False) -> DataFrame:
    """Add ``out_col`` = 1-based position of the row inside its ``key`` group.

    Rows are ordered by ``order_cols`` (ascending, NULLs first); a NULL key is a
    key.  Rows equal in all order columns are numbered in any order and can't be
    cut apart.  ``hot_only`` slices hot keys alone, for tables of mostly small keys.
    """
    if not hot_only:
        return _number_sliced(df, key, order_cols, out_col, slices)
    bucket = key_bucket(key)
    hot = hot_buckets(df, bucket)
    inside = Window.partitionBy(key).orderBy(*[F.col(c).asc_nulls_first() for c in order_cols])
    rest = df.where(~bucket.isin(hot)) if hot else df
    numbered = rest.select("*", F.row_number().over(inside).cast("bigint").alias(out_col))
    if not hot:
        return numbered
    return numbered.unionByName(_number_sliced(df.where(bucket.isin(hot)), key, order_cols, out_col, slices))


def _number_sliced(df: DataFrame, key: str, order_cols: list[str], out_col: str, slices: int | None) -> DataFrame:
    spark = df.sparkSession
    order = [F.col(c).asc_nulls_first() for c in order_cols]
    ranged = (df.repartitionByRange(slices, F.col(key).asc_nulls_first(), *order) if slices
              else df.repartitionByRange(F.col(key).asc_nulls_first(), *order))
    path = scratch_path(spark, "slices")
    sliced = ranged.withColumn("_slice", F.spark_partition_id())
    sliced.write.parquet(path)
    rows = spark.read.schema(sliced.schema).parquet(path)

    inside = Window.partitionBy(key, "_slice").orderBy(*order)
    earlier = Window.partitionBy("_key").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(F.col(key).alias("_key"), F.col("_slice").alias("_of")).agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_key", "_of", F.sum("_n").over(earlier).alias("_before")).where("_before > 0")
    numbered = rows.withColumn("_inside", F.row_number().over(inside))
    same_slice = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_slice") == F.col("_of"))
    return (numbered.join(before, same_slice, "left")
            .withColumn(out_col, (F.col("_inside") + F.coalesce("_before", F.lit(0))).cast("bigint"))
            .select(*df.columns, out_col))
