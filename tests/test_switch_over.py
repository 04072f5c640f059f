"""Rebuilt tables and replaced days: a write that fails midway leaves the old rows; files cover stretches of the key."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quitanda.plans.materialize import (existing, files_in_range, materialize, model_path, read_range, write_bounds,
                                        write_table)
from quitanda.plans.models import MODELS
from quitanda.session import scratch_path
from quitanda.sources.files import list_files
from quitanda.sources.landing import load_raw, read_landing, read_raw, write_landing

SPEC = MODELS["mart_sales_daily"]


def days(spark, n):
    return spark.range(n).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("sales_date"),
                                 F.col("id").alias("orders_count"))


def failing(df, column):
    """The same rows, but one of the later ones raises when it is written."""
    return df.withColumn(column, F.when(F.col(column) == F.lit(df.count() - 1), F.raise_error("planted")).otherwise(F.col(column)))


def test_failed_rebuild_leaves_the_old_table(spark):
    base = scratch_path(spark, "switch")
    materialize(spark, SPEC, days(spark, 50), base)
    assert existing(spark, SPEC, base).count() == 50
    with pytest.raises(Exception, match="planted"):
        materialize(spark, SPEC, failing(days(spark, 90), "orders_count"), base)
    assert existing(spark, SPEC, base).count() == 50
    assert [f.rsplit("/", 1)[-1] for f in list_files(spark, base)] == ["mart_sales_daily"]  # no rest of the failed write
    after = materialize(spark, SPEC, days(spark, 90), base)
    assert after.count() == 90 and existing(spark, SPEC, base).count() == 90


def test_rebuild_may_read_the_table_it_replaces(spark):
    base = scratch_path(spark, "switch-self")
    old = materialize(spark, SPEC, days(spark, 5), base)
    new = materialize(spark, SPEC, old.unionByName(days(spark, 7)), base)
    assert new.count() == 12


def test_failed_rebuild_in_a_catalog(spark):
    base = scratch_path(spark, "switch-db")
    db = "quitanda_" + base.rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE {db}")
    for spec, df, column in ((SPEC, days(spark, 40), "orders_count"),
                             (MODELS["int_reviews_by_order"], spark.range(30).select(
                                 F.col("id").cast("string").alias("order_id"), F.col("id").alias("review_count")), "review_count")):
        materialize(spark, spec, df, base, database=db)
        with pytest.raises(Exception, match="planted"):
            materialize(spark, spec, failing(df, column), base, database=db)
        assert spark.table(f"{db}.{spec.name}").count() == df.count()
        assert materialize(spark, spec, df.limit(3), base, database=db).count() == 3
        assert [t.name for t in spark.catalog.listTables(db) if t.name.startswith(spec.name)] == [spec.name]


def test_failed_day_leaves_the_old_day(spark):
    base = scratch_path(spark, "switch-day")
    rows = spark.range(20).select(F.col("id").cast("string").alias("order_id"), F.col("id").alias("payment_sequential"),
                                  F.lit("boleto").alias("payment_type"), F.lit(1).cast("long").alias("payment_installments"),
                                  F.lit(1.0).alias("payment_value"))
    for write, read in (
            (lambda df: write_landing(df, base, "order_payments", "2024-03-01"),
             lambda: read_landing(spark, base, "order_payments", "2024-03-01")),
            (lambda df: load_raw(df, f"{base}/raw", "order_payments", "2024-03-01"),
             lambda: read_raw(spark, f"{base}/raw", "order_payments"))):
        write(rows)
        with pytest.raises(Exception, match="planted"):
            write(failing(rows, "payment_sequential"))
        assert read().count() == 20
        write(rows.limit(4))
        assert read().count() == 4
        write(rows.limit(0))
        assert read().count() == 0


@pytest.mark.parametrize("month_of", [None, "day"])
def test_a_lookup_opens_few_files(spark, month_of):
    """20 000 rows in random order in at least eight files: each file is one stretch of the key."""
    path = scratch_path(spark, "ranged")
    rows = spark.range(20_000, numPartitions=8).select(
        F.xxhash64("id").alias("k"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 59).cast("int")).alias("day"))
    key = "day" if month_of else "k"
    write_table(rows, path, (key, "k") if month_of else ("k",), month_of, max_records_per_file=2500)
    write_bounds(spark, path, key)
    bounds = spark.read.parquet(f"{path}/_bounds").orderBy("least").collect()
    assert len(bounds) >= 8
    assert all(a.most <= b.least for a, b in zip(bounds, bounds[1:]))
    one = rows.orderBy("k").limit(777).orderBy(F.desc("k")).first()[key]
    got = read_range(spark, path, key, one, one)
    assert len(files_in_range(spark, path, F.lit(one), F.lit(one))) <= 3
    assert set(got.inputFiles()) <= set(files_in_range(spark, path, F.lit(one), F.lit(one)))
    assert got.count() == rows.where(F.col(key) == F.lit(one)).count() > 0
    far = "1990-01-01" if month_of else -(1 << 63)
    assert read_range(spark, path, key, F.lit(far).cast("date") if month_of else far, F.lit(far).cast("date") if month_of else far).count() == 0


def test_model_path_is_where_readers_look(spark):
    base = scratch_path(spark, "switch-path")
    materialize(spark, SPEC, days(spark, 3), base)
    assert spark.read.parquet(model_path(base, SPEC.name)).count() == 3
