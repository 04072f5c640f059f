"""The sliced numbering equals the plain window, however large a key is."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quitanda.operators.numbering import number_within


def plain(df, key, order):
    w = Window.partitionBy(key).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return df.withColumn("n", F.row_number().over(w).cast("bigint"))


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(7)
    rows = [(0, rnd.randint(0, 50), rnd.random()) for _ in range(3000)]          # one hot key
    rows += [(k, rnd.randint(0, 5), rnd.random()) for k in range(1, 200) for _ in range(rnd.randint(1, 6))]
    rows += [(7, 1, 0.5), (7, 1, 0.5)]                                             # identical rows
    rows += [(None, i % 7, float(i)) for i in range(40)] + [(3, None, None)]
    return spark.createDataFrame(rows, "k long, a int, b double")


@pytest.mark.parametrize("slices", [None, 1, 4, 37])
def test_matches_row_number(skewed, slices):
    got = number_within(skewed, "k", ["a", "b"], "n", slices=slices)
    assert sorted(got.collect(), key=str) == sorted(plain(skewed, "k", ["a", "b"]).collect(), key=str)


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_hot_key_with_payload(spark, reuse):
    """Two million rows, a third under one key, a column outside the sort keys."""
    df = spark.range(2_000_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 100_003).alias("k"),
        F.xxhash64("id").alias("a"), F.concat(F.lit("payload "), F.col("id").cast("string")).alias("p"))
    before = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        got = number_within(df, "k", ["a"], "n", slices=16)
        wrong = got.join(plain(df, "k", ["a"]).select("a", F.col("n").alias("m")), "a").where("n <> m").count()
        spans = got.where("k = 0").count()
    finally:
        spark.conf.set("spark.sql.exchange.reuse", before)
    assert wrong == 0 and spans > 600_000


def test_lines_of_a_hot_order_are_spread_over_tasks(spark, tmp_path):
    """An order with a third of all lines: its lines are numbered by many tasks, none holds most of them."""
    from quitanda.sources.star import raw_order_items
    n = 30_000
    lines = spark.range(n, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("l_orderkey"), F.col("id").alias("l_linenumber"),
        *[(F.col("id") % 50).alias(c) for c in ("l_partkey", "l_suppkey")],
        *[F.lit(1.0).alias(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")],
        *[F.lit("N").alias(c) for c in ("l_returnflag", "l_linestatus")],
        F.to_timestamp_ntz(F.lit("1998-01-01 00:00:00")).alias("l_shipdate"))
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "64"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        hot = raw_order_items(spark, str(tmp_path)).where("order_id = '1'")
        assert hot.agg(F.min("order_item_id"), F.max("order_item_id"), F.count_distinct("order_item_id")).first()[:] == (
            1, n // 3 + 1, n // 3 + 1)  # and the line whose own key is 1
        # the hot order lies in about 21 of 64 slices, each numbered on its own
        most = hot.groupBy(F.spark_partition_id().alias("task")).agg(
            F.count("*").alias("n"), F.max("order_item_id").alias("last")).where("last > 0").agg(F.max("n")).first()[0]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert most < 0.3 * n / 3


def test_models_without_the_number_neither_write_nor_sort_lines(spark, monkeypatch):
    import quitanda.sources.star as star
    from quitanda.plans.models import Warehouse
    monkeypatch.setattr(star, "number_within", lambda *a, **k: pytest.fail("lines were numbered"))
    wh = Warehouse.from_star(spark, "/root/testdata/sf0.001")
    for name in ("int_order_items_by_order", "fct_orders", "mart_product_performance", "mart_executive_kpi"):
        plan = wh.model(name)._jdf.queryExecution().optimizedPlan().toString()
        assert "row_number" not in plan
    with pytest.raises(pytest.fail.Exception):
        wh.model("fct_order_items")


def test_lines_of_ordinary_orders_are_not_written(spark, monkeypatch):
    """Only hot keys are sliced: a table without any is numbered in one shuffle."""
    import quitanda.operators.numbering as numbering
    monkeypatch.setattr(numbering, "scratch_path", lambda *a, **k: pytest.fail("lines were written"))
    df = spark.range(3000).select((F.col("id") % 700).alias("k"), F.xxhash64("id").alias("a"))
    got = number_within(df, "k", ["a"], "n", hot_only=True)
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert sorted(got.collect()) == sorted(plain(df, "k", ["a"]).collect())


def test_hot_keys_apart(skewed):
    for slices in (None, 5):
        got = number_within(skewed, "k", ["a", "b"], "n", slices=slices, hot_only=True)
        assert sorted(got.collect(), key=str) == sorted(plain(skewed, "k", ["a", "b"]).collect(), key=str)
