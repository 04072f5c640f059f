"""Distinct counts with measures: equal to one plain aggregate, combined behind the shuffle only."""

from __future__ import annotations

import random

from conftest import SF_SMALL
from pyspark.sql import functions as F

from quitanda.operators.distinct import aggregate_distinct
from quitanda.plans.models import Warehouse


def test_equals_count_distinct(spark):
    rnd = random.Random(11)
    rows = [(rnd.choice(["hot", "hot", "a", "b", None, str(rnd.randint(0, 99))]), rnd.choice([None, "p", "q", "r", ""]),
             rnd.choice([None, "s", str(rnd.randint(0, 30))]), rnd.choice([None, 0.1, 2.5, -3.0, 1e9]), rnd.randint(0, 9))
            for _ in range(2000)]
    rows += [("none", None, None, None, 1), ("none", None, None, None, 1)]
    df = spark.createDataFrame(rows, "k string, a string, b string, x double, n long")
    got = aggregate_distinct(df, "k", {"as": "a", "bs": "b"}, {
        "rows": ("rows", None), "xs": ("count", F.col("x")), "x": ("exact", F.col("x")), "n": ("sum", F.col("n")),
        "least": ("min", F.col("x")), "most": ("max", F.col("x"))})
    plain = df.groupBy("k").agg(
        F.count_distinct("a").alias("as"), F.count_distinct("b").alias("bs"), F.count("*").alias("rows"),
        F.count("x").alias("xs"), F.sum(F.col("x").cast("decimal(38,18)")).alias("x"), F.sum("n").alias("n"),
        F.min("x").alias("least"), F.max("x").alias("most"))
    assert got.columns == plain.columns
    assert sorted(got.collect(), key=str) == sorted(plain.collect(), key=str)
    assert aggregate_distinct(df.limit(0), "k", {"as": "a"}).count() == 0


def test_rows_are_combined_behind_the_shuffle(spark):
    """The copies of a row go straight into a shuffle; no aggregate runs in the tasks that read them."""
    wh = Warehouse.from_star(spark, SF_SMALL)
    for name in ("int_order_items_by_order", "int_orders_enriched", "fct_orders", "mart_product_performance",
                 "mart_seller_performance"):
        lines = wh.model(name)._jdf.queryExecution().executedPlan().toString().splitlines()
        expand = max(i for i, line in enumerate(lines) if "Expand" in line)
        above = next(line for line in reversed(lines[:expand]) if "Exchange" in line or "Aggregate" in line)
        assert "REPARTITION_BY_COL" in above, (name, above)


def test_spread_of_hot_keys_only(spark):
    """Without a hot key there is one shuffle; with one, entries are spread by value as ever. Rows are the same."""
    for keys, exchanges in ((400, 1), (2, 2)):
        df = spark.range(2000).select((F.col("id") % keys).cast("string").alias("k"), (F.col("id") % 7).cast("string").alias("a"),
                                      F.when(F.col("id") % 3 > 0, F.col("id").cast("double")).alias("x"))
        df = df.unionByName(df.limit(5).withColumn("k", F.lit(None).cast("string")))
        measures = {"rows": ("rows", None), "x": ("exact", F.col("x")), "least": ("min", F.col("x"))}
        got = aggregate_distinct(df, "k", {"as": "a"}, measures, spread_hot_only=True)
        assert sorted(got.collect(), key=str) == sorted(aggregate_distinct(df, "k", {"as": "a"}, measures).collect(), key=str)
        plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert plan.count("Exchange hashpartitioning(k") == exchanges, plan
