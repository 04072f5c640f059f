"""Plan shape: pruning, pushdown, no Python in the hot path, partition pruning."""

from __future__ import annotations

from conftest import SF_SMALL
from quitanda.plans.materialize import MONTH_COLUMN, month_slice, write_table
from quitanda.plans.models import MODELS, Warehouse
from quitanda.session import scratch_path


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udfs_in_any_model(spark):
    wh = Warehouse.from_star(spark, SF_SMALL)
    for name in MODELS:
        p = plan_of(wh.model(name))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_scans_read_only_needed_columns(spark):
    df = Warehouse.from_star(spark, SF_SMALL).model("mart_review_performance")
    p = plan_of(df)
    # reviews come from the events table: only these three columns are read
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string>" in p or \
           "struct<event_id:bigint,ts:timestamp_ntz>" in p


def test_unused_item_number_is_pruned(spark):
    p = plan_of(Warehouse.from_star(spark, SF_SMALL).model("int_order_items_by_order"))
    assert "Window" not in p and "l_linenumber" not in p


def test_month_partitions_prune(spark):
    path = scratch_path(spark, "prune") + "/fct_orders"
    spec = MODELS["fct_orders"]
    write_table(Warehouse.from_star(spark, SF_SMALL).model("fct_orders"), path, spec.sort_by,
                spec.partition_month_of)
    one = month_slice(spark, path, 199601)
    p = plan_of(one)
    assert "PartitionFilters: [isnotnull(yyyymm" in p and "= 199601" in p
    assert one.where(f"{MONTH_COLUMN} != 199601").count() == 0
    assert one.count() > 0


def test_hot_month_is_cut_into_sorted_files(spark):
    """Rebalanced write: a hot month gives several files, each a slice of the sort key."""
    from pyspark.sql import functions as F
    path = scratch_path(spark, "hot-month") + "/t"
    rows = spark.range(400_000).select(
        F.when(F.col("id") % 10 < 9, F.lit("2024-05-03")).otherwise(F.lit("2024-07-09")).cast("date").alias("day"),
        F.xxhash64("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
    keys = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize")
    try:
        spark.conf.set(keys[0], "4m")
        write_table(rows, path, ("k",), "day")
    finally:
        spark.conf.unset(keys[0])
    files = spark.read.parquet(path).groupBy(MONTH_COLUMN, F.input_file_name().alias("f")).agg(F.count("*").alias("n"))
    per_month = {r[MONTH_COLUMN]: r["count"] for r in files.groupBy(MONTH_COLUMN).count().collect()}
    assert per_month[202405] > 1 and per_month[202407] <= per_month[202405]
    one = spark.read.parquet(files.where(f"{MONTH_COLUMN} = 202405").first().f)
    got = [r.k for r in one.select("k").collect()]
    assert got == sorted(got)


def test_item_stream_stays_narrow(spark):
    """What a line's own columns give is computed behind the joins, not sent through their shuffles."""
    wh = Warehouse.from_star(spark, SF_SMALL)
    for name in ("fct_order_items", "mart_dashboard_sales_detail"):
        lines = plan_of(wh.model(name)).splitlines()
        joins = [i for i, line in enumerate(lines) if "Join" in line]
        assert any("item_total_value" in line for line in lines[:joins[0]]), name
        assert not any("item_total_value" in line or "item_revenue" in line for line in lines[joins[0]:]
                       if "Project" in line), name


def test_distinct_counts_of_lines_are_not_numbered(spark, monkeypatch):
    import pytest
    import quitanda.sources.star as star
    from quitanda.catalog import QUERIES
    monkeypatch.setattr(star, "number_within", lambda *a, **k: pytest.fail("lines were numbered"))
    assert QUERIES["agg_count_distinct"](spark, SF_SMALL).count() > 0
