"""Negative fixtures: each data-quality check reports what it must and passes the rest."""

from __future__ import annotations

import pytest

from quitanda.operators import quality as dq
from quitanda.operators.quality import Check, Declarations
from quitanda.plans.pipeline import QualityGateError, run_pipeline
from quitanda.session import scratch_path
from test_semantics import make_wh, order


def test_not_null(spark):
    df = spark.createDataFrame([("a",), ("",), (None,)], "k string")
    assert [r.k for r in dq.not_null_violations(df, "k").collect()] == [None]


def test_unique_ignores_repeated_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    rows = dq.unique_violations(df, "k").collect()
    assert [(r.unique_field, r.n_records) for r in rows] == [("a", 2)]


def test_accepted_values_passes_null(spark):
    df = spark.createDataFrame([("delivered", 1), ("lost", 6), (None, None)], "s string, score long")
    assert [r.value_field for r in dq.accepted_values_violations(df, "s", ["delivered"]).collect()] == ["lost"]
    bad_scores = dq.accepted_values_violations(df, "score", [1, 2, 3, 4, 5]).collect()
    assert [r.value_field for r in bad_scores] == [6]


def test_relationships_skips_null_child_keys(spark):
    child = spark.createDataFrame([("1",), ("2",), (None,)], "k string")
    parent = spark.createDataFrame([("1",)], "pk string")
    assert [r.from_field for r in dq.relationships_violations(child, "k", parent, "pk").collect()] == ["2"]


def test_non_negative(spark):
    df = spark.createDataFrame([(-0.01,), (None,), (0.0,), (-0.0,), (3.0,)], "v double")
    assert [r.v for r in dq.non_negative_violations(df, "v").collect()] == [-0.01]


def test_unique_combination_counts_null_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), ("b", None), ("b", 2)], "k string, n long")
    rows = sorted((r.k, r.n, r.row_count) for r in dq.unique_combination_violations(df, ["k", "n"]).collect())
    assert rows == [("a", 1, 2), ("b", None, 2)]


def test_check_model_single_pass_counts(spark):
    df = spark.createDataFrame([("a", -1.0, "x"), ("a", None, "y"), (None, 2.0, "x")], "k string, v double, s string")
    checks = [Check("not_null", "k"), Check("non_negative", "v"), Check("accepted_values", "s", ("x",)),
              Check("unique", "k"), Check("unique_combination", ("k", "s"))]
    got = {(r.test_name, r.column_name): r.violations
           for r in dq.check_model("m", df, checks, lambda _: None).collect()}
    assert got == {("not_null", "k"): 1, ("non_negative", "v"): 1, ("accepted_values", "s"): 1,
                   ("unique", "k"): 1, ("unique_combination", "k,s"): 0}


def test_check_model_equals_single_checks(spark):
    """All kinds at once report what each ``*_violations`` function reports alone, from one scan and one shuffle."""
    import random
    rng = random.Random(4)
    pick = lambda *v: rng.choice((None, *v))
    rows = [(pick("a", "b", "", "c,d"), pick(1, 2, 30), pick(-1.5, -0.0, 0.0, 2.0), pick(7, 8)) for _ in range(60)]
    schema = "k string, n long, v double, p long"
    df = spark.createDataFrame(rows, schema)
    parents = {"one": spark.createDataFrame([("a",), ("a",), (None,), ("zz",)], "pk string"),
               "two": spark.createDataFrame([(7,), (9,)], "pk int")}
    checks = [Check("not_null", "k"), Check("not_null", "v"), Check("non_negative", "v"), Check("unique", "k"),
              Check("unique", "n"), Check("accepted_values", "n", (1, 2)), Check("accepted_values", "k", ("a", "")),
              Check("relationships", "k", to="one", field="pk"), Check("relationships", "p", to="two", field="pk"),
              Check("unique_combination", ("k", "n")), Check("unique_combination", ("n", "v", "p"))]

    def alone(c, table):
        if c.kind == "relationships":
            return dq.relationships_violations(table, c.column, parents[c.to], c.field)
        extra = [c.values] if c.kind == "accepted_values" else []
        return getattr(dq, f"{c.kind}_violations")(table, c.column, *extra)

    got = dq.check_model("m", df, checks, parents.get)
    assert [(r.test_name, r.column_name, r.violations) for r in got.collect()] == [
        (c.kind, c.column_label, alone(c, df).count()) for c in checks]
    none = dq.check_model("m", df.where("false"), checks, parents.get).collect()
    assert len(none) == len(checks) and {r.violations for r in none} == {0}
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_pipeline_gate_stops_on_violation(spark):
    # order 2 has an unknown status: the staging accepted_values test fails
    wh = make_wh(spark, orders=[order("1"), order("2", status="lost")],
                 customers=[("c1", "u", 1, "x", "sp"), ("c2", "u", 1, "x", "sp")])
    with pytest.raises(QualityGateError) as err:
        run_pipeline(spark, wh, scratch_path(spark, "gate-test"))
    assert err.value.layer == "staging"
    assert any(f["column_name"] == "order_status" for f in err.value.failures)


def test_pipeline_builds_all_layers_when_clean(spark):
    wh = make_wh(spark, orders=[order("1")], customers=[("c1", "u", 1, "x", "sp")])
    suite = Declarations({"stg_orders": [Check("unique", "order_id")],
                          "fct_orders": [Check("not_null", "customer_unique_id")]})
    res = run_pipeline(spark, wh, scratch_path(spark, "gate-ok"), suite=suite)
    assert res.layers_done == ["staging", "intermediate", "core", "analytics"]
    assert {r.violations for r in res.test_results.collect()} == {0}
    assert res.tables["mart_executive_kpi"].first().orders_count == 1


def test_gate_stops_in_layer_children(spark):
    # NULL prices make the item roll-up's value NULL; int_orders_enriched (same
    # layer, next wave) must not be written
    import datetime as dt
    from quitanda.sources.files import list_files
    wh = make_wh(spark, orders=[order("1")], customers=[("c1", "u", 1, "x", "sp")],
                 order_items=[("1", 1, "p", "s", dt.datetime(2020, 1, 1), None, 1.0)])
    suite = Declarations({"int_order_items_by_order": [Check("not_null", "order_item_value")]})
    base = scratch_path(spark, "gate-wave")
    with pytest.raises(QualityGateError) as err:
        run_pipeline(spark, wh, base, suite=suite)
    assert err.value.layer == "intermediate"
    written = {p.rstrip("/").rsplit("/", 1)[-1] for p in list_files(spark, base)}
    assert "int_order_items_by_order" in written and "int_orders_enriched" not in written


def test_gate_blocks_only_descendants(spark):
    """A failed roll-up blocks what reads it; other models of its layer are still written."""
    import datetime as dt
    from quitanda.sources.files import list_files
    wh = make_wh(spark, orders=[order("1")], customers=[("c1", "u", 1, "x", "sp")],
                 order_items=[("1", 1, "p", "s", dt.datetime(2020, 1, 1), 1.0, 1.0)])
    suite = Declarations({"dim_customers": [Check("accepted_values", "customer_id", ("nobody",))]})
    base = scratch_path(spark, "gate-branch")
    with pytest.raises(QualityGateError) as err:
        run_pipeline(spark, wh, base, suite=suite)
    assert err.value.layer == "core"
    written = {p.rstrip("/").rsplit("/", 1)[-1] for p in list_files(spark, base)}
    assert {"dim_products", "dim_sellers", "dim_date"} <= written
    assert not {"fct_orders", "fct_order_items", "mart_executive_kpi"} & written


def test_one_layer_on_written_tables(spark):
    from quitanda.plans.models import LAYERS, Warehouse
    sf = "/root/testdata/sf0.001"
    base = scratch_path(spark, "layers")
    run_pipeline(spark, Warehouse.from_star(spark, sf), base, layers=LAYERS[:3], gate=False)
    unread = Warehouse(spark, {})  # no raw table at all: the marts come from the written facts
    res = run_pipeline(spark, unread, base, layers=["analytics"], gate=False)
    assert res.test_results.count() == 240
    whole = Warehouse.from_star(spark, sf)
    for mart in ("mart_executive_kpi", "mart_dashboard_sales_detail", "mart_seller_performance"):
        assert sorted(map(str, res.tables[mart].collect())) == sorted(map(str, whole.model(mart).collect()))


def test_item_mart_plans_from_tables(spark):
    """Few exchanges and no sort-based aggregate in the item marts over written tables."""
    from quitanda.plans.models import LAYERS, Warehouse
    base = scratch_path(spark, "marts")
    wh = Warehouse.from_star(spark, "/root/testdata/sf0.001")
    run_pipeline(spark, wh, base, layers=LAYERS[:3], gate=False, suite=Declarations({}))
    for mart in ("mart_product_performance", "mart_seller_performance"):
        plan = wh.model(mart)._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and plan.count("Exchange hashpartitioning") <= 6
    plan = wh.model("mart_dashboard_sales_detail")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join") == 1


def test_database_build_and_single_model(spark, capsys):
    from quitanda.__main__ import main
    from quitanda.plans.materialize import database_for
    base = scratch_path(spark, "dbcli")
    sf = "/root/testdata/sf0.001"
    assert main(["star", "--sf-dir", sf, "--raw-root", f"{base}/raw"]) == 0
    common = ["--raw-root", f"{base}/raw", "--out", f"{base}/out", "--env", "dev"]
    assert main(["build", *common, "--no-gate"]) == 0
    db = database_for("dev")
    assert spark.table(f"{db}.mart_executive_kpi").first().orders_count == 1500
    bucketed = spark.sql(f"DESCRIBE EXTENDED {db}.int_payments_by_order").where("col_name = 'Bucket Columns'").first()
    assert "order_id" in bucketed.data_type
    spark.sql(f"DROP TABLE {db}.mart_executive_kpi")
    assert main(["model", "mart_executive_kpi", *common]) == 0
    assert spark.table(f"{db}.mart_executive_kpi").count() == 1
    capsys.readouterr()
    assert main(["test", "mart_executive_kpi", "fct_orders", *common]) == 0
    assert "failed_tests" in capsys.readouterr().out
    for table in spark.catalog.listTables(db):
        spark.sql(f"DROP TABLE {db}.{table.name}") if not table.isTemporary else None
