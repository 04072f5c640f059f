"""The item stream carries codes of the dimensions' texts, and the order fact is dealt by order_id."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

import quitanda.operators.joins as joins
from quitanda.operators.joins import coded_attributes
from quitanda.plans import core
from quitanda.plans.intermediate import int_orders_enriched
from quitanda.plans.models import Warehouse
from test_semantics import make_wh, order


def rows(df):
    return sorted(map(str, df.collect()))


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("most", [0, 3, 10_000])
def test_coded_attributes_equal_a_plain_join(spark, monkeypatch, most):
    monkeypatch.setattr(joins, "CODED_COMBINATIONS", most)
    dim = spark.createDataFrame([("a", "x", None), ("a", "x", None), ("a", None, "x"), ("b", None, None), (None, "n", "n"),
                                 ("c", "x", None), ("d", "", "y")], "k string, t string, u string")
    left = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), (None, 3), ("missing", 4), ("d", 5)], "k string, n long")
    narrow, decode = coded_attributes(dim, "k", ["t", "u"], "_c")
    got = decode(left.join(narrow, "k", "left")).select("k", "n", "t", "u")
    assert rows(got) == rows(left.join(dim, "k", "left").select("k", "n", "t", "u"))
    assert ("t" in narrow.columns) == (most < 5)


def test_item_stream_carries_no_dimension_texts(spark):
    wh = Warehouse.from_star(spark, SF_SMALL)
    for name in ("fct_order_items", "mart_dashboard_sales_detail"):
        p = plan_of(wh.model(name))
        assert "s_nationkey" not in p and "p_type" not in p, name


def test_order_fact_is_not_shuffled_again_for_customers(spark):
    conf, old = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set(conf, "-1")
        lines = plan_of(Warehouse.from_star(spark, SF_SMALL).model("fct_orders")).splitlines()
    finally:
        spark.conf.set(conf, old)
    # the joins on order_id come last: the join of the customers is the innermost one of the orders' own
    on = [line.split("SortMergeJoin [")[1].split("#")[0] for line in lines if "SortMergeJoin [" in line]
    assert on[:4] == ["order_id"] * 3 + ["customer_id"]


CUSTOMERS = [("c1", "u1", 1, "x", "sp"), ("c1", "u1b", 2, "y", None), ("c2", "u2", 1, "x", "sp"), (None, "u0", 1, "x", "rj")]
ORDERS = [order("1"), order("1"), order("2", customer="c2"), order("3", customer="none"), ("4", None, *order("4")[2:])]
SIZES = (1, 1.0, 1, 9000.0, 1.0, 1.0, 1.0)


def items(n: int):
    at = dt.datetime(2020, 1, 1)
    return ([("1", i, f"p{i % 3}", f"s{i % 2}", at, float(i), 1.0) for i in range(n)]
            + [(str(100 + i), 1, "p1", "s0", at, 1.0, 1.0) for i in range(40)]
            + [("2", 1, "p9", None, at, 2.0, None), (None, 1, None, "s1", at, 3.0, 1.0), ("9", 1, "p1", "s1", at, 4.0, 1.0)])


def test_fct_orders_from_rollups_equals_the_enriched_way(spark):
    wh = make_wh(spark, orders=ORDERS, customers=CUSTOMERS, order_items=items(4))
    parts = [wh.model(n) for n in ("int_order_items_by_order", "int_payments_by_order", "int_reviews_by_order")]
    enriched = int_orders_enriched(wh.model("stg_orders"), *parts)
    assert rows(wh.model("fct_orders")) == rows(core.fct_orders(enriched, wh.model("dim_customers")))


@pytest.mark.parametrize("n", [3, 400])
def test_items_with_context_with_and_without_a_hot_order(spark, n):
    wh = make_wh(spark, orders=ORDERS, customers=CUSTOMERS, order_items=items(n),
                 products=[("p0", "a", *SIZES), ("p1", None, *SIZES[:3], None, *SIZES[4:]), ("p1", "b", *SIZES)],
                 sellers=[("s0", 1, "x", "sp"), ("s1", 2, None, None)])
    lines, o, p, s = (wh.model(x) for x in ("stg_order_items", "fct_orders", "dim_products", "dim_sellers"))
    plain = (lines.join(o.select("order_id", *core.ITEM_ORDER_ATTRS), "order_id", "left")
             .join(p.select("product_id", "product_category_name", "product_category_name_english",
                            "product_weight_class"), "product_id", "left")
             .join(s.select("seller_id", "seller_city", "seller_state", "seller_region"), "seller_id", "left"))
    got = core.fct_order_items(lines, o, p, s)
    assert rows(got) == rows(plain.select(*core.FCT_ORDER_ITEMS_COLUMNS))
    # with a hot order both sides are shuffled for the join, so that it can be cut apart
    assert ("concat(order_id" in plan_of(got)) == (n == 400)


TEXTS = {"product_category_name", "product_category_name_english", "product_weight_class", "seller_city", "seller_state",
         "seller_region", "customer_city", "customer_state", "customer_region"}


@pytest.mark.parametrize("most", [0, 10_000])
def test_streams_write_the_rows_of_the_models(spark, monkeypatch, most):
    """Written from narrow streams, the item tables hold the models' own rows, sorted within their files."""
    from quitanda.operators.quality import Declarations
    from quitanda.plans import analytics
    from quitanda.plans.pipeline import run_pipeline
    from quitanda.session import SHUFFLE_CLEANUP, scratch_path
    import quitanda.plans.pipeline as pipeline
    monkeypatch.setattr(joins, "CODED_COMBINATIONS", most)
    written, cleanup, real = {}, set(), pipeline.materialize

    def seen(spark, spec, df, *rest):
        written[spec.name] = rest[-1]
        cleanup.add(spark.conf.get(SHUFFLE_CLEANUP))
        return real(spark, spec, df, *rest)
    monkeypatch.setattr(pipeline, "materialize", seen)
    before = spark.conf.get(SHUFFLE_CLEANUP)
    wh = make_wh(spark, orders=ORDERS, customers=CUSTOMERS, order_items=items(30),
                 products=[("p0", "a", *SIZES), ("p1", None, *SIZES), ("p1", "b", *SIZES)],
                 sellers=[("s0", 1, "x", "sp"), ("s1", 2, None, None)])
    tables = run_pipeline(spark, wh, scratch_path(spark, "streams"), gate=False, suite=Declarations({})).tables
    assert cleanup == {"true"} and spark.conf.get(SHUFFLE_CLEANUP) == before
    for name in ("fct_order_items", "mart_dashboard_sales_detail"):
        assert TEXTS.isdisjoint(written[name].rows.columns) == (most > 0), name
    got = tables["fct_order_items"]
    assert rows(got) == rows(core.fct_order_items(tables["stg_order_items"], tables["fct_orders"], tables["dim_products"],
                                                  tables["dim_sellers"]))
    dashboard = analytics.mart_dashboard_sales_detail(got, tables["fct_orders"])
    assert tables["mart_dashboard_sales_detail"].columns == dashboard.columns
    assert rows(tables["mart_dashboard_sales_detail"]) == rows(dashboard)
