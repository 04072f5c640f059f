"""Numbers the fixture mapping was designed to produce (FIXTURES.md §3), at sf0.01."""

from __future__ import annotations

import pytest

from conftest import SF_ORACLE
from quitanda.plans.models import Warehouse


@pytest.fixture(scope="module")
def wh(spark):
    return Warehouse.from_star(spark, SF_ORACLE)


def test_executive_kpi_anchors(wh):
    k = wh.model("mart_executive_kpi").first()
    assert (k.orders_count, k.customers_count, k.items_count) == (15000, 4499, 60000)
    assert k.revenue == pytest.approx(3183256271.63, abs=1e-6)
    assert k.payment_value == pytest.approx(3758789620.06, abs=1e-6)
    assert (k.delivered_orders_count, k.late_orders_count) == (4933, 1149)
    assert round(k.late_delivery_rate, 6) == 0.232921
    assert k.avg_delivery_days == pytest.approx(15.413542, abs=1e-6)
    assert round(k.avg_review_score, 3) == 3.0


def test_month_and_missing_children_anchors(wh):
    assert wh.model("mart_sales_monthly").count() == 80
    e = wh.model("int_orders_enriched")
    assert e.where("item_count = 0").count() == 257
    assert e.where("payment_count = 0").count() == 366
    assert e.where("review_count = 0").count() == 10000
    late_same_day = e.where("is_late_delivery = 1 AND delivery_delay_days = 0").count()
    assert late_same_day == 167


def test_segment_anchors(wh):
    seg = {r.customer_segment: r["count"] for r in wh.model("mart_customer_rfm").groupBy("customer_segment").count().collect()}
    assert seg == {"champion": 375, "loyal_customer": 303, "at_risk": 2982, "one_time_buyer": 462,
                   "regular_customer": 377}
