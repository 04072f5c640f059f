"""Hand-written rows for the semantic corner cases of the models."""

from __future__ import annotations

import datetime as dt

import pytest

from quitanda.plans.models import Warehouse
from quitanda.schemas import RAW_SCHEMAS

D, TS = dt.date, dt.datetime


def make_wh(spark, **rows) -> Warehouse:
    raw = {}
    for table, schema in RAW_SCHEMAS.items():
        df = spark.createDataFrame(rows.get(table, []), schema)
        raw[table] = (lambda df=df: df)
    return Warehouse(spark, raw)


def order(oid, status="delivered", purchase=TS(2020, 1, 10, 12, 0), delivered=None,
          estimated=D(2020, 1, 20), customer=None):
    return (oid, customer or f"c{oid}", status, purchase, None, None, delivered, estimated)


def review(rid, oid, score, created, answered=None, msg=None):
    return (rid, oid, score, None, msg, created, answered)


def test_status_is_normalised_before_flags(spark):
    wh = make_wh(spark, orders=[order("1", status=" Delivered ")])
    r = wh.model("stg_orders").first()
    assert (r.order_status, r.is_delivered, r.is_canceled) == ("delivered", 1, 0)


def test_latest_review_tie_breaks_on_review_id(spark):
    t = TS(2020, 2, 1, 8, 0)
    wh = make_wh(spark, order_reviews=[review("r1", "1", 5, D(2020, 1, 30), t),
                                       review("r2", "1", 2, D(2020, 1, 29), t)])
    r = wh.model("int_reviews_by_order").first()
    assert (r.latest_review_id, r.latest_review_score, r.review_count) == ("r2", 2, 2)


def test_latest_review_falls_back_to_creation_day(spark):
    wh = make_wh(spark, order_reviews=[review("r1", "1", 5, D(2020, 1, 30)),
                                       review("r2", "1", 2, D(2020, 1, 29))])
    r = wh.model("int_reviews_by_order").first()
    assert (r.latest_review_id, r.latest_review_score) == ("r1", 5)
    assert r.latest_review_answer_timestamp is None


def test_order_without_children_gets_defaults(spark):
    wh = make_wh(spark, orders=[order("1")])
    r = wh.model("int_orders_enriched").first()
    assert (r.item_count, r.order_item_value, r.payment_count, r.payment_types) == (0, 0.0, 0, "unknown")
    assert (r.review_count, r.avg_review_score, r.has_review_comment) == (0, None, 0)
    assert r.latest_review_score is None


def test_delivery_later_on_estimated_day_is_late_with_zero_delay(spark):
    wh = make_wh(spark, orders=[order("1", delivered=TS(2020, 1, 20, 15, 0), estimated=D(2020, 1, 20))])
    r = wh.model("int_orders_enriched").first()
    assert (r.is_late_delivery, r.delivery_delay_days) == (1, 0)


def test_day_difference_counts_calendar_boundaries(spark):
    wh = make_wh(spark, orders=[order("1", purchase=TS(2020, 1, 10, 23, 59), delivered=TS(2020, 1, 11, 0, 1))])
    r = wh.model("int_orders_enriched").first()
    assert r.actual_delivery_days == 1


def test_sum_if_without_match_is_zero(spark):
    wh = make_wh(spark, order_payments=[("1", 1, "credit_card", 1, 10.5), ("1", 2, " Boleto ", 2, 4.25)])
    r = wh.model("int_payments_by_order").first()
    assert (r.credit_card_value, r.boleto_value, r.voucher_value) == (10.5, 4.25, 0.0)
    assert (r.payment_types, r.boleto_payment_count, r.voucher_payment_count) == ("boleto, credit_card", 1, 0)


def test_exact_sums_are_exact(spark):
    items = [("1", i, "p", "s", TS(2020, 1, 1), 0.1, 0.2) for i in range(1, 11)]
    wh = make_wh(spark, order_items=items)
    r = wh.model("int_order_items_by_order").first()
    # an item's total is the double 0.1 + 0.2 = 0.30000000000000004; ten of them add up without further error
    assert (r.order_item_value, r.order_freight_value, r.order_total_value) == (1.0, 2.0, 3.0000000000000004)


def test_rate_is_null_without_delivered_orders(spark):
    wh = make_wh(spark, orders=[order("1", status="shipped"), order("2", status="canceled")])
    r = wh.model("mart_sales_monthly").first()
    assert (r.orders_count, r.delivered_orders_count, r.late_delivery_rate, r.delivery_rate) == (2, 0, None, 0.0)


def test_empty_orders_give_one_kpi_row_and_fallback_date_spine(spark):
    wh = make_wh(spark)
    kpi = wh.model("mart_executive_kpi").collect()
    assert len(kpi) == 1 and kpi[0].orders_count == 0 and kpi[0].delivery_rate is None
    assert kpi[0].kpi_grain == "overall"
    days = wh.model("dim_date").collect()
    assert [d.date_day for d in days] == [D(2016, 1, 1)]


def test_date_spine_covers_review_days_and_weekdays(spark):
    wh = make_wh(spark, orders=[order("1", purchase=TS(2020, 1, 4, 10, 0), estimated=D(2020, 1, 5))],
                 order_reviews=[review("r", "1", 4, D(2020, 1, 7))])
    days = {d.date_day: d for d in wh.model("dim_date").collect()}
    assert sorted(days) == [D(2020, 1, 4), D(2020, 1, 5), D(2020, 1, 6), D(2020, 1, 7)]
    sun = days[D(2020, 1, 5)]
    assert (sun.day_of_week, sun.is_weekend, sun.day_name, sun.iso_week) == (7, 1, "Sunday", 1)
    assert days[D(2020, 1, 6)].day_of_week == 1


def test_rfm_segments_follow_rule_order(spark):
    base = TS(2020, 6, 1, 9, 0)
    orders = [order(f"a{i}", purchase=base, customer=f"ca{i}") for i in range(5)]
    customers = [(f"ca{i}", "A", 1, "x", "sp") for i in range(5)]
    items = [(f"a{i}", 1, "p", "s", base, 300.0, 1.0) for i in range(5)]
    orders.append(order("b", purchase=TS(2019, 1, 1, 9, 0), customer="cb"))
    customers.append(("cb", "B", 1, "x", "sp"))
    orders.append(order("c", purchase=TS(2020, 5, 1, 9, 0), customer="cc"))
    customers.append(("cc", "C", 1, "x", "sp"))
    wh = make_wh(spark, orders=orders, customers=customers, order_items=items)
    seg = {r.customer_unique_id: r.customer_segment for r in wh.model("mart_customer_rfm").collect()}
    assert seg == {"A": "champion", "B": "at_risk", "C": "one_time_buyer"}


@pytest.mark.parametrize("state,region", [("SP", "southeast"), ("RS", "south"), ("BA", "northeast"),
                                          ("DF", "center_west"), ("AM", "north"), ("ZZ", "unknown")])
def test_region_rule(spark, state, region):
    wh = make_wh(spark, customers=[("c1", "u1", 1, "x", f" {state.lower()} ")])
    assert wh.model("dim_customers").first().customer_region == region
