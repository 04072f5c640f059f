"""Intermediate layer: many-side tables pre-aggregated to one row per key.

Aggregating items, payments and reviews to the order grain *before* joining
keeps every later join 1:0..1 (no fan-out) and lets Spark combine partial
aggregates map-side, so a hot order never ships its raw rows through a
shuffle.  The three roll-ups and the order spine are all hash-partitioned on
``order_id``; the joins in ``int_orders_enriched`` reuse that partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quitanda.functions import (any_value, days_between, distinct_list, exact_avg, exact_sum,
                                exact_sum_if, flag, latest_by, month_start)
from quitanda.operators.distinct import aggregate_distinct
from quitanda.operators.joins import left_join_fill_many

PAYMENT_KINDS = ["credit_card", "boleto", "voucher", "debit_card"]


def int_geolocation_zip(stg_geolocation: DataFrame) -> DataFrame:
    zip_col = "geolocation_zip_code_prefix"
    return (stg_geolocation.where(F.col(zip_col).isNotNull())
            .groupBy(zip_col)
            .agg(any_value("geolocation_city").alias("geolocation_city"),
                 any_value("geolocation_state").alias("geolocation_state"),
                 exact_avg("geolocation_lat").alias("avg_latitude"),
                 exact_avg("geolocation_lng").alias("avg_longitude"),
                 F.count(F.lit(1)).alias("geolocation_records")))


def int_order_items_by_order(stg_order_items: DataFrame) -> DataFrame:
    rolled = aggregate_distinct(
        stg_order_items, "order_id",
        {"unique_product_count": "product_id", "unique_seller_count": "seller_id"},
        {"item_count": ("rows", None),
         "order_item_value": ("exact", F.col("price")),
         "order_freight_value": ("exact", F.col("freight_value")),
         "order_total_value": ("exact", F.col("item_total_value")),
         "first_shipping_limit_date": ("min", F.col("shipping_limit_date")),
         "last_shipping_limit_date": ("max", F.col("shipping_limit_date"))}, spread_hot_only=True)
    money = [F.col(c).cast("double").alias(c)
             for c in ("order_item_value", "order_freight_value", "order_total_value")]
    return rolled.select("order_id", "item_count", "unique_product_count", "unique_seller_count", *money,
                         "first_shipping_limit_date", "last_shipping_limit_date")


def int_payments_by_order(stg_order_payments: DataFrame) -> DataFrame:
    t = F.col("payment_type")
    per_kind_value = [exact_sum_if("payment_value", t == k).alias(f"{k}_value")
                      for k in PAYMENT_KINDS]
    per_kind_count = [F.count_if(t == k).alias(f"{k}_payment_count") for k in PAYMENT_KINDS]
    return (stg_order_payments.groupBy("order_id")
            .agg(F.count(F.lit(1)).alias("payment_count"),
                 distinct_list("payment_type", ", ").alias("payment_types"),
                 F.max("payment_installments").alias("max_payment_installments"),
                 exact_sum("payment_value").alias("payment_value"),
                 *per_kind_value, *per_kind_count))


def int_reviews_by_order(stg_order_reviews: DataFrame) -> DataFrame:
    seen_at = F.coalesce(F.col("review_answer_timestamp"),
                         F.col("review_creation_date").cast("timestamp_ntz"))
    latest = latest_by(["review_id", "review_score"], seen_at, "review_id")
    return (stg_order_reviews.groupBy("order_id")
            .agg(F.count(F.lit(1)).alias("review_count"),
                 F.avg("review_score").alias("avg_review_score"),
                 latest.alias("_latest"),
                 F.max("review_creation_date").alias("latest_review_creation_date"),
                 F.max("review_answer_timestamp").alias("latest_review_answer_timestamp"),
                 F.max("has_review_comment").alias("has_review_comment"))
            .select("order_id", "review_count", "avg_review_score",
                    F.col("_latest.review_id").alias("latest_review_id"),
                    F.col("_latest.review_score").alias("latest_review_score"),
                    "latest_review_creation_date", "latest_review_answer_timestamp",
                    "has_review_comment"))


def int_orders_enriched(stg_orders: DataFrame, items_by_order: DataFrame,
                        payments_by_order: DataFrame, reviews_by_order: DataFrame,
                        more: tuple[str, ...] = ()) -> DataFrame:
    """Orders ⟕ the three roll-ups; ``more`` names further columns of the orders to keep."""
    delivered, estimated = F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")
    purchase = F.col("order_purchase_timestamp")
    spine = stg_orders.select(
        "order_id", "customer_id", "order_status", "order_purchase_timestamp",
        "order_purchase_date",
        month_start("order_purchase_date").alias("order_purchase_month"),
        "order_approved_at", "order_approved_date", "order_delivered_carrier_date",
        "order_delivered_carrier_date_day", "order_delivered_customer_date",
        "order_delivered_customer_date_day", "order_estimated_delivery_date",
        "order_estimated_delivery_date_day", "is_delivered", "is_canceled", "is_unavailable",
        F.when(delivered.isNotNull(), days_between(purchase, delivered)).alias("actual_delivery_days"),
        F.when(estimated.isNotNull(), days_between(purchase, estimated)).alias("estimated_delivery_days"),
        F.when(delivered.isNotNull() & estimated.isNotNull(), days_between(estimated, delivered))
         .alias("delivery_delay_days"),
        # a timestamp later on the estimated *day* is late (the date means midnight)
        flag(delivered.isNotNull() & estimated.isNotNull() & (delivered > estimated))
         .alias("is_late_delivery"),
        *more,
    )
    zero_bigint, zero_money = F.lit(0).cast("bigint"), F.lit(0.0)
    return left_join_fill_many(spine, "order_id", [
        (items_by_order, {
            "item_count": zero_bigint, "unique_product_count": zero_bigint,
            "unique_seller_count": zero_bigint, "order_item_value": zero_money,
            "order_freight_value": zero_money, "order_total_value": zero_money}),
        (payments_by_order, {
            "payment_count": zero_bigint, "payment_types": F.lit("unknown"),
            "max_payment_installments": zero_bigint, "payment_value": zero_money,
            "credit_card_value": zero_money, "boleto_value": zero_money,
            "voucher_value": zero_money, "debit_card_value": zero_money}),
        (reviews_by_order, {
            "review_count": zero_bigint, "avg_review_score": None, "latest_review_id": None,
            "latest_review_score": None, "latest_review_creation_date": None,
            "latest_review_answer_timestamp": None, "has_review_comment": F.lit(0)}),
    ])
