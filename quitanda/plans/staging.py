"""Staging layer: one cleaned view per raw table (projection only, no shuffle)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quitanda.functions import blank_to_null, flag, has_text, norm_lower, norm_upper


def stg_customers(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id", "customer_unique_id", "customer_zip_code_prefix",
        norm_lower("customer_city").alias("customer_city"),
        norm_upper("customer_state").alias("customer_state"),
    )


def stg_geolocation(geolocation: DataFrame) -> DataFrame:
    return geolocation.select(
        "geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng",
        norm_lower("geolocation_city").alias("geolocation_city"),
        norm_upper("geolocation_state").alias("geolocation_state"),
    )


def stg_orders(orders: DataFrame) -> DataFrame:
    # Normalise the status first: the flags test the cleaned value, so
    # ' Delivered ' counts as delivered.
    clean = orders.select(
        "order_id", "customer_id",
        norm_lower("order_status").alias("order_status"),
        "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
        "order_delivered_customer_date", "order_estimated_delivery_date",
    )
    status = F.col("order_status")
    return clean.select(
        "order_id", "customer_id", "order_status",
        "order_purchase_timestamp",
        F.to_date("order_purchase_timestamp").alias("order_purchase_date"),
        "order_approved_at",
        F.to_date("order_approved_at").alias("order_approved_date"),
        "order_delivered_carrier_date",
        F.to_date("order_delivered_carrier_date").alias("order_delivered_carrier_date_day"),
        "order_delivered_customer_date",
        F.to_date("order_delivered_customer_date").alias("order_delivered_customer_date_day"),
        "order_estimated_delivery_date",
        F.to_date("order_estimated_delivery_date").alias("order_estimated_delivery_date_day"),
        flag(status == "delivered").alias("is_delivered"),
        flag(status == "canceled").alias("is_canceled"),
        flag(status == "unavailable").alias("is_unavailable"),
    )


# Columns of an item line that no other of its columns gives.
ITEM_COLUMNS = ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value"]


def stg_order_items(order_items: DataFrame) -> DataFrame:
    return order_items.select(
        "order_id", "order_item_id", "product_id", "seller_id",
        "shipping_limit_date", *item_values()[:1], "price", "freight_value", *item_values()[1:],
    )


def item_values() -> list[Column]:
    """What is computed from ``ITEM_COLUMNS``."""
    return [
        F.to_date("shipping_limit_date").alias("shipping_limit_date_day"),
        F.lit(1).cast("decimal(18,0)").alias("item_quantity"),
        F.col("price").alias("item_revenue"),
        (F.col("price") + F.col("freight_value")).alias("item_total_value"),
    ]


def stg_order_payments(order_payments: DataFrame) -> DataFrame:
    return order_payments.select(
        "order_id", "payment_sequential",
        norm_lower("payment_type").alias("payment_type"),
        "payment_installments", "payment_value",
    )


def stg_order_reviews(order_reviews: DataFrame) -> DataFrame:
    return order_reviews.select(
        "review_id", "order_id", "review_score",
        blank_to_null("review_comment_title").alias("review_comment_title"),
        blank_to_null("review_comment_message").alias("review_comment_message"),
        "review_creation_date",
        F.to_date("review_creation_date").alias("review_creation_date_day"),
        "review_answer_timestamp",
        F.to_date("review_answer_timestamp").alias("review_answer_date_day"),
        has_text("review_comment_message").alias("has_review_comment"),
    )


def stg_products(products: DataFrame) -> DataFrame:
    return products.select(
        "product_id",
        F.nullif(norm_lower(F.coalesce(F.col("product_category_name"), F.lit(""))), F.lit(""))
         .alias("product_category_name"),
        F.col("product_name_lenght").alias("product_name_length"),
        F.col("product_description_lenght").alias("product_description_length"),
        "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm",
        "product_width_cm",
        (F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm"))
         .alias("product_volume_cm3"),
    )


def stg_sellers(sellers: DataFrame) -> DataFrame:
    return sellers.select(
        "seller_id", "seller_zip_code_prefix",
        norm_lower("seller_city").alias("seller_city"),
        norm_upper("seller_state").alias("seller_state"),
    )


def stg_product_category_name_translation(translation: DataFrame) -> DataFrame:
    return translation.select(
        norm_lower("product_category_name").alias("product_category_name"),
        norm_lower("product_category_name_english").alias("product_category_name_english"),
    )
