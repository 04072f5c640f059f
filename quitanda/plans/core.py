"""Core layer: conformed dimensions and the four fact tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quitanda.functions import (day_name, days_between, iso_day_of_week, is_weekend,
                                month_start, quarter_start, region_of, weight_class,
                                year_month, year_start)
from quitanda.operators.joins import coded_attributes, coded_columns
from quitanda.operators.numbering import hot_buckets, key_bucket
from quitanda.plans.intermediate import int_orders_enriched
from quitanda.plans.staging import ITEM_COLUMNS, item_values

FALLBACK_FIRST_DAY = "2016-01-01"


@dataclass(frozen=True)
class RowStream:
    """A model's rows while they are shuffled: ``finish`` adds what codes and other columns stand for."""
    rows: DataFrame
    finish: Callable[[DataFrame], DataFrame]   # keeps every other column
    columns: tuple[str, ...]                   # the model's, in their order

    def whole(self) -> DataFrame:
        return self.finish(self.rows).select(*self.columns)


def dim_customers(stg_customers: DataFrame, geolocation_zip: DataFrame) -> DataFrame:
    g = geolocation_zip.select(
        F.col("geolocation_zip_code_prefix").alias("customer_zip_code_prefix"),
        F.col("avg_latitude").alias("customer_latitude"),
        F.col("avg_longitude").alias("customer_longitude"))
    return (stg_customers.join(g, "customer_zip_code_prefix", "left")
            .select("customer_id", "customer_unique_id", "customer_zip_code_prefix",
                    "customer_city", "customer_state",
                    region_of("customer_state").alias("customer_region"),
                    "customer_latitude", "customer_longitude"))


def dim_sellers(stg_sellers: DataFrame, geolocation_zip: DataFrame) -> DataFrame:
    g = geolocation_zip.select(
        F.col("geolocation_zip_code_prefix").alias("seller_zip_code_prefix"),
        F.col("avg_latitude").alias("seller_latitude"),
        F.col("avg_longitude").alias("seller_longitude"))
    return (stg_sellers.join(g, "seller_zip_code_prefix", "left")
            .select("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state",
                    region_of("seller_state").alias("seller_region"),
                    "seller_latitude", "seller_longitude"))


def dim_products(stg_products: DataFrame, stg_translation: DataFrame) -> DataFrame:
    t = stg_translation.select("product_category_name",
                               F.col("product_category_name_english").alias("_english"))
    category = F.col("product_category_name")
    return (stg_products.join(t, "product_category_name", "left")
            .select("product_id",
                    F.coalesce(category, F.lit("unknown")).alias("product_category_name"),
                    F.coalesce(F.col("_english"), category, F.lit("unknown"))
                     .alias("product_category_name_english"),
                    "product_name_length", "product_description_length", "product_photos_qty",
                    "product_weight_g", "product_length_cm", "product_height_cm",
                    "product_width_cm", "product_volume_cm3",
                    weight_class("product_weight_g").alias("product_weight_class")))


def dim_date(stg_orders: DataFrame, stg_order_reviews: DataFrame) -> DataFrame:
    """One row per day from the first purchase day to the last relevant day.

    The bounds are two one-row aggregates combined into one row; the days are
    generated from that single row (the range spans days, not data rows).
    """
    review_last = stg_order_reviews.agg(F.max("review_creation_date_day").alias("m")).scalar()
    bounds = stg_orders.agg(
        F.min("order_purchase_date").alias("first_purchase"),
        F.max(F.coalesce("order_estimated_delivery_date_day", "order_purchase_date")).alias("last_order"),
    ).select(
        F.coalesce(F.col("first_purchase"), F.to_date(F.lit(FALLBACK_FIRST_DAY))).alias("min_date"),
        F.col("last_order"), review_last.alias("last_review"),
    ).select(
        "min_date",
        F.greatest(F.coalesce("last_order", "min_date"), F.coalesce("last_review", "min_date"))
         .alias("max_date"),
    )
    last_day = F.greatest(F.col("max_date"), F.col("min_date"))
    days = bounds.select(F.explode(F.sequence(F.col("min_date"), last_day,
                                              F.expr("INTERVAL 1 DAY"))).alias("date_day"))
    d = F.col("date_day")
    return days.select(
        "date_day",
        F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
        F.dayofmonth(d).alias("day_of_month"),
        iso_day_of_week(d).alias("day_of_week"),
        F.weekofyear(d).alias("iso_week"),
        month_start(d).alias("month_start_date"),
        quarter_start(d).alias("quarter_start_date"),
        year_start(d).alias("year_start_date"),
        year_month(d).alias("year_month"),
        day_name(d).alias("day_name"),
        is_weekend(d).alias("is_weekend"),
    )


# The fact's columns, in their order.
FCT_ORDERS_COLUMNS = [
    "order_id", "customer_id", "customer_unique_id", "customer_city", "customer_state",
    "customer_region", "order_status", "order_purchase_timestamp", "order_purchase_date",
    "order_purchase_month", "order_approved_at", "order_approved_date",
    "order_delivered_carrier_date", "order_delivered_carrier_date_day",
    "order_delivered_customer_date", "order_delivered_customer_date_day",
    "order_estimated_delivery_date", "order_estimated_delivery_date_day", "is_delivered",
    "is_canceled", "is_unavailable", "actual_delivery_days", "estimated_delivery_days",
    "delivery_delay_days", "is_late_delivery", "item_count", "unique_product_count",
    "unique_seller_count", "order_item_value", "order_freight_value", "order_total_value",
    "payment_count", "payment_types", "max_payment_installments", "payment_value",
    "credit_card_value", "boleto_value", "voucher_value", "debit_card_value", "review_count",
    "avg_review_score", "latest_review_id", "latest_review_score", "latest_review_creation_date",
    "latest_review_answer_timestamp", "has_review_comment",
]


CUSTOMER_ATTRS = ("customer_unique_id", "customer_city", "customer_state", "customer_region")


def fct_orders(orders_enriched: DataFrame, dim_customers_df: DataFrame) -> DataFrame:
    c = dim_customers_df.select("customer_id", *CUSTOMER_ATTRS)
    return orders_enriched.join(c, "customer_id", "left").select(*FCT_ORDERS_COLUMNS)


def fct_orders_from_rollups(stg_orders: DataFrame, items_by_order: DataFrame, payments_by_order: DataFrame,
                            reviews_by_order: DataFrame, dim_customers_df: DataFrame) -> DataFrame:
    """The same rows where no enriched orders are written yet.

    Customers join the still narrow orders; the joins on ``order_id`` come last, so the wide rows are
    not shuffled for the customers, and what joins them on ``order_id`` finds them dealt by it.
    """
    c = dim_customers_df.select("customer_id", *CUSTOMER_ATTRS)
    orders = stg_orders.join(c, "customer_id", "left")
    return int_orders_enriched(orders, items_by_order, payments_by_order, reviews_by_order,
                               CUSTOMER_ATTRS).select(*FCT_ORDERS_COLUMNS)


# The fact's columns, in their order.
FCT_ORDER_ITEMS_COLUMNS = [
    "order_id", "order_item_id", "product_id", "seller_id", "customer_id", "order_status",
    "order_purchase_timestamp", "order_purchase_date", "order_purchase_month",
    "shipping_limit_date", "shipping_limit_date_day", "price", "freight_value", "item_quantity",
    "item_revenue", "item_total_value", "product_category_name", "product_category_name_english",
    "product_weight_class", "seller_city", "seller_state", "seller_region", "customer_city",
    "customer_state", "customer_region", "is_delivered", "is_late_delivery",
    "actual_delivery_days", "delivery_delay_days", "latest_review_score",
]
ITEM_ORDER_ATTRS = ["customer_id", "order_status", "order_purchase_timestamp",
                    "order_purchase_date", "order_purchase_month", "customer_city",
                    "customer_state", "customer_region", "is_delivered", "is_late_delivery",
                    "actual_delivery_days", "delivery_delay_days", "latest_review_score"]


def item_stream(stg_order_items: DataFrame, fct_orders_df: DataFrame, dim_products_df: DataFrame,
                dim_sellers_df: DataFrame, more: tuple[str, ...] = (), orders_written: bool = True) -> RowStream:
    """Item lines ⟕ product ⟕ seller ⟕ order facts, all on unique right keys.

    ``more`` names further order attributes to take from the same join; ``orders_written`` tells that the
    order facts are a table, cheap to read once more for the codes of its customers' texts.
    """
    o = fct_orders_df.select("order_id", *ITEM_ORDER_ATTRS, *more)
    with_customer = None
    if orders_written:
        o, with_customer = coded_columns(o, "_customer", ["customer_city", "customer_state", "customer_region"])
    p, with_product = coded_attributes(dim_products_df, "product_id",
                                       ["product_category_name", "product_category_name_english",
                                        "product_weight_class"], "_product")
    s, with_seller = coded_attributes(dim_sellers_df, "seller_id", ["seller_city", "seller_state", "seller_region"],
                                      "_seller")
    lines = stg_order_items.select(*ITEM_COLUMNS)
    if hot_buckets(lines, key_bucket("order_id")):
        # Orders may come dealt by order_id.  Lines of a hot order are cut apart by AQE only if both sides
        # are shuffled for this join, and a computed key has them shuffled.
        o = o.withColumn("order_id", F.concat(F.col("order_id"), F.lit("")))
    # Each join re-shuffles the item stream on a new key unless the dimension is
    # small enough to broadcast, so the stream is kept narrow: only the base
    # columns of a line and codes of the dimensions' texts go through (texts and
    # computed values are added behind the joins), products come first (they are
    # many), the wide order attributes last.
    joined = lines.join(p, "product_id", "left").join(s, "seller_id", "left").join(o, "order_id", "left")

    def finish(df: DataFrame) -> DataFrame:
        df = with_seller(with_product(df))
        df = with_customer(df) if with_customer else df
        return df.select("*", *item_values())
    return RowStream(joined, finish, tuple(FCT_ORDER_ITEMS_COLUMNS))


def items_with_context(stg_order_items: DataFrame, fct_orders_df: DataFrame,
                       dim_products_df: DataFrame, dim_sellers_df: DataFrame,
                       more: tuple[str, ...] = ()) -> DataFrame:
    """The rows of ``item_stream`` with all their columns."""
    stream = item_stream(stg_order_items, fct_orders_df, dim_products_df, dim_sellers_df, more, orders_written=False)
    return stream.finish(stream.rows)


def fct_order_items(stg_order_items: DataFrame, fct_orders_df: DataFrame,
                    dim_products_df: DataFrame, dim_sellers_df: DataFrame) -> DataFrame:
    return items_with_context(stg_order_items, fct_orders_df, dim_products_df,
                              dim_sellers_df).select(*FCT_ORDER_ITEMS_COLUMNS)


def fct_payments(stg_order_payments: DataFrame, fct_orders_df: DataFrame) -> DataFrame:
    o = fct_orders_df.select("order_id", "customer_id", "customer_unique_id", "customer_state",
                             "customer_region", "order_status", "order_purchase_date",
                             "order_purchase_month")
    return (stg_order_payments.join(o, "order_id", "left")
            .select("order_id", "payment_sequential", "customer_id", "customer_unique_id",
                    "customer_state", "customer_region", "order_status", "order_purchase_date",
                    "order_purchase_month", "payment_type", "payment_installments",
                    "payment_value"))


def fct_reviews(stg_order_reviews: DataFrame, fct_orders_df: DataFrame) -> DataFrame:
    o = fct_orders_df.select("order_id", "customer_id", "customer_unique_id", "customer_state",
                             "customer_region", "order_status", "order_purchase_date",
                             "order_purchase_month")
    return (stg_order_reviews.join(o, "order_id", "left")
            .select("review_id", "order_id", "customer_id", "customer_unique_id",
                    "customer_state", "customer_region", "order_status", "order_purchase_date",
                    "order_purchase_month", "review_score", "review_comment_title",
                    "review_comment_message", "review_creation_date", "review_creation_date_day",
                    "review_answer_timestamp", "review_answer_date_day", "has_review_comment"))


__all__ = ["dim_customers", "dim_sellers", "dim_products", "dim_date", "fct_orders",
           "fct_order_items", "fct_payments", "fct_reviews", "items_with_context",
           "days_between"]
