"""Analytics marts: grouped KPIs over the facts.

All measures are decomposable (counts, exact sums, min/max, distinct counts)
so Spark's partial aggregation combines them map-side before the shuffle; a
hot group (one day, one state, one seller) only ever ships one partial row
per task.  Means are exact sum / count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quitanda.functions import (any_value, days_between, exact_avg, exact_sum, month_start,
                                rfm_segment, safe_divide)
from quitanda.operators.distinct import aggregate_distinct
from quitanda.operators.joins import coded_columns
from quitanda.plans.core import RowStream, items_with_context
from quitanda.plans.staging import item_values

ORDER_MEASURE_NAMES = [
    "orders_count", "customers_count", "items_count", "revenue", "freight_revenue",
    "gross_revenue", "payment_value", "delivered_orders_count", "canceled_orders_count",
    "late_orders_count", "avg_order_value", "avg_delivery_days", "avg_review_score",
]


def _delivered() -> Column:
    return F.col("order_status") == "delivered"


def _late() -> Column:
    return F.col("is_late_delivery") == 1


def _order_measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("orders_count"),
        F.count_distinct("customer_unique_id").alias("customers_count"),
        F.sum("item_count").alias("items_count"),
        exact_sum("order_item_value").alias("revenue"),
        exact_sum("order_freight_value").alias("freight_revenue"),
        exact_sum("order_total_value").alias("gross_revenue"),
        exact_sum("payment_value").alias("payment_value"),
        F.count_if(_delivered()).alias("delivered_orders_count"),
        F.count_if(F.col("order_status") == "canceled").alias("canceled_orders_count"),
        F.count_if(_late()).alias("late_orders_count"),
        exact_avg("order_item_value").alias("avg_order_value"),
        F.avg("actual_delivery_days").alias("avg_delivery_days"),
        F.avg("latest_review_score").alias("avg_review_score"),
    ]


def mart_sales_daily(fct_orders: DataFrame) -> DataFrame:
    return (fct_orders.groupBy(F.col("order_purchase_date").alias("sales_date"))
            .agg(*_order_measures()))


def mart_sales_monthly(fct_orders: DataFrame) -> DataFrame:
    return (fct_orders.groupBy(F.col("order_purchase_month").alias("sales_month"))
            .agg(*_order_measures())
            .withColumn("delivery_rate", safe_divide("delivered_orders_count", "orders_count"))
            .withColumn("late_delivery_rate",
                        safe_divide("late_orders_count", "delivered_orders_count")))


def mart_customer_rfm(fct_orders: DataFrame) -> DataFrame:
    # the latest purchase day over *all* orders, computed once as a scalar
    max_order_date = fct_orders.agg(F.max("order_purchase_date")).scalar()
    metrics = (fct_orders.where(F.col("customer_unique_id").isNotNull())
               .groupBy("customer_unique_id")
               .agg(any_value("customer_state").alias("customer_state"),
                    any_value("customer_region").alias("customer_region"),
                    F.min("order_purchase_date").alias("first_order_date"),
                    F.max("order_purchase_date").alias("last_order_date"),
                    F.count(F.lit(1)).alias("total_orders"),
                    exact_sum("order_item_value").alias("monetary_value"),
                    exact_avg("order_item_value").alias("avg_order_value"),
                    F.sum("item_count").alias("total_items"),
                    F.avg("latest_review_score").alias("avg_review_score")))
    return metrics.select(
        "customer_unique_id", "customer_state", "customer_region", "first_order_date",
        "last_order_date",
        days_between(F.col("last_order_date"), max_order_date).alias("recency_days"),
        "total_orders", "monetary_value", "avg_order_value", "total_items", "avg_review_score",
    ).withColumn("customer_segment",
                 rfm_segment("total_orders", "monetary_value", "recency_days"))


def _by_item_key(fct_order_items: DataFrame, key: str, distinct: dict[str, str], averages: dict[str, str]) -> DataFrame:
    """Numbers of the item lines of a product or seller; ``averages`` names whole-number columns to average."""
    rolled = aggregate_distinct(
        fct_order_items, key, {"orders_count": "order_id", **distinct},
        {"item_lines_count": ("rows", None),
         "revenue": ("exact", F.col("item_revenue")),
         "freight_revenue": ("exact", F.col("freight_value")),
         "gross_revenue": ("exact", F.col("item_total_value")),
         "_price": ("exact", F.col("price")), "_prices": ("count", F.col("price")),
         "late_item_lines_count": ("count", F.when(_late(), 1)),
         **{f"_{name}_sum": ("sum", F.col(c).cast("double")) for name, c in averages.items()},
         **{f"_{name}_n": ("count", F.col(c)) for name, c in averages.items()}})
    return rolled.select(
        key, "item_lines_count", "orders_count", *distinct,
        *[F.col(c).cast("double").alias(c) for c in ("revenue", "freight_revenue", "gross_revenue")],
        safe_divide("_price", "_prices").alias("avg_item_price"),
        *[safe_divide(f"_{name}_sum", f"_{name}_n").alias(name) for name in averages],
        "late_item_lines_count")


def mart_product_performance(fct_order_items: DataFrame, dim_products: DataFrame) -> DataFrame:
    """Numbers per product first; its descriptions are joined to the few rows that are left."""
    measures = _by_item_key(fct_order_items, "product_id", {"sellers_count": "seller_id"},
                            {"avg_review_score": "latest_review_score"})
    named = ["product_category_name", "product_category_name_english", "product_weight_class"]
    return (measures.join(dim_products.select("product_id", *named), "product_id", "left")
            .select("product_id", *named, *measures.columns[1:]))


def mart_seller_performance(fct_order_items: DataFrame, dim_sellers: DataFrame) -> DataFrame:
    """Numbers per seller first; its descriptions are joined to the few rows that are left."""
    measures = _by_item_key(fct_order_items, "seller_id", {"products_count": "product_id"},
                            {"avg_delivery_days": "actual_delivery_days", "avg_review_score": "latest_review_score"})
    named = ["seller_city", "seller_state", "seller_region"]
    return (measures.join(dim_sellers.select("seller_id", *named), "seller_id", "left")
            .select("seller_id", *named, "item_lines_count", "orders_count", "products_count", "revenue",
                    "freight_revenue", "gross_revenue", "avg_item_price", "avg_delivery_days", "late_item_lines_count",
                    "avg_review_score"))


def mart_delivery_performance(fct_orders: DataFrame) -> DataFrame:
    return (fct_orders.groupBy(F.col("order_purchase_month").alias("sales_month"),
                               "customer_state", "customer_region")
            .agg(F.count(F.lit(1)).alias("orders_count"),
                 F.count_if(_delivered()).alias("delivered_orders_count"),
                 F.count_if(F.col("order_status") == "canceled").alias("canceled_orders_count"),
                 F.count_if(_late()).alias("late_orders_count"),
                 F.avg("actual_delivery_days").alias("avg_delivery_days"),
                 F.avg("estimated_delivery_days").alias("avg_estimated_delivery_days"),
                 F.avg("delivery_delay_days").alias("avg_delivery_delay_days"))
            .withColumn("delivery_rate", safe_divide("delivered_orders_count", "orders_count"))
            # the source names this column late_delivery_r; kept for schema parity
            .withColumn("late_delivery_r",
                        safe_divide("late_orders_count", "delivered_orders_count")))


def mart_review_performance(fct_reviews: DataFrame) -> DataFrame:
    return (fct_reviews.groupBy(month_start("review_creation_date_day").alias("review_month"),
                                "review_score")
            .agg(F.count(F.lit(1)).alias("reviews_count"),
                 F.count_if(F.col("has_review_comment") == 1).alias("reviews_with_comment_count"),
                 F.count_distinct("order_id").alias("reviewed_orders_count")))


def mart_payment_performance(fct_payments: DataFrame) -> DataFrame:
    return (fct_payments.groupBy(F.col("order_purchase_month").alias("sales_month"),
                                 "payment_type")
            .agg(F.count(F.lit(1)).alias("payment_rows_count"),
                 F.count_distinct("order_id").alias("orders_count"),
                 exact_sum("payment_value").alias("payment_value"),
                 exact_avg("payment_value").alias("avg_payment_value"),
                 F.avg("payment_installments").alias("avg_payment_installments"),
                 F.max("payment_installments").alias("max_payment_installments")))


def mart_geo_sales_state(fct_orders: DataFrame) -> DataFrame:
    return (fct_orders.groupBy("customer_state", "customer_region")
            .agg(F.count(F.lit(1)).alias("orders_count"),
                 F.count_distinct("customer_unique_id").alias("customers_count"),
                 exact_sum("order_item_value").alias("revenue"),
                 exact_sum("order_freight_value").alias("freight_revenue"),
                 exact_sum("order_total_value").alias("gross_revenue"),
                 exact_avg("order_item_value").alias("avg_order_value"),
                 F.count_if(_delivered()).alias("delivered_orders_count"),
                 F.count_if(_late()).alias("late_orders_count"),
                 F.avg("actual_delivery_days").alias("avg_delivery_days"),
                 F.avg("latest_review_score").alias("avg_review_score")))


def mart_executive_kpi(fct_orders: DataFrame) -> DataFrame:
    """One row even for an empty input (global aggregate; rates NULL then)."""
    return (fct_orders.agg(
        F.count(F.lit(1)).alias("orders_count"),
        F.count_distinct("customer_unique_id").alias("customers_count"),
        F.sum("item_count").alias("items_count"),
        exact_sum("order_item_value").alias("revenue"),
        exact_sum("order_freight_value").alias("freight_revenue"),
        exact_sum("order_total_value").alias("gross_revenue"),
        exact_sum("payment_value").alias("payment_value"),
        exact_avg("order_item_value").alias("avg_order_value"),
        F.count_if(_delivered()).alias("delivered_orders_count"),
        F.count_if(F.col("order_status") == "canceled").alias("canceled_orders_count"),
        F.count_if(F.col("order_status") == "unavailable").alias("unavailable_orders_count"),
        F.count_if(_late()).alias("late_orders_count"),
        F.avg("actual_delivery_days").alias("avg_delivery_days"),
        F.avg("latest_review_score").alias("avg_review_score"))
        .select(F.lit("overall").alias("kpi_grain"), "*")
        .withColumn("delivery_rate", safe_divide("delivered_orders_count", "orders_count"))
        .withColumn("cancellation_rate", safe_divide("canceled_orders_count", "orders_count"))
        .withColumn("late_delivery_rate", safe_divide("late_orders_count", "delivered_orders_count")))


# The mart's columns, in their order.
DASHBOARD_COLUMNS = [
    "order_id", "order_item_id", "order_purchase_timestamp", "order_purchase_date",
    "order_purchase_month", "order_status", "customer_id", "customer_city", "customer_state",
    "customer_region", "product_id", "product_category_name", "product_category_name_english",
    "product_weight_class", "seller_id", "seller_city", "seller_state", "seller_region", "price",
    "freight_value", "item_revenue", "item_total_value", "shipping_limit_date_day",
    "is_delivered", "is_late_delivery", "actual_delivery_days", "delivery_delay_days",
    "latest_review_score", "payment_types", "max_payment_installments", "payment_value",
]


PAYMENT_ATTRS = ("payment_types", "max_payment_installments", "payment_value")


def mart_dashboard_sales_detail(fct_order_items: DataFrame, fct_orders: DataFrame) -> DataFrame:
    """Item-grain wide table: the item fact and three payment columns of its order
    (order-level payment value repeats per item)."""
    paid = fct_orders.select("order_id", *PAYMENT_ATTRS)
    return fct_order_items.join(paid, "order_id", "left").select(*DASHBOARD_COLUMNS)


def dashboard_stream(fct_order_items: DataFrame, fct_orders: DataFrame) -> RowStream:
    """The same rows, narrow, over a written item fact: codes for the texts of products, sellers and customers."""
    wanted = [c for c in DASHBOARD_COLUMNS if c not in (*PAYMENT_ATTRS, "item_revenue", "item_total_value")]
    narrow, decoders = fct_order_items.select(*wanted), []
    for code, texts in {"_product": ["product_category_name", "product_category_name_english", "product_weight_class"],
                        "_seller": ["seller_city", "seller_state", "seller_region"],
                        "_customer": ["customer_city", "customer_state", "customer_region"]}.items():
        narrow, decode = coded_columns(narrow, code, texts)
        decoders.append(decode)
    paid = fct_orders.select("order_id", *PAYMENT_ATTRS)

    def finish(df: DataFrame) -> DataFrame:
        for decode in decoders:
            df = decode(df)
        return df.select("*", *item_values()[2:])   # item_revenue, item_total_value
    return RowStream(narrow.join(paid, "order_id", "left"), finish, tuple(DASHBOARD_COLUMNS))


def dashboard_from_items(stg_order_items: DataFrame, fct_orders: DataFrame, dim_products: DataFrame,
                         dim_sellers: DataFrame) -> DataFrame:
    """The same rows where no item fact is written yet: its order join gives the payment columns, too."""
    return items_with_context(stg_order_items, fct_orders, dim_products, dim_sellers,
                              PAYMENT_ATTRS).select(*DASHBOARD_COLUMNS)
