"""Single-operator queries: each isolates one operator the models rely on.

They run on the model data (derived from the whole driver tables), and each
has an independent SQL formulation for the oracle check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quitanda import oracle
from quitanda.catalog import register
from quitanda.functions import (any_value, avg_if, blank_to_null, day_name, days_between,
                                distinct_list, has_text, iso_day_of_week, latest_by, exact_sum,
                                exact_sum_if, month_key, month_start, norm_lower, norm_upper,
                                quarter_start, region_of, safe_divide, weight_class, year_month,
                                year_start)
from quitanda.operators.distinct import aggregate_distinct
from quitanda.operators.joins import attach_scalar, left_join_fill, orphans
from quitanda.operators.numbering import number_within
from quitanda.plans.models import Warehouse
from quitanda.sources.star import LINE_ORDER, read_driver

_W = oracle.with_ctes


def _m(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return Warehouse.from_star(spark, sf_dir).model(name)


# C14: anti join — orders nobody reviewed
register("join_anti",
         lambda s, d: orphans(_m(s, d, "stg_orders").select("order_id"), "order_id",
                              _m(s, d, "stg_order_reviews"), "order_id"),
         _W("SELECT o.order_id FROM stg_orders o WHERE o.order_id IS NOT NULL AND NOT EXISTS "
            "(SELECT 1 FROM stg_order_reviews r WHERE r.order_id = o.order_id)",
            ["stg_orders", "stg_order_reviews"]))

# Left join with defaults for misses
register("join_left_fill",
         lambda s, d: left_join_fill(
             _m(s, d, "stg_orders").select("order_id", "order_status"),
             _m(s, d, "int_payments_by_order"), "order_id",
             {"payment_count": F.lit(0).cast("bigint"), "payment_types": F.lit("unknown"),
              "payment_value": F.lit(0.0)}),
         _W("SELECT o.order_id, o.order_status, coalesce(p.payment_count, CAST(0 AS BIGINT)) AS payment_count, "
            "coalesce(p.payment_types, 'unknown') AS payment_types, "
            "coalesce(p.payment_value, CAST(0 AS DOUBLE)) AS payment_value "
            "FROM stg_orders o LEFT JOIN int_payments_by_order p ON o.order_id = p.order_id",
            ["stg_orders", "int_payments_by_order"]))


# A value computed once attached to every row
def _join_scalar(s: SparkSession, d: str) -> DataFrame:
    orders = _m(s, d, "stg_orders").select("order_id", "order_purchase_date")
    last = orders.agg(F.max("order_purchase_date").alias("last_purchase_date"))
    out = attach_scalar(orders, last, "last_purchase_date")
    return out.withColumn("days_before_last", days_between("order_purchase_date", "last_purchase_date"))


register("join_scalar", _join_scalar,
         _W("SELECT order_id, order_purchase_date, last_purchase_date, "
            "CAST(datediff('day', order_purchase_date, last_purchase_date) AS BIGINT) AS days_before_last "
            "FROM (SELECT order_id, order_purchase_date, "
            "(SELECT max(order_purchase_date) FROM stg_orders) AS last_purchase_date FROM stg_orders)",
            ["stg_orders"]))

# sumIf — 0 (not NULL) when nothing matches
_SUM_IF_KINDS = ["voucher", "debit_card", "not_defined"]
register("agg_sum_if",
         lambda s, d: _m(s, d, "fct_payments").groupBy(F.col("order_purchase_month").alias("sales_month"))
         .agg(*[exact_sum_if("payment_value", F.col("payment_type") == k).alias(f"{k}_value")
                for k in _SUM_IF_KINDS]),
         _W("SELECT order_purchase_month AS sales_month, "
            + ", ".join(f"{oracle.exact_sum_if('payment_value', f"payment_type = '{k}'")} AS {k}_value"
                        for k in _SUM_IF_KINDS)
            + " FROM fct_payments GROUP BY order_purchase_month", ["fct_payments"]))

# countIf
register("agg_count_if",
         lambda s, d: _m(s, d, "fct_orders").groupBy(F.col("order_purchase_month").alias("sales_month"))
         .agg(F.count_if(F.col("is_late_delivery") == 1).alias("late_orders_count"),
              F.count_if(F.col("order_status") == "canceled").alias("canceled_orders_count"),
              F.count_if(F.col("order_status") == "unavailable").alias("unavailable_orders_count")),
         _W("SELECT order_purchase_month AS sales_month, "
            f"{oracle.count_if('is_late_delivery = 1')} AS late_orders_count, "
            f"{oracle.count_if("order_status = 'canceled'")} AS canceled_orders_count, "
            f"{oracle.count_if("order_status = 'unavailable'")} AS unavailable_orders_count "
            "FROM fct_orders GROUP BY order_purchase_month", ["fct_orders"]))

# avgIf — NULL when nothing matches
register("agg_avg_if",
         lambda s, d: _m(s, d, "fct_orders").groupBy("customer_state")
         .agg(avg_if("delivery_delay_days", F.col("is_late_delivery") == 1).alias("avg_late_delay_days"),
              avg_if("actual_delivery_days", F.col("order_status") == "delivered").alias("avg_delivered_days")),
         _W("SELECT customer_state, "
            "avg(CASE WHEN is_late_delivery = 1 THEN delivery_delay_days END) AS avg_late_delay_days, "
            "avg(CASE WHEN order_status = 'delivered' THEN actual_delivery_days END) AS avg_delivered_days "
            "FROM fct_orders GROUP BY customer_state", ["fct_orders"]))

# Any value of a group-constant attribute (deterministic)
register("agg_any_value",
         lambda s, d: _m(s, d, "stg_customers").groupBy("customer_zip_code_prefix")
         .agg(any_value("customer_city").alias("customer_city"),
              any_value("customer_state").alias("customer_state"),
              F.count(F.lit(1)).alias("customers")),
         _W("SELECT customer_zip_code_prefix, min(customer_city) AS customer_city, "
            "min(customer_state) AS customer_state, count(*) AS customers "
            "FROM stg_customers GROUP BY customer_zip_code_prefix", ["stg_customers"]))


# argMax — latest order per person, all fields from the same row
def _agg_arg_max(s: SparkSession, d: str) -> DataFrame:
    latest = latest_by(["order_id", "order_status"], F.col("order_purchase_timestamp"), "order_id")
    return (_m(s, d, "fct_orders").groupBy("customer_unique_id").agg(latest.alias("_l"))
            .select("customer_unique_id", F.col("_l.order_id").alias("latest_order_id"),
                    F.col("_l.order_status").alias("latest_order_status")))


register("agg_arg_max", _agg_arg_max,
         _W("SELECT customer_unique_id, order_id AS latest_order_id, order_status AS latest_order_status "
            "FROM (SELECT *, row_number() OVER (PARTITION BY customer_unique_id ORDER BY "
            "order_purchase_timestamp DESC NULLS LAST, order_id DESC) AS rk FROM fct_orders) WHERE rk = 1",
            ["fct_orders"]))

# D15 + H21 + H22: sorted distinct list joined to a string
register("agg_distinct_list",
         lambda s, d: _m(s, d, "fct_payments").groupBy("customer_unique_id")
         .agg(distinct_list("payment_type", ", ").alias("payment_types"),
              F.count(F.lit(1)).alias("payments")),
         _W("SELECT customer_unique_id, array_to_string(list_sort(list_distinct(list(payment_type))), ', ') "
            "AS payment_types, count(*) AS payments FROM fct_payments GROUP BY customer_unique_id",
            ["fct_payments"]))

# Exact distinct counts (several in one aggregate)
register("agg_count_distinct",
         lambda s, d: aggregate_distinct(
             Warehouse.from_star(s, d).model("fct_order_items", derived=False), "seller_id",
             {"orders_count": "order_id", "products_count": "product_id", "customers_count": "customer_id"}),
         _W("SELECT seller_id, count(DISTINCT order_id) AS orders_count, "
            "count(DISTINCT product_id) AS products_count, count(DISTINCT customer_id) AS customers_count "
            "FROM fct_order_items GROUP BY seller_id", ["fct_order_items"]))

# Ratio with zero / NULL guard (days without deliveries give NULL)
register("agg_safe_divide",
         lambda s, d: _m(s, d, "fct_orders").groupBy(F.col("order_purchase_date").alias("sales_date"))
         .agg(F.count_if(F.col("is_late_delivery") == 1).alias("late"),
              F.count_if(F.col("order_status") == "delivered").alias("delivered"))
         .withColumn("late_per_delivered", safe_divide("late", "delivered")),
         _W("SELECT *, " + oracle.safe_divide("late", "delivered") + " AS late_per_delivered FROM "
            f"(SELECT order_purchase_date AS sales_date, {oracle.count_if('is_late_delivery = 1')} AS late, "
            f"{oracle.count_if("order_status = 'delivered'")} AS delivered "
            "FROM fct_orders GROUP BY order_purchase_date)", ["fct_orders"]))

# Global aggregate (exactly one row)
register("agg_global",
         lambda s, d: _m(s, d, "stg_order_items").agg(
             F.count(F.lit(1)).alias("item_lines"), F.count_distinct("order_id").alias("orders"),
             exact_sum("price").alias("revenue"),
             F.min("shipping_limit_date").alias("first_shipping_limit"),
             F.max("shipping_limit_date").alias("last_shipping_limit")),
         _W("SELECT count(*) AS item_lines, count(DISTINCT order_id) AS orders, "
            f"{oracle.exact_sum('price')} AS revenue, min(shipping_limit_date) AS first_shipping_limit, "
            "max(shipping_limit_date) AS last_shipping_limit FROM stg_order_items", ["stg_order_items"]))

# D3: group by a computed alias
register("agg_group_alias",
         lambda s, d: _m(s, d, "stg_order_items")
         .groupBy(month_start("shipping_limit_date_day").alias("ship_month"))
         .agg(F.count(F.lit(1)).alias("item_lines"), exact_sum("item_total_value").alias("gross_value")),
         _W(f"SELECT {oracle.month_start('shipping_limit_date_day')} AS ship_month, count(*) AS item_lines, "
            f"{oracle.exact_sum('item_total_value')} AS gross_value FROM stg_order_items "
            f"GROUP BY {oracle.month_start('shipping_limit_date_day')}", ["stg_order_items"]))

# Two-level aggregation (lines → orders → order-size histogram)
register("agg_two_level",
         lambda s, d: _m(s, d, "stg_order_items").groupBy("order_id")
         .agg(F.count(F.lit(1)).alias("item_count"), exact_sum("price").alias("order_value"))
         .groupBy("item_count")
         .agg(F.count(F.lit(1)).alias("orders"), exact_sum("order_value").alias("value"),
              F.max("order_value").alias("max_order_value")),
         _W("SELECT item_count, count(*) AS orders, " + oracle.exact_sum("order_value") + " AS value, "
            "max(order_value) AS max_order_value FROM (SELECT order_id, count(*) AS item_count, "
            + oracle.exact_sum("price") + " AS order_value FROM stg_order_items GROUP BY order_id) "
            "GROUP BY item_count", ["stg_order_items"]))


# Date spine from one bounds row
def _gen_date_spine(s: SparkSession, d: str) -> DataFrame:
    r = _m(s, d, "stg_order_reviews")
    bounds = r.agg(F.min("review_creation_date_day").alias("lo"), F.max("review_creation_date_day").alias("hi"))
    return bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("date_day"))


register("gen_date_spine", _gen_date_spine,
         _W("SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) "
            "AS DATE) AS date_day FROM (SELECT min(review_creation_date_day) AS lo, "
            "max(review_creation_date_day) AS hi FROM stg_order_reviews) WHERE lo IS NOT NULL",
            ["stg_order_reviews"]))


# Calendar parts of every purchase day
def _fn_date_parts(s: SparkSession, d: str) -> DataFrame:
    days = _m(s, d, "stg_orders").select(F.col("order_purchase_date").alias("d")).distinct()
    c = F.col("d")
    return days.select(
        c.alias("day"), F.year(c).alias("year"), F.quarter(c).alias("quarter"), F.month(c).alias("month"),
        F.dayofmonth(c).alias("day_of_month"), iso_day_of_week(c).alias("day_of_week"),
        F.weekofyear(c).alias("iso_week"), month_start(c).alias("month_start_date"),
        quarter_start(c).alias("quarter_start_date"), year_start(c).alias("year_start_date"),
        year_month(c).alias("year_month"), day_name(c).alias("day_name"))


register("fn_date_parts", _fn_date_parts,
         _W("SELECT d AS day, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, "
            "CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day_of_month, "
            "CAST(isodow(d) AS INTEGER) AS day_of_week, CAST(weekofyear(d) AS INTEGER) AS iso_week, "
            "CAST(date_trunc('month', d) AS DATE) AS month_start_date, "
            "CAST(date_trunc('quarter', d) AS DATE) AS quarter_start_date, "
            "CAST(date_trunc('year', d) AS DATE) AS year_start_date, strftime(d, '%Y-%m') AS year_month, "
            "strftime(d, '%A') AS day_name FROM (SELECT DISTINCT order_purchase_date AS d FROM stg_orders)",
            ["stg_orders"]))

# Text normalisation on the raw review and customer text
register("fn_text_normalize",
         lambda s, d: Warehouse.from_star(s, d).table("raw.order_reviews").select(
             "review_id", blank_to_null("review_comment_title").alias("title"),
             blank_to_null("review_comment_message").alias("message"),
             norm_lower("review_comment_message").alias("message_lower"),
             norm_upper("review_comment_title").alias("title_upper"),
             F.char_length(F.trim(F.coalesce("review_comment_message", F.lit("")))).alias("message_chars"),
             has_text("review_comment_message").alias("has_message")),
         _W("SELECT review_id, nullif(trim(coalesce(review_comment_title, '')), '') AS title, "
            "nullif(trim(coalesce(review_comment_message, '')), '') AS message, "
            "lower(trim(review_comment_message)) AS message_lower, upper(trim(review_comment_title)) AS title_upper, "
            "CAST(length(trim(coalesce(review_comment_message, ''))) AS INTEGER) AS message_chars, "
            "CASE WHEN length(trim(coalesce(review_comment_message, ''))) > 0 THEN 1 ELSE 0 END AS has_message "
            "FROM raw_order_reviews", ["raw_order_reviews"]))

# State → region
register("fn_region",
         lambda s, d: _m(s, d, "stg_customers").groupBy("customer_state")
         .agg(F.count(F.lit(1)).alias("customers"))
         .withColumn("customer_region", region_of("customer_state")),
         _W(f"SELECT customer_state, count(*) AS customers, {oracle.region_of('customer_state')} "
            "AS customer_region FROM stg_customers GROUP BY customer_state", ["stg_customers"]))

# Weight class
register("fn_weight_class",
         lambda s, d: _m(s, d, "stg_products").groupBy(weight_class("product_weight_g").alias("product_weight_class"))
         .agg(F.count(F.lit(1)).alias("products"), F.min("product_weight_g").alias("min_weight_g"),
              F.max("product_weight_g").alias("max_weight_g")),
         _W("SELECT product_weight_class, count(*) AS products, min(product_weight_g) AS min_weight_g, "
            "max(product_weight_g) AS max_weight_g FROM (SELECT *, CASE WHEN product_weight_g IS NULL THEN "
            "'unknown' WHEN product_weight_g < 500 THEN 'light' WHEN product_weight_g < 5000 THEN 'medium' "
            "ELSE 'heavy' END AS product_weight_class FROM stg_products) GROUP BY product_weight_class",
            ["stg_products"]))

# Customer segments
register("fn_rfm_segment",
         lambda s, d: _m(s, d, "mart_customer_rfm").groupBy("customer_segment")
         .agg(F.count(F.lit(1)).alias("customers"), exact_sum("monetary_value").alias("monetary_value")),
         _W("SELECT customer_segment, count(*) AS customers, " + oracle.exact_sum("monetary_value")
            + " AS monetary_value FROM mart_customer_rfm GROUP BY customer_segment", ["mart_customer_rfm"]))

# Yyyymm partition key
register("fn_month_key",
         lambda s, d: _m(s, d, "fct_orders").groupBy(month_key("order_purchase_date").alias("yyyymm"))
         .agg(F.count(F.lit(1)).alias("orders")),
         _W("SELECT CAST(year(order_purchase_date) * 100 + month(order_purchase_date) AS INTEGER) AS yyyymm, "
            "count(*) AS orders FROM fct_orders GROUP BY 1", ["fct_orders"]))


# Skew-safe numbering inside a key: rows of hot keys cut into ordered slices, numbered per slice.
def _num_within_order(s: SparkSession, d: str) -> DataFrame:
    li = read_driver(s, d, "lineitem")
    return number_within(li, "l_orderkey", LINE_ORDER, "line_rank", hot_only=True).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "line_rank")


_rank_order = ", ".join(f"{c} ASC NULLS FIRST" for c in oracle.LINE_ORDER)
register("num_within_order", _num_within_order,
         "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, "
         f"CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY {_rank_order}) AS BIGINT) AS line_rank "
         "FROM lineitem")
