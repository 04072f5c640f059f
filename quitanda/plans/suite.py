"""The declared data-quality tests of every model (240 declarations).

Fixed values: the declarations mirror the source project's schema files —
model, column, test kind and its arguments, in file order.
"""

from __future__ import annotations

from quitanda.functions.classify import (ORDER_STATUSES, PAYMENT_TYPES, REGIONS, SEGMENTS,
                                         WEIGHT_CLASSES)
from quitanda.operators.quality import Check, Declarations


def nn(c): return Check("not_null", c)                     # noqa: E704
def uq(c): return Check("unique", c)                       # noqa: E704
def nonneg(c): return Check("non_negative", c)             # noqa: E704
def av(c, vals): return Check("accepted_values", c, tuple(vals))  # noqa: E704
def rel(c, to, fld): return Check("relationships", c, to=to, field=fld)  # noqa: E704
def uc(*cols): return Check("unique_combination", tuple(cols))  # noqa: E704


FLAG = [0, 1]
SCORES = [1, 2, 3, 4, 5]

SUITE = Declarations({
    # staging (50)
    "stg_customers": [nn("customer_id"), uq("customer_id"), nn("customer_unique_id")],
    "stg_geolocation": [nn("geolocation_zip_code_prefix")],
    "stg_orders": [nn("order_id"), uq("order_id"), nn("customer_id"),
                   rel("customer_id", "stg_customers", "customer_id"),
                   nn("order_status"), av("order_status", ORDER_STATUSES),
                   nn("order_purchase_timestamp"), nn("order_purchase_date"),
                   av("is_delivered", FLAG), av("is_canceled", FLAG)],
    "stg_order_items": [uc("order_id", "order_item_id"), nn("order_id"),
                        rel("order_id", "stg_orders", "order_id"), nn("order_item_id"),
                        nn("product_id"), rel("product_id", "stg_products", "product_id"),
                        nn("seller_id"), rel("seller_id", "stg_sellers", "seller_id"),
                        nn("price"), nonneg("price"), nn("freight_value"), nonneg("freight_value"),
                        nn("item_total_value"), nonneg("item_total_value")],
    "stg_order_payments": [uc("order_id", "payment_sequential"), nn("order_id"),
                           rel("order_id", "stg_orders", "order_id"), nn("payment_type"),
                           av("payment_type", PAYMENT_TYPES), nn("payment_value"),
                           nonneg("payment_value")],
    "stg_order_reviews": [nn("review_id"), nn("order_id"),
                          rel("order_id", "stg_orders", "order_id"), nn("review_score"),
                          av("review_score", SCORES), av("has_review_comment", FLAG)],
    "stg_products": [nn("product_id"), uq("product_id"), nonneg("product_weight_g"),
                     nonneg("product_volume_cm3")],
    "stg_sellers": [nn("seller_id"), uq("seller_id")],
    "stg_product_category_name_translation": [nn("product_category_name"),
                                              uq("product_category_name"),
                                              nn("product_category_name_english")],
    # intermediate (46)
    "int_geolocation_zip": [nn("geolocation_zip_code_prefix"), uq("geolocation_zip_code_prefix"),
                            nonneg("geolocation_records")],
    "int_order_items_by_order": [nn("order_id"), uq("order_id"),
                                 rel("order_id", "stg_orders", "order_id"),
                                 nn("item_count"), nonneg("item_count"),
                                 nn("order_item_value"), nonneg("order_item_value"),
                                 nn("order_freight_value"), nonneg("order_freight_value"),
                                 nn("order_total_value"), nonneg("order_total_value")],
    "int_payments_by_order": [nn("order_id"), uq("order_id"),
                              rel("order_id", "stg_orders", "order_id"),
                              nn("payment_count"), nonneg("payment_count"),
                              nn("payment_value"), nonneg("payment_value"),
                              nonneg("max_payment_installments")],
    "int_reviews_by_order": [nn("order_id"), uq("order_id"),
                             rel("order_id", "stg_orders", "order_id"),
                             nn("review_count"), nonneg("review_count"),
                             av("latest_review_score", SCORES), av("has_review_comment", FLAG)],
    "int_orders_enriched": [nn("order_id"), uq("order_id"), nn("customer_id"),
                            rel("customer_id", "stg_customers", "customer_id"),
                            nn("order_status"), nn("order_purchase_date"),
                            nn("item_count"), nonneg("item_count"),
                            nn("order_item_value"), nonneg("order_item_value"),
                            nn("order_freight_value"), nonneg("order_freight_value"),
                            nn("order_total_value"), nonneg("order_total_value"),
                            nn("payment_value"), nonneg("payment_value"),
                            av("is_late_delivery", FLAG)],
    # core (61)
    "dim_date": [nn("date_day"), uq("date_day"), nn("year"), nn("month"), av("is_weekend", FLAG)],
    "dim_customers": [nn("customer_id"), uq("customer_id"), nn("customer_unique_id"),
                      av("customer_region", REGIONS)],
    "dim_sellers": [nn("seller_id"), uq("seller_id"), av("seller_region", REGIONS)],
    "dim_products": [nn("product_id"), uq("product_id"), nn("product_category_name_english"),
                     av("product_weight_class", WEIGHT_CLASSES), nonneg("product_volume_cm3")],
    "fct_orders": [nn("order_id"), uq("order_id"), nn("customer_id"),
                   rel("customer_id", "dim_customers", "customer_id"),
                   nn("order_purchase_date"), rel("order_purchase_date", "dim_date", "date_day"),
                   nn("order_status"), nn("order_item_value"), nonneg("order_item_value"),
                   nn("order_freight_value"), nonneg("order_freight_value"),
                   nn("order_total_value"), nonneg("order_total_value"),
                   nn("payment_value"), nonneg("payment_value"),
                   av("is_delivered", FLAG), av("is_late_delivery", FLAG)],
    "fct_order_items": [uc("order_id", "order_item_id"), nn("order_id"),
                        rel("order_id", "fct_orders", "order_id"), nn("product_id"),
                        rel("product_id", "dim_products", "product_id"), nn("seller_id"),
                        rel("seller_id", "dim_sellers", "seller_id"), nn("price"), nonneg("price"),
                        nn("freight_value"), nonneg("freight_value"), nn("item_total_value"),
                        nonneg("item_total_value")],
    "fct_payments": [uc("order_id", "payment_sequential"), nn("order_id"),
                     rel("order_id", "fct_orders", "order_id"), nn("payment_type"),
                     av("payment_type", PAYMENT_TYPES), nn("payment_value"),
                     nonneg("payment_value")],
    "fct_reviews": [nn("review_id"), nn("order_id"), rel("order_id", "fct_orders", "order_id"),
                    nn("review_creation_date_day"),
                    rel("review_creation_date_day", "dim_date", "date_day"),
                    nn("review_score"), av("review_score", SCORES)],
    # analytics (83)
    "mart_sales_daily": [nn("sales_date"), uq("sales_date"), nn("orders_count"),
                         nonneg("orders_count"), nn("revenue"), nonneg("revenue"),
                         nn("gross_revenue"), nonneg("gross_revenue"), nonneg("avg_order_value")],
    "mart_sales_monthly": [nn("sales_month"), uq("sales_month"), nn("orders_count"),
                           nonneg("orders_count"), nn("customers_count"),
                           nonneg("customers_count"), nn("revenue"), nonneg("revenue")],
    "mart_customer_rfm": [nn("customer_unique_id"), uq("customer_unique_id"),
                          nn("recency_days"), nonneg("recency_days"), nn("total_orders"),
                          nonneg("total_orders"), nn("monetary_value"), nonneg("monetary_value"),
                          nn("customer_segment"), av("customer_segment", SEGMENTS)],
    "mart_product_performance": [nn("product_id"), uq("product_id"),
                                 nn("product_category_name_english"), nn("orders_count"),
                                 nonneg("orders_count"), nn("revenue"), nonneg("revenue")],
    "mart_seller_performance": [nn("seller_id"), uq("seller_id"), nn("orders_count"),
                                nonneg("orders_count"), nn("revenue"), nonneg("revenue"),
                                nn("late_item_lines_count"), nonneg("late_item_lines_count")],
    "mart_delivery_performance": [uc("sales_month", "customer_state", "customer_region"),
                                  nn("sales_month"), nn("customer_state"), nn("orders_count"),
                                  nonneg("orders_count"), nn("late_orders_count"),
                                  nonneg("late_orders_count")],
    "mart_review_performance": [uc("review_month", "review_score"), nn("review_month"),
                                nn("review_score"), av("review_score", SCORES),
                                nn("reviews_count"), nonneg("reviews_count")],
    "mart_payment_performance": [uc("sales_month", "payment_type"), nn("sales_month"),
                                 nn("payment_type"), av("payment_type", PAYMENT_TYPES),
                                 nn("payment_value"), nonneg("payment_value")],
    "mart_geo_sales_state": [nn("customer_state"), uq("customer_state"), nn("orders_count"),
                             nonneg("orders_count"), nn("revenue"), nonneg("revenue")],
    "mart_executive_kpi": [nn("kpi_grain"), uq("kpi_grain"), nn("orders_count"),
                           nonneg("orders_count"), nn("revenue"), nonneg("revenue")],
    "mart_dashboard_sales_detail": [uc("order_id", "order_item_id"), nn("order_id"),
                                    nn("order_item_id"), nn("order_purchase_date"),
                                    nn("product_id"), nn("seller_id"), nn("item_revenue"),
                                    nonneg("item_revenue"), nn("item_total_value"),
                                    nonneg("item_total_value")],
})
