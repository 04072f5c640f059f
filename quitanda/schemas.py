"""Typed schemas of the nine raw tables and the model registry metadata.

Raw tables keep the source's types: string business keys, bigint counters,
double money and measures, ``timestamp_ntz`` for the seconds-precision
DateTime columns, ``date`` for Date columns.  Only the three order milestone
timestamps are nullable in the source DDL; we keep NULLs everywhere (no
type-default filling unless asked, see ``sources.landing.fill_type_defaults``).
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
TS, DT = T.TimestampNTZType(), T.DateType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


RAW_SCHEMAS: dict[str, T.StructType] = {
    "customers": _schema(("customer_id", S), ("customer_unique_id", S),
                         ("customer_zip_code_prefix", L), ("customer_city", S),
                         ("customer_state", S)),
    "geolocation": _schema(("geolocation_zip_code_prefix", L), ("geolocation_lat", D),
                           ("geolocation_lng", D), ("geolocation_city", S),
                           ("geolocation_state", S)),
    "orders": _schema(("order_id", S), ("customer_id", S), ("order_status", S),
                      ("order_purchase_timestamp", TS), ("order_approved_at", TS),
                      ("order_delivered_carrier_date", TS),
                      ("order_delivered_customer_date", TS),
                      ("order_estimated_delivery_date", DT)),
    "order_items": _schema(("order_id", S), ("order_item_id", L), ("product_id", S),
                           ("seller_id", S), ("shipping_limit_date", TS), ("price", D),
                           ("freight_value", D)),
    "order_payments": _schema(("order_id", S), ("payment_sequential", L), ("payment_type", S),
                              ("payment_installments", L), ("payment_value", D)),
    "order_reviews": _schema(("review_id", S), ("order_id", S), ("review_score", L),
                             ("review_comment_title", S), ("review_comment_message", S),
                             ("review_creation_date", DT), ("review_answer_timestamp", TS)),
    "products": _schema(("product_id", S), ("product_category_name", S),
                        ("product_name_lenght", I), ("product_description_lenght", D),
                        ("product_photos_qty", I), ("product_weight_g", D),
                        ("product_length_cm", D), ("product_height_cm", D),
                        ("product_width_cm", D)),
    "sellers": _schema(("seller_id", S), ("seller_zip_code_prefix", L), ("seller_city", S),
                       ("seller_state", S)),
    "product_category_name_translation": _schema(("product_category_name", S),
                                                 ("product_category_name_english", S)),
}

# Sort key of each raw table (row-group min/max pruning after sortWithinPartitions).
RAW_SORT_KEYS: dict[str, list[str]] = {
    "customers": ["customer_id"],
    "geolocation": ["geolocation_zip_code_prefix"],
    "orders": ["order_id", "customer_id"],
    "order_items": ["order_id", "order_item_id"],
    "order_payments": ["order_id", "payment_sequential"],
    "order_reviews": ["order_id", "review_id"],
    "products": ["product_id"],
    "sellers": ["seller_id"],
    "product_category_name_translation": ["product_category_name"],
}

RAW_TABLES = list(RAW_SCHEMAS)


def ddl_of(table: str, name: str | None = None, location: str | None = None) -> str:
    """``CREATE TABLE IF NOT EXISTS`` text for a raw table (Spark SQL, Parquet)."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in RAW_SCHEMAS[table].fields)
    where = f" LOCATION '{location}'" if location else ""
    return f"CREATE TABLE IF NOT EXISTS {name or table} ({cols}) USING parquet{where}"
