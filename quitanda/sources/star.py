"""Derive the nine raw retail tables from the driver's star-schema tables.

The reference ships no data besides one seed, so the raw inputs are mapped
from the driver tables (customer, orders, lineitem, part, supplier, events)
by fixed, deterministic rules.  Every rule is a built-in column expression;
the only shuffles are the orders ⟕ customer join (customer attributes per
order) and the per-order numbering of lines, only for what reads the number;
lines of hot orders are numbered slice by slice and written once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quitanda.operators.numbering import number_within
from quitanda.schemas import RAW_SCHEMAS

# State code by nation key 0..24 ('ZZ' exercises the 'unknown' region).
STATE_BY_NATION = ["SP", "RJ", "MG", "ES", "PR", "SC", "RS", "BA", "SE", "AL", "PE", "PB",
                   "RN", "CE", "PI", "MA", "DF", "GO", "MT", "MS", "AC", "RO", "AM", "RR",
                   "ZZ"]
# Payment types picked by (priority digit + sequence) % 5; 'boleto'
# is written untidy on purpose so the staging normalisation has work to do.
RAW_PAYMENT_TYPES = ["credit_card", " Boleto ", "voucher", "debit_card", "not_defined"]
# The category whose translation goes by another name.
UNTRANSLATED_TYPE = "LARGE"

LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
              "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def read_driver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of one driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_STATE_ARRAY = "array(" + ", ".join(f"'{s}'" for s in STATE_BY_NATION) + ")"


def _state(nationkey: Column) -> Column:
    return F.element_at(F.expr(_STATE_ARRAY), nationkey + 1)


def _city(nationkey: Column, trailing: bool = True) -> Column:
    parts = [F.lit(" City "), nationkey.cast("string")] + ([F.lit(" ")] if trailing else [])
    return F.concat(*parts)


def _conform(df: DataFrame, table: str) -> DataFrame:
    schema = RAW_SCHEMAS[table]
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One customer row per order (the order-level customer key)."""
    o = read_driver(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = read_driver(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    k = F.col("o_orderkey")
    df = o.join(c, o.o_custkey == c.c_custkey, "left").select(
        F.concat(F.lit("c"), k.cast("string")).alias("customer_id"),
        F.when(k % 5 == 0, F.concat(F.lit("o"), k.cast("string")))
         .otherwise(F.concat(F.lit("u"), F.col("o_custkey").cast("string")))
         .alias("customer_unique_id"),
        F.col("c_nationkey").alias("customer_zip_code_prefix"),
        _city(F.col("c_nationkey")).alias("customer_city"),
        F.concat(F.lower(_state(F.col("c_nationkey"))), F.lit(" ")).alias("customer_state"),
    )
    return _conform(df, "customers")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_driver(spark, sf_dir, "orders")
    k, st = F.col("o_orderkey"), F.col("o_orderstatus")
    purchase = F.timestamp_add("SECOND", (k * 37) % 86400, F.col("o_orderdate"))
    status = (F.when(st == "F", F.lit(" Delivered "))
              .when(st == "P", F.lit("shipped"))
              .when(k % 4 == 0, F.lit("canceled"))
              .when(k % 4 == 1, F.lit("unavailable"))
              .otherwise(F.lit("processing")))
    df = o.select(
        k.cast("string").alias("order_id"),
        F.concat(F.lit("c"), k.cast("string")).alias("customer_id"),
        status.alias("order_status"),
        purchase.alias("order_purchase_timestamp"),
        F.when(k % 7 == 0, F.lit(None)).otherwise(F.timestamp_add("HOUR", F.lit(1), purchase))
         .alias("order_approved_at"),
        F.when(st.isin("F", "P"), F.timestamp_add("DAY", F.lit(2), purchase))
         .alias("order_delivered_carrier_date"),
        F.when(st == "F", F.timestamp_add("DAY", 1 + k % 30, purchase))
         .alias("order_delivered_customer_date"),
        F.date_add(F.to_date(F.col("o_orderdate")), 24).alias("order_estimated_delivery_date"),
    )
    return _conform(df, "orders")


def raw_order_items(spark: SparkSession, sf_dir: str, numbered: bool = True) -> DataFrame:
    """lineitem rows; the item number is the line's rank inside its order.

    Numbering first counts lines and writes those of hot orders once, so an order with
    a third of all lines is spread over tasks; without it the number is NULL.
    """
    li = read_driver(spark, sf_dir, "lineitem")
    number = F.lit(None).cast("bigint")
    if numbered:
        li = number_within(li.select("l_orderkey", *LINE_ORDER), "l_orderkey", LINE_ORDER, "order_item_id",
                           hot_only=True)
        number = F.col("order_item_id")
    df = li.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        number.alias("order_item_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("freight_value"),
    )
    return _conform(df, "order_items")


def raw_order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_driver(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    seq = F.col("payment_sequential")
    digit = F.substring(F.col("o_orderpriority"), 1, 1).cast("int")
    types = F.array(*[F.lit(t) for t in RAW_PAYMENT_TYPES])
    # every order's payments are kept; those of keys that are a multiple of 41 are
    # booked under the order before (0: after) as its further payments, so these
    # orders miss in left joins
    moved = k % 41 == 0
    booked = F.when(moved, F.when(k > 0, k - 1).otherwise(k + 1)).otherwise(k)
    df = (o.select("o_orderkey", "o_orderpriority", "o_totalprice",
                  F.explode(F.sequence(F.lit(1).cast("bigint"), 1 + k % 3)).alias("payment_sequential"))
          .select(
              booked.cast("string").alias("order_id"),
              (seq + F.when(moved, 3).otherwise(0)).alias("payment_sequential"),
              F.element_at(types, ((digit + seq) % 5 + 1).cast("int")).alias("payment_type"),
              (1 + k % 10).alias("payment_installments"),
              F.when(seq == 1, F.col("o_totalprice")).otherwise((seq * 10).cast("double"))
               .alias("payment_value"),
          ))
    return _conform(df, "order_payments")


def raw_order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_driver(spark, sf_dir, "events")
    i, et = F.col("event_id"), F.col("event_type")
    df = e.select(
        i.cast("string").alias("review_id"),
        (F.floor(i / 2) * 3).cast("bigint").cast("string").alias("order_id"),
        (1 + i % 5).alias("review_score"),
        F.when(i % 3 == 0, F.lit(None).cast("string")).otherwise(et).alias("review_comment_title"),
        F.when(i % 4 == 0, F.lit(None).cast("string"))
         .when(i % 4 == 1, F.lit("   "))
         .otherwise(F.concat(F.lit(" "), et, F.lit(" "))).alias("review_comment_message"),
        F.to_date(F.col("ts")).alias("review_creation_date"),
        F.when(i % 11 == 0, F.lit(None)).otherwise(F.col("ts")).alias("review_answer_timestamp"),
    )
    return _conform(df, "order_reviews")


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_driver(spark, sf_dir, "part")
    k, size = F.col("p_partkey"), F.col("p_size")
    df = p.select(
        k.cast("string").alias("product_id"),
        F.when(k % 19 == 0, F.lit(None).cast("string"))
         .when(k % 17 == 0, F.lit(""))
         .otherwise(F.concat(F.lit(" "), F.col("p_type"), F.lit(" "))).alias("product_category_name"),
        F.char_length("p_name").alias("product_name_lenght"),
        (F.char_length("p_name") * 10).alias("product_description_lenght"),
        (size % 5).alias("product_photos_qty"),
        F.when(k % 13 == 0, F.lit(None)).otherwise(size * 200).alias("product_weight_g"),
        size.alias("product_length_cm"),
        (size + 1).alias("product_height_cm"),
        (size + 2).alias("product_width_cm"),
    )
    return _conform(df, "products")


def raw_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_driver(spark, sf_dir, "supplier")
    n = F.col("s_nationkey")
    df = s.select(
        F.col("s_suppkey").cast("string").alias("seller_id"),
        n.alias("seller_zip_code_prefix"),
        _city(n).alias("seller_city"),
        F.concat(F.lower(_state(n)), F.lit(" ")).alias("seller_state"),
    )
    return _conform(df, "sellers")


def raw_product_category_name_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_driver(spark, sf_dir, "part")
    name = F.when(F.col("p_type") == UNTRANSLATED_TYPE, "large (retired)").otherwise(F.lower("p_type"))
    df = (p.select("p_type").distinct()
          .select(name.alias("product_category_name"),
                  F.concat(F.lit("en_"), F.lower("p_type")).alias("product_category_name_english")))
    return _conform(df, "product_category_name_translation")


def raw_geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer."""
    c = read_driver(spark, sf_dir, "customer")
    n = F.col("c_nationkey")
    lat = F.col("c_acctbal") / F.lit(100.0)
    # nations with key % 6 == 0 lie under a zip that nobody else uses, so
    # customers and sellers of those zips miss the join
    df = c.select(
        (n + F.when(n % 6 == 0, 1000).otherwise(0)).alias("geolocation_zip_code_prefix"),
        lat.alias("geolocation_lat"),
        (-lat).alias("geolocation_lng"),
        _city(n, trailing=False).alias("geolocation_city"),
        F.concat(F.lower(_state(n)), F.lit(" ")).alias("geolocation_state"),
    )
    return _conform(df, "geolocation")


RAW_BUILDERS = {
    "customers": raw_customers,
    "geolocation": raw_geolocation,
    "orders": raw_orders,
    "order_items": raw_order_items,
    "order_payments": raw_order_payments,
    "order_reviews": raw_order_reviews,
    "products": raw_products,
    "sellers": raw_sellers,
    "product_category_name_translation": raw_product_category_name_translation,
}


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return RAW_BUILDERS[name](spark, sf_dir)
