"""Model registry and the ``Warehouse`` that resolves models lazily.

Each model is a function of DataFrames; ``ref()`` of the source project is a
function argument here.  ``Warehouse.model(name)`` builds the lazy plan of a
model from its parents (memoised per warehouse), so a query is one Catalyst
plan from the raw scans to the result — views are inlined, unused columns
pruned, filters pushed to the scans.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from quitanda.plans import analytics, core, intermediate, staging


@dataclass(frozen=True)
class ModelSpec:
    name: str
    layer: str                      # staging | intermediate | core | analytics
    build: Callable[..., DataFrame]
    parents: tuple[str, ...]        # "raw.<table>" or another model's name
    materialized: str = "table"     # view | table
    sort_by: tuple[str, ...] = ()
    partition_month_of: str | None = None   # date column whose yyyymm partitions the table
    bucket_by: str | None = None            # key of the buckets of a catalog table
    # the same rows from other parents, for a plan in which the first parent isn't a written table
    inline: tuple[Callable[..., DataFrame], tuple[str, ...]] | None = None
    # the same rows as a narrow stream of written parents, for the shuffles of a table's write
    stream: Callable[..., core.RowStream] | None = None


def _spec(name, layer, build, parents, materialized="table", sort_by=(), month_of=None, bucket_by=None,
          inline=None, stream=None):
    return ModelSpec(name, layer, build, tuple(parents), materialized, tuple(sort_by), month_of, bucket_by, inline,
                     stream)


MODELS: dict[str, ModelSpec] = {s.name: s for s in [
    _spec("stg_customers", "staging", staging.stg_customers, ["raw.customers"], "view"),
    _spec("stg_geolocation", "staging", staging.stg_geolocation, ["raw.geolocation"], "view"),
    _spec("stg_orders", "staging", staging.stg_orders, ["raw.orders"], "view"),
    _spec("stg_order_items", "staging", staging.stg_order_items, ["raw.order_items"], "view"),
    _spec("stg_order_payments", "staging", staging.stg_order_payments, ["raw.order_payments"], "view"),
    _spec("stg_order_reviews", "staging", staging.stg_order_reviews, ["raw.order_reviews"], "view"),
    _spec("stg_products", "staging", staging.stg_products, ["raw.products"], "view"),
    _spec("stg_sellers", "staging", staging.stg_sellers, ["raw.sellers"], "view"),
    _spec("stg_product_category_name_translation", "staging",
          staging.stg_product_category_name_translation,
          ["raw.product_category_name_translation"], "view"),
    _spec("int_geolocation_zip", "intermediate", intermediate.int_geolocation_zip,
          ["stg_geolocation"], sort_by=["geolocation_zip_code_prefix"]),
    _spec("int_order_items_by_order", "intermediate", intermediate.int_order_items_by_order,
          ["stg_order_items"], sort_by=["order_id"], bucket_by="order_id"),
    _spec("int_payments_by_order", "intermediate", intermediate.int_payments_by_order,
          ["stg_order_payments"], sort_by=["order_id"], bucket_by="order_id"),
    _spec("int_reviews_by_order", "intermediate", intermediate.int_reviews_by_order,
          ["stg_order_reviews"], sort_by=["order_id"], bucket_by="order_id"),
    _spec("int_orders_enriched", "intermediate", intermediate.int_orders_enriched,
          ["stg_orders", "int_order_items_by_order", "int_payments_by_order",
           "int_reviews_by_order"], sort_by=["order_purchase_date", "order_id"],
          month_of="order_purchase_date"),
    _spec("dim_customers", "core", core.dim_customers, ["stg_customers", "int_geolocation_zip"],
          sort_by=["customer_id"]),
    _spec("dim_sellers", "core", core.dim_sellers, ["stg_sellers", "int_geolocation_zip"],
          sort_by=["seller_id"]),
    _spec("dim_products", "core", core.dim_products,
          ["stg_products", "stg_product_category_name_translation"], sort_by=["product_id"]),
    _spec("dim_date", "core", core.dim_date, ["stg_orders", "stg_order_reviews"],
          sort_by=["date_day"]),
    _spec("fct_orders", "core", core.fct_orders, ["int_orders_enriched", "dim_customers"],
          sort_by=["order_purchase_date", "order_id"], month_of="order_purchase_date",
          inline=(core.fct_orders_from_rollups,
                  ("stg_orders", "int_order_items_by_order", "int_payments_by_order", "int_reviews_by_order",
                   "dim_customers"))),
    _spec("fct_order_items", "core", core.fct_order_items,
          ["stg_order_items", "fct_orders", "dim_products", "dim_sellers"],
          sort_by=["order_purchase_date", "order_id", "order_item_id"],
          month_of="order_purchase_date", stream=core.item_stream),
    _spec("fct_payments", "core", core.fct_payments, ["stg_order_payments", "fct_orders"],
          sort_by=["order_purchase_date", "order_id", "payment_sequential"],
          month_of="order_purchase_date"),
    _spec("fct_reviews", "core", core.fct_reviews, ["stg_order_reviews", "fct_orders"],
          sort_by=["review_creation_date_day", "order_id", "review_id"],
          month_of="review_creation_date_day"),
    _spec("mart_sales_daily", "analytics", analytics.mart_sales_daily, ["fct_orders"],
          sort_by=["sales_date"]),
    _spec("mart_sales_monthly", "analytics", analytics.mart_sales_monthly, ["fct_orders"],
          sort_by=["sales_month"]),
    _spec("mart_customer_rfm", "analytics", analytics.mart_customer_rfm, ["fct_orders"],
          sort_by=["customer_unique_id"]),
    _spec("mart_product_performance", "analytics", analytics.mart_product_performance,
          ["fct_order_items", "dim_products"], sort_by=["product_category_name_english", "product_id"]),
    _spec("mart_seller_performance", "analytics", analytics.mart_seller_performance,
          ["fct_order_items", "dim_sellers"], sort_by=["seller_state", "seller_id"]),
    _spec("mart_delivery_performance", "analytics", analytics.mart_delivery_performance,
          ["fct_orders"], sort_by=["sales_month", "customer_state"]),
    _spec("mart_review_performance", "analytics", analytics.mart_review_performance,
          ["fct_reviews"], sort_by=["review_month", "review_score"]),
    _spec("mart_payment_performance", "analytics", analytics.mart_payment_performance,
          ["fct_payments"], sort_by=["sales_month", "payment_type"]),
    _spec("mart_geo_sales_state", "analytics", analytics.mart_geo_sales_state, ["fct_orders"],
          sort_by=["customer_region", "customer_state"]),
    _spec("mart_executive_kpi", "analytics", analytics.mart_executive_kpi, ["fct_orders"],
          sort_by=["kpi_grain"]),
    _spec("mart_dashboard_sales_detail", "analytics", analytics.mart_dashboard_sales_detail,
          ["fct_order_items", "fct_orders"],
          sort_by=["order_purchase_date", "order_id", "order_item_id"],
          month_of="order_purchase_date",
          inline=(analytics.dashboard_from_items, ("stg_order_items", "fct_orders", "dim_products", "dim_sellers")),
          stream=analytics.dashboard_stream),
]}

#: Raw columns that cost a pass of their own to derive, and the models whose rows hold them; any other
#: model is built on the raw table without the column.
DERIVED_BY = {"raw.order_items": ("stg_order_items", "fct_order_items", "mart_dashboard_sales_detail")}

LAYERS = ["staging", "intermediate", "core", "analytics"]


def models_in(layer: str) -> list[str]:
    return [name for name, spec in MODELS.items() if spec.layer == layer]


@dataclass
class Warehouse:
    """Resolves raw tables and models to lazy DataFrames.

    ``raw`` maps a raw table name to a zero-argument DataFrame factory (the
    star fixture mapping, landing Parquet, a JDBC extract, or a catalog
    table).  ``overrides`` replaces any model with an already materialised
    DataFrame (used by the layered build to read written tables back).
    """
    spark: SparkSession
    raw: dict[str, Callable[[], DataFrame]]
    overrides: dict[str, DataFrame] = field(default_factory=dict)
    #: Raw tables without the columns of ``DERIVED_BY``, where these are derived on reading.
    raw_without: dict[str, Callable[[], DataFrame]] = field(default_factory=dict)
    _memo: dict[tuple[str, bool], DataFrame] = field(default_factory=dict)

    @classmethod
    def from_star(cls, spark: SparkSession, sf_dir: str) -> "Warehouse":
        from quitanda.sources.star import RAW_BUILDERS, raw_order_items
        return cls(spark, {name: (lambda b=b: b(spark, sf_dir)) for name, b in RAW_BUILDERS.items()},
                   raw_without={"order_items": lambda: raw_order_items(spark, sf_dir, numbered=False)})

    @classmethod
    def from_tables(cls, spark: SparkSession, paths: dict[str, str]) -> "Warehouse":
        """Raw tables read from Parquet folders (e.g. a loaded raw layer).

        The registry schema is given to the reader, so no file footer is read
        to infer it; load-date partition columns are still discovered.
        """
        from quitanda.schemas import RAW_SCHEMAS

        def reader(name: str, path: str):
            schema = RAW_SCHEMAS.get(name)
            r = spark.read.schema(schema) if schema is not None else spark.read
            return lambda: r.parquet(path)
        return cls(spark, {name: reader(name, p) for name, p in paths.items()})

    @classmethod
    def from_landing(cls, spark: SparkSession, landing_base: str, load_date: str,
                     env: str | None = None) -> "Warehouse":
        """Raw tables read straight from one load date of the landing zone
        (typed by the registry schema, partition-pruned to that date)."""
        from quitanda.schemas import RAW_SCHEMAS
        from quitanda.sources.landing import read_landing

        def reader(table: str) -> DataFrame:
            landed = read_landing(spark, landing_base, table, load_date, RAW_SCHEMAS[table], env)
            return landed if landed is not None else spark.createDataFrame([], RAW_SCHEMAS[table])
        return cls(spark, {t: (lambda t=t: reader(t)) for t in RAW_SCHEMAS})

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str) -> "Warehouse":
        """Raw tables from the catalog (created by ``sources.landing.create_raw_tables``)."""
        from quitanda.schemas import RAW_SCHEMAS
        return cls(spark, {t: (lambda t=t: spark.table(f"{database}.{t}")) for t in RAW_SCHEMAS})

    def table(self, ref: str) -> DataFrame:
        return self._resolve(ref, True)

    def model(self, name: str, derived: bool | None = None) -> DataFrame:
        """A model's plan; ``derived=False`` leaves the columns of ``DERIVED_BY`` NULL where nothing reads them."""
        if derived is None:
            derived = any(name in readers for readers in DERIVED_BY.values())
        return self._resolve(name, derived)

    def stream(self, name: str) -> core.RowStream | None:
        """A model's rows as the narrow stream of its ``ModelSpec``, where its other tables are written."""
        spec = MODELS[name]
        if spec.stream is None or not all(p in self.overrides or MODELS[p].materialized == "view" for p in spec.parents):
            return None
        return spec.stream(*[self.model(p) for p in spec.parents])

    def _resolve(self, ref: str, derived: bool) -> DataFrame:
        """A raw table or model; ``derived`` tells whether the columns of ``DERIVED_BY`` are read."""
        if ref in self.overrides:
            return self.overrides[ref]
        if (ref, derived) not in self._memo:
            if ref.startswith("raw."):
                without = None if derived else self.raw_without.get(ref[4:])
                found = (without or self.raw[ref[4:]])()
            else:
                spec = MODELS[ref]
                build, parents = spec.build, spec.parents
                if spec.inline and parents[0] not in self.overrides:
                    build, parents = spec.inline
                found = build(*[self._resolve(p, derived) for p in parents])
            self._memo[(ref, derived)] = found
        return self._memo[(ref, derived)]
