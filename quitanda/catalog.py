"""The registered queries and their SQL oracles.

* the 33 models, by name;
* ``dq_*``: the data-quality operators applied to model columns, and the full suite;
* ``join_*``, ``agg_*``, ``fn_*``, ``gen_*``, ``num_*``: single operators the models use,
  isolated on the model data (``catalog_ops``);
* ``io_*``: sources and sinks, round-tripping model data through storage (``catalog_io``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quitanda import oracle
from quitanda.functions.classify import REGION_STATES
from quitanda.operators import quality as dq
from quitanda.plans.models import LAYERS, MODELS, Warehouse, models_in
from quitanda.plans.suite import SUITE
from quitanda.sources.star import read_driver

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def _model_query(name: str) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return Warehouse.from_star(spark, sf_dir).model(name)
    run.__name__ = f"query_{name}"
    return run


for _name in MODELS:
    QUERIES[_name] = _model_query(_name)
    ORACLES[_name] = oracle.model_sql(_name)


def register(name: str, fn: QueryFn, sql: str | None) -> None:
    QUERIES[name] = fn
    if sql is not None:
        ORACLES[name] = sql


def _wh(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse.from_star(spark, sf_dir)


# ------------------------------------------------------------------ data quality
ALL_STATES = [s for _, states in REGION_STATES for s in states]
_W = oracle.with_ctes


def _sql_values(values) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


register("dq_not_null",
         lambda s, d: dq.not_null_violations(_wh(s, d).model("stg_order_reviews"), "review_comment_title"),
         _W("SELECT * FROM stg_order_reviews WHERE review_comment_title IS NULL", ["stg_order_reviews"]))

register("dq_unique",
         lambda s, d: dq.unique_violations(_wh(s, d).model("stg_order_reviews"), "order_id"),
         _W("SELECT order_id AS unique_field, count(*) AS n_records FROM stg_order_reviews "
            "WHERE order_id IS NOT NULL GROUP BY order_id HAVING count(*) > 1", ["stg_order_reviews"]))

register("dq_accepted_values",
         lambda s, d: dq.accepted_values_violations(_wh(s, d).model("dim_customers"), "customer_state",
                                                    ALL_STATES),
         _W("SELECT value_field, n_records FROM (SELECT customer_state AS value_field, count(*) AS n_records "
            "FROM dim_customers GROUP BY customer_state) "
            f"WHERE value_field NOT IN ({_sql_values(oracle.ALL_STATES)})", ["dim_customers"]))

register("dq_relationships",
         lambda s, d: dq.relationships_violations(_wh(s, d).model("dim_customers"), "customer_zip_code_prefix",
                                                  _wh(s, d).model("int_geolocation_zip"),
                                                  "geolocation_zip_code_prefix"),
         _W("SELECT c.customer_zip_code_prefix AS from_field FROM dim_customers c "
            "WHERE c.customer_zip_code_prefix IS NOT NULL AND NOT EXISTS (SELECT 1 FROM int_geolocation_zip g "
            "WHERE g.geolocation_zip_code_prefix = c.customer_zip_code_prefix)",
            ["dim_customers", "int_geolocation_zip"]))

register("dq_non_negative",
         lambda s, d: dq.non_negative_violations(_wh(s, d).model("int_orders_enriched"), "delivery_delay_days"),
         _W("SELECT * FROM int_orders_enriched WHERE delivery_delay_days < 0", ["int_orders_enriched"]))

register("dq_unique_combination",
         lambda s, d: dq.unique_combination_violations(read_driver(s, d, "lineitem"),
                                                       ["l_orderkey", "l_linenumber"]),
         "SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem "
         "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")


def _suite_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quitanda.plans.pipeline import run_pipeline
    from quitanda.session import scratch_path
    result = run_pipeline(spark, _wh(spark, sf_dir), scratch_path(spark, "suite"), gate=False)
    return dq.summarize(result.test_results)


def _check_sql(model: str, layer: str, c: dq.Check) -> str:
    col = c.column_label
    if c.kind == "not_null":
        v = f"(SELECT count(*) FROM {model} WHERE {c.column} IS NULL)"
    elif c.kind == "non_negative":
        v = f"(SELECT count(*) FROM {model} WHERE {c.column} < 0)"
    elif c.kind == "accepted_values":
        v = (f"(SELECT count(DISTINCT {c.column}) FROM {model} WHERE {c.column} IS NOT NULL "
             f"AND {c.column} NOT IN ({_sql_values(oracle.ACCEPTED[c.column])}))")
    elif c.kind == "unique":
        v = (f"(SELECT count(*) FROM (SELECT {c.column} FROM {model} WHERE {c.column} IS NOT NULL "
             f"GROUP BY {c.column} HAVING count(*) > 1))")
    elif c.kind == "relationships":
        v = (f"(SELECT count(*) FROM {model} ch WHERE ch.{c.column} IS NOT NULL AND NOT EXISTS "
             f"(SELECT 1 FROM {c.to} pa WHERE pa.{c.field} = ch.{c.column}))")
    else:
        cols = ", ".join(c.column)
        v = f"(SELECT count(*) FROM (SELECT 1 FROM {model} GROUP BY {cols} HAVING count(*) > 1))"
    return (f"SELECT '{model}' AS model, '{c.kind}' AS test_name, '{col}' AS column_name, "
            f"CAST({v} AS BIGINT) AS violations, '{layer}' AS layer, {v} = 0 AS passed")


def _suite_sql() -> str:
    selects = []
    for layer in LAYERS:
        for model in models_in(layer):
            for c in SUITE.by_model.get(model, []):
                selects.append(_check_sql(model, layer, c))
    return _W("\nUNION ALL\n".join(selects), list(MODELS))


register("dq_suite_summary", _suite_summary, _suite_sql())

# these modules import ``register`` from here, so they come last
import quitanda.catalog_ops  # noqa: E402,F401  (registers the single-operator queries)
import quitanda.catalog_io  # noqa: E402,F401  (registers the source/sink round trips)
