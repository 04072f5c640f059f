"""Sources and sinks: naming rules, error handling, empty extracts, env selection."""

from __future__ import annotations

import pytest

from quitanda.plans.materialize import alias_name, database_for
from quitanda.session import scratch_path
from quitanda.sources.files import bulk_load_csv, table_name_of, write_csv
from quitanda.sources.jdbc import source_query
from quitanda.sources.landing import DdlError, extract_to_landing, run_ddl_folder


def test_csv_table_name_rule():
    assert table_name_of("/x/shop_orders_dataset.csv") == "shop_orders"
    assert table_name_of("/x/product_category_name_translation.csv") == "product_category_name_translation"


def test_alias_and_environment_rules():
    assert alias_name("fct_orders") == "fct_orders"
    assert alias_name("fct_orders", "gold") == "gold_fct_orders"
    assert alias_name("x", "marts", custom_alias=" y ") == "y"
    assert (database_for("prod"), database_for("dev"), database_for("staging")) == ("retail_prod", "retail_dev", "retail_dev")
    assert source_query("orders") == '(select * from staging."orders") q'


def test_bulk_load_reports_bad_file_and_continues(spark):
    base = scratch_path(spark, "csv-test")
    write_csv(spark.createDataFrame([("a", 1)], "k string, v long"), f"{base}/in/good_dataset.csv")
    write_csv(spark.createDataFrame([("x", "not a number", "1")], "a string, b string, c string"),
              f"{base}/in/customers_dataset.csv")
    statuses = {s.table: s.status for s in bulk_load_csv(spark, f"{base}/in", f"{base}/out")}
    assert statuses == {"good": "loaded", "customers": "failed"}
    assert spark.read.parquet(f"{base}/out/good").count() == 1


def test_empty_extract_reports_empty(spark):
    base = scratch_path(spark, "empty-extract")
    df = spark.createDataFrame([], "order_id string")
    st = extract_to_landing(spark, df, base, "orders", "2024-01-15")
    assert (st.status, st.rows, st.path) == ("empty", 0, None)


def test_ddl_folder_errors(spark, tmp_path):
    with pytest.raises(DdlError):
        run_ddl_folder(spark, str(tmp_path))
    (tmp_path / "a.sql").write_text("   \n")
    with pytest.raises(DdlError):
        run_ddl_folder(spark, str(tmp_path))
    (tmp_path / "a.sql").write_text("CREATE TEMPORARY VIEW ddl_probe AS SELECT 1 AS one;")
    assert len(run_ddl_folder(spark, str(tmp_path))) == 1
    assert spark.table("ddl_probe").first().one == 1


def test_incremental_load_is_exactly_once(spark):
    from quitanda.sources.landing import write_landing
    from quitanda.streaming.landing_stream import load_landing_incrementally
    from test_semantics import make_wh
    base = scratch_path(spark, "stream-once")
    rows = [("1", 1, "voucher", 1, 5.0), ("2", 1, "boleto", 2, 7.5)]
    df = make_wh(spark, order_payments=rows).table("raw.order_payments")
    write_landing(df, f"{base}/landing", "order_payments", "2024-03-01")
    first = load_landing_incrementally(spark, f"{base}/landing", "order_payments", f"{base}/raw", f"{base}/ckpt")
    assert first.count() == 2
    again = load_landing_incrementally(spark, f"{base}/landing", "order_payments", f"{base}/raw", f"{base}/ckpt")
    assert again.count() == 2          # nothing new landed: nothing loaded twice


def test_catalog_warehouse(spark):
    from quitanda.plans.models import Warehouse
    from quitanda.sources.landing import create_raw_tables
    base = scratch_path(spark, "catalog")
    db = "quitanda_cat_" + base.rsplit("-", 1)[-1]
    create_raw_tables(spark, db, base)
    spark.sql(f"INSERT INTO {db}.orders VALUES ('1', 'c1', ' Delivered ', TIMESTAMP_NTZ'2020-01-01 10:00:00', "
              "NULL, NULL, NULL, DATE'2020-01-20')")
    wh = Warehouse.from_catalog(spark, db)
    assert wh.model("stg_orders").first().is_delivered == 1


def payments(spark, n, order="1"):
    from test_semantics import make_wh
    return make_wh(spark, order_payments=[(order, i, "voucher", 1, 5.0) for i in range(n)]).table("raw.order_payments")


def test_a_day_that_becomes_empty_is_cleared(spark):
    from quitanda.schemas import RAW_SCHEMAS
    from quitanda.sources.landing import load_raw, read_landing
    base = scratch_path(spark, "emptied")
    schema = RAW_SCHEMAS["order_payments"]

    def land_and_load(n, day="2024-03-01"):
        st = extract_to_landing(spark, payments(spark, n), f"{base}/landing", "order_payments", day)
        landed = read_landing(spark, f"{base}/landing", "order_payments", day, schema)
        return st, load_raw(landed, f"{base}/raw", "order_payments", day)

    land_and_load(3, "2024-03-02")
    st, raw = land_and_load(2)
    assert (st.status, st.rows, raw.count()) == ("success", 2, 5)
    st, raw = land_and_load(0)
    assert (st.status, st.rows, raw.count()) == ("empty", 0, 3)
    assert read_landing(spark, f"{base}/landing", "order_payments", "2024-03-02", schema).count() == 3
    assert read_landing(spark, f"{base}/landing", "order_payments", "2024-03-09", schema) is None


def test_stream_replaces_a_day_that_is_extracted_again(spark):
    from quitanda.sources.landing import write_landing
    from quitanda.streaming.landing_stream import load_landing_incrementally
    base = scratch_path(spark, "stream-again")

    def load():
        return load_landing_incrementally(spark, f"{base}/landing", "order_payments", f"{base}/raw", f"{base}/ckpt")

    write_landing(payments(spark, 2), f"{base}/landing", "order_payments", "2024-03-01")
    assert load().count() == 2
    write_landing(payments(spark, 2), f"{base}/landing", "order_payments", "2024-03-01")
    assert load().count() == 2
    write_landing(payments(spark, 5), f"{base}/landing", "order_payments", "2024-03-01")
    write_landing(payments(spark, 1), f"{base}/landing", "order_payments", "2024-03-02")
    assert load().count() == 6


def test_batch_load_after_a_stream_load(spark):
    from quitanda.schemas import RAW_SCHEMAS
    from quitanda.sources.landing import load_raw, read_landing, write_landing
    from quitanda.streaming.landing_stream import load_landing_incrementally
    base = scratch_path(spark, "stream-batch")
    write_landing(payments(spark, 4), f"{base}/landing", "order_payments", "2024-03-01")
    load_landing_incrementally(spark, f"{base}/landing", "order_payments", f"{base}/raw", f"{base}/ckpt")
    write_landing(payments(spark, 2), f"{base}/landing", "order_payments", "2024-03-02")
    landed = read_landing(spark, f"{base}/landing", "order_payments", "2024-03-02", RAW_SCHEMAS["order_payments"])
    assert load_raw(landed, f"{base}/raw", "order_payments", "2024-03-02").count() == 6
    assert load_raw(landed, f"{base}/raw", "order_payments", "2024-03-02", mode="append").count() == 8


def test_landing_without_data_gives_empty_raw_tables(spark):
    from quitanda.plans.models import Warehouse
    wh = Warehouse.from_landing(spark, scratch_path(spark, "nothing"), "2024-03-01")
    assert wh.model("stg_orders").count() == 0 and wh.model("mart_executive_kpi").first().orders_count == 0


def test_jdbc_predicates():
    import datetime as dt
    from quitanda.sources.jdbc import date_predicates, hash_predicates
    parts = hash_predicates("order_id", 4)
    assert len(parts) == 4 and parts[2].endswith("% 4 = 2") and all("coalesce" in p for p in parts)
    days = date_predicates("day", dt.date(2024, 1, 1), dt.date(2024, 1, 31), 3)
    assert days == ["\"day\" < '2024-01-11' or \"day\" is null", "\"day\" >= '2024-01-11' and \"day\" < '2024-01-21'",
                    "\"day\" >= '2024-01-21'"]
    assert date_predicates("day", dt.date(2024, 1, 1), dt.date(2024, 1, 1), 8) == ["1 = 1"]
    assert len(date_predicates("day", dt.date(2024, 1, 1), dt.date(2024, 1, 3), 8)) == 3


def test_date_predicates_cover_every_row_once():
    import datetime as dt
    import duckdb
    from quitanda.sources.jdbc import date_predicates
    con = duckdb.connect()
    con.sql("CREATE TABLE t AS SELECT DATE '2023-12-20' + CAST(i AS INTEGER) AS day FROM range(60) r(i) UNION ALL SELECT NULL")
    for parts in (2, 3, 7, 50):
        clauses = date_predicates("day", dt.date(2024, 1, 1), dt.date(2024, 1, 31), parts)
        assert sum(con.sql(f"SELECT count(*) FROM t WHERE {c}").fetchall()[0][0] for c in clauses) == 61
