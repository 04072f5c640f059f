"""The command line: fixture raw tables → landing → raw → one model."""

from __future__ import annotations

from conftest import SF_SMALL
from quitanda.__main__ import main
from quitanda.session import scratch_path


def test_star_land_load_model(spark, capsys):
    base = scratch_path(spark, "cli")
    assert main(["star", "--sf-dir", SF_SMALL, "--raw-root", f"{base}/raw"]) == 0
    assert main(["land", "--raw-root", f"{base}/raw", "--landing", f"{base}/landing", "--date", "2024-02-01"]) == 0
    assert main(["load", "--landing", f"{base}/landing", "--raw-root", f"{base}/raw2", "--date", "2024-02-01"]) == 0
    assert main(["model", "mart_executive_kpi", "--raw-root", f"{base}/raw2", "--out", f"{base}/out"]) == 0
    kpi = spark.read.parquet(f"{base}/out/mart_executive_kpi").first()
    assert (kpi.orders_count, kpi.revenue) == (1500, 317364757.31)
    assert '"status": "success"' in capsys.readouterr().out



def test_models_from_a_landing_date(spark):
    from quitanda.plans.models import Warehouse
    base = scratch_path(spark, "from-landing")
    assert main(["star", "--sf-dir", SF_SMALL, "--raw-root", f"{base}/raw"]) == 0
    assert main(["land", "--raw-root", f"{base}/raw", "--landing", f"{base}/landing", "--date", "2024-02-02"]) == 0
    got = Warehouse.from_landing(spark, f"{base}/landing", "2024-02-02").model("mart_executive_kpi").first()
    want = Warehouse.from_star(spark, SF_SMALL).model("mart_executive_kpi").first()
    assert got == want
