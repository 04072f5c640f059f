"""Scratch and checkpoint locations come from the session's spark.checkpoint.dir."""

from __future__ import annotations

from quitanda.session import ensure_checkpoint_dir, scratch_path


def test_scratch_paths_live_under_the_checkpoint_dir(spark):
    base = ensure_checkpoint_dir(spark)
    assert base and spark.conf.get("spark.checkpoint.dir") == base
    p1, p2 = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert p1.startswith(base.rstrip("/") + "/quitanda/x-") and p1 != p2
    assert scratch_path(spark, "fixed", unique=False) == base.rstrip("/") + "/quitanda/fixed"


def test_existing_checkpoint_dir_is_kept(spark):
    before = spark.conf.get("spark.checkpoint.dir")
    assert ensure_checkpoint_dir(spark) == before
    assert spark.conf.get("spark.checkpoint.dir") == before
