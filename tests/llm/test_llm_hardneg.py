"""Hard negatives against every score taken one by one."""

from __future__ import annotations

import math
import random

import numpy as np
from pyspark.sql import functions as F

from quitanda.llm import hardneg

SCHEMA = "vec_id long, label int, embedding array<float>"


def plain(rows, scale=256, positives=5, negatives=10, least=30, most=90):
    """All results; ties of equal ids are broken by position, which the ids returned do not show."""
    good = [(i, label, [math.floor(scale * float(np.float32(x))) for x in v]) for i, label, v in rows
            if label is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    order = lambda s: (-s[0], s[1] is None, s[1] or 0, s[2])
    for n, (a_id, a_label, a) in enumerate(good):
        if a_id is None or a_id % 100:
            continue
        scored = [(sum(x * y for x, y in zip(a, v)), i, m, label) for m, (i, label, v) in enumerate(good)
                  if m != n and len(v) == len(a)]
        for p in sorted((s for s in scored if s[3] == a_label), key=order)[:positives]:
            fits = sorted((s for s in scored if s[3] != a_label and least * p[0] <= 100 * s[0] <= most * p[0]), key=order)
            out += [(a_id, p[1], rank, s[1], p[0], s[0]) for rank, s in enumerate(fits[:negatives], 1)]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()), key=str)


def rows_of(n, seed, labels=4, dim=12, step=1):
    rng = random.Random(seed)
    centres = [[rng.uniform(-1, 1) for _ in range(dim)] for _ in range(labels)]
    return [(i * step, rng.randrange(labels), [c + rng.gauss(0, 0.6) for c in rng.choice(centres)]) for i in range(n)]


def mined(spark, rows, **options):
    from quitanda.llm.common import workers_find_package
    workers_find_package(spark)
    return hardneg.mine(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0, **options)


def test_blocks_and_pilot_equal_brute_force(spark):
    rows = rows_of(700, 1, step=10)  # every tenth is an anchor
    want = plain(rows)
    assert len(want) > 500
    assert found(mined(spark, rows)) == want
    assert found(mined(spark, rows, block_anchors=16, block_rows=64)) == want


def test_ties_repeats_nulls_and_lengths(spark):
    rng = random.Random(2)
    rows = [(i, i % 3, [rng.choice([0.0, 0.25, 0.5]) for _ in range(4)]) for i in range(120)]  # many equal scores
    rows += [(100, 1, [0.5, 0.5, 0.5, 0.5])] * 2 + rows[:3]  # repeated anchors and rows
    rows += [(None, 1, [0.5, 0.25, 0.5, 0.25]), (None, 2, [0.25, 0.25, 0.25, 0.25]), (200, None, [0.5] * 4), (300, 1, None),
             (400, 1, []), (500, 2, [0.5, None, 0.5, 0.5]), (600, 2, [0.5, math.nan, 0.5, 0.5]), (700, 2, [math.inf] * 4),
             (800, 1, [0.5, 0.5]), (801, 1, [0.5, 0.25]), (802, 2, [0.25, 0.25]), (900, 9, [0.5] * 4), (1000, 0, [-0.5] * 4)]
    assert found(mined(spark, rows)) == plain(rows)
    assert found(mined(spark, rows, block_anchors=2, block_rows=16)) == plain(rows)


def test_few_rows_and_none(spark):
    assert mined(spark, []).collect() == []
    assert mined(spark, [(100, 1, [0.5, 0.5])]).collect() == []
    assert mined(spark, [(1, 1, [0.5, 0.5]), (2, 2, [0.5, 0.25])]).collect() == []  # no anchor
    rows = [(100, 1, [0.5, 0.5]), (1, 1, [0.5, 0.5]), (2, 2, [0.25, 0.25])]
    assert found(mined(spark, rows)) == plain(rows) != []


def test_other_columns_have_any_name(spark):
    from quitanda.llm.common import workers_find_package
    workers_find_package(spark)
    rows = rows_of(200, 4, step=20)
    extra = spark.createDataFrame(rows, SCHEMA).withColumns(
        {c: F.lit("mine") for c in ("row_id", "comps", "summary", "part", "block", "low", "high", "floor", "own", "anchor", "dim")})
    assert found(hardneg.mine(extra, F.col("vec_id") % 100 == 0)) == plain(rows)


def test_bounds_hold_and_tighten():
    rng = np.random.default_rng(1)
    comps = rng.integers(-300, 300, (60, 64))
    levels = hardneg.by_level(hardneg.summaries(comps), 64)
    exact = hardneg.exact_scores(comps, comps)
    assert (exact == comps @ comps.T).all()
    before = None
    for mean, spread in levels:
        middle, width = mean @ mean.T, spread @ spread.T + 1e-3
        assert (exact <= middle + width).all() and (exact >= middle - width).all()
        if before is not None:
            assert (middle + width <= before + 1e-2).all()
        before = middle + width


def test_bounds_leave_most_pairs_unscored(monkeypatch):
    """Vectors near a few centres: the exact product is taken for a small part of the pairs."""
    import pyarrow as pa
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 200, (20, 8)).repeat(8, axis=1)
    comps = (centres[rng.integers(0, 20, 2000)] + rng.normal(0, 20, (2000, 64))).astype(np.int64)
    labels = rng.integers(0, 5, 2000)
    table = pa.table({"row_id": np.arange(2000), "vec_id": np.arange(2000), "label": labels, "dim": np.full(2000, 64),
                      "comps": hardneg._lists(comps), "summary": hardneg._lists(hardneg.summaries(comps))})
    one = pa.array([[hardneg._LOW + 1]] * 50)
    anchors = table.slice(0, 50).append_column("low", one).append_column("floor", one).append_column(
        "high", pa.array([[hardneg._HIGH]] * 50))
    scored = []
    real = hardneg.exact_scores
    monkeypatch.setattr(hardneg, "exact_scores", lambda a, b: scored.append(len(a) * len(b)) or real(a, b))
    hardneg.search_block(anchors, table, 5, True)
    assert sum(scored) < 0.6 * 50 * 2000
