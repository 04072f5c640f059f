"""Centroid clustering against plain k-means over integers."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quitanda.llm import centroids

SCHEMA = "vec_id long, embedding array<float>"


def plain(rows, k=16, rounds=3, scale=64, dims=64):
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted((i is None, hashlib.sha256(f"1:{i}".encode()).hexdigest() if i is not None else "", v) for i, v in kept)[:k]
    cs = [v for _, _, v in start]

    def assign(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c)), n) for n, c in enumerate(cs))

    for _ in range(rounds):
        to = [assign(v)[1] for _, v in kept]
        cs = [[sum(col) // len(col) for col in zip(*own)] if (own := [v for (_, v), n in zip(kept, to) if n == c]) else cs[c]
              for c in range(len(cs))]
    last = [assign(v) for _, v in kept]
    inner = {c: sum(s for s, n in last if n == c) for c in range(len(cs))}
    return sorted(((i, n, s, inner[n], sum(inner.values()), hashlib.sha256(",".join(map(str, cs[n])).encode()).hexdigest())
                   for (i, _), (s, n) in zip(kept, last)), key=str)


def found(spark, rows, **options):
    from quitanda.llm.common import workers_find_package
    workers_find_package(spark)
    df = rows if hasattr(rows, "columns") else spark.createDataFrame(rows, SCHEMA)
    return sorted((tuple(r) for r in centroids.cluster(df, **options).drop("centroid").collect()), key=str)


def test_equals_plain_k_means(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(i % 7, 1.5) for _ in range(8)]) for i in range(400)]
    assert found(spark, rows, dims=8) == plain(rows, dims=8)
    assert found(spark, rows, dims=8, k=3, rounds=5) == plain(rows, dims=8, k=3, rounds=5)


def test_ties_repeats_nulls_and_lengths(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.5]) for _ in range(3)]) for i in range(80)]
    rows += rows[:10] + [(5, [0.5, 0.5, 0.5]), (None, [0.0, 0.0, 0.0]), (None, None), (6, []), (7, [1.0, 1.0]),
                         (8, [0.5, None, 0.5]), (9, [math.nan, 0.0, 0.0]), (10, [0.0, -math.inf, 0.0])]
    assert found(spark, rows, dims=3) == plain(rows, dims=3)


def test_few_vectors_and_none(spark):
    assert found(spark, [], dims=2) == []
    assert found(spark, [(1, None)], dims=2) == []
    rows = [(1, [0.5, 1.0]), (2, [0.5, 1.0]), (None, [0.25, -1.0])]
    assert found(spark, rows, dims=2) == plain(rows, dims=2)


def test_other_columns_have_any_name(spark):
    rows = [(i, [float(i % 5), float(i % 3)]) for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns(
        {c: F.lit("mine") for c in ("vec", "cluster", "distance", "n", "total", "inertia", "centroid")})
    assert found(spark, df, dims=2) == plain(rows, dims=2)


def test_large_components_raise(spark):
    with pytest.raises(Exception, match="might not fit"):
        found(spark, [(i, [1e30, 0.0]) for i in range(30)], dims=2)


def test_walk_finds_the_nearest_and_stops_early():
    rng = np.random.default_rng(3)
    cs = rng.integers(-60, 60, (16, 64))
    block = cs[rng.integers(0, 16, 500)] + rng.integers(-4, 5, (500, 64))
    number, away = centroids.nearest(block, cs)
    every = ((block[:, None, :] - cs[None]) ** 2).sum(axis=2)
    assert (number == every.argmin(axis=1)).all() and (away == every.min(axis=1)).all()
    small = rng.integers(-2, 3, (300, 2))  # equal values and distances everywhere
    few = rng.integers(-2, 3, (16, 2))
    number, away = centroids.nearest(small, few)
    every = ((small[:, None, :] - few[None]) ** 2).sum(axis=2)
    assert (number == every.argmin(axis=1)).all() and (away == every.min(axis=1)).all()
