"""Property tests: exact money aggregates equal decimal arithmetic, in any row order."""

from __future__ import annotations

from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quitanda.functions import exact_avg, exact_sum, exact_sum_if, safe_divide

cents = st.integers(min_value=-10**9, max_value=10**9)


@settings(max_examples=25, deadline=None)
@given(st.lists(cents, min_size=1, max_size=40), st.integers(min_value=1, max_value=6))
def test_exact_sum_and_avg_are_exact(spark, values, parts):
    rows = [(i % 3, v / 100) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "g int, x double").repartition(parts)
    got = {r.g: (r.s, r.a, r.p) for r in df.groupBy("g").agg(
        exact_sum("x").alias("s"), exact_avg("x").alias("a"),
        exact_sum_if("x", F.col("x") > 0).alias("p")).collect()}
    for g in got:
        vs = [v for i, v in enumerate(values) if i % 3 == g]
        exact = sum(Decimal(v) for v in vs) / 100
        assert got[g][0] == float(exact)
        assert got[g][1] == float(exact) / len(vs)
        assert got[g][2] == float(sum(Decimal(v) for v in vs if v > 0) / 100)


def test_safe_divide_guards(spark):
    df = spark.createDataFrame([(1, 0), (1, None), (3, 4)], "n long, d long")
    assert [r.q for r in df.select(safe_divide("n", "d").alias("q")).collect()] == [None, None, 0.75]


def test_inputs_are_not_rounded(spark):
    df = spark.range(1000).select(F.lit(0.004).alias("x"))
    assert df.agg(exact_sum("x").alias("s"), exact_avg("x").alias("a")).first() == (4.0, 0.004)
    places = [-23.54562128115268, -23.546081127035535]
    got = spark.createDataFrame([(p,) for p in places], "x double").agg(exact_avg("x").alias("a")).first().a
    assert got == float(sum(Decimal(repr(p)) for p in places)) / 2
    none = spark.createDataFrame([(None,)], "x double").agg(exact_sum("x").alias("s"), exact_avg("x").alias("a")).first()
    assert none == (None, None)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6).map(lambda v: round(v, 14)), min_size=1, max_size=30))
def test_sum_equals_duckdb(spark, values):
    import duckdb
    from quitanda import oracle
    con = duckdb.connect()
    rows = ", ".join(f"({v!r}::DOUBLE)" for v in values)
    want = con.sql(f"SELECT {oracle.exact_sum('x')}, {oracle.exact_avg('x')} FROM (VALUES {rows}) t(x)").fetchall()[0]
    got = spark.createDataFrame([(v,) for v in values], "x double").agg(exact_sum("x"), exact_avg("x")).first()
    assert tuple(got) == want
