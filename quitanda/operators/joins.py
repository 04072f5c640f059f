"""Join patterns used by the models and the data-quality checks.

Strategy is left to Catalyst + AQE: a side is broadcast only when its
*runtime* size is under ``spark.sql.autoBroadcastJoinThreshold`` (AQE's
checked conversion) and otherwise joined sort-merge; a hot key on the
preserved side of a left join is split by AQE's skew-join handling.  We add no
unconditional broadcast hints for tables whose size grows with the data (the
codes of ``coded_attributes`` are a bounded number of rows).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quitanda.session import scratch_path

# Most combinations of attributes that are sent as a code; their table is a few hundred kB then.
CODED_COMBINATIONS = 10_000


def left_join_fill(left: DataFrame, right: DataFrame, on: str | list[str],
                   fills: dict[str, Column | None], drop_other: bool = True) -> DataFrame:
    """``left ⟕ right`` keeping ``fills``' columns from ``right``.

    A miss gives the fill value (``None`` keeps SQL NULL).  The right side is
    expected to be unique on ``on`` (pre-aggregated), so no row fans out.
    """
    keys = [on] if isinstance(on, str) else list(on)
    right_cols = [c for c in fills] if drop_other else [c for c in right.columns if c not in keys]
    joined = left.join(right.select(*keys, *right_cols), keys, "left")
    out = []
    for c in joined.columns:
        fill = fills.get(c)
        out.append(F.coalesce(F.col(c), fill).alias(c) if fill is not None else F.col(c))
    return joined.select(*out)


def left_join_fill_many(left: DataFrame, on: str | list[str],
                        rights: list[tuple[DataFrame, dict[str, Column | None]]]) -> DataFrame:
    """Several ``left_join_fill`` on the same key, with one final projection.

    All right sides must be unique on ``on``.  Building the joins first and
    applying every fill in a single ``select`` keeps the plan (and its
    analysis) small.
    """
    keys = [on] if isinstance(on, str) else list(on)
    joined = left
    fills: dict[str, Column | None] = {}
    for right, right_fills in rights:
        joined = joined.join(right.select(*keys, *right_fills), keys, "left")
        fills.update(right_fills)
    out = [F.col(c) for c in left.columns]
    out += [F.coalesce(F.col(c), f).alias(c) if f is not None else F.col(c) for c, f in fills.items()]
    return joined.select(*out)


def coded_attributes(dim: DataFrame, key: str, attributes: list[str],
                     code: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``dim`` with a number in place of its ``attributes``, and the join that gives a table its attributes back.

    For a long table that is joined with ``dim`` and shuffled again: texts that few combinations share
    need not go through those shuffles.  The combinations and the narrow table are written when this is
    called, so Spark knows their sizes; if there are more combinations than ``CODED_COMBINATIONS``, the
    attributes themselves stay in ``dim``.  Every row of ``dim`` keeps its own row, and a key that misses has
    NULL in all attributes, as in a plain left join.
    """
    spark = dim.sparkSession
    path = scratch_path(spark, "codes")
    narrow = dim.select(key, *attributes)
    codes = _written(narrow.select(*attributes).distinct().withColumn(code, F.monotonically_increasing_id()),
                     f"{path}/combinations")
    if codes.count() > CODED_COMBINATIONS:
        return narrow, lambda df: df
    same = [narrow[a].eqNullSafe(codes[a]) for a in attributes]
    coded = _written(narrow.join(codes, same).select(narrow[key], codes[code]), f"{path}/coded")
    # a broadcast of CODED_COMBINATIONS rows at most
    return coded, lambda df: df.join(F.broadcast(codes), code, "left").drop(code)


def coded_columns(df: DataFrame, code: str,
                  attributes: list[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df``, a written table, with a number in place of its ``attributes``, and the join that gives them back.

    As ``coded_attributes``, for texts that already stand in the long table: one more pass over them finds
    their combinations.
    """
    codes = _written(df.select(*attributes).distinct().withColumn(code, F.monotonically_increasing_id()),
                     scratch_path(df.sparkSession, "codes"))
    if codes.count() > CODED_COMBINATIONS:
        return df, lambda out: out
    named = codes.select(code, *[F.col(a).alias(f"_of_{a}") for a in attributes])
    same = [df[a].eqNullSafe(named[f"_of_{a}"]) for a in attributes]
    narrow = df.join(F.broadcast(named), same, "left").drop(*attributes, *[f"_of_{a}" for a in attributes])
    return narrow, lambda out: out.join(F.broadcast(codes), code, "left").drop(code)


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent (``left_anti``).

    Parent keys are de-duplicated first (partial aggregation, map-side), so a
    parent key repeated on a third of the parent rows never reaches one task
    whole; a hot key on the child side is split by AQE's skew-join handling.
    """
    parent_keys = (parent.select(F.col(parent_key).alias(child_key))
                   .where(F.col(child_key).isNotNull()).distinct())
    return child.where(F.col(child_key).isNotNull()).join(parent_keys, child_key, "left_anti")


def attach_scalar(df: DataFrame, one_row: DataFrame, column: str, alias: str | None = None) -> DataFrame:
    """Attach a value computed once (a one-row aggregate) to every row.

    Uses a scalar subquery: Spark evaluates it in its own job and inlines the
    value — no join and no broadcast of anything but one value.
    """
    return df.withColumn(alias or column, one_row.select(column).scalar())
