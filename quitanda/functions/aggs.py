"""Aggregate expressions.

Amounts and coordinates are doubles (as in the source tables).  Sums and means
add them as ``decimal(38, 18)``: decimal addition is exact, so the result
depends neither on row order nor on partitioning, and no input is rounded that
has up to 18 decimals.  Only the final sum becomes a double again.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quitanda.functions.text import _col


def safe_divide(num: Column | str, den: Column | str) -> Column:
    """num / den as double; NULL when den is 0 or NULL (never raises)."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def avg_if(x: Column | str, cond: Column) -> Column:
    """Mean of ``x`` over rows where ``cond`` holds; NULL when none does."""
    return F.avg(F.when(cond, _col(x)))


EXACT = "decimal(38,18)"


def exact_sum(x: Column | str) -> Column:
    """Order-independent sum; NULL over no values."""
    return F.sum(_col(x).cast(EXACT)).cast("double")


def exact_sum_if(x: Column | str, cond: Column) -> Column:
    """``sumIf``: exact sum over matching rows, 0 when none match."""
    return F.sum(F.when(cond, _col(x).cast(EXACT)).otherwise(F.lit(0).cast(EXACT))).cast("double")


def exact_avg(x: Column | str) -> Column:
    """Order-independent mean: the exact sum over the count; NULL over no values."""
    return F.try_divide(exact_sum(x), F.count(_col(x)).cast("double"))


def any_value(x: Column | str) -> Column:
    """A value of a group-constant attribute; ``min`` so reruns agree."""
    return F.min(_col(x))


def latest_by(values: list[Column | str], order: Column, tiebreak: Column | str) -> Column:
    """The ``values`` of the row with the greatest ``order`` (ties: greatest ``tiebreak``).

    One ``max_by`` over a struct keeps all returned fields from the same row;
    a NULL ordering time sorts below every real time.
    """
    return F.max_by(F.struct(*[_col(v) for v in values]), F.struct(order, _col(tiebreak)))


def distinct_list(x: Column | str, sep: str = ", ") -> Column:
    """Sorted distinct values joined into one string (NULLs dropped).

    Meant for attributes with a small closed domain (payment types): the set
    a group holds is bounded by that domain however many rows the group has.
    Partial aggregation builds the sets map-side.
    """
    return F.array_join(F.array_sort(F.collect_set(_col(x))), sep)
