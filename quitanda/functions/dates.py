"""Calendar helpers shared by the order, review and date-dimension models."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quitanda.functions.text import _col


def days_between(start: Column | str, end: Column | str) -> Column:
    """Calendar-day boundaries crossed from ``start`` to ``end`` (bigint).

    Spark's ``datediff`` takes (end, start); this helper keeps the natural
    order.  23:59 → 00:01 of the next day is 1.
    """
    return F.datediff(_col(end), _col(start)).cast("bigint")


def month_start(d: Column | str) -> Column:
    return F.trunc(_col(d), "MM")


def quarter_start(d: Column | str) -> Column:
    return F.trunc(_col(d), "quarter")


def year_start(d: Column | str) -> Column:
    return F.trunc(_col(d), "year")


def month_key(d: Column | str) -> Column:
    """yyyymm as an int — the partition key of the month-partitioned tables."""
    d = _col(d)
    return (F.year(d) * 100 + F.month(d)).cast("int")


def iso_day_of_week(d: Column | str) -> Column:
    """Monday = 1 … Sunday = 7 (Spark's ``dayofweek`` starts on Sunday)."""
    return (F.weekday(_col(d)) + 1).cast("int")


def is_weekend(d: Column | str) -> Column:
    return F.when(iso_day_of_week(d).isin(6, 7), F.lit(1)).otherwise(F.lit(0))


def day_name(d: Column | str) -> Column:
    return F.date_format(_col(d), "EEEE")


def year_month(d: Column | str) -> Column:
    return F.date_format(_col(d), "yyyy-MM")
