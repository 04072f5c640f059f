"""Text normalisation used by the staging layer (column expressions, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm_lower(c: Column | str) -> Column:
    """lower(trim(x)): city names, statuses, payment types, categories."""
    return F.lower(F.trim(_col(c)))


def norm_upper(c: Column | str) -> Column:
    """upper(trim(x)): state codes."""
    return F.upper(F.trim(_col(c)))


def blank_to_null(c: Column | str) -> Column:
    """Trimmed text, with NULL and all-blank text both mapped to NULL."""
    return F.nullif(F.trim(F.coalesce(_col(c), F.lit(""))), F.lit(""))


def has_text(c: Column | str) -> Column:
    """1 when the trimmed text is non-empty, else 0 (NULL counts as empty)."""
    return F.when(F.char_length(F.trim(F.coalesce(_col(c), F.lit("")))) > 0, F.lit(1)).otherwise(F.lit(0))
