"""Column-expression helpers (all JVM-side built-ins; no Python UDFs)."""

from quitanda.functions.aggs import (any_value, avg_if, distinct_list, exact_avg, exact_sum, exact_sum_if, latest_by,
                                     safe_divide)
from quitanda.functions.classify import flag, region_of, rfm_segment, weight_class
from quitanda.functions.dates import (day_name, days_between, iso_day_of_week, is_weekend,
                                      month_key, month_start, quarter_start, year_month,
                                      year_start)
from quitanda.functions.text import blank_to_null, has_text, norm_lower, norm_upper

__all__ = [
    "any_value", "avg_if", "distinct_list", "exact_avg", "exact_sum", "exact_sum_if", "latest_by", "safe_divide", "flag",
    "region_of", "rfm_segment", "weight_class", "day_name", "days_between", "iso_day_of_week", "is_weekend",
    "month_key", "month_start", "quarter_start", "year_month", "year_start", "blank_to_null", "has_text",
    "norm_lower", "norm_upper",
]
