"""Business classifications (fixed rule tables shared by Spark and the SQL oracle)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quitanda.functions.text import _col

# Fixed values that must equal the reference's: Brazilian state codes per region,
# checked in this order; any other state is 'unknown'.
REGION_STATES = [
    ("southeast", ["SP", "RJ", "MG", "ES"]),
    ("south", ["PR", "SC", "RS"]),
    ("northeast", ["BA", "SE", "AL", "PE", "PB", "RN", "CE", "PI", "MA"]),
    ("center_west", ["DF", "GO", "MT", "MS"]),
    ("north", ["AC", "RO", "AM", "RR", "PA", "AP", "TO"]),
]
REGIONS = [name for name, _ in REGION_STATES] + ["unknown"]

# Product weight classes by grams (NULL → unknown).
WEIGHT_LIGHT_BELOW = 500
WEIGHT_MEDIUM_BELOW = 5000
WEIGHT_CLASSES = ["unknown", "light", "medium", "heavy"]

# Customer segments, first matching rule wins.
#   champion        orders >= 5 and monetary >= 1000 and recency <= 90 days
#   loyal_customer  orders >= 3 and recency <= 180 days
#   at_risk         recency > 365 days
#   one_time_buyer  orders = 1
#   regular_customer otherwise
SEGMENTS = ["champion", "loyal_customer", "at_risk", "one_time_buyer", "regular_customer"]

# Accepted order statuses and payment types.
ORDER_STATUSES = ["created", "approved", "invoiced", "processing", "shipped",
                  "delivered", "unavailable", "canceled"]
PAYMENT_TYPES = ["credit_card", "boleto", "voucher", "debit_card", "not_defined"]


def region_of(state: Column | str) -> Column:
    state = _col(state)
    expr = None
    for region, states in REGION_STATES:
        cond = state.isin(*states)
        expr = F.when(cond, F.lit(region)) if expr is None else expr.when(cond, F.lit(region))
    return expr.otherwise(F.lit("unknown"))


def weight_class(grams: Column | str) -> Column:
    grams = _col(grams)
    return (F.when(grams.isNull(), F.lit("unknown"))
            .when(grams < WEIGHT_LIGHT_BELOW, F.lit("light"))
            .when(grams < WEIGHT_MEDIUM_BELOW, F.lit("medium"))
            .otherwise(F.lit("heavy")))


def rfm_segment(total_orders: Column | str, monetary: Column | str, recency_days: Column | str) -> Column:
    n, m, r = _col(total_orders), _col(monetary), _col(recency_days)
    return (F.when((n >= 5) & (m >= 1000) & (r <= 90), F.lit("champion"))
            .when((n >= 3) & (r <= 180), F.lit("loyal_customer"))
            .when(r > 365, F.lit("at_risk"))
            .when(n == 1, F.lit("one_time_buyer"))
            .otherwise(F.lit("regular_customer")))


def flag(cond: Column) -> Column:
    """0/1 integer flag (kept as int, not boolean, for the accepted-values tests)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))
