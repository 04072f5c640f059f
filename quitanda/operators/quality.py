"""Declarative data-quality checks as Spark jobs.

Each ``*_violations`` function returns the rows a check reports (the check
passes when there are none), with the same NULL rules as the source
project's tests:

* not_null           rows whose column is NULL
* unique             non-NULL values seen more than once (value, count)
* accepted_values    values outside the list; NULL passes (value, count)
* relationships      non-NULL child keys without a parent row
* non_negative       rows whose column is < 0; NULL passes
* unique_combination key groups seen more than once; NULL keys do count

``check_model`` evaluates all declarations of one model in one scan: every
row gives a (check, key) entry to each check that needs to see it — failing
rows only for the row-local and value checks — and parent tables add their
keys, so a single grouped shuffle with map-side combining decides all checks.
The result is one row per declaration, so the whole suite result is tiny.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quitanda.operators.joins import orphans


@dataclass(frozen=True)
class Check:
    kind: str                          # one of the six kinds above
    column: str | tuple[str, ...]      # a column, or columns for unique_combination
    values: tuple = ()                 # accepted_values
    to: str | None = None              # relationships: parent model
    field: str | None = None           # relationships: parent column

    @property
    def column_label(self) -> str:
        return ",".join(self.column) if isinstance(self.column, tuple) else self.column


@dataclass
class Declarations:
    by_model: dict[str, list[Check]] = field(default_factory=dict)

    def count(self) -> int:
        return sum(len(v) for v in self.by_model.values())


def _lit(v) -> Column:
    return F.lit(v)


def not_null_violations(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique_violations(df: DataFrame, column: str) -> DataFrame:
    return (df.where(F.col(column).isNotNull())
            .groupBy(F.col(column).alias("unique_field"))
            .agg(F.count(F.lit(1)).alias("n_records"))
            .where(F.col("n_records") > 1))


def accepted_values_violations(df: DataFrame, column: str, values) -> DataFrame:
    # filter first (pushed to the scan; passing rows never reach the shuffle);
    # a NULL value passes because NOT IN on NULL is not true
    return (df.where(~F.col(column).isin(*[_lit(v) for v in values]))
            .groupBy(F.col(column).alias("value_field"))
            .agg(F.count(F.lit(1)).alias("n_records")))


def relationships_violations(child: DataFrame, column: str, parent: DataFrame, field_: str) -> DataFrame:
    return orphans(child.select(F.col(column).alias("from_field")), "from_field", parent, field_)


def non_negative_violations(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) < 0)


def unique_combination_violations(df: DataFrame, columns: list[str] | tuple[str, ...]) -> DataFrame:
    return (df.groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count"))
            .where(F.col("row_count") > 1))


def _stacked(df: DataFrame, entries: list[Column]) -> DataFrame:
    """(check, key) rows: for every row of ``df`` the entries that are not NULL, from one scan."""
    return (df.select(F.explode(F.array(*entries)).alias("e"))
            .where(F.col("e").isNotNull()).select("e.check", "e.key"))


def _entry(number: int, cond: Column, *key: Column) -> Column:
    """(check, key) where ``cond`` holds, else NULL.

    One key is its text.  Of several, each is given with its length, so no two combinations are one text; NULL is ``-``.
    """
    texts = [k.cast("string") for k in key]
    if len(texts) > 1:
        texts = [F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])]
    one = texts[0] if texts else F.lit("")
    return F.when(cond, F.struct(F.lit(number).alias("check"), one.alias("key")))


def _key(df: DataFrame, column: str) -> Column:
    """A key column; negative zero is zero, as in grouping."""
    floating = df.schema[column].dataType.typeName() in ("double", "float")
    return F.col(column) + F.lit(0.0).cast(df.schema[column].dataType) if floating else F.col(column)


def _child_entry(number: int, check: Check, df: DataFrame) -> Column:
    """What a row of the tested table gives to a check: the failing rows of the row-local and value
    checks (passing rows never reach the shuffle), the keys of the others."""
    if check.kind == "unique_combination":
        return _entry(number, F.lit(True), *[_key(df, c) for c in check.column])
    c = _key(df, check.column)
    if check.kind == "not_null":
        return _entry(number, c.isNull())
    if check.kind == "non_negative":
        return _entry(number, c < 0)
    if check.kind == "accepted_values":
        return _entry(number, ~c.isin(*[_lit(v) for v in check.values]), c)
    return _entry(number, c.isNotNull(), c)  # unique, relationships


def _group_violations(checks: list[Check]) -> Column:
    """Violations that one (check, key) group adds, from its ``n`` rows and whether a parent has the key."""
    n = F.col("n")
    per_kind = {"unique": (n > 1).cast("bigint"), "unique_combination": (n > 1).cast("bigint"),
                # one for each distinct failing value, as the test reports them
                "accepted_values": F.lit(1).cast("bigint"),
                "relationships": F.when(F.col("has_parent"), F.lit(0).cast("bigint")).otherwise(n)}
    out = n  # row-local checks count rows
    for kind, violations in per_kind.items():
        numbers = [i for i, c in enumerate(checks) if c.kind == kind]
        if numbers:
            out = F.when(F.col("check").isin(*numbers), violations).otherwise(out)
    return out


RESULT_COLUMNS = ["model", "test_name", "column_name", "violations"]


def _result_row(model: str, check: Check, violations: Column) -> list[Column]:
    return [F.lit(model).alias("model"), F.lit(check.kind).alias("test_name"),
            F.lit(check.column_label).alias("column_name"),
            violations.cast("bigint").alias("violations")]


def check_model(model: str, df: DataFrame, checks: list[Check],
                resolve: Callable[[str], DataFrame]) -> DataFrame | None:
    """One row per declaration: (model, test_name, column_name, violations).

    One scan of the model and one of each parent; all keys of all checks share one shuffle.
    """
    if not checks:
        return None
    rows = _stacked(df, [_child_entry(i, c, df) for i, c in enumerate(checks)]).withColumn("own", F.lit(True))
    parents: dict[str, list[Column]] = {}
    for i, c in enumerate(checks):
        if c.kind == "relationships":
            # the key as the child's type, so both sides have the same text
            key = _key(resolve(c.to), c.field).cast(df.schema[c.column].dataType)
            parents.setdefault(c.to, []).append(_entry(i, key.isNotNull(), key))
    for to, entries in parents.items():
        rows = rows.unionByName(_stacked(resolve(to), entries).withColumn("own", F.lit(False)))
    groups = rows.groupBy("check", "key").agg(F.count_if("own").alias("n"), F.max(~F.col("own")).alias("has_parent"))
    groups = groups.where("n > 0").withColumn("violations", _group_violations(checks))
    totals = groups.agg(*[F.coalesce(F.sum(F.when(F.col("check") == i, F.col("violations"))), F.lit(0)).alias(f"_v{i}")
                          for i in range(len(checks))])
    return totals.select(F.inline(F.array(*[F.struct(*_result_row(model, c, F.col(f"_v{i}")))
                                            for i, c in enumerate(checks)])))


def summarize(results: DataFrame) -> DataFrame:
    return results.withColumn("passed", (F.col("violations") == 0))
