"""Numbers: money casts, null-skipping sums, ratios that never fail."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"


def money(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast(MONEY)


def null_sum(*values: Column | str) -> Column:
    """Row-wise sum that skips nulls; all null gives 0."""
    columns = [F.col(v) if isinstance(v, str) else v for v in values]
    return reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0)) for c in columns])


def total(value: Column | str) -> Column:
    """Aggregate sum whose empty result is 0."""
    return F.coalesce(F.sum(value), F.lit(0))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division; null when the denominator is 0 or null."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def flag(condition: Column) -> Column:
    """1 when the condition is true, else 0 (null counts as false)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))
