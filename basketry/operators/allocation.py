"""Spreading a monthly amount over the orders of the month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.numbers import ratio
from basketry.operators.joins import month_table


def with_month_totals(df: DataFrame, months: list[str], totals: dict[str, object]) -> DataFrame:
    """Add per-month aggregates to every row.

    Aggregated first (map-side combining) and joined back as a calendar-sized table; a window over
    the month would sort a whole month of orders in one task.
    """
    summed = df.groupBy(*months).agg(*[agg.alias(out) for out, agg in totals.items()])
    return df.join(month_table(summed), months, "left")


def share_of_total(amount: str, total: str):
    """The row's share of the month: null when the month total is 0."""
    return ratio(F.col(amount), F.col(total))
