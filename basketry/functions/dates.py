"""Dates: UTC to shop time, month and quarter buckets, labels, distances."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

SHOP_ZONE = "America/Sao_Paulo"

# Month abbreviations of the shop's locale, January first.
MONTH_NAMES = ["jan", "fev", "mar", "abr", "mai", "jun", "jul", "ago", "set", "out", "nov", "dez"]


def local_ts(ts: Column | str) -> Column:
    """UTC instant to shop wall-clock time, daylight saving included."""
    return F.from_utc_timestamp(F.col(ts) if isinstance(ts, str) else ts, SHOP_ZONE)


def local_date(ts: Column | str) -> Column:
    return F.to_date(local_ts(ts))


def month_start(day: Column | str) -> Column:
    return F.to_date(F.trunc(day, "MM"))


def quarter_start(day: Column | str) -> Column:
    return F.to_date(F.trunc(day, "QUARTER"))


def month_label(day: Column | str) -> Column:
    """`2015-08`: sorts as text."""
    return F.date_format(day, "yyyy-MM")


def month_label_reversed(day: Column | str) -> Column:
    """`08-2015`, the layout of the product and campaign reports."""
    return F.date_format(day, "MM-yyyy")


def campaign_month_label(day: Column | str) -> Column:
    """`Dez-15`: capitalised month abbreviation of the shop's locale and a two-digit year."""
    names = F.array(*[F.lit(n.capitalize()) for n in MONTH_NAMES])
    return F.concat(F.element_at(names, F.month(day)), F.lit("-"), F.date_format(day, "yy"))


def calendar_months_between(later: Column | str, earlier: Column | str) -> Column:
    """Difference of calendar months; the day of month plays no part (unlike `months_between`)."""
    return (F.year(later) * 12 + F.month(later)) - (F.year(earlier) * 12 + F.month(earlier))


def days_before(as_of: dt.date, day: Column | str) -> Column:
    """Age in days of `day` on the run day."""
    return F.datediff(F.lit(as_of), day)


def same_month(day: Column | str, as_of: dt.date) -> Column:
    """Same-month-as-run-day test, written as a range so that it reaches the scan as a filter."""
    first = as_of.replace(day=1)
    following = (first + dt.timedelta(days=32)).replace(day=1)
    column = F.col(day) if isinstance(day, str) else day
    return (column >= F.lit(first)) & (column < F.lit(following))


def parse_day_first(text: Column | str) -> Column:
    """`31/12/2015` to a date; unreadable text gives null."""
    return F.to_date(F.try_to_timestamp(text, F.lit("dd/MM/yyyy")))


def local_since(ts: Column | str, first: dt.date) -> Column:
    """Shop-local day on or after `first`.

    The plain comparison of the raw instant is implied by the exact test (the zone is less than a day
    away); it is there because only a plain comparison can prune files and row groups.
    """
    column = F.col(ts) if isinstance(ts, str) else ts
    low = dt.datetime.combine(first - dt.timedelta(days=1), dt.time())
    return (column >= F.lit(low.isoformat(" ")).cast("timestamp")) & (local_date(column) >= F.lit(first))


def local_between(ts: Column | str, first: dt.date, last: dt.date) -> Column:
    """Shop-local day within [first, last], with the same kind of implied plain range."""
    column = F.col(ts) if isinstance(ts, str) else ts
    high = dt.datetime.combine(last + dt.timedelta(days=2), dt.time())
    return (
        local_since(column, first) & (column < F.lit(high.isoformat(" ")).cast("timestamp"))
        & (local_date(column) <= F.lit(last))
    )
