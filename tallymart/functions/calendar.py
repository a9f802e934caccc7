"""Calendar parts as expressions.  Facts carry real dates, so a report needs no
join to the date dimension to read a year or a month name."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def year(d: Column | str) -> Column:
    return F.year(d).alias("year")


def quarter(d: Column | str) -> Column:
    return F.quarter(d).alias("quarter")


def month(d: Column | str) -> Column:
    return F.month(d).alias("month")


def month_name(d: Column | str) -> Column:
    return F.date_format(d, "MMMM")


def month_start(d: Column | str) -> Column:
    return F.trunc(d, "month")


def in_year(d: str, y: int) -> Column:
    """A range, not ``year(d) = y``, so that the filter reaches the scan."""
    return F.col(d).between(F.lit(date(y, 1, 1)), F.lit(date(y, 12, 31)))


def in_quarter(d: str, y: int, q: int) -> Column:
    first = date(y, 3 * q - 2, 1)
    following = date(y + 1, 1, 1) if q == 4 else date(y, 3 * q + 1, 1)
    return (F.col(d) >= F.lit(first)) & (F.col(d) < F.lit(following))


def quarter_days(y: int, q: int) -> tuple[date, date]:
    """First and last day of a quarter."""
    following = date(y + 1, 1, 1) if q == 4 else date(y, 3 * q + 1, 1)
    return date(y, 3 * q - 2, 1), following - timedelta(days=1)


def year_days(y: int) -> tuple[date, date]:
    """First and last day of a year."""
    return date(y, 1, 1), date(y, 12, 31)


def day_months_before(as_of: date, n: int) -> date:
    """As ``months_before``, as a day, so that folders can be chosen by it."""
    month = as_of.year * 12 + as_of.month - 1 - n
    first = date(month // 12, month % 12 + 1, 1)
    following = date((month + 1) // 12, (month + 1) % 12 + 1, 1)
    return first + timedelta(days=min(as_of.day, (following - first).days) - 1)


def months_before(as_of: date, n: int) -> Column:
    """The day ``n`` months before; a month end clips."""
    return F.add_months(F.lit(as_of), -n)


FOREVER = date(9999, 12, 31)


def closed_end(valid_to: str = "valid_to") -> Column:
    """The window's last day, an open end being the last day there is."""
    return F.coalesce(F.col(valid_to), F.lit(FOREVER))


def covers(d: Column, valid_from: Column | str = "valid_from", valid_to: Column | str = "valid_to") -> Column:
    """The validity window holds day ``d``; an open end is NULL."""
    first, last = (F.col(c) if isinstance(c, str) else c for c in (valid_from, valid_to))
    return (first <= d) & (last.isNull() | (last >= d))
