"""Decimal arithmetic with pinned result types.

Totals are DECIMAL(28,2): the sum type Spark gives DECIMAL(18,2), so a grand
total over a very large mart cannot overflow.  Ratios are divided with enough
fractional digits that the one rounding to the result scale is exact half-up
for totals up to 10^20.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
TOTAL = "decimal(28,2)"
_OPERAND = "decimal(22,2)"


def total(value: Column | str) -> Column:
    """Sum of a money column."""
    return F.sum(value).cast(TOTAL)


def units(value: Column | str) -> Column:
    """Sum of a count column."""
    return F.sum(value).cast("bigint")


def ratio(num: Column | str, den: Column | str, scale: int = 2, times: int = 1) -> Column:
    """``times * num / den`` rounded half-up; NULL where ``den`` is zero."""
    n, d = (F.col(c) if isinstance(c, str) else c for c in (num, den))
    n, d = n.cast(_OPERAND), d.cast(_OPERAND)
    if times != 1:
        n = n * F.lit(times)
    return (n / F.nullif(d, F.lit(0).cast(_OPERAND))).cast(f"decimal(18,{scale})")


def percent(num: Column | str, den: Column | str, scale: int = 2) -> Column:
    """``num`` as a percentage of ``den``."""
    return ratio(num, den, scale, times=100)


def zero(value: Column | str, dtype: str = TOTAL) -> Column:
    """The value with NULL read as zero."""
    return F.coalesce(value if isinstance(value, Column) else F.col(value), F.lit(0).cast(dtype))
