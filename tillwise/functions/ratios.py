"""Ratios that tolerate empty denominators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _double(value: ColumnOrName) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("double")


def ratio(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """Null where the denominator is zero or missing."""
    return F.try_divide(_double(numerator), _double(denominator))


def ratio_or_zero(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    return F.coalesce(ratio(numerator, denominator), F.lit(0.0))


def relative_change(current: ColumnOrName, previous: ColumnOrName) -> Column:
    """Growth against an earlier value, null where that value is zero or missing."""
    return ratio(current, previous) - F.lit(1.0)
