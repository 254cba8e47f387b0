"""Filters of the interactive view."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.schema import DIMENSIONS, FILTER_KEYS

ALL = "All"


@dataclass(frozen=True)
class Filters:
    """An inclusive date range (ISO text) and one value, or All, per dimension."""

    start_date: str
    end_date: str
    region: str = ALL
    channel: str = ALL
    segment: str = ALL
    category: str = ALL
    product: str = ALL

    def active(self) -> dict[str, str]:
        chosen = {dimension: getattr(self, FILTER_KEYS[dimension]) for dimension in DIMENSIONS}
        return {dimension: value for dimension, value in chosen.items() if value != ALL}


def default_filters(facts: DataFrame) -> Filters:
    """The whole date range and every value."""
    first, last = facts.agg(F.min("order_date"), F.max("order_date")).first()
    return Filters(str(first), str(last))


def filter_facts(facts: DataFrame, filters: Filters) -> DataFrame:
    date = F.col("order_date").cast("date")
    kept = facts.where(date.between(F.lit(filters.start_date).cast("date"), F.lit(filters.end_date).cast("date")))
    if "month" in facts.columns:  # prunes a table partitioned by month
        kept = kept.where(F.col("month").between(filters.start_date[:7], filters.end_date[:7]))
    for dimension, value in filters.active().items():
        kept = kept.where(F.col(dimension) == value)
    return kept


def _date(text: str) -> dt.date | None:
    try:
        return dt.date.fromisoformat(text)
    except ValueError:
        return None


def previous_period(filters: Filters, min_date: str) -> Filters | None:
    """The window of the same length that ends the day before, if the data reaches back that far."""
    start, end, first = _date(filters.start_date), _date(filters.end_date), _date(min_date)
    if start is None or end is None or end < start:
        return None
    before_start, before_end = start - (end - start) - dt.timedelta(days=1), start - dt.timedelta(days=1)
    if first is not None and before_start < first:
        return None
    return replace(filters, start_date=before_start.isoformat(), end_date=before_end.isoformat())
