"""Month keys of the form YYYY-MM."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_key(date: Column | str) -> Column:
    return F.date_format(date, "yyyy-MM")


def month_start(month: Column | str) -> Column:
    return F.to_date(F.concat(month, F.lit("-01")), "yyyy-MM-dd")


def shift_month(month: Column | str, months: Column | int) -> Column:
    return month_key(F.add_months(month_start(month), months))


def calendar_columns(date: str = "order_date") -> dict[str, Column]:
    return {
        "year": F.year(date),
        "quarter": F.concat(F.year(date).cast("string"), F.lit("Q"), F.quarter(date).cast("string")),
        "month": month_key(date),
        "month_of_year": F.month(date),
    }


def month_bounds(month: str) -> tuple[dt.date, dt.date]:
    """First day of a month and of the month after it."""
    year, number = int(month[:4]), int(month[5:7])
    return dt.date(year, number, 1), dt.date(year + number // 12, number % 12 + 1, 1)


def shift_month_key(month: str, months: int) -> str:
    position = int(month[:4]) * 12 + int(month[5:7]) - 1 + months
    return f"{position // 12:04d}-{position % 12 + 1:02d}"
