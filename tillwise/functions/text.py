"""Text forms of numbers used in evidence sentences and ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole(value: Column) -> Column:
    """1,234"""
    return F.format_number(value.cast("double"), 0)


def dollars(value: Column) -> Column:
    """$1,234"""
    return F.concat(F.lit("$"), whole(value))


def one_decimal(value: Column) -> Column:
    return F.format_string("%.1f", value.cast("double"))


def percent(rate: Column) -> Column:
    """0.123 as 12.3%"""
    return F.concat(one_decimal(rate.cast("double") * 100), F.lit("%"))


def slug(value: Column) -> Column:
    return F.replace(F.lower(value), F.lit(" "), F.lit("-"))


def text_or(value: Column, default: Column | str) -> Column:
    """Trimmed text, or a default where nothing is left."""
    fallback = F.lit(default) if isinstance(default, str) else default
    return F.coalesce(F.nullif(F.trim(value), F.lit("")), fallback)


def plain_number(value: Column) -> Column:
    """A number as text without a trailing .0 on whole values."""
    is_whole = (F.floor(value) == value) & (F.abs(value) < 1e15)
    return F.when(is_whole, value.cast("bigint").cast("string")).otherwise(value.cast("string"))
