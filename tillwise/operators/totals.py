"""Exact sums of money that stay in whole-number arithmetic until a group is complete.

Facts may carry each money column a second time as whole ten-thousandths. Adding those up is much
cheaper than adding decimals. A sum is kept as two whole numbers, high and low, so that totals over
trillions of lines fit; the group's total is put together as a decimal at the end.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.schema import MONEY, UNITS

UNIT = Decimal("0.0001")
LOW_BITS = 20


def money_of(units: Column) -> Column:
    """Ten-thousandths as exact money."""
    return (units.cast("decimal(18,0)") * F.lit(UNIT)).cast(MONEY)


def with_units(facts: DataFrame) -> DataFrame:
    """Add the whole-number columns to facts with decimal money of at most four places."""
    return facts.withColumns({units: (F.col(c) * 10_000).cast("bigint") for c, units in UNITS.items()})


def total(facts: DataFrame, column: str, where: Column | None = None) -> Column:
    """The sum of a column, over the rows that satisfy a condition if one is given."""
    units = UNITS.get(column)
    has_units = units in facts.columns
    value = F.col(units if has_units else column)
    if where is not None:
        value = F.when(where, value)
    if not has_units:
        return F.sum(value)
    high = F.sum(F.shiftright(value, LOW_BITS)).cast("decimal(20,0)")
    low = F.sum(value.bitwiseAND((1 << LOW_BITS) - 1)).cast("decimal(20,0)")
    return (high * F.lit(Decimal(1 << LOW_BITS)) + low) * F.lit(UNIT)
