"""Financial and calendar columns of a sales line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.functions.calendar import calendar_columns
from tillwise.functions.parsing import strict_date, strict_number
from tillwise.functions.ratios import ratio
from tillwise.schema import FACT_COLUMNS, MONEY, MONEY_COLUMNS


def price_lines(raw: DataFrame) -> DataFrame:
    """Gross revenue from quantity and list price."""
    return raw.withColumn("gross_revenue", F.col("quantity") * F.col("list_price"))


def add_economics(lines: DataFrame) -> DataFrame:
    """Gross to discount to net to cost to profit, and the line margins.

    Decimal money is kept in one narrow exact type; doubles stay doubles.
    """
    exact = isinstance(lines.schema["gross_revenue"].dataType, T.DecimalType)

    def money(value: Column) -> Column:
        return value.cast(MONEY) if exact else value.cast("double")

    gross, discount, cost = F.col("gross_revenue"), F.col("discount_amount"), F.col("cost")
    return (
        lines.withColumns(
            {
                "discount_amount": money(gross * F.col("discount_rate")),
                "cost": money(F.col("quantity") * F.col("unit_cost")),
                "gross_revenue": money(gross),
            }
        )
        .withColumn("net_revenue", money(gross - discount))
        .withColumn("gross_profit", money(F.col("net_revenue") - cost))
        .withColumns(
            {
                "gross_margin": ratio("gross_profit", "net_revenue"),
                "margin_before_discount": ratio(gross - cost, gross),
            }
        )
    )


def add_calendar(df: DataFrame) -> DataFrame:
    return df.withColumns(calendar_columns())


def enrich(raw: DataFrame) -> DataFrame:
    """Facts from a raw sales table with list prices and unit costs; text is read as the strict gate reads it."""
    types = {f.name: f.dataType.typeName() for f in raw.schema.fields}
    numbers = ("quantity", "list_price", "discount_rate", "unit_cost")
    read = {c: strict_number(F.col(c), "string") for c in numbers if types[c] == "string"}
    typed = raw.withColumns({**read, "order_date": strict_date(F.col("order_date"), types["order_date"])})
    return add_calendar(add_economics(price_lines(typed)))


def exact_money(facts: DataFrame) -> DataFrame:
    """Money columns as decimals, so that sums do not depend on the order of rows."""
    return facts.withColumns({c: F.col(c).cast(MONEY) for c in MONEY_COLUMNS})


def export_facts(facts: DataFrame) -> DataFrame:
    """The 17 exported columns, dates as text, money to cents and rates to four places."""
    shapes = {
        "order_date": F.date_format("order_date", "yyyy-MM-dd"),
        **{c: F.round(c, 2).cast("double") for c in MONEY_COLUMNS},
        **{c: F.round(F.col(c).cast("double"), 4) for c in ("discount_rate", "gross_margin")},
    }
    return facts.select(*[shapes.get(c, F.col(c)).alias(c) for c in FACT_COLUMNS])
