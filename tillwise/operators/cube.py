"""A table of pre-aggregated sales from which most summaries can be made without reading the lines again.

A cube has the columns of facts, so the operators on groups take it in place of facts. It has two kinds of rows:

- cells: sums of money, quantity, discount rates and lines for each month, discount band and combination of the five
  dimensions. Sums are additive, so a cell may be added up to anything coarser.
- orders: distinct orders are not additive. They are counted once for each of the declared groupings, for all groupings in
  one aggregation, and stand in rows of their own, marked with the grouping, with its columns filled and no sums.

A cube's size depends on the combinations that occur and not on the number of lines. Counting orders in a grouping that was
not declared is refused.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.functions.bands import discount_bucket
from tillwise.operators.economics import MARK, ORDERS, grouping_name, order_identity
from tillwise.schema import DIMENSIONS, MONEY_COLUMNS, UNITS
from tillwise.session import stored

BAND = "discount_bucket"
KEYS = ("month", "month_of_year", BAND, *DIMENSIONS)
LINES, RATES = "lines", "rates"

#: Groupings in which orders are counted: those of the report's sections.
GROUPINGS: tuple[tuple[str, ...], ...] = (
    (), ("month",), *((d,) for d in DIMENSIONS), (BAND,), ("month_of_year",), ("category", "month_of_year"), ("channel", "month_of_year"),
    ("category", "channel"), ("region", "category"), ("channel", "customer_segment"), ("product", "channel"), ("product", "category"),
)


def _measures(facts: DataFrame) -> list[Column]:
    """Sums that keep the type of the facts: whole ten-thousandths where they are there."""
    money = [UNITS[c] for c in MONEY_COLUMNS] if all(UNITS[c] in facts.columns for c in MONEY_COLUMNS) else list(MONEY_COLUMNS)
    sums = [F.sum(c).alias(c) for c in (*money, "quantity")]
    return [*sums, F.sum("discount_rate").alias(RATES), F.count("discount_rate").alias(LINES)]


def sales_cube(facts: DataFrame, groupings: Sequence[Sequence[str]] = GROUPINGS) -> DataFrame:
    """The cube of a fact table, written: two aggregations over the lines."""
    banded = facts.withColumn(BAND, discount_bucket(F.col("discount_rate")))
    cells = banded.groupBy(*KEYS).agg(*_measures(facts))

    kinds = {f.name: f.dataType for f in banded.schema.fields}
    marks = [
        F.struct(F.lit(grouping_name(g)).alias(MARK), *[(F.col(k) if k in g else F.lit(None).cast(kinds[k])).alias(k) for k in KEYS])
        for g in groupings
    ]
    narrow = banded.select(order_identity(facts).alias("_order"), F.explode(F.array(*marks)).alias("_mark")).select("_order", "_mark.*")
    counted = narrow.groupBy(MARK, *KEYS).agg(F.countDistinct("_order").alias(ORDERS))
    return stored(cells.unionByName(counted, allowMissingColumns=True))
