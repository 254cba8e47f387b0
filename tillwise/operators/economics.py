"""Grouped sales economics and the summaries made from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.functions.ratios import ratio, ratio_or_zero
from tillwise.operators.ordering import order_statistics, running_totals, upper_median_position
from tillwise.operators.totals import total
from tillwise.schema import DIMENSIONS, ORDER_KEY
from tillwise.session import durable

SUMS = {
    "gross_revenue": "gross_revenue",
    "revenue": "net_revenue",
    "profit": "gross_profit",
    "cost": "cost",
    "discount_amount": "discount_amount",
    "units": "quantity",
}
#: Columns of a cube (see `operators/cube`): the grouping a row counts orders in (null for cells), and that count.
MARK, ORDERS = "_tillwise_grouping", "_tillwise_orders"
RANKED_DIMENSIONS = {dimension: place for place, dimension in enumerate(DIMENSIONS)}


def order_identity(facts: DataFrame) -> Column:
    """What distinct orders are counted on: the narrow key where the source has one."""
    return F.col(ORDER_KEY if ORDER_KEY in facts.columns else "order_id")


def is_cube(facts: DataFrame) -> bool:
    return MARK in facts.columns


def grouping_name(by: Sequence[str]) -> str:
    return ",".join(sorted(by)) or "all"


def _aggregates(facts: DataFrame, sums: Sequence[str], orders: bool) -> list[Column]:
    columns = [total(facts, SUMS[name]).alias(name) for name in sums]
    if orders:
        counted = F.coalesce(F.sum(ORDERS), F.lit(0)) if is_cube(facts) else F.countDistinct(order_identity(facts))
        columns.append(counted.alias("orders"))
    return columns


def _cube_rows(cube: DataFrame, by: Sequence[str | Column], orders: bool) -> DataFrame:
    """The cells, and the rows that count orders in this grouping."""
    cells = F.col(MARK).isNull()
    if not orders:
        return cube.where(cells)
    if not all(isinstance(x, str) for x in by):
        raise ValueError("Group a cube by names of columns.")
    name = grouping_name(by)
    if cube.where(F.col(MARK) == name).isEmpty() and not cube.where(cells).isEmpty():
        raise ValueError(f"The cube does not count orders by {name}.")
    return cube.where(cells | (F.col(MARK) == name))


def exact_economics(
    facts: DataFrame, by: Sequence[str | Column], sums: Sequence[str] = tuple(SUMS), orders: bool = True
) -> DataFrame:
    """Grouped sums in the type of the facts (exact for decimals).

    Distinct orders are counted in the same aggregation: rows first shrink to one per group and
    order on the map side, which also dissolves a hot group before anything is shuffled. A cube counted them before.
    """
    if is_cube(facts):
        facts = _cube_rows(facts, by, orders)
    return facts.groupBy(*by).agg(*_aggregates(facts, sums, orders))


def with_rates(grouped: DataFrame) -> DataFrame:
    return grouped.withColumns(
        {"margin": ratio("profit", "revenue"), "discount_rate": ratio("discount_amount", "gross_revenue")}
    )


def money_as_double(df: DataFrame) -> DataFrame:
    """Leave the exact type once everything is summed."""
    decimals = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({c: F.col(c).cast("double") for c in decimals})


def group_economics(facts: DataFrame, by: Sequence[str | Column], orders: bool = True) -> DataFrame:
    """Sums, distinct orders, margin and discount rate per group; rates are null on a zero base."""
    return with_rates(money_as_double(exact_economics(facts, by, orders=orders)))


def cents(value: Column, digits: int = 2) -> Column:
    """Round while the value is still exact, then leave the exact type."""
    return F.round(value, digits).cast("double")


def executive_kpis(facts: DataFrame) -> DataFrame:
    """Thirteen headline metrics; ratios on an empty base are zero."""
    whole = exact_economics(facts, [])
    whole = whole.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in SUMS})
    revenue = cents(F.col("revenue"))
    return whole.select(
        cents(F.col("gross_revenue")).alias("gross_revenue"),
        revenue.alias("net_revenue"),
        revenue.alias("revenue"),
        F.col("units").alias("units_sold"),
        "orders",
        F.round(ratio_or_zero("revenue", "orders"), 2).alias("average_order_value"),
        F.round(ratio_or_zero("revenue", "units"), 2).alias("average_selling_price"),
        cents(F.col("cost")).alias("cost"),
        cents(F.col("profit")).alias("gross_profit"),
        F.round(ratio_or_zero("profit", "revenue"), 4).alias("gross_margin"),
        cents(F.col("discount_amount")).alias("discount_amount"),
        F.round(ratio_or_zero("discount_amount", "gross_revenue"), 4).alias("discount_rate"),
        F.round(ratio_or_zero(F.col("gross_revenue") - F.col("cost"), "gross_revenue"), 4).alias(
            "margin_before_discount"
        ),
    )


def view_kpis(facts: DataFrame, by: Sequence[str | Column] = ()) -> DataFrame:
    """Eleven unrounded metrics of a filtered view, all zero when nothing matches."""
    grouped = exact_economics(facts, by)
    grouped = money_as_double(grouped.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in SUMS}))
    return grouped.withColumns(
        {
            "margin": ratio_or_zero("profit", "revenue"),
            "discount_rate": ratio_or_zero("discount_amount", "gross_revenue"),
            "average_order_value": ratio_or_zero("revenue", "orders"),
            "average_selling_price": ratio_or_zero("revenue", "units"),
        }
    )


def monthly_series(facts: DataFrame) -> DataFrame:
    grouped = money_as_double(exact_economics(facts, ["month"], orders=False))
    return grouped.select(
        "month",
        "revenue",
        "profit",
        ratio_or_zero("profit", "revenue").alias("margin"),
        ratio_or_zero("discount_amount", "gross_revenue").alias("discount_rate"),
    ).orderBy("month")


def _products(facts: DataFrame) -> DataFrame:
    grouped = money_as_double(exact_economics(facts, ["product"], orders=False))
    return grouped.select(
        "product",
        "revenue",
        "profit",
        ratio_or_zero("profit", "revenue").alias("margin"),
        ratio_or_zero("discount_amount", "gross_revenue").alias("discount_rate"),
        "units",
    )


def product_series(facts: DataFrame) -> DataFrame:
    return _products(facts).orderBy(F.desc("revenue"), "product")


def product_table(
    facts: DataFrame, sort_by: str = "revenue", ascending: bool = False, top: int | None = 12, risk_margin: float = 0.25
) -> DataFrame:
    """Products sorted by any of their columns, thin margins flagged; the first rows unless all are asked for."""
    rows = _products(facts).withColumn("at_risk", F.col("margin") < risk_margin)
    ordered = rows.orderBy(F.col(sort_by).asc() if ascending else F.col(sort_by).desc(), "product")
    return ordered if top is None else ordered.limit(top)


def profitability_map(facts: DataFrame) -> DataFrame:
    """Products against the upper median of their margins."""
    products = durable(_products(facts))
    middle = order_statistics(products, "margin", {"benchmark": upper_median_position()}).select("benchmark")
    placed = products.withColumn("benchmark_margin", middle.scalar())
    return placed.select(
        "product",
        "revenue",
        "margin",
        "units",
        "benchmark_margin",
        (F.col("margin") < F.col("benchmark_margin")).alias("below_benchmark"),
    )


def by_dimension(facts: DataFrame, dimensions: Sequence[str] = DIMENSIONS) -> DataFrame:
    """One row per line and dimension. An exploded array keeps the partitioning of the lines."""
    pairs = [F.struct(F.lit(d).alias("dimension"), F.col(d).alias("value")) for d in dimensions]
    rows = facts.select("*", F.explode(F.array(*pairs)).alias("_pair")).select("*", "_pair.*").drop("_pair", *dimensions)
    if not is_cube(facts):
        return rows
    counts = F.col(MARK) == F.col("dimension")  # orders counted by a dimension belong to its values only
    name = F.when(counts, F.lit(grouping_name(["dimension", "value"])))
    return rows.where(F.col(MARK).isNull() | counts).withColumn(MARK, name)


def dimension_economics(facts: DataFrame, dimensions: Sequence[str] = DIMENSIONS, orders: bool = True) -> DataFrame:
    """Economics of every value of every dimension in one pass over the facts."""
    return group_economics(by_dimension(facts, dimensions), ["dimension", "value"], orders=orders)


def dimension_place(dimension: Column | str = "dimension") -> Column:
    places = F.create_map(*[F.lit(x) for pair in RANKED_DIMENSIONS.items() for x in pair])
    return F.element_at(places, F.col(dimension) if isinstance(dimension, str) else dimension)


def with_shares(summary: DataFrame) -> DataFrame:
    """Shares of the dimension's total.

    The summary is written out first: the totals, one row per dimension, then come from it and not
    from a second pass over the facts.
    """
    summary = durable(summary)
    totals = summary.groupBy("dimension").agg(
        F.sum("revenue").alias("_revenue"), F.sum("profit").alias("_profit")
    )
    joined = summary.join(F.broadcast(totals), "dimension")
    share = {
        f"{name}_share": F.col(name) / F.when(F.col(f"_{name}") == 0, 1.0).otherwise(F.col(f"_{name}"))
        for name in ("revenue", "profit")
    }
    return joined.withColumns(share).drop("_revenue", "_profit")


def dimension_summary(facts: DataFrame, dimensions: Sequence[str] = DIMENSIONS) -> DataFrame:
    """Economics and shares per dimension value, largest revenue first within each dimension."""
    summary = with_shares(dimension_economics(facts, dimensions))
    return summary.orderBy(dimension_place(), F.desc("revenue"), "value")


def combination_summary(facts: DataFrame, dimensions: Sequence[str], limit: int = 60) -> DataFrame:
    """The combinations of dimension values with the largest revenue."""
    return group_economics(facts, dimensions).orderBy(F.desc("revenue"), *dimensions).limit(limit)


def seasonality(facts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Economics per month of year, across all years."""
    return group_economics(facts, [*by, "month_of_year"]).orderBy(*by, "month_of_year")


def pareto_curve(facts: DataFrame, dimension: str) -> DataFrame:
    """Entities by falling revenue with their share and the running share."""
    entities = exact_economics(facts, [dimension], sums=("revenue",), orders=False)
    order = [F.desc("revenue"), F.col(dimension)]
    curve = durable(
        running_totals(
            entities.withColumn("_one", F.lit(1).cast("bigint")), order, {"_reached": "revenue", "rank": "_one"}
        )
    )
    whole = curve.agg(F.sum("revenue")).scalar().cast("double")
    base = F.when(whole == 0, 1.0).otherwise(whole)
    return curve.select(
        dimension,
        F.col("revenue").cast("double").alias("revenue"),
        (F.col("revenue").cast("double") / base).alias("revenue_share"),
        (F.col("_reached").cast("double") / base).alias("cumulative_revenue_share"),
        "rank",
    )


def pareto_summary(facts: DataFrame, dimension: str, level: float = 0.8, leaders: int = 3) -> DataFrame:
    """How many entities it takes to reach a share of revenue, and what the leaders hold."""
    curve = pareto_curve(facts, dimension)
    counted = curve.agg(
        (F.count_if(F.col("cumulative_revenue_share") < level) + 1).alias("entities_for_80_percent"),
        F.count("*").alias("entity_count"),
        F.sum(F.when(F.col("rank") <= leaders, F.col("revenue_share"))).alias("_leaders"),
    )
    return counted.select(
        F.lit(dimension).alias("dimension"),
        "entities_for_80_percent",
        "entity_count",
        F.round(F.col("entities_for_80_percent") / F.greatest(F.col("entity_count"), F.lit(1)), 4).alias(
            "share_of_entities_for_80_percent"
        ),
        F.round("_leaders", 4).alias(f"top_{leaders}_revenue_share"),
    )


def economic_bridge(facts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Gross revenue to gross profit as ordered steps."""
    grouped = exact_economics(facts, by, orders=False)
    grouped = money_as_double(grouped.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in SUMS}))
    steps = (
        ("gross_revenue", "gross_revenue"),
        ("discount_amount", "discount_amount"),
        ("net_revenue", "revenue"),
        ("cost", "cost"),
        ("gross_profit", "profit"),
    )
    rows = [
        F.struct(F.lit(i).alias("step"), F.lit(name).alias("item"), F.col(column).alias("amount"))
        for i, (name, column) in enumerate(steps, start=1)
    ]
    return grouped.select(*by, F.inline(F.array(*rows))).orderBy(*by, "step")
