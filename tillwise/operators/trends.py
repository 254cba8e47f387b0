"""Monthly trends, unusual months and the direction of products."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.calendar import month_start
from tillwise.functions.ratios import ratio, relative_change
from tillwise.operators.economics import (
    MARK,
    cents,
    exact_economics,
    group_economics,
    grouping_name,
    is_cube,
    money_as_double,
    monthly_series,
    with_rates,
)
from tillwise.operators.ordering import order_statistics, quantile_position
from tillwise.session import durable

# Scale that makes a median deviation comparable to a standard deviation.
MAD_SCALE = 0.6745

# How a month came to be flagged.
MAD_METHOD = "MAD robust z-score"
BATCH_FALLBACK_METHOD = "median-centered z-score fallback (MAD=0)"
VIEW_FALLBACK_METHOD = "standard deviation fallback"


def monthly_performance(facts: DataFrame, by: Sequence[str] = (), calendar: bool = False) -> DataFrame:
    """Economics per month with growth, rolling means and acceleration.

    Windows run over the grouped months only. Year-on-year looks 12 rows back by default and at the
    same month of the year before with ``calendar``; the two differ when months are missing.
    """
    months = group_economics(facts, [*by, "month"])
    series = Window.partitionBy(*by).orderBy("month")
    last_three = series.rowsBetween(-2, 0)

    def earlier(column: str, rows: int) -> Column:
        return F.lag(column, rows).over(series)

    months = months.withColumns(
        {
            "mom_revenue_growth": relative_change("revenue", earlier("revenue", 1)),
            "mom_profit_growth": relative_change("profit", earlier("profit", 1)),
            "margin_change_pp": (F.col("margin") - earlier("margin", 1)) * 100,
            "revenue_rolling_3m": F.avg("revenue").over(last_three),
            "profit_rolling_3m": F.avg("profit").over(last_three),
        }
    )
    if calendar:
        position = F.year(month_start("month")) * 12 + F.month(month_start("month"))
        months = months.withColumn("_position", position)
        same_month = Window.partitionBy(*by).orderBy("_position").rangeBetween(-12, -12)
        year_ago = {m: F.max(m).over(same_month) for m in ("revenue", "profit")}
    else:
        year_ago = {m: earlier(m, 12) for m in ("revenue", "profit")}
    months = months.withColumns(
        {
            **{f"yoy_{m}_growth": relative_change(m, past) for m, past in year_ago.items()},
            "growth_acceleration": F.col("mom_revenue_growth") - earlier("mom_revenue_growth", 1),
        }
    )
    return months.drop("_position").orderBy(*by, "month")


def _deviations(values: DataFrame, by: Sequence[str], spread: Column) -> DataFrame:
    """Each month's value with the median, the median deviation and a spread of its series."""
    series = Window.partitionBy(*by)
    centred = values.withColumn("median", F.median("value").over(series)).withColumn("spread", spread.over(series))
    return centred.withColumn("mad", F.median(F.abs(F.col("value") - F.col("median"))).over(series))


def _flagged(scored: DataFrame, fallback_method: str, threshold: float) -> DataFrame:
    by_mad = F.col("robust")
    distance = F.col("value") - F.col("median")
    score = F.when(by_mad, F.lit(MAD_SCALE) * distance / F.nullif(F.col("mad"), F.lit(0.0))).otherwise(
        F.coalesce(ratio(distance, "spread"), F.lit(0.0))
    )
    return (
        scored.withColumn("robust_z_score", score)
        .where(F.abs("robust_z_score") >= threshold)
        .withColumns(
            {
                "direction": F.when(F.col("robust_z_score") > 0, "high").otherwise("low"),
                "method": F.when(by_mad, MAD_METHOD).otherwise(fallback_method),
                "threshold": F.lit(float(threshold)),
            }
        )
    )


def robust_anomalies(facts: DataFrame, threshold: float = 3.0, by: Sequence[str] = ()) -> DataFrame:
    """Months whose revenue, profit or margin lies far from the median of its series.

    Months without a margin are left out of the margin series.
    """
    months = with_rates(money_as_double(exact_economics(facts, [*by, "month"], orders=False)))
    metrics = [F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in ("revenue", "profit", "margin")]
    values = months.select(*by, "month", F.inline(F.array(*metrics))).where(F.col("value").isNotNull())
    scored = _deviations(values, [*by, "metric"], F.stddev_pop("value")).withColumn("robust", F.col("mad") > 0)
    flagged = _flagged(scored, BATCH_FALLBACK_METHOD, threshold)
    digits = F.when(F.col("metric") == "margin", F.round("value", 4)).otherwise(F.round("value", 2))
    return flagged.select(
        *by, "month", "metric", digits.alias("value"), F.round("robust_z_score", 3).alias("robust_z_score"),
        "direction", "method", "threshold",
    ).orderBy(*by, F.array_position(F.array(*[F.lit(m) for m in ("revenue", "profit", "margin")]), "metric"), "month")


def revenue_anomalies(facts: DataFrame, threshold: float = 3.0, min_months: int = 6) -> DataFrame:
    """The interactive variant: revenue only, enough months required, sample deviation as fallback."""
    values = monthly_series(facts).select("month", F.lit("revenue").alias("metric"), F.col("revenue").alias("value"))
    scored = _deviations(values, ["metric"], F.stddev_samp("value"))
    scored = scored.withColumn("robust", F.col("mad") > 1e-9)
    scored = scored.withColumn("_months", F.count("*").over(Window.partitionBy("metric")))
    flagged = _flagged(scored.where(F.col("_months") >= min_months), VIEW_FALLBACK_METHOD, threshold)
    return flagged.select("month", "metric", "value", "robust_z_score", "direction", "method", "threshold").orderBy("month")


def anomalies_in_window(anomalies: DataFrame, start_date: str, end_date: str) -> DataFrame:
    """Anomalies of the months touched by a date range."""
    return anomalies.where(F.col("month").between(start_date[:7], end_date[:7]))


def product_economics(
    facts: DataFrame, growing: float = 0.12, declining: float = -0.08, margin_slip: float = 0.015, months: int = 3
) -> DataFrame:
    """Products with their economics, the change from their first to their last months, and a profile.

    Every line is counted twice, once for its product and category and once for its product and
    month, in a single aggregation; the first and last months are then a window per product.
    """
    grains = F.array(
        F.struct(F.col("category").alias("_category"), F.lit(None).cast("string").alias("_month")),
        F.struct(F.lit(None).cast("string").alias("_category"), F.col("month").alias("_month")),
    )
    grained = facts.select("*", F.explode(grains).alias("_grain")).select("*", "_grain.*")
    if is_cube(facts):  # orders are counted by product and category, in the first grain
        counts = (F.col(MARK) == grouping_name(["product", "category"])) & F.col("_category").isNotNull()
        grained = grained.where(F.col(MARK).isNull() | counts).withColumn(
            MARK, F.when(F.col(MARK).isNotNull(), F.lit(grouping_name(["product", "_category", "_month"])))
        )
    grouped = exact_economics(grained, ["product", "_category", "_month"])
    with_margin = with_rates(grouped)

    per_product = Window.partitionBy("product")
    monthly = F.col("_month").isNotNull()
    position = Window.partitionBy("product", monthly)
    ranked = with_margin.withColumns(
        {
            "_from_start": F.row_number().over(position.orderBy(F.asc("_month"))),
            "_from_end": F.row_number().over(position.orderBy(F.desc("_month"))),
        }
    )

    def mean_of(metric: str, rank: str) -> Column:
        return F.avg(F.when(monthly & (F.col(rank) <= months), F.col(metric).cast("double"))).over(per_product)

    directed = ranked.withColumns(
        {
            "first_revenue": mean_of("revenue", "_from_start"),
            "last_revenue": mean_of("revenue", "_from_end"),
            "first_margin": mean_of("margin", "_from_start"),
            "last_margin": mean_of("margin", "_from_end"),
        }
    ).where(~monthly)
    growth = F.coalesce(relative_change("last_revenue", "first_revenue"), F.lit(0.0))
    products = durable(directed.withColumn("growth", growth))

    median = order_statistics(products, "margin", {"median": quantile_position(0.5)}).select("median")
    rising = F.col("growth") > growing
    profile = (
        F.when(rising & (F.col("margin") > F.col("median_margin")), "strong-growth-strong-margin")
        .when(rising & (F.col("last_margin") < F.col("first_margin") - margin_slip), "growth-margin-pressure")
        .when(F.col("growth") < declining, "declining")
        .otherwise("stable")
    )
    return (
        products.withColumn("median_margin", median.scalar())
        .select(
            "product",
            F.col("_category").alias("category"),
            cents(F.col("revenue")).alias("revenue"),
            cents(F.col("profit")).alias("profit"),
            F.round("margin", 4).alias("margin"),
            F.round("discount_rate", 4).alias("discount_rate"),
            "units",
            "orders",
            F.round("growth", 4).alias("recent_revenue_growth"),
            F.round((F.col("last_margin") - F.col("first_margin")) * 100, 2).alias("recent_margin_change_pp"),
            profile.alias("growth_profile"),
        )
        .orderBy(F.desc("revenue"), "product")
    )
