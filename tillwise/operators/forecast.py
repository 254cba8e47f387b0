"""Monthly revenue forecasts per series, and how well they would have done."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.calendar import month_start, shift_month
from tillwise.operators.economics import exact_economics

MIN_MONTHS = 6
SEASONAL_MONTHS = 18
BAND = 1.96

# How a forecast was made.
SEASONAL_METHOD = "Trend + shrunk month-of-year seasonality"
LINEAR_METHOD = "Linear trend (insufficient history for seasonality)"


def _series(facts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Monthly revenue numbered along each series; gaps between months are closed up."""
    months = exact_economics(facts, [*by, "month"], sums=("revenue",), orders=False)
    whole = Window.partitionBy(*by)
    return months.select(
        *by,
        "month",
        F.col("revenue").cast("double").alias("actual"),
        (F.row_number().over(whole.orderBy("month")) - 1).alias("position"),
        F.count("*").over(whole).alias("months"),
        F.month(month_start("month")).alias("month_of_year"),
    ).where(F.col("months") >= MIN_MONTHS)


def _trend(window: Window, actual: Column) -> dict[str, Column]:
    position = F.col("position").cast("double")
    return {
        "slope": F.regr_slope(actual, position).over(window),
        "intercept": F.regr_intercept(actual, position).over(window),
    }


def _fitted() -> Column:
    return F.col("intercept") + F.col("slope") * F.col("position")


def _season(mean_ratio: Column) -> Column:
    """Half of a month's usual departure from the trend, none where the month is unknown."""
    return F.coalesce(0.5 + 0.5 * mean_ratio, F.lit(1.0))


def revenue_forecast(facts: DataFrame, horizon: int = 3, by: Sequence[str] = ()) -> DataFrame:
    """The next months of each series with a band, from a linear trend and shrunken seasons.

    Series with fewer than six months are left out. All steps stay on the partitioning by series.
    """
    whole = Window.partitionBy(*by)
    fitted = _series(facts, by).withColumns(_trend(whole, F.col("actual")))
    fitted = fitted.withColumn("fitted", _fitted())
    known = ["months", "slope", "intercept"]
    seasons = fitted.groupBy(*by, "month_of_year").agg(
        *[F.max(c).alias(c) for c in known],
        F.max("month").alias("last_month"),
        F.sum(F.pow(F.col("actual") - F.col("fitted"), 2)).alias("squares"),
        F.avg(F.col("actual") / F.greatest(F.col("fitted"), F.lit(1.0))).alias("mean_ratio"),
    )
    # At most twelve seasons per series.
    models = seasons.groupBy(*by).agg(
        *[F.max(c).alias(c) for c in (*known, "last_month")],
        F.sum("squares").alias("squares"),
        F.map_from_entries(F.collect_list(F.struct("month_of_year", "mean_ratio"))).alias("mean_ratios"),
    )
    known_series = models.where(F.col("months").isNotNull())  # a single series may be too short
    ahead = known_series.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    ahead = ahead.withColumn("month", shift_month("last_month", F.col("step")))
    seasonal = F.col("months") >= SEASONAL_MONTHS
    mean_ratio = F.try_element_at("mean_ratios", F.month(month_start("month")))
    trend = F.col("intercept") + F.col("slope") * (F.col("months") + F.col("step") - 1)
    revenue = F.greatest(F.lit(0.0), trend * _season(F.when(seasonal, mean_ratio)))
    error = F.sqrt(F.col("squares") / F.greatest(F.col("months") - 2, F.lit(1)))
    band = BAND * error * F.sqrt(1 + F.col("step") / F.col("months"))
    return (
        ahead.withColumns({"revenue": revenue, "band": band})
        .select(
            *by,
            "step",
            "month",
            "revenue",
            F.greatest(F.lit(0.0), F.col("revenue") - F.col("band")).alias("lower"),
            (F.col("revenue") + F.col("band")).alias("upper"),
            F.when(seasonal, SEASONAL_METHOD).otherwise(LINEAR_METHOD).alias("method"),
        )
        .orderBy(*by, "step")
    )


def forecast_backtest(facts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean absolute percentage error of one-step forecasts from up to six growing histories.

    Each month is repeated for the cutoffs it precedes or is the target of, at most six times, and
    every cutoff is fitted as its own window of the series.
    """
    cutoffs = F.filter(
        F.sequence(F.greatest(F.lit(5), F.col("months") - 6).cast("int"), (F.col("months") - 1).cast("int")),
        lambda cutoff: cutoff >= F.col("position"),
    )
    repeated = _series(facts, by).withColumn("cutoff", F.explode(cutoffs))
    history = F.col("position") < F.col("cutoff")
    fold = Window.partitionBy(*by, "cutoff")
    fitted = repeated.withColumns(
        {
            **_trend(fold, F.when(history, F.col("actual"))),
            "last_month": F.max(F.when(history, F.col("month"))).over(fold),
        }
    ).withColumn("fitted", _fitted())
    same_season = F.col("month_of_year") == F.month(F.add_months(month_start("last_month"), 1))
    folds = fitted.groupBy(*by, "cutoff").agg(
        F.max("slope").alias("slope"),
        F.max("intercept").alias("intercept"),
        F.max(F.when(~history, F.col("actual"))).alias("actual"),
        F.avg(F.when(history & same_season, F.col("actual") / F.greatest(F.col("fitted"), F.lit(1.0)))).alias("mean_ratio"),
    )
    season = _season(F.when(F.col("cutoff") >= SEASONAL_MONTHS, F.col("mean_ratio")))
    trend = F.col("intercept") + F.col("slope") * F.col("cutoff")
    folds = folds.withColumn("predicted", F.greatest(F.lit(0.0), trend * season))
    scored = (F.col("predicted") != 0) & (F.col("actual") != 0)
    miss = F.abs(F.col("actual") - F.col("predicted")) / F.nullif(F.abs("actual"), F.lit(0.0))
    checked = folds.groupBy(*by).agg(
        F.count("*").alias("tried"),
        F.avg(F.when(scored, miss)).alias("validation_mape"),
        F.count_if(scored).alias("folds"),
    )
    checked = checked.where(F.col("tried") > 0).drop("tried")
    return checked.orderBy(*by) if by else checked
