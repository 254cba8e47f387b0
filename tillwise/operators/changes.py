"""What changed between two periods, and which dimension values drove it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.calendar import month_bounds, shift_month_key
from tillwise.functions.ratios import ratio_or_zero, relative_change
from tillwise.operators.economics import by_dimension, money_as_double, view_kpis
from tillwise.operators.filters import Filters, filter_facts, previous_period
from tillwise.operators.totals import total
from tillwise.schema import DIMENSION_LABELS, FILTER_KEYS

BRIEF_SCHEMA = (
    "mode string, current_month string, previous_month string, revenue_delta double, revenue_growth double, "
    "profit_delta double, profit_growth double, margin_delta double"
)
DRIVER_SCHEMA = (
    "direction string, rank int, dimension string, filter_key string, value string, "
    "delta double, current double, previous double"
)


def month_catalogue(facts: DataFrame, *sums: Column) -> DataFrame:
    """A row per month: its lines, its first and last day and any further sums. Catalogues of parts of a table add up, see `merged_catalogue`."""
    days = (F.min("order_date").alias("first_day"), F.max("order_date").alias("last_day"))
    return facts.groupBy("month").agg(F.count("*").alias("lines"), *days, *sums).where(F.col("month").isNotNull())


def merged_catalogue(catalogue: DataFrame) -> DataFrame:
    """One row per month of catalogues written at different times."""
    days = (F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"))
    return catalogue.groupBy("month").agg(F.sum("lines").alias("lines"), *days)


def months_present(facts: DataFrame, complete_only: bool = False, catalogue: DataFrame | None = None) -> list[str]:
    """The months with sales, oldest first: a calendar-bounded list, from a catalogue of months where there is one.

    With ``complete_only`` the last month counts only if sales reach its last day.
    """
    known = month_catalogue(facts) if catalogue is None else merged_catalogue(catalogue)
    found = known.where(F.col("lines") > 0).select("month", "last_day").collect()
    months = sorted(row.month for row in found)
    if complete_only and months:
        last_day = max(row.last_day for row in found if row.month == months[-1])
        following = month_bounds(months[-1])[1]
        if (following - last_day).days > 1:
            months = months[:-1]
    return months


def compared_months(
    facts: DataFrame, mode: str, complete_only: bool = False, catalogue: DataFrame | None = None
) -> tuple[str, str] | None:
    """The latest month and the one it is compared with.

    ``latest`` takes the month present before it, ``mom`` the calendar month before it or else the
    month present before it, ``yoy`` the same month of the year before or nothing.
    """
    months = months_present(facts, complete_only, catalogue)
    if len(months) < 2:
        return None
    current = months[-1]
    if mode == "latest":
        return current, months[-2]
    wanted = shift_month_key(current, -12 if mode == "yoy" else -1)
    if wanted in months:
        return current, wanted
    return None if mode == "yoy" else (current, months[-2])


def in_months(facts: DataFrame, months: tuple[str, ...]) -> DataFrame:
    """Facts of some months, as date ranges that reach the scan and month keys that prune partitions."""
    date, kept = F.col("order_date"), F.lit(False)
    for month in months:
        first, following = month_bounds(month)
        kept = kept | ((date >= F.lit(first)) & (date < F.lit(following)))
    return facts.where(kept & F.col("month").isin(*months))


def _at(facts: DataFrame, month: str, column: str) -> Column:
    return F.coalesce(total(facts, column, F.col("month") == month), F.lit(0))


def period_brief(facts: DataFrame, mode: str = "mom", complete_only: bool = False, catalogue: DataFrame | None = None) -> DataFrame:
    """One row of changes in revenue, profit and margin, or none without two comparable months.

    With a catalogue of months only the lines of the two months are read.
    """
    chosen = compared_months(facts, mode, complete_only, catalogue)
    if chosen is None:
        return facts.sparkSession.createDataFrame([], BRIEF_SCHEMA)
    current, previous = chosen
    totals = in_months(facts, chosen).agg(
        *[
            _at(facts, month, column).cast("double").alias(f"{metric}_{when}")
            for when, month in (("now", current), ("then", previous))
            for metric, column in (("revenue", "net_revenue"), ("profit", "gross_profit"))
        ]
    )
    margin = {when: ratio_or_zero(f"profit_{when}", f"revenue_{when}") for when in ("now", "then")}
    return totals.select(
        F.lit(mode).alias("mode"),
        F.lit(current).alias("current_month"),
        F.lit(previous).alias("previous_month"),
        (F.col("revenue_now") - F.col("revenue_then")).alias("revenue_delta"),
        relative_change("revenue_now", "revenue_then").alias("revenue_growth"),
        (F.col("profit_now") - F.col("profit_then")).alias("profit_delta"),
        relative_change("profit_now", "profit_then").alias("profit_growth"),
        (margin["now"] - margin["then"]).alias("margin_delta"),
    )


def what_changed(facts: DataFrame, catalogue: DataFrame | None = None) -> DataFrame:
    """The last two months present."""
    return period_brief(facts, "latest", catalogue=catalogue)


def period_drivers(
    facts: DataFrame, mode: str = "mom", top: int = 5, complete_only: bool = False, catalogue: DataFrame | None = None
) -> DataFrame:
    """The dimension values with the largest revenue gains and losses across all dimensions.

    Only the two compared months are read, with a catalogue also to find them. Current and previous revenue come from one conditional
    aggregation, so values seen in one month only need no outer join.
    """
    chosen = compared_months(facts, mode, complete_only, catalogue)
    if chosen is None:
        return facts.sparkSession.createDataFrame([], DRIVER_SCHEMA)
    current, previous = chosen
    sliced = by_dimension(in_months(facts, chosen))
    moved = (
        sliced.groupBy("dimension", "value")
        .agg(
            _at(sliced, current, "net_revenue").alias("current"),
            _at(sliced, previous, "net_revenue").alias("previous"),
        )
        .withColumn("delta", F.col("current") - F.col("previous"))
        .where(F.col("delta") != 0)
        .withColumn("direction", F.when(F.col("delta") > 0, "positive").otherwise("negative"))
    )
    strongest = Window.partitionBy("direction").orderBy(F.abs("delta").desc(), "dimension", "value")
    ranked = money_as_double(moved.withColumn("rank", F.row_number().over(strongest)).where(F.col("rank") <= top))

    def named(names: dict[str, str]) -> Column:
        return F.element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), F.col("dimension"))

    return ranked.select(
        "direction",
        "rank",
        named(DIMENSION_LABELS).alias("dimension"),
        named(FILTER_KEYS).alias("filter_key"),
        "value",
        "delta",
        "current",
        "previous",
    ).orderBy(F.desc("direction"), "rank")


# The compared metrics of a view and whether their change is relative or absolute.
COMPARED_METRICS = (
    ("revenue", "relative"),
    ("profit", "relative"),
    ("margin", "absolute"),
    ("discount_amount", "relative"),
    ("average_order_value", "relative"),
    ("average_selling_price", "relative"),
)


def period_over_period_kpis(facts: DataFrame, filters: Filters, min_date: str) -> DataFrame:
    """Metrics of the filtered view against the window before it, one row per metric, in one scan.

    Changes are null when the data does not reach back over a whole window.
    """
    before = previous_period(filters, min_date)
    span = filters if before is None else Filters(**{**filters.__dict__, "start_date": before.start_date})
    start = F.lit(filters.start_date).cast("date")
    flagged = filter_facts(facts, span).withColumn(
        "period", F.when(F.col("order_date") >= start, "current").otherwise("previous")
    )
    kpis = view_kpis(flagged, ["period"])

    def at(period: str, metric: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("period") == period, F.col(metric))), F.lit(0.0))

    wide = kpis.agg(
        *[at(p, m).alias(f"{m}_{p}") for m, _ in COMPARED_METRICS for p in ("current", "previous")]
    )
    rows = []
    for metric, kind in COMPARED_METRICS:
        now, then = F.col(f"{metric}_current"), F.col(f"{metric}_previous")
        change = relative_change(now, then) if kind == "relative" else now - then
        known = before is not None
        rows.append(
            F.struct(
                F.lit(metric).alias("metric"),
                F.lit(kind).alias("change_kind"),
                now.alias("current"),
                (then if known else F.lit(None).cast("double")).alias("previous"),
                (change if known else F.lit(None).cast("double")).alias("change"),
            )
        )
    return wide.select(F.inline(F.array(*rows)))
