"""Named queries: (session, table folder) to DataFrame."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping
from dataclasses import replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.catalog.uploads import configure_upload, net_amount, sales_file, sales_upload, untidy_amount, untidy_date
from tillwise.functions.parsing import parse_date, parse_number
from tillwise.operators import changes, discounts, economics, forecast, lineage, opportunity, recommend, sketches, trends
from tillwise.operators.cube import sales_cube
from tillwise.operators.facts import enrich, exact_money, export_facts
from tillwise.operators.filters import Filters, default_filters, filter_facts, previous_period
from tillwise.operators.ingest import ROW_INDEX, Ingest, ingest
from tillwise.operators.mapping import infer_mapping
from tillwise.operators.validate import check_summary, duplicate_ids, gate_status, validation_report
from tillwise.plans.report import COMBINATIONS, methodology
from tillwise.schema import DIMENSIONS, RAW_COLUMNS, UNITS
from tillwise.session import configure, ensure_checkpoint_dir, stored
from tillwise.sources.sinks import append_facts, read_catalogue, stored_fingerprint, write_facts, write_issues
from tillwise.sources.star import order_months, raw_sales, read_table, sales_facts, stored_bytes
from tillwise.sources.tables import read_sales_csv, read_upload

Query = Callable[[SparkSession, str], DataFrame]

DIGITS = 6
ECONOMICS = ("cost",)
CALENDAR = ("order_date", "month")

# The window and values the filtered queries look at.
VIEW = Filters("1997-01-01", "1998-12-31", region="ASIA", segment="BUILDING")
DATA_START = "1995-01-01"
BOTH_PERIODS = replace(VIEW, start_date=previous_period(VIEW, DATA_START).start_date)
SCOPE = Filters("1995-01-01", "2001-08-01", region="EUROPE", category="PROMO", product="PROMO red widget")
# The test data has small spreads between slices; the shipped thresholds would keep nothing.
RADAR = opportunity.Thresholds(recovery_share=1e-5, margin_gap=0.001)
SCENARIOS = (
    *opportunity.PRESETS,
    opportunity.Scenario("Price -10%, cost -5%", price_pct=-10, cost_pct=-5),
    opportunity.Scenario("Discount to floor", discount_pp=-10),
    opportunity.Scenario("Discount to ceiling", discount_pp=95),
)


def tidy(df: DataFrame, digits: Mapping[str, int] | None = None) -> DataFrame:
    """Round doubles to a common precision, and show arrays and structs as flat text columns."""
    digits = digits or {}
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            rounded = F.round(column, digits.get(field.name, DIGITS))
            columns.append(F.when(rounded == 0, 0.0).otherwise(rounded).alias(field.name))  # no negative zero
        elif isinstance(field.dataType, T.DecimalType):
            columns.append(column.cast("double").alias(field.name))
        elif isinstance(field.dataType, T.ArrayType):
            columns.append(F.concat_ws("; ", column).alias(field.name))
        elif isinstance(field.dataType, T.StructType):
            columns += [column.getField(f).alias(f"{field.name}_{f}") for f in field.dataType.names]
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType)):
            columns.append(column.cast("bigint").alias(field.name))
        elif isinstance(field.dataType, T.DateType):
            columns.append(F.date_format(column, "yyyy-MM-dd").alias(field.name))
        else:
            columns.append(column)
    return df.select(*columns)


def on_facts(
    operator: Callable[[DataFrame], DataFrame],
    *columns: str,
    digits: Mapping[str, int] | None = None,
    within: Filters | None = None,
) -> Query:
    """A query that applies an operator to the facts it needs columns of, within filters that it applies itself."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        configure(spark, stored_bytes(spark, folder))
        return tidy(operator(sales_facts(spark, folder, columns, within)), digits)

    return run


def on_months(operator: Callable[..., DataFrame], *columns: str) -> Query:
    """A query that compares months, which it finds in a catalogue made from the orders alone."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        configure(spark, stored_bytes(spark, folder))
        return tidy(operator(sales_facts(spark, folder, columns), catalogue=order_months(spark, folder)))

    return run


def stored_build(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and months of facts that were written in two parts, from their catalogue."""
    configure(spark)
    facts = sales_facts(spark, folder, pinned=True)
    ensure_checkpoint_dir(spark)
    place = f"{spark.sparkContext.getCheckpointDir()}/facts-{uuid.uuid4().hex}"
    early = F.col("order_date") < F.lit(VIEW.start_date).cast("date")
    write_facts(facts.where(early), place)
    append_facts(facts.where(~early), place)
    months = read_catalogue(spark, place).agg(F.count("*").alias("months"), F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"))
    return tidy(months.withColumn("build", stored_fingerprint(spark, place).select(F.struct("fingerprint", "row_count")).scalar())
                .select("months", "first_day", "last_day", "build.fingerprint", "build.row_count"))


def on_cube(operator: Callable[[DataFrame], DataFrame], digits: Mapping[str, int] | None = None) -> Query:
    """A query that applies an operator to the cube of all facts."""
    return on_facts(lambda f: operator(sales_cube(f)), *ECONOMICS, *CALENDAR, *DIMENSIONS, digits=digits)


def on_upload(view: Callable[[Ingest], DataFrame], digits: Mapping[str, int] | None = None) -> Query:
    """A query over the checked rows of the untidy upload."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        configure_upload(spark, folder)
        rows = sales_upload(spark, folder)
        mapping = infer_mapping([c for c in rows.columns if c != ROW_INDEX])
        return tidy(view(ingest(rows, mapping)), digits)

    return run


def file_products(spark: SparkSession, folder: str) -> DataFrame:
    """Accepted rows and revenue by product, of the upload written as CSV files and read back by byte ranges."""
    configure_upload(spark, folder)
    rows = read_upload(spark, sales_file(spark, folder))
    found = ingest(rows, infer_mapping([c for c in rows.columns if c != ROW_INDEX]))
    revenue = F.sum(F.col("net_revenue").cast("decimal(18,2)"))
    return tidy(found.facts.groupBy("product", "category").agg(F.count("*").alias("rows"), revenue.alias("revenue")))


def rejected_file(spark: SparkSession, folder: str) -> DataFrame:
    """What was wrong with how many rows, from the file of rejected rows of the upload."""
    configure_upload(spark, folder)
    rows = sales_upload(spark, folder)
    place = _new_place(spark, "issues")
    write_issues(ingest(rows, infer_mapping([c for c in rows.columns if c != ROW_INDEX])).issues, place)
    read = spark.read.schema("row bigint, field string, value string, issue string").option("header", True).option("escape", '"').csv(place)
    return read.groupBy("field", "issue").agg(
        F.count("*").alias("issues"), F.countDistinct("row").alias("rows"), F.min("row").alias("first_row"), F.max("row").alias("last_row")
    )


def typed_file(spark: SparkSession, folder: str) -> DataFrame:
    """Costs by category and channel of the sales table, written as CSV, read with types and enriched."""
    configure(spark)
    place = _new_place(spark, "sales")
    raw_sales(spark, folder).write.option("header", True).option("escape", '"').csv(place)
    facts = enrich(read_sales_csv(spark, place))
    return tidy(facts.groupBy("category", "channel").agg(
        F.count("*").alias("rows"), F.sum("quantity").alias("units"), F.sum("cost").alias("cost"), F.sum("discount_rate").alias("rates"),
        F.min("order_date").alias("first_day"), F.max("order_date").alias("last_day")))


def _new_place(spark: SparkSession, name: str) -> str:
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def validation(spark: SparkSession, folder: str) -> DataFrame:
    configure(spark)
    report = validation_report(raw_sales(spark, folder), dt.date(2001, 1, 1), dt.date(1996, 1, 1))
    return tidy(report)


# What every so many-th line is spoiled with, by the rest of its number: at least one line breaks each row rule.
SPOIL_EVERY = 199
SPOILED = (
    (0, "transaction_id", "BAD-1"), (1, "order_id", "oops"), (2, "order_date", "2024-02-30"), (3, "order_date", "not-a-date"),
    (4, "order_date", "2099-01-01"), (5, "order_date", "1990-05-05"), (6, "quantity", "abc"), (7, "quantity", "0"),
    (8, "quantity", "-3"), (9, "quantity", "1.5"), (10, "list_price", "NaN"), (11, "list_price", "-5"),
    (12, "list_price", "100d"), (13, "unit_cost", "-2"), (14, "discount_rate", "1.1"), (15, "discount_rate", "-0.1"),
    (16, "region", None), (17, "product", None), (18, "unit_cost", "2f"), (19, "discount_rate", "x"),
)


def spoiled_validation(spark: SparkSession, folder: str) -> DataFrame:
    """The strict gate over the lines as text, some of them spoiled."""
    configure(spark)
    raw = raw_sales(spark, folder)
    rest = F.substring("transaction_id", 5, 20).cast("bigint") % SPOIL_EVERY
    text = {c: F.col(c).cast("string") for c in RAW_COLUMNS}
    for number, column, value in SPOILED:
        text[column] = F.when(rest == number, F.lit(value)).otherwise(text[column])
    report = validation_report(raw.select(*[x.alias(c) for c, x in text.items()]), dt.date(2001, 1, 1), dt.date(1996, 1, 1))
    return tidy(report.drop("examples"))


def lineage_row(spark: SparkSession, folder: str) -> DataFrame:
    """Size and dates of the facts, with the outcome of the gate over the same rows."""
    status = gate_status(validation(spark, folder))
    return tidy(lineage.lineage_metadata(sales_facts(spark, folder, ("order_date",)), len(RAW_COLUMNS), status))


def duplicates(spark: SparkSession, folder: str) -> DataFrame:
    configure(spark)
    return tidy(duplicate_ids(sales_facts(spark, folder, ()).select("transaction_id")))


def fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    configure(spark)
    columns = ("gross_revenue" if c == "list_price" else c for c in RAW_COLUMNS)
    return tidy(lineage.dataset_fingerprint(sales_facts(spark, folder).withColumn(
        "gross_revenue", F.col("gross_revenue").cast("decimal(15,2)")), list(columns)))


def numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Amounts written in several ways, and what is read back."""
    configure(spark)
    amount = net_amount()
    text = (
        F.when(F.col("l_linestatus") == "F", untidy_amount(amount, "l_tax"))
        .when(F.col("l_returnflag") == "A", F.concat(F.rint(F.col("l_discount") * 100).cast("int").cast("string"), F.lit(" %")))
        .when(F.col("l_returnflag") == "R", F.concat(F.lit("€ "), amount.cast("string")))
        .when(F.col("l_linenumber") == 1, F.concat(amount.cast("string"), F.lit("d")))
        .when(F.col("l_linenumber") == 2, F.concat(F.col("l_linenumber").cast("string"), F.lit("e3")))
        .when(F.col("l_linenumber") == 3, F.lit("NaN"))
        .when(F.col("l_linenumber") == 4, F.concat(F.lit("-"), amount.cast("string")))
        .otherwise(F.lit(""))
    )
    written = read_table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", text.alias("written"))
    return tidy(written.withColumn("number", parse_number(F.col("written"))))


def dates(spark: SparkSession, folder: str) -> DataFrame:
    """Order dates written in several ways, and what is read back."""
    configure(spark)
    orders = read_table(spark, folder, "orders")
    style = F.when(F.col("o_orderstatus") == "O", "R").when(F.col("o_orderstatus") == "F", "A").otherwise("I")
    text = (
        F.when(F.col("o_orderpriority") == "5-LOW", F.date_format("o_orderdate", "dd-MM-yy"))
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.date_format("o_orderdate", "MMM d, yyyy"))
        .when(F.col("o_orderpriority") == "1-URGENT", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .otherwise(untidy_date("o_orderdate", "style"))
    )
    written = orders.withColumn("style", style).select("o_orderkey", text.alias("written"))
    return tidy(written.withColumn("date", parse_date(F.col("written"))))


def columns_validation(spark: SparkSession, folder: str) -> DataFrame:
    """The strict gate over the lines without two of their columns and with one that does not belong."""
    configure(spark)
    raw = raw_sales(spark, folder).drop("channel", "unit_cost").withColumn("note", F.lit("x"))
    return tidy(validation_report(raw, dt.date(2001, 1, 1), dt.date(1996, 1, 1)))


def default_view(facts: DataFrame) -> DataFrame:
    """Headline numbers under the filters a view opens with."""
    chosen = default_filters(facts)
    found = economics.view_kpis(filter_facts(facts, chosen))
    return found.withColumns({"start_date": F.lit(chosen.start_date), "end_date": F.lit(chosen.end_date)})


MISSING_MONTH = "1996-05"
QUANTILES = (0.05, 0.25, 0.5, 0.85, 0.99)


def calendar_growth(facts: DataFrame) -> DataFrame:
    """Monthly performance with the year before looked up in the calendar, where a month has no lines."""
    return trends.monthly_performance(facts.where(F.col("month") != MISSING_MONTH), calendar=True)


def approximate_margins(facts: DataFrame) -> DataFrame:
    """Quantiles of the line margin by region from sketches of its months, and whether each keeps the stated error in rank."""
    months = stored(sketches.month_sketches(facts, "gross_margin", ["region"]))
    estimates = stored(sketches.merged_quantiles(months, QUANTILES, ["region"]))
    checked = sketches.rank_errors(facts, "gross_margin", estimates, ["region"])
    return checked.select("region", "share", "lines", (F.col("error") <= sketches.rank_error()).alias("within_error"))


# Thresholds so low that every rule finds something in the test data.
LOW = {"channel_spread": 1e-6, "profit_lag": -0.5, "weak_margin": 1e-5, "weak_discount": 1e-5}


def _scoped(facts: DataFrame, **thresholds: float) -> DataFrame:
    return recommend.scoped_recommendations(recommend.recommendations(facts, **thresholds), SCOPE, top=5)


MONEY_MEANS = {"revenue_rolling_3m": 2, "profit_rolling_3m": 2, "margin_change_pp": 4}
FORECAST = {"revenue": 2, "lower": 2, "upper": 2}
EVIDENCE = {"revenue": 4, "profit": 4}

QUERIES: dict[str, Query] = {
    "kpis": on_facts(economics.executive_kpis, *ECONOMICS),
    "monthly_performance": on_facts(trends.monthly_performance, *ECONOMICS, "month", digits=MONEY_MEANS),
    "dimension_summary": on_facts(economics.dimension_summary, *ECONOMICS, *DIMENSIONS),
    **{
        f"combo_{name}": on_facts(
            lambda f, pair=pair, limit=limit: economics.combination_summary(f, pair, limit), *ECONOMICS, *pair
        )
        for name, (pair, limit) in COMBINATIONS.items()
    },
    "seasonality_month": on_facts(economics.seasonality, *ECONOMICS, "month_of_year"),
    "seasonality_category": on_facts(
        lambda f: economics.seasonality(f, ["category"]), *ECONOMICS, "category", "month_of_year"
    ),
    "seasonality_channel": on_facts(
        lambda f: economics.seasonality(f, ["channel"]), *ECONOMICS, "channel", "month_of_year"
    ),
    "monthly_series": on_facts(economics.monthly_series, *ECONOMICS, "month"),
    "product_series": on_facts(economics.product_series, *ECONOMICS, "product"),
    "product_table": on_facts(
        lambda f: economics.product_table(f, sort_by="margin", ascending=True, risk_margin=0.45), *ECONOMICS, "product"
    ),
    "profitability_map": on_facts(economics.profitability_map, *ECONOMICS, "product"),
    "pareto_product": on_facts(lambda f: economics.pareto_curve(f, "product"), *ECONOMICS, "product"),
    "pareto_category": on_facts(lambda f: economics.pareto_curve(f, "category"), *ECONOMICS, "category"),
    "pareto_summary": on_facts(
        lambda f: economics.pareto_summary(f, "product").unionByName(economics.pareto_summary(f, "category")),
        *ECONOMICS,
        "product",
        "category",
    ),
    "discount_distribution": on_facts(discounts.discount_distribution, *ECONOMICS),
    "discount_summary": on_facts(discounts.discount_summary, *ECONOMICS),
    "discount_leakage": on_facts(discounts.discount_leakage),
    "discount_margin_spearman": on_facts(discounts.discount_margin_spearman, "gross_margin"),
    "anomalies": on_facts(lambda f: trends.robust_anomalies(f, threshold=2.5), *ECONOMICS, "month"),
    "revenue_anomalies": on_facts(trends.revenue_anomalies, *ECONOMICS, "month"),
    "anomalies_in_window": on_facts(
        lambda f: trends.anomalies_in_window(trends.robust_anomalies(f, threshold=1.0), VIEW.start_date, VIEW.end_date),
        *ECONOMICS,
        "month",
    ),
    "anomalies_by_region": on_facts(
        lambda f: trends.robust_anomalies(f, threshold=2.5, by=["region"]), *ECONOMICS, "month", "region"
    ),
    "product_economics": on_facts(trends.product_economics, *ECONOMICS, "product", "month"),
    "filtered_kpis": on_facts(
        lambda f: economics.view_kpis(filter_facts(f, VIEW)), *ECONOMICS, *CALENDAR, "region", "customer_segment", within=VIEW
    ),
    "period_over_period_kpis": on_facts(
        lambda f: changes.period_over_period_kpis(f, VIEW, DATA_START),
        *ECONOMICS,
        *CALENDAR,
        "region",
        "customer_segment",
        within=BOTH_PERIODS,
    ),
    "what_changed": on_months(changes.what_changed, *ECONOMICS, *CALENDAR),
    "period_brief_mom": on_months(partial(changes.period_brief, mode="mom"), *ECONOMICS, *CALENDAR),
    "period_brief_yoy": on_months(partial(changes.period_brief, mode="yoy"), *ECONOMICS, *CALENDAR),
    "period_drivers_latest": on_months(partial(changes.period_drivers, mode="latest"), *CALENDAR, *DIMENSIONS),
    "period_drivers_mom": on_months(partial(changes.period_drivers, mode="mom"), *CALENDAR, *DIMENSIONS),
    "period_drivers_yoy": on_months(
        partial(changes.period_drivers, mode="yoy", complete_only=True), *CALENDAR, *DIMENSIONS
    ),
    "opportunity_radar": on_facts(
        lambda f: opportunity.opportunity_radar(f, RADAR),
        *ECONOMICS,
        *DIMENSIONS,
        digits={"estimated_discount_recovery": 2, "priority_score": 2},
    ),
    "economic_bridge": on_facts(lambda f: economics.economic_bridge(f), *ECONOMICS),
    "economic_bridge_by_region": on_facts(lambda f: economics.economic_bridge(f, ["region"]), *ECONOMICS, "region"),
    "scenario_grid": on_facts(
        lambda f: opportunity.scenario_grid(f, SCENARIOS, ["region"]).drop(
            "break_even_price_pct", "price_above_break_even_pp"
        ),
        *ECONOMICS,
        "region",
        digits={"projected_revenue": 2, "projected_profit": 2},
    ),
    "break_even_price": on_facts(
        lambda f: opportunity.scenario_grid(f, SCENARIOS).select(
            "scenario", "break_even_price_pct", "price_above_break_even_pp"
        ),
        *ECONOMICS,
    ),
    "forecast": on_facts(forecast.revenue_forecast, *CALENDAR, digits=FORECAST),
    "forecast_by_category": on_facts(
        lambda f: forecast.revenue_forecast(f, by=["category"]), *CALENDAR, "category", digits=FORECAST
    ),
    "forecast_backtest": on_facts(
        lambda f: forecast.forecast_backtest(f, by=["category"]), *CALENDAR, "category"
    ),
    "recommendations": on_facts(recommend.recommendations, *ECONOMICS, *DIMENSIONS, digits=EVIDENCE),
    "scoped_recommendations": on_facts(_scoped, *ECONOMICS, *DIMENSIONS, digits=EVIDENCE),
    "dynamic_recommendations": on_facts(
        lambda f: recommend.dynamic_recommendations(f, tension=0.98, discount_alert=0.04, margin_gap=0.001),
        *ECONOMICS,
        *DIMENSIONS,
        digits=EVIDENCE,
    ),
    "recommendations_low_thresholds": on_facts(partial(recommend.recommendations, **LOW), *ECONOMICS, *DIMENSIONS, digits=EVIDENCE),
    "scoped_recommendations_low_thresholds": on_facts(partial(_scoped, **LOW), *ECONOMICS, *DIMENSIONS, digits=EVIDENCE),
    "dynamic_recommendations_high": on_facts(
        lambda f: recommend.dynamic_recommendations(f, tension=0.98, discount_alert=0.04, discount_high=0.04, margin_gap=0.001),
        *ECONOMICS,
        *DIMENSIONS,
        digits=EVIDENCE,
    ),
    "opportunity_radar_high": on_facts(
        lambda f: opportunity.opportunity_radar(f, replace(RADAR, high_profit_share=1e-6, high_revenue_share=1e-6)),
        *ECONOMICS,
        *DIMENSIONS,
        digits={"estimated_discount_recovery": 2, "priority_score": 2},
    ),
    "monthly_performance_calendar": on_facts(calendar_growth, *ECONOMICS, "month", digits=MONEY_MEANS),
    "default_view_kpis": on_facts(default_view, *ECONOMICS, *CALENDAR),
    "approximate_margin_quantiles": on_facts(approximate_margins, "gross_margin", "month", "region"),
    "cube_monthly_performance": on_cube(trends.monthly_performance, digits=MONEY_MEANS),
    "cube_dimension_summary": on_cube(economics.dimension_summary),
    "cube_product_economics": on_cube(trends.product_economics),
    "enriched_facts": on_facts(
        lambda f: f.drop("order_key", *UNITS.values()), *ECONOMICS, *CALENDAR, *DIMENSIONS
    ),
    "fact_export": on_facts(export_facts, *ECONOMICS, *CALENDAR, *DIMENSIONS),
    "lineage_metadata": lineage_row,
    "dataset_fingerprint": fingerprint,
    "stored_build": stored_build,
    "filter_options": on_facts(lineage.filter_options, *DIMENSIONS),
    "validation_report": validation,
    "validation_report_spoiled": spoiled_validation,
    "validation_report_columns": columns_validation,
    "check_summary": lambda spark, folder: tidy(check_summary(validation(spark, folder))),
    "duplicate_ids": duplicates,
    "parse_number": numbers,
    "parse_date": dates,
    "ingest_facts": on_upload(lambda i: i.facts),
    "ingest_duplicates": on_upload(lambda i: i.duplicates),
    "ingest_issues": on_upload(lambda i: i.issues),
    "ingest_preview": on_upload(lambda i: i.preview),
    "ingest_quality": on_upload(lambda i: i.quality),
    "ingest_file_products": file_products,
    "ingest_rejected_file": rejected_file,
    "typed_file_costs": typed_file,
    "fact_gaps": on_facts(lineage.fact_gaps, *ECONOMICS, "order_date"),
    "report_methodology": on_cube(methodology),
    "ingest_summary": on_upload(
        lambda i: economics.view_kpis(exact_money(i.facts)),
        digits={c: 2 for c in ("gross_revenue", "revenue", "profit", "cost", "discount_amount")},
    ),
}
