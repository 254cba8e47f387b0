"""The batch report: validate, enrich, and every section as its own table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.operators import discounts, economics, lineage, recommend, trends
from tillwise.operators.cube import sales_cube
from tillwise.operators.facts import enrich, export_facts
from tillwise.operators.ingest import UPLOAD_CHECKS
from tillwise.operators.totals import with_units
from tillwise.operators.validate import validate
from tillwise.schema import RAW_COLUMNS, UPLOAD_SCHEMA_VERSION
from tillwise.session import configure, stored
from tillwise.sources.sinks import write_sections

# Two-dimensional summaries and how many combinations each keeps.
COMBINATIONS = {
    "category_channel": (("category", "channel"), 60),
    "region_category": (("region", "category"), 60),
    "channel_segment": (("channel", "customer_segment"), 60),
    "product_channel": (("product", "channel"), 40),
}


# How the numbers of a report are defined; the years are those of the data.
METHODOLOGY = {
    "anomaly_detection": "Monthly revenue, profit, and margin use MAD robust z-scores; |z| >= 3.0 is flagged.",
    "growth": "MoM uses percentage change from the immediately preceding month; YoY uses the same month 12 months earlier; "
    "acceleration is the first difference of MoM growth.",
    "margin": "Gross margin = (net revenue - cost) / net revenue. Margin before discount uses gross revenue as the denominator.",
    "discount": "Discount amount = gross revenue - net revenue. Weighted discount rate = total discount amount / total gross revenue.",
    "seasonality": "Month-of-year patterns are descriptive across the observed {years} history and are not causal claims.",
}
BUILD_MODE = "deterministic"
# Input files a report names at most.
NAMED_FILES = 20


def methodology(cube: DataFrame) -> DataFrame:
    """A row per topic. The years come from the months of the cube."""
    year = F.substring("month", 1, 4)
    first, last = F.min(year), F.max(year)
    years = cube.agg(F.when(first == last, first).otherwise(F.concat(first, F.lit("–"), last)).alias("years"))
    topics = [F.struct(F.lit(k).alias("topic"), F.lit(v).alias("text")) for k, v in METHODOLOGY.items()]
    text = F.replace("text", F.lit("{years}"), F.coalesce("years", F.lit("empty"))).alias("text")
    return years.select("years", F.inline(F.array(*topics))).select("topic", text)


def report_sections(raw: DataFrame, facts: DataFrame, checked: dict, source_file: str = "", seed: int = 0) -> dict[str, DataFrame]:
    """Every section of the report by name. All that add up lines start from one cube; only quantiles of lines, ranks of lines,
    the date range and the export read the facts."""
    cube = sales_cube(facts)
    fingerprint = lineage.dataset_fingerprint(raw, RAW_COLUMNS, seed)
    metadata = lineage.lineage_metadata(facts, checked["column_count"], checked["status"])
    build = fingerprint.select(F.struct("fingerprint", "build_id")).scalar()
    metadata = metadata.withColumn("_build", build).select("*", "_build.fingerprint", "_build.build_id").drop("_build")
    told = {"source_file": F.lit(source_file), "build_mode": F.lit(BUILD_MODE), "random_seed": F.lit(seed)}
    metadata = metadata.withColumns(told)
    sections = {
        "metadata": metadata,
        "filter_options": lineage.filter_options(cube),
        "summary": economics.executive_kpis(cube),
        "monthly_performance": trends.monthly_performance(cube),
        "dimensions": economics.dimension_summary(cube),
    }
    for name, (pair, limit) in COMBINATIONS.items():
        sections[f"combinations_{name}"] = economics.combination_summary(cube, pair, limit)
    for dimension in ("product", "category"):
        sections[f"pareto_{dimension}"] = economics.pareto_summary(cube, dimension)
        sections[f"pareto_{dimension}_curve"] = economics.pareto_curve(cube, dimension)
    sections |= {
        "discount_summary": discounts.discount_summary(cube),
        "discount_leakage": discounts.discount_leakage(facts),
        "discount_margin_spearman": discounts.discount_margin_spearman(facts),
        "discount_distribution": discounts.discount_distribution(cube),
        "product_economics": trends.product_economics(cube),
        "anomalies": trends.robust_anomalies(cube),
        "seasonality_month": economics.seasonality(cube),
        "seasonality_category": economics.seasonality(cube, ["category"]),
        "seasonality_channel": economics.seasonality(cube, ["channel"]),
        "recommendations": recommend.recommendations(cube),
        "methodology": methodology(cube),
        "records": export_facts(facts),
    }
    return sections


def build_report(
    raw: DataFrame,
    folder: str,
    file_format: str = "parquet",
    as_of: dt.date | None = None,
    min_date: dt.date = dt.date(2000, 1, 1),
    seed: int = 0,
) -> dict:
    """Validate a raw sales table (raising on the first broken rule) and write all sections.

    The metadata names the files the table was read from, if it was read from files.
    """
    configure(raw.sparkSession)
    checked = validate(raw, as_of, min_date)
    facts = enrich(raw)
    if isinstance(facts.schema["net_revenue"].dataType, T.DecimalType):
        facts = with_units(facts)
    facts = stored(facts)  # every section starts from here
    names = sorted({path.rstrip("/").rsplit("/", 1)[-1] for path in raw.inputFiles()[:NAMED_FILES]})
    write_sections(report_sections(raw, facts, checked, ", ".join(names), seed), folder, file_format)
    return checked


def upload_sections(facts: DataFrame, column_count: int) -> dict[str, DataFrame]:
    """What an accepted upload is shown with before any filter is set."""
    return {
        "metadata": lineage.lineage_metadata(
            facts, column_count, "passed", schema_version=UPLOAD_SCHEMA_VERSION, checks=UPLOAD_CHECKS
        ),
        "filter_options": lineage.filter_options(facts),
        "summary": economics.view_kpis(facts).select(
            F.col("revenue").alias("net_revenue"),
            "gross_revenue",
            F.col("profit").alias("gross_profit"),
            F.col("margin").alias("gross_margin"),
            "discount_amount",
            "discount_rate",
            "orders",
            "units",
            "average_order_value",
            "average_selling_price",
            "cost",
        ),
        "anomalies": trends.revenue_anomalies(facts),
        "recommendations": recommend.dynamic_recommendations(facts),
        "records": facts,
    }
