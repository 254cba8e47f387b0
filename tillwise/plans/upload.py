"""Bring your own data: read a file, map its columns, keep what is valid."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tillwise.operators.ingest import ROW_INDEX, Ingest, ingest
from tillwise.operators.mapping import infer_mapping
from tillwise.plans.report import upload_sections
from tillwise.session import configure
from tillwise.sources.sinks import write_issues, write_sections
from tillwise.sources.tables import read_upload


def accept(rows: DataFrame, mapping: Mapping[str, str] | None = None) -> Ingest:
    """Check numbered rows and insist on at least one valid one."""
    result = ingest(rows, mapping or infer_mapping([c for c in rows.columns if c != ROW_INDEX]))
    if result.facts.isEmpty():
        raise ValueError("No valid rows remain after validation. Review the mapping and source data.")
    return result


def load_upload(
    spark: SparkSession,
    path: str,
    folder: str,
    mapping: Mapping[str, str] | None = None,
    file_format: str = "parquet",
) -> Ingest:
    """Read a sales file and write its sections, its quality report and its rejected rows."""
    configure(spark)
    rows = read_upload(spark, path)
    result = accept(rows, mapping)
    sections = upload_sections(result.facts, len(rows.columns) - 1) | {"quality": result.quality}
    write_sections(sections, folder, file_format)
    write_issues(result.issues, f"{folder.rstrip('/')}/issues")
    return result
