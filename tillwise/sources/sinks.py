"""Files out: report sections and rejected rows."""

from __future__ import annotations

from collections.abc import Mapping
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.operators.changes import merged_catalogue, month_catalogue
from tillwise.operators.lineage import DIGEST_SUMS, digest_sums, fingerprint_of
from tillwise.schema import FACT_COLUMNS

# Beside the month partitions of a fact table: a row per month and write, hidden from readers of the facts.
CATALOGUE = "_catalogue"
# Not digested: quotients of other columns, which engines write out differently.
RATIOS = ("gross_margin",)


def write_sections(sections: Mapping[str, DataFrame], folder: str, file_format: str = "parquet") -> None:
    """One table per report section; each is written by the executors."""
    for name, section in sections.items():
        section.write.mode("overwrite").format(file_format).save(f"{folder.rstrip('/')}/{name}")


def write_facts(facts: DataFrame, path: str) -> None:
    """Joined facts as a month-partitioned table, which later queries prune and need not join, with a catalogue of its months.

    The rebalance hint gives each month few files and lets a hot month spread over several tasks.
    """
    _write(facts, path, "overwrite")


def append_facts(facts: DataFrame, path: str) -> None:
    """Add facts to a table. Only the new lines are digested and counted; the catalogue gets rows for their months."""
    _write(facts, path, "append")


def _write(facts: DataFrame, path: str, mode: str) -> None:
    spark, place = facts.sparkSession, path.rstrip("/")
    there = set() if mode == "overwrite" else _files(spark, facts, place)
    facts.hint("rebalance", "month").write.mode(mode).option("compression", "zstd").partitionBy("month").parquet(place)
    # The catalogue is made from the files just written: the facts, with their joins, are computed only once.
    added = sorted(_files(spark, facts, place) - there)
    written = spark.read.schema(facts.schema).option("basePath", place).parquet(*added) if added else facts.limit(0)
    columns = [c for c in FACT_COLUMNS if c in facts.columns and c not in RATIOS]
    month_catalogue(written, *digest_sums(columns)).write.mode(mode).parquet(f"{place}/{CATALOGUE}")


def _files(spark: SparkSession, facts: DataFrame, place: str) -> set[str]:
    """The fact files of a table; none where there is no table yet."""
    try:
        return {unquote(file) for file in spark.read.schema(facts.schema).parquet(place).inputFiles()}
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return set()


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """The months of a written fact table: `month`, `lines`, `first_day`, `last_day`."""
    return merged_catalogue(spark.read.parquet(f"{path.rstrip('/')}/{CATALOGUE}"))


def stored_fingerprint(spark: SparkSession, path: str, seed: int = 0) -> DataFrame:
    """The fingerprint of a written fact table from its catalogue; no line is read."""
    known = spark.read.parquet(f"{path.rstrip('/')}/{CATALOGUE}")
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in DIGEST_SUMS]
    return fingerprint_of(known.agg(*sums, F.coalesce(F.sum("lines"), F.lit(0)).alias("row_count")), seed)


def write_issues(issues: DataFrame, path: str) -> None:
    """All rejected rows as CSV with quoted text."""
    ordered = issues.select("row", "field", "value", "issue")
    writer = ordered.write.mode("overwrite").option("header", True).option("escape", '"')
    writer.csv(path)
