"""Where a table came from and what can be filtered in it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.operators.economics import by_dimension
from tillwise.operators.validate import CHECKS
from tillwise.schema import SCHEMA_VERSION


def lineage_metadata(
    facts: DataFrame,
    column_count: int,
    status: str,
    schema_version: str = SCHEMA_VERSION,
    checks: Sequence[str] = CHECKS,
) -> DataFrame:
    """Size, date range and checks of a fact table in one row."""
    return facts.agg(
        F.lit(schema_version).alias("schema_version"),
        F.count("*").alias("row_count"),
        F.lit(column_count).alias("column_count"),
        F.lit(status).alias("validation_status"),
        F.array(*[F.lit(c) for c in checks]).alias("validation_checks"),
        F.date_format(F.min("order_date"), "yyyy-MM-dd").alias("date_min"),
        F.date_format(F.max("order_date"), "yyyy-MM-dd").alias("date_max"),
    )


def fact_gaps(facts: DataFrame) -> DataFrame:
    """Lines whose order or part is missing, in one row.

    A line without a cost counts in revenue but not in cost and profit, so margins over it are too low; `uncosted_revenue`
    says by how much revenue.
    """
    uncosted = F.col("cost").isNull()
    return facts.agg(
        F.count("*").alias("lines"),
        F.count_if(F.col("order_date").isNull()).alias("undated_lines"),
        F.count_if(uncosted).alias("uncosted_lines"),
        F.coalesce(F.sum(F.when(uncosted, F.col("net_revenue"))), F.lit(0)).alias("uncosted_revenue"),
    )


#: Columns of the added-up digests: sums of parts of a table add up to those of the table.
DIGEST_SUMS = ("digest_high", "digest_low")


def digest_sums(columns: Sequence[str]) -> list[Column]:
    """Two 64-bit parts of every row's digest, added up exactly.

    Every value is written with its length in front, so that different rows never read the same.
    """
    texts = [F.col(c).cast("string") for c in columns]
    line = F.concat(*[F.coalesce(F.concat(F.length(x).cast("string"), F.lit(":"), x), F.lit("-")) for x in texts])
    digest = F.sha2(line, 256)
    parts = [F.conv(F.substring(digest, at, 16), 16, 10).cast("decimal(20,0)") for at in (1, 17)]
    return [F.coalesce(F.sum(part), F.lit(0)).alias(name) for part, name in zip(parts, DIGEST_SUMS, strict=True)]


def fingerprint_of(total: DataFrame, seed: int = 0) -> DataFrame:
    """Fingerprint and build id from the digest sums and the `row_count` of a whole table."""
    told = total.select(F.concat_ws("-", *[F.col(c).cast("string") for c in DIGEST_SUMS]).alias("fingerprint"), "row_count")
    parts: list[Column] = [F.col("fingerprint"), F.col("row_count").cast("string"), F.lit(SCHEMA_VERSION), F.lit(str(seed))]
    return told.withColumn("build_id", F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 16))


def dataset_fingerprint(df: DataFrame, columns: Sequence[str], seed: int = 0) -> DataFrame:
    """A fingerprint of the rows that does not depend on their order or partitioning.

    The build id digests the sums, the row count, the schema version and the seed.
    """
    return fingerprint_of(df.agg(*digest_sums(columns), F.count("*").alias("row_count")), seed)


def filter_options(facts: DataFrame) -> DataFrame:
    """The distinct values of every dimension, blanks left out."""
    pairs = by_dimension(facts).select("dimension", "value").where(F.col("value") != "")
    return pairs.distinct().orderBy("dimension", "value")
