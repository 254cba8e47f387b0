"""A corpus pipeline of four stages over `documents`: quality rules, near duplicates, secrets, packing.

Every stage takes (spark, docs, folder of the tables) and works on all rows its predecessor kept. The first three return
the columns of `documents`; the last returns the packed pieces. Empty tables give empty results, extra columns stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillwise.llm import quality, queries, secrets, simhash
from tillwise.llm.common import read, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the forest keep. The forest is fitted on the labelled ones among `docs`."""
    detector = quality.fit_detector(docs, read(spark, sf_dir, "labels"))
    return quality.keep_good(docs, detector)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of linked SimHash fingerprints: the one with the smallest id, in full."""
    return simhash.keep_one(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced in their texts."""
    return secrets.redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return queries.packed_rows(docs)


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("secret_scan", secret_scan), ("packing", packing)]

#: No stage but the scan can be said in SQL: a fitted forest, a component search and a packing. Tests check each
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what a stage returns is written and read again for the next."""
    docs = read(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = written(docs)
    return docs
