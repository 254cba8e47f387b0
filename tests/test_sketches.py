"""Sketches merge over months and keep their stated error in rank."""

import pytest
from pyspark.sql import functions as F

from tillwise.operators.sketches import SIZE, merged_quantiles, month_sketches, rank_error, rank_errors

SHARES = (0.01, 0.5, 0.85)


@pytest.fixture(scope="module")
def values(spark):
    """Two groups of very different sizes, over months, with a hot value and nulls."""
    i = F.col("id")
    return spark.range(60_000).select(
        F.when(i % 100 == 0, "small").otherwise("large").alias("kind"),
        F.concat(F.lit("2024-"), F.lpad((i % 7 + 1).cast("string"), 2, "0")).alias("month"),
        F.when(i % 11 == 0, None).when(i % 3 == 0, 0.5).otherwise((i * 7919 % 60_000) / 60_000.0).alias("x"),
    )


def test_merged_months_keep_the_error(values):
    months = month_sketches(values, "x", ["kind"])
    assert months.count() == 14
    estimates = merged_quantiles(months, SHARES, ["kind"]).cache()
    errors = rank_errors(values, "x", estimates, ["kind"]).collect()
    assert len(errors) == 6 and all(r.error <= rank_error() for r in errors)
    lines = {r.kind: r.lines for r in errors}
    assert lines == {r.kind: r.n for r in values.groupBy("kind").agg(F.count("x").alias("n")).collect()}


def test_a_range_of_months_and_no_groups(values):
    some = values.where("month <= '2024-03'")
    estimates = merged_quantiles(month_sketches(values, "x").where("month <= '2024-03'"), SHARES).cache()
    errors = rank_errors(some, "x", estimates).collect()
    assert len(errors) == 3 and all(r.error <= rank_error() for r in errors)


def test_few_values_are_exact_and_none_gives_no_row(spark):
    few = spark.createDataFrame([("a", "m", 1.0), ("a", "m", 2.0), ("a", "n", 3.0), ("b", "m", None)], "g string, month string, x double")
    found = merged_quantiles(month_sketches(few, "x", ["g"]), [0.5], ["g"]).collect()
    assert [(r.g, r.estimate, r.lines) for r in found] == [("a", 2.0, 3)]
    assert merged_quantiles(month_sketches(few.limit(0), "x"), [0.5]).count() == 0


def test_larger_sketches_err_less():
    assert rank_error(4 * SIZE) < rank_error(SIZE) < 0.025
