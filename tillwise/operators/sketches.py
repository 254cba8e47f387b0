"""Approximate quantiles, for those who ask for them: one mergeable sketch per group and month.

The exact quantiles in `ordering` shuffle one row per distinct value. A sketch has a bounded size whatever the number
of lines, sketches of months merge into those of any range of months, and new months never touch old ones. The price is
an error in rank: the share of values below an estimate may be off by `rank_error`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.operators.ordering import broadcast_if_small

SKETCH, LINES = "sketch", "lines"
SIZE = 400  # values kept in the top level of a sketch; Spark takes 8 to 65,535

# The normalised rank error that 99 of 100 estimates of a KLL sketch keep, as a function of its size.
ERROR_SCALE, ERROR_POWER = 2.296, 0.9021


def rank_error(size: int = SIZE) -> float:
    """The stated error in rank, as a share of the lines: twice what 99 of 100 estimates keep, so that a breach is not to be expected."""
    return 2 * ERROR_SCALE / size**ERROR_POWER


def month_sketches(facts: DataFrame, value: str, by: Sequence[str] = (), size: int = SIZE) -> DataFrame:
    """A sketch of the non-null values for every group and month: `by`, `month`, `sketch`, `lines`.

    Sketches are partly built on the map side, so that a hot group shuffles one sketch a task.
    """
    known = facts.where(F.col(value).isNotNull())
    number = F.col(value).cast("double")
    return known.groupBy(*by, "month").agg(F.kll_sketch_agg_double(number, size).alias(SKETCH), F.count("*").alias(LINES))


def merged_quantiles(sketches: DataFrame, shares: Sequence[float], by: Sequence[str] = (), size: int = SIZE) -> DataFrame:
    """`by`, `share`, `estimate` and `lines` from sketches of any months; a group without values has no row."""
    merged = sketches.groupBy(*by).agg(F.kll_merge_agg_double(SKETCH, size).alias(SKETCH), F.sum(LINES).alias(LINES))
    asked = [
        F.struct(F.lit(float(s)).alias("share"), F.kll_sketch_get_quantile_double(SKETCH, F.lit(float(s))).alias("estimate"))
        for s in shares
    ]
    return merged.where(F.col(LINES) > 0).select(*by, F.inline(F.array(*asked)), LINES)


def rank_errors(facts: DataFrame, value: str, estimates: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Add `error` to a written table of estimates: how far its share lies from the shares of lines below and up to the estimate.

    The lines are counted against the estimates of their group in one pass; ties with the estimate count in its favour.
    """
    known = facts.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_value"))
    listed = estimates.groupBy(*by).agg(F.collect_list(F.struct("share", "estimate")).alias("_asked"))
    if by:
        joined = known.join(broadcast_if_small(listed), list(by))
    else:
        joined = known.withColumn("_asked", listed.select("_asked").scalar())
    below, upto = F.col("_value") < F.col("_one.estimate"), F.col("_value") <= F.col("_one.estimate")
    counted = joined.select(*by, "_value", F.explode("_asked").alias("_one")).groupBy(*by, F.col("_one.share").alias("share")).agg(
        F.count_if(below).alias("_below"), F.count_if(upto).alias("_upto")
    )

    def apart(lines: Column) -> Column:
        wanted = F.col("share") * lines
        return F.greatest(F.col("_below") - wanted, wanted - F.col("_upto"), F.lit(0.0)) / lines

    return estimates.join(counted, [*by, "share"]).select(*estimates.columns, apart(F.col(LINES)).alias("error"))
