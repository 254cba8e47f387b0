"""What discounts cost and where they leak."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.functions.bands import DISCOUNT_BANDS, discount_bucket
from tillwise.functions.ratios import ratio, ratio_or_zero
from tillwise.operators import ordering
from tillwise.operators.economics import cents, group_economics, is_cube
from tillwise.operators.ordering import average_ranks, order_statistics, quantile_position, running_totals
from tillwise.operators.totals import total
from tillwise.session import durable

# Values on at least one row in this many are hot; there cannot be more than this many of them.
HOT_SHARE = 1_000


def discount_distribution(facts: DataFrame) -> DataFrame:
    """Economics per discount band, of facts or of a cube."""
    banded = facts if is_cube(facts) else facts.withColumn("discount_bucket", discount_bucket(F.col("discount_rate")))
    kept = banded.where(F.col("discount_bucket").isNotNull())
    place = F.array_position(F.array(*[F.lit(name) for _, name in DISCOUNT_BANDS]), F.col("discount_bucket"))
    return group_economics(kept, ["discount_bucket"]).orderBy(place)


def discount_summary(facts: DataFrame) -> DataFrame:
    """Mean and weighted rate, revenue given up, and the margin before and after discounts; of facts or of a cube."""
    counted = (F.sum("rates"), F.sum("lines")) if is_cube(facts) else (F.sum("discount_rate"), F.count("discount_rate"))
    whole = facts.agg(
        counted[0].alias("rates"),
        counted[1].alias("lines"),
        total(facts, "gross_revenue").alias("gross"),
        total(facts, "discount_amount").alias("discount"),
        total(facts, "net_revenue").alias("net"),
        total(facts, "cost").alias("cost"),
        total(facts, "gross_profit").alias("profit"),
    )
    before = ratio_or_zero(F.col("gross") - F.col("cost"), "gross")
    after = ratio_or_zero("profit", "net")
    return whole.select(
        F.round(ratio("rates", "lines"), 4).alias("average_discount"),
        F.round(ratio_or_zero("discount", "gross"), 4).alias("weighted_discount_rate"),
        cents(F.col("discount")).alias("revenue_lost_to_discounts"),
        F.round(before, 4).alias("margin_before_discount"),
        F.round(after, 4).alias("margin_after_discount"),
        F.round((before - after) * 100, 2).alias("margin_erosion_pp"),
    )


def discount_leakage(facts: DataFrame, share: float = 0.85) -> DataFrame:
    """Revenue and discount of the lines at or above a quantile of the discount rate.

    The lines are first totalled per distinct rate, so the exact quantile and the totals above it
    both come from one scan and from a table without hot values.
    """
    rates = durable(
        facts.groupBy("discount_rate").agg(
            F.count("*").alias("rows"),
            total(facts, "net_revenue").alias("net"),
            total(facts, "discount_amount").alias("discount"),
        )
    )
    known = rates.where(F.col("discount_rate").isNotNull())
    cutoff = order_statistics(known, "discount_rate", {"cutoff": quantile_position(share)}, rows="rows")
    leaking = rates.withColumn("cutoff", cutoff.select("cutoff").scalar())
    above = F.col("discount_rate").cast("double") >= F.col("cutoff")
    return leaking.agg(
        F.max("cutoff").alias("cutoff"),
        F.coalesce(F.sum(F.when(above, F.col("net"))), F.lit(0)).alias("net"),
        F.coalesce(F.sum(F.when(above, F.col("discount"))), F.lit(0)).alias("discount"),
        F.coalesce(F.sum(F.when(above, F.col("rows"))), F.lit(0)).alias("leakage_lines"),
    ).select(
        F.round("cutoff", 4).alias("leakage_threshold"),
        cents(F.col("net")).alias("leakage_revenue"),
        cents(F.col("discount")).alias("leakage_discount_amount"),
        "leakage_lines",
    )


def attach_per_value(df: DataFrame, table: DataFrame, value: str, rows: str) -> DataFrame:
    """Join a one-row-per-value table to rows in which a few values may be very frequent.

    A table of checked size is broadcast. A larger one is split: values frequent enough to burden a
    task are few by arithmetic and are broadcast, the others are joined by shuffling.
    """
    if table.limit(ordering.BROADCAST_ROWS + 1).count() <= ordering.BROADCAST_ROWS:
        return df.join(F.broadcast(table), value)
    heavy = F.col(rows) * HOT_SHARE >= table.agg(F.sum(rows)).scalar()
    hot, cold = table.where(heavy), table.where(~heavy)
    joined_hot = df.join(F.broadcast(hot), value)
    joined_cold = df.join(F.broadcast(hot.select(value)), value, "left_anti").join(cold, value)
    return joined_hot.unionByName(joined_cold)


def spearman(facts: DataFrame, left: str, right: str, name: str) -> DataFrame:
    """Exact rank correlation of two columns, ties at their average rank.

    Ranks come from running counts over distinct values. The left ranks are summed per right value
    on the map side, so that no value of either column gathers its rows in one task.
    """
    pairs = facts.select(left, right).where(F.col(left).isNotNull() & F.col(right).isNotNull())
    left_ranks = durable(average_ranks(pairs, left, "left_rank"))
    size = left_ranks.agg(F.sum("rows")).scalar()
    middle = (size + 1) / 2.0
    left_spread = left_ranks.agg(F.sum(F.col("rows") * F.pow(F.col("left_rank") - middle, 2)).alias("spread"))

    ranked = attach_per_value(pairs, left_ranks, left, "rows").withColumn("offset", F.col("left_rank") - middle)
    per_right = ranked.groupBy(right).agg(F.count("*").alias("seen"), F.sum("offset").alias("offsets"))
    placed = running_totals(per_right, [F.col(right)], {"upto": "seen"})
    right_offset = F.col("upto") - (F.col("seen") - 1) / 2 - middle
    joint = placed.agg(
        F.sum(right_offset * F.col("offsets")).alias("joint"),
        F.sum(F.col("seen") * F.pow(right_offset, 2)).alias("spread"),
    )
    return joint.select(
        ratio("joint", F.sqrt(F.col("spread")) * F.sqrt(left_spread.scalar())).alias(name)
    )


def discount_margin_spearman(facts: DataFrame) -> DataFrame:
    return spearman(facts, "discount_rate", "gross_margin", "discount_margin_spearman")
