"""Where commercial attention is worth spending, and what price, discount or cost moves would do."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.functions.ratios import ratio_or_zero
from tillwise.operators.economics import by_dimension, exact_economics, money_as_double
from tillwise.operators.ordering import order_statistics, quantile_position
from tillwise.schema import DIMENSION_LABELS, DIMENSIONS, FILTER_KEYS
from tillwise.session import durable

MAX_DISCOUNT_RATE = 0.95


@dataclass(frozen=True)
class Thresholds:
    """What makes a slice material and what makes it urgent; shares are of the overall figures."""

    recovery: float = 1.0
    recovery_share: float = 0.001
    margin_gap: float = 0.03
    gap_revenue_share: float = 0.03
    gap_weight: float = 0.25
    high_profit_share: float = 0.025
    high_revenue_share: float = 0.004


def _named(names: dict[str, str]) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), F.col("dimension"))


def opportunity_radar(facts: DataFrame, limits: Thresholds = Thresholds(), top: int = 5) -> DataFrame:
    """Slices that discount above the median of their dimension or trail the overall margin.

    One scan of the facts gives all slices; the written slices then give the medians (one row per
    dimension) and the overall totals (one row).
    """
    slices = durable(exact_economics(by_dimension(facts), ["dimension", "value"], orders=False))
    total = slices.where(F.col("dimension") == DIMENSIONS[0]).agg(
        F.sum("revenue").cast("double").alias("revenue"), F.sum("profit").cast("double").alias("profit")
    )
    overall = total.select(F.struct("revenue", "profit", ratio_or_zero("profit", "revenue").alias("margin"))).scalar()

    rated = money_as_double(slices).withColumns(
        {
            "margin": ratio_or_zero("profit", "revenue"),
            "discount_rate": ratio_or_zero("discount_amount", "gross_revenue"),
        }
    )
    peers = order_statistics(
        rated, "discount_rate", {"peer_discount_rate": quantile_position(0.5)}, by=["dimension"]
    ).where(F.col("size") >= 2)
    compared = rated.join(F.broadcast(peers.drop("size")), "dimension").withColumn("overall", overall)

    recovery = F.greatest(F.lit(0.0), F.col("gross_revenue") * (F.col("discount_rate") - F.col("peer_discount_rate")))
    compared = compared.withColumn("estimated_discount_recovery", recovery).withColumn(
        "margin_gap", F.col("overall.margin") - F.col("margin")
    )
    gap_value = F.greatest(F.lit(0.0), F.col("margin_gap")) * F.col("revenue") * limits.gap_weight
    scored = compared.withColumn("priority_score", F.col("estimated_discount_recovery") + gap_value)

    leaks = F.col("estimated_discount_recovery") >= F.greatest(
        F.lit(limits.recovery), F.col("overall.revenue") * limits.recovery_share
    )
    trails = (F.col("margin_gap") >= limits.margin_gap) & (
        F.col("revenue") >= F.col("overall.revenue") * limits.gap_revenue_share
    )
    urgent = F.col("priority_score") >= F.greatest(
        F.col("overall.profit") * limits.high_profit_share, F.col("overall.revenue") * limits.high_revenue_share
    )
    return (
        scored.where(leaks | trails)
        .select(
            F.concat_ws("-", _named(FILTER_KEYS), "value").alias("id"),
            _named(DIMENSION_LABELS).alias("dimension"),
            _named(FILTER_KEYS).alias("filter_key"),
            "value",
            "revenue",
            "margin",
            "discount_rate",
            "peer_discount_rate",
            "estimated_discount_recovery",
            "margin_gap",
            F.when(urgent, "high").otherwise("medium").alias("priority"),
            "priority_score",
        )
        .orderBy(F.desc("priority_score"), "id")
        .limit(top)
    )


@dataclass(frozen=True)
class Scenario:
    """Moves to test: price and cost in percent, discount in percentage points; volume is held."""

    name: str
    price_pct: float = 0.0
    discount_pp: float = 0.0
    cost_pct: float = 0.0


# The quick tests on offer.
PRESETS = (
    Scenario("Tighten discount 2pp", discount_pp=-2.0),
    Scenario("Cost +5% shock", cost_pct=5.0),
    Scenario("Price +3%", price_pct=3.0),
)


def scenario_grid(facts: DataFrame, scenarios: Sequence[Scenario] = PRESETS, by: Sequence[str] = ()) -> DataFrame:
    """Baseline and projected revenue, profit and margin per group and scenario.

    Also the price move that would keep the baseline profit, null when nothing is sold. The given
    scenarios are exploded onto the grouped totals.
    """
    grouped = exact_economics(facts, by, orders=False)
    base = money_as_double(
        grouped.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("gross_revenue", "revenue", "profit", "cost", "discount_amount")})
    )
    moves = F.array(
        *[
            F.struct(
                F.lit(s.name).alias("scenario"),
                F.lit(float(s.price_pct)).alias("price_pct"),
                F.lit(float(s.discount_pp)).alias("discount_pp"),
                F.lit(float(s.cost_pct)).alias("cost_pct"),
            )
            for s in scenarios
        ]
    )
    tested = base.select("*", F.inline(moves))
    rate = ratio_or_zero("discount_amount", "gross_revenue") + F.col("discount_pp") / 100
    tested = tested.withColumn("rate", F.least(F.lit(MAX_DISCOUNT_RATE), F.greatest(F.lit(0.0), rate)))
    revenue = F.col("gross_revenue") * (1 + F.col("price_pct") / 100) * (1 - F.col("rate"))
    tested = tested.withColumn("projected_revenue", revenue).withColumn(
        "projected_cost", F.col("cost") * (1 + F.col("cost_pct") / 100)
    )
    tested = tested.withColumn("projected_profit", F.col("projected_revenue") - F.col("projected_cost"))
    at_list = F.col("gross_revenue") * (1 - F.col("rate"))
    needed = F.when(at_list > 0, ((F.col("profit") + F.col("projected_cost")) / at_list - 1) * 100)
    return tested.select(
        *by,
        "scenario",
        "price_pct",
        "discount_pp",
        "cost_pct",
        F.col("revenue").alias("baseline_revenue"),
        F.col("profit").alias("baseline_profit"),
        ratio_or_zero("profit", "revenue").alias("baseline_margin"),
        "projected_revenue",
        "projected_profit",
        ratio_or_zero("projected_profit", "projected_revenue").alias("projected_margin"),
        needed.alias("break_even_price_pct"),
        (F.col("price_pct") - needed).alias("price_above_break_even_pp"),
    )
