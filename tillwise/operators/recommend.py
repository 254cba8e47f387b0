"""Recommendations computed from the dimension summaries, one row each, with their evidence."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.functions.ratios import ratio_or_zero
from tillwise.functions.text import dollars, one_decimal, percent, slug, whole
from tillwise.operators.economics import (
    by_dimension,
    dimension_economics,
    dimension_place,
    exact_economics,
    money_as_double,
    with_shares,
)
from tillwise.operators.filters import Filters
from tillwise.operators.ordering import column_statistics, quantile_position
from tillwise.schema import DIMENSIONS, FILTER_KEYS
from tillwise.session import durable

# Severity, implication and advice of each rule.
RULES = {
    "global-product-margin-pressure": (
        "high",
        "A large revenue base is carrying weaker unit economics than the typical product, so growth may be less valuable than it appears.",
        "Review pricing, discount thresholds, and cost drivers for this product before increasing demand-generation spend.",
    ),
    "global-channel-discount-spread": (
        "medium",
        "Commercial volume in this channel is more dependent on price concessions, increasing the risk of margin leakage.",
        "Introduce approval bands for high-discount transactions and evaluate whether volume gains offset foregone gross profit.",
    ),
    "global-regional-economics-gap": (
        "medium",
        "The regional revenue mix is economically uneven and may reflect logistics cost, discount mix, or product mix differences.",
        "Decompose the regional gap by category and channel before setting a region-wide growth target.",
    ),
    "global-category-profit-underweight": (
        "high",
        "Revenue concentration in the category overstates its contribution to economic value.",
        "Prioritize high-margin products within the category and test lower discount ceilings on weak-margin combinations.",
    ),
    "global-segment-discount-governance": (
        "medium",
        "Large negotiated discounts can be economically justified only if they are supported by sufficient volume, retention, or lower service cost.",
        "Create segment-specific discount guardrails tied to contribution margin rather than using revenue alone.",
    ),
    "global-discount-pool": (
        "info",
        "Even small improvements in discount discipline can materially change gross profit at this revenue scale.",
        "Track discount amount as a controllable investment and review the top product-channel combinations consuming it each month.",
    ),
    "scope": (
        "medium",
        "The filtered commercial slice deserves a mix, pricing, or cost review before pursuing additional volume.",
        "Inspect the next-level product and channel mix, then target the specific combinations driving the gap.",
    ),
    "product-tension": (
        "high",
        "Scaling demand without fixing economics can grow low-quality revenue.",
        "Review pricing, discount approval, and unit cost before increasing acquisition spend.",
    ),
    "discount-spend": (
        "medium",
        "Discount is a commercial investment and should be measured against incremental volume and profit.",
        "Rank customers, channels, and products by discount leakage and introduce approval bands for the weakest economics.",
    ),
    "margin-gap": (
        "medium",
        "The performance gap is large enough to justify a mix, pricing, or cost investigation.",
        None,
    ),
}

EVIDENCE_COLUMNS = ("revenue", "profit", "margin", "discount_rate", "benchmark")


def _text(template: str, **values: Column) -> Column:
    """Fill {name} places of a sentence with columns."""
    pieces, rest = [], template
    while "{" in rest:
        plain, _, rest = rest.partition("{")
        name, _, rest = rest.partition("}")
        pieces += [F.lit(plain), values[name]]
    return F.concat(*pieces, F.lit(rest))


def _rule(
    source: DataFrame,
    number: int,
    rule: str,
    observation: Column,
    evidence: Column,
    dimension: Column | str | None = None,
    value: Column | None = None,
    numbers: dict[str, Column] | None = None,
    id_: Column | None = None,
    severity: Column | None = None,
    advice: Column | None = None,
) -> DataFrame:
    """Shape the rows of one rule; ``numbers`` repeats the evidence as columns."""
    usual_severity, implication, usual_advice = RULES[rule]
    missing = F.lit(None).cast("string")
    scope = F.lit(dimension) if isinstance(dimension, str) else dimension
    given = numbers or {}
    return source.select(
        F.lit(number).alias("rule"),
        (F.lit(rule) if id_ is None else id_).alias("id"),
        (F.lit(usual_severity) if severity is None else severity).alias("severity"),
        F.struct(
            (missing if scope is None else scope).alias("dimension"),
            (missing if value is None else value).alias("value"),
        ).alias("scope"),
        observation.alias("observation"),
        evidence.alias("evidence"),
        F.lit(implication).alias("implication"),
        (F.lit(usual_advice) if advice is None else advice).alias("recommendation"),
        *[given.get(c, F.lit(None)).cast("double").alias(c) for c in EVIDENCE_COLUMNS],
    )


def _in_order(rules: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, rules).orderBy(
        "rule", F.coalesce(dimension_place("scope.dimension"), F.lit(-1)), F.desc_nulls_last("revenue"), "id"
    )


def _extremes(summary: DataFrame) -> DataFrame:
    """The outermost values of each dimension, one row per dimension; ties go to the larger revenue."""
    row = F.struct("value", "revenue", "profit", "margin", "discount_rate", *(
        c for c in ("revenue_share", "profit_share") if c in summary.columns
    ))
    picks = {}
    for metric in ("margin", "discount_rate", "revenue"):
        known = F.when(F.col(metric).isNotNull(), row)
        picks[f"most_{metric}"] = F.max_by(known, F.struct(F.col(metric), F.col("revenue"), F.col("value")))
        picks[f"least_{metric}"] = F.min_by(
            known, F.struct(F.coalesce(F.col(metric), F.lit(float("inf"))), -F.col("revenue"), F.col("value"))
        )
    return summary.groupBy("dimension").agg(F.count("*").alias("values"), *[c.alias(n) for n, c in picks.items()])


def recommendations(
    facts: DataFrame,
    channel_spread: float = 0.025,
    profit_lag: float = 0.03,
    weak_margin: float = 0.015,
    weak_discount: float = 0.02,
) -> DataFrame:
    """Global findings, then one finding per dimension value that is weak against its peers.

    The facts are read once, into the dimension summary; every rule works on that table.
    """
    summary = with_shares(dimension_economics(facts, orders=False))
    extremes = durable(_extremes(summary))  # one row per dimension
    peers = column_statistics(
        summary,
        {
            "median_margin": ("margin", quantile_position(0.5)),
            "median_discount": ("discount_rate", quantile_position(0.5)),
            "leading": ("revenue", quantile_position(0.75)),
        },
        by=["dimension"],
    )
    against_peers = summary.join(F.broadcast(durable(peers)), "dimension")

    margin, revenue, profit, rate = (F.col(c) for c in ("margin", "revenue", "profit", "discount_rate"))
    own = {"revenue": revenue, "profit": profit, "margin": margin, "discount_rate": rate}

    pressed = (
        against_peers.where(F.col("dimension") == "product")
        .where((revenue >= F.col("leading")) & (margin < F.col("median_margin")))
        .orderBy(F.desc("revenue"), "value")
        .limit(1)
    )
    rules = [
        _rule(
            pressed,
            1,
            "global-product-margin-pressure",
            _text(
                "{value} is a top-quartile revenue product but earns only {margin} gross margin.",
                value=F.col("value"),
                margin=percent(margin),
            ),
            _text(
                "It generated {revenue} revenue and {profit} gross profit, versus a product median margin of {median}.",
                revenue=dollars(revenue),
                profit=dollars(profit),
                median=percent(F.col("median_margin")),
            ),
            numbers={**own, "benchmark": F.col("median_margin")},
        )
    ]

    def at(dimension: str) -> DataFrame:
        return extremes.where(F.col("dimension") == dimension)

    def of(pick: str) -> dict[str, Column]:
        return {c: F.col(f"{pick}.{c}") for c in ("value", "revenue", "profit", "margin", "discount_rate")}

    def evidence_of(pick: str, benchmark: Column) -> dict[str, Column]:
        return {**{k: v for k, v in of(pick).items() if k != "value"}, "benchmark": benchmark}

    high, low = of("most_discount_rate"), of("least_discount_rate")
    spread = high["discount_rate"] - low["discount_rate"]
    rules.append(
        _rule(
            at("channel").where(spread > channel_spread),
            2,
            "global-channel-discount-spread",
            _text(
                "{value} carries the highest realized discount rate at {rate}.",
                value=high["value"],
                rate=percent(high["discount_rate"]),
            ),
            _text(
                "Its discount rate is {spread} percentage points above {low}, while margin is {margin}.",
                spread=one_decimal(spread * 100),
                low=low["value"],
                margin=percent(high["margin"]),
            ),
            "channel",
            high["value"],
            evidence_of("most_discount_rate", low["discount_rate"]),
        )
    )

    weakest, strongest = of("least_margin"), of("most_margin")
    rules.append(
        _rule(
            at("region"),
            3,
            "global-regional-economics-gap",
            _text(
                "{value} has the lowest regional margin at {margin}.",
                value=weakest["value"],
                margin=percent(weakest["margin"]),
            ),
            _text(
                "That is {gap} percentage points below {strongest}, on {revenue} revenue.",
                gap=one_decimal((strongest["margin"] - weakest["margin"]) * 100),
                strongest=strongest["value"],
                revenue=dollars(weakest["revenue"]),
            ),
            "region",
            weakest["value"],
            evidence_of("least_margin", strongest["margin"]),
        )
    )

    top = of("most_revenue")
    revenue_share, profit_share = F.col("most_revenue.revenue_share"), F.col("most_revenue.profit_share")
    rules.append(
        _rule(
            at("category").where(profit_share + profit_lag < revenue_share),
            4,
            "global-category-profit-underweight",
            _text(
                "{value} contributes {revenue} of revenue but only {profit} of gross profit.",
                value=top["value"],
                revenue=percent(revenue_share),
                profit=percent(profit_share),
            ),
            _text(
                "Its realized gross margin is {margin} with a {rate} discount rate.",
                margin=percent(top["margin"]),
                rate=percent(top["discount_rate"]),
            ),
            "category",
            top["value"],
            evidence_of("most_revenue", profit_share),
        )
    )
    rules.append(
        _rule(
            at("customer_segment"),
            5,
            "global-segment-discount-governance",
            _text(
                "{value} receives the highest segment discount rate at {rate}.",
                value=high["value"],
                rate=percent(high["discount_rate"]),
            ),
            _text(
                "The segment produced {revenue} revenue at {margin} margin.",
                revenue=dollars(high["revenue"]),
                margin=percent(high["margin"]),
            ),
            "customer_segment",
            high["value"],
            evidence_of("most_discount_rate", F.lit(None)),
        )
    )

    # Every line has one value per dimension, so any dimension adds up to the whole.
    overall = summary.where(F.col("dimension") == DIMENSIONS[0]).agg(
        *[F.sum(c).alias(c) for c in ("gross_revenue", "revenue", "profit", "discount_amount")]
    )
    given_up = F.round("discount_amount", 2)
    overall_rate = F.round(ratio_or_zero("discount_amount", "gross_revenue"), 4)
    overall_margin = F.round(ratio_or_zero("profit", "revenue"), 4)
    rules.append(
        _rule(
            overall,
            6,
            "global-discount-pool",
            _text("The business gave up {amount} of gross revenue through discounts.", amount=dollars(given_up)),
            _text(
                "Weighted realized discount is {rate}; gross margin after discount is {margin}.",
                rate=percent(overall_rate),
                margin=percent(overall_margin),
            ),
            numbers={
                "revenue": revenue,
                "profit": profit,
                "margin": overall_margin,
                "discount_rate": overall_rate,
                "benchmark": given_up,
            },
        )
    )

    weak = against_peers.where(
        (margin < F.col("median_margin") - weak_margin) | (rate > F.col("median_discount") + weak_discount)
    )
    rules.append(
        _rule(
            weak,
            7,
            "scope",
            _text(
                "{value} is economically weaker than its peer median on margin or discount discipline.",
                value=F.col("value"),
            ),
            _text(
                "Revenue {revenue}, margin {margin}, discount {rate}.",
                revenue=dollars(revenue),
                margin=percent(margin),
                rate=percent(rate),
            ),
            F.col("dimension"),
            F.col("value"),
            {**own, "benchmark": F.col("median_margin")},
            id_=F.concat(F.lit("scope-"), "dimension", F.lit("-"), slug(F.col("value"))),
        )
    )
    return _in_order(rules)


def _rounded(value: Column) -> Column:
    """Grouped digits of the nearest whole number, halves up."""
    return whole(F.floor(value + 0.5))


def dynamic_recommendations(
    facts: DataFrame,
    tension: float = 0.75,
    discount_alert: float = 0.08,
    discount_high: float = 0.15,
    margin_gap: float = 0.03,
    top: int = 8,
) -> DataFrame:
    """Findings for any selection of facts: a strained leader, heavy discounting, uneven margins."""
    totals = durable(money_as_double(exact_economics(by_dimension(facts), ["dimension", "value"], orders=False)))
    summary = totals.withColumns(
        {
            "margin": ratio_or_zero("profit", "revenue"),
            "discount_rate": ratio_or_zero("discount_amount", "gross_revenue"),
        }
    )
    products = summary.where(F.col("dimension") == "product")
    last = F.col("size") - 1
    peers = column_statistics(
        products,
        {
            "leading": ("revenue", last - F.least(F.floor(F.col("size") / 4), last)),
            "median": ("margin", quantile_position(0.5)),
        },
        by=["dimension"],
    )

    margin, revenue = F.col("margin"), F.col("revenue")
    strained = (
        products.join(F.broadcast(peers), "dimension")
        .where((revenue >= F.col("leading")) & (margin < F.col("median") * tension))
        .orderBy(F.desc("revenue"), "value")
        .limit(1)
    )
    own = {c: F.col(c) for c in ("revenue", "profit", "margin", "discount_rate")}
    rules = [
        _rule(
            strained,
            1,
            "product-tension",
            _text("{value} is a revenue leader with weak realized margin.", value=F.col("value")),
            _text(
                "Revenue is {revenue} while gross margin is {margin}, versus a product median of {median}.",
                revenue=_rounded(revenue),
                margin=percent(margin),
                median=percent(F.col("median")),
            ),
            "product",
            F.col("value"),
            {**own, "benchmark": F.col("median")},
        )
    ]

    overall = (
        totals.where(F.col("dimension") == DIMENSIONS[0])
        .agg(*[F.sum(c).alias(c) for c in ("gross_revenue", "revenue", "profit", "discount_amount")])
        .withColumns(
            {
                "margin": ratio_or_zero("profit", "revenue"),
                "discount_rate": ratio_or_zero("discount_amount", "gross_revenue"),
            }
        )
    )
    rules.append(
        _rule(
            overall.where(F.col("discount_rate") > discount_alert),
            2,
            "discount-spend",
            _text("Discounting consumes {rate} of gross revenue.", rate=percent(F.col("discount_rate"))),
            _text(
                "{amount} of gross-to-net value is currently given away.", amount=_rounded(F.col("discount_amount"))
            ),
            numbers={**own, "benchmark": F.col("discount_amount")},
            severity=F.when(F.col("discount_rate") > discount_high, "high").otherwise("medium"),
        )
    )

    compared = ("region", "channel", "customer_segment", "category")
    label = F.element_at(
        F.create_map(*[F.lit(x) for d in compared for x in (d, FILTER_KEYS[d])]), F.col("dimension")
    )
    weakest, best = F.col("least_margin"), F.col("most_margin")
    gap = best["margin"] - weakest["margin"]
    uneven = _extremes(summary.where(F.col("dimension").isin(*compared))).where(
        (F.col("values") >= 2) & (gap >= margin_gap)
    )
    rules.append(
        _rule(
            uneven,
            3,
            "margin-gap",
            _text(
                "{value} has the weakest {label} margin at {margin}.",
                value=weakest["value"],
                label=label,
                margin=percent(weakest["margin"]),
            ),
            _text(
                "The gap to {best} is {gap} percentage points on {revenue} of revenue.",
                best=best["value"],
                gap=one_decimal(gap * 100),
                revenue=_rounded(weakest["revenue"]),
            ),
            F.col("dimension"),
            weakest["value"],
            {**{c: weakest[c] for c in own}, "benchmark": best["margin"]},
            id_=F.concat(label, F.lit("-margin-gap")),
            advice=_text(
                "Decompose {value} by product and channel/customer mix before setting a blanket growth target.",
                value=weakest["value"],
            ),
        )
    )
    return _in_order(rules).limit(top)


def scoped_recommendations(found: DataFrame, filters: Filters, top: int | None = None) -> DataFrame:
    """Findings about any actively filtered value; the global ones without a filter or a match."""
    found = durable(found)
    is_global = F.col("scope.dimension").isNull()
    matches = F.lit(False)
    for dimension, value in filters.active().items():
        matches = matches | ((F.col("scope.dimension") == dimension) & (F.col("scope.value") == value))
    matching = found.where(matches)
    chosen = found.where(is_global) if matching.isEmpty() else matching
    ordered = chosen.orderBy("rule", F.desc_nulls_last("revenue"), "id")
    return ordered if top is None else ordered.limit(top)
