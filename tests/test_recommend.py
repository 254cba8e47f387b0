import pytest

from tests.conftest import make_facts
from tillwise.operators import recommend
from tillwise.operators.economics import by_dimension, dimension_summary
from tillwise.operators.filters import Filters


@pytest.fixture(scope="module")
def found(decision_facts):
    return recommend.recommendations(decision_facts).collect()


def test_global_rules(found):
    by_id = {r.id: r for r in found if r.rule < 7}
    assert set(by_id) == {
        "global-product-margin-pressure",
        "global-channel-discount-spread",
        "global-regional-economics-gap",
        "global-segment-discount-governance",
        "global-category-profit-underweight",
        "global-discount-pool",
    }
    spread = by_id["global-channel-discount-spread"]
    assert (spread.scope.dimension, spread.scope.value, spread.severity) == ("channel", "Distributor", "medium")
    assert spread.observation == "Distributor carries the highest realized discount rate at 22.0%."
    assert "16.0 percentage points above Online" in spread.evidence
    assert by_id["global-product-margin-pressure"].observation.startswith("Desk is a top-quartile revenue product")
    assert by_id["global-regional-economics-gap"].scope.value == "West"
    assert by_id["global-discount-pool"].scope.dimension is None
    assert all(r.observation and r.evidence and r.implication and r.recommendation for r in found)


def test_order_and_scoped_rules(found, decision_facts):
    assert [r.rule for r in found] == sorted(r.rule for r in found)
    scoped = [(r.scope.dimension, r.scope.value) for r in found if r.rule == 7]
    assert scoped == [
        ("region", "West"),
        ("channel", "Distributor"),
        ("customer_segment", "Enterprise"),
        ("category", "Office"),
        ("product", "Desk"),
    ]
    assert next(r for r in found if r.rule == 7 and r.scope.dimension == "product").id == "scope-product-desk"
    assert dimension_summary(decision_facts).count() == 10


def test_scoping(decision_facts):
    every = recommend.recommendations(decision_facts)

    def scoped(**values):
        return recommend.scoped_recommendations(every, Filters("2024-01-01", "2025-12-31", **values)).collect()

    assert {r.id for r in scoped()} == {"global-product-margin-pressure", "global-discount-pool"}
    assert {(r.rule, r.scope.value) for r in scoped(region="West")} == {(3, "West"), (7, "West")}
    assert {r.scope.value for r in scoped(region="West", product="Desk")} == {"West", "Desk"}
    assert all(r.scope.dimension is None for r in scoped(region="South"))  # nothing to say: the global ones
    top = recommend.scoped_recommendations(every, Filters("2024-01-01", "2025-12-31", region="West"), top=1)
    assert top.count() == 1


def test_dynamic_rules(trend_facts, decision_facts):
    rows = recommend.dynamic_recommendations(trend_facts).collect()
    assert [r.id for r in rows] == [
        "product-tension",
        "discount-spend",
        "region-margin-gap",
        "channel-margin-gap",
        "category-margin-gap",
    ]
    assert rows[0].scope.value == "A" and rows[1].severity == "medium"
    assert all(r.evidence and r.recommendation for r in rows)
    assert next(r for r in recommend.dynamic_recommendations(decision_facts).collect() if r.rule == 2).severity == "high"
    assert recommend.dynamic_recommendations(decision_facts, top=1).count() == 1


def test_ties_and_missing_margins_do_not_break_the_extremes(spark):
    rows = make_facts(
        spark,
        [
            ("2024-01-01", "N", "O", "S", "C", "free", 1, 100, 100, 10),
            ("2024-01-01", "S", "O", "S", "C", "x", 1, 100, 0, 10),
            ("2024-01-01", "E", "O", "S", "C", "y", 1, 100, 0, 10),
        ],
    )
    gap = next(r for r in recommend.recommendations(rows).collect() if r.rule == 3)
    assert gap.scope.value in {"E", "S"} and gap.margin == pytest.approx(0.9)
    assert by_dimension(rows).count() == 15
