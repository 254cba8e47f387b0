import pytest

from tillwise.operators import recommend, trends
from tillwise.operators.filters import Filters
from tillwise.plans.view import view_sections


def test_every_panel_follows_the_filters(decision_facts):
    filters = Filters("2024-08-01", "2025-02-28", channel="Online")
    sections = view_sections(
        decision_facts,
        filters,
        "2024-01-15",
        trends.revenue_anomalies(decision_facts, threshold=1.0),
        recommend.recommendations(decision_facts),
    )
    rows = {name: section.collect() for name, section in sections.items()}
    revenue = sum(100 + 6 * i for i in range(7, 14))
    assert rows["kpis"][0].revenue == pytest.approx(revenue)
    assert next(r for r in rows["kpi_changes"] if r.metric == "revenue").previous is None  # not a whole window
    assert [r.month for r in rows["monthly_series"]][0] == "2024-08" and len(rows["monthly_series"]) == 7
    assert [r["product"] for r in rows["product_series"]] == ["Headset"] == [r["product"] for r in rows["product_table"]]
    assert rows["profitability_map"][0].below_benchmark is False
    assert rows["period_brief_mom"][0].revenue_delta == pytest.approx(6)
    assert rows["period_brief_yoy"] == [] == rows["period_drivers_yoy"]
    assert {r.value for r in rows["period_drivers_mom"]} == {"South", "Online", "SMB", "Electronics", "Headset"}
    assert rows["opportunities"] == []  # nothing to compare with
    assert rows["bridge"][2].amount == pytest.approx(revenue)
    assert [r.month for r in rows["forecast"]] == ["2025-03", "2025-04", "2025-05"]
    assert rows["forecast_backtest"][0].validation_mape == pytest.approx(0, abs=1e-9)
    assert len(rows["scenarios"]) == 3
    assert all("2024-08" <= r.month <= "2025-02" for r in rows["anomalies"]) and rows["anomalies"]
    assert all(r.scope.dimension is None for r in rows["recommendations"])  # nothing scoped to Online
