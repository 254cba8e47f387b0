"""The interactive view: everything that is shown for one choice of filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tillwise.operators import changes, economics, forecast, opportunity, recommend, trends
from tillwise.operators.filters import Filters, filter_facts


def view_sections(
    facts: DataFrame,
    filters: Filters,
    min_date: str,
    anomalies: DataFrame,
    found: DataFrame,
    scenarios: Sequence[opportunity.Scenario] = opportunity.PRESETS,
) -> dict[str, DataFrame]:
    """Panels by name for the facts inside the filters.

    Anomalies and recommendations are those of the whole data, narrowed to the window and to the
    filtered values. Each panel reads only the columns and months it needs.
    """
    kept = filter_facts(facts, filters)
    return {
        "kpis": economics.view_kpis(kept),
        "kpi_changes": changes.period_over_period_kpis(facts, filters, min_date),
        "monthly_series": economics.monthly_series(kept),
        "product_series": economics.product_series(kept),
        "product_table": economics.product_table(kept),
        "profitability_map": economics.profitability_map(kept),
        "period_brief_mom": changes.period_brief(kept, "mom"),
        "period_brief_yoy": changes.period_brief(kept, "yoy"),
        "period_drivers_mom": changes.period_drivers(kept, "mom"),
        "period_drivers_yoy": changes.period_drivers(kept, "yoy"),
        "opportunities": opportunity.opportunity_radar(kept),
        "bridge": economics.economic_bridge(kept),
        "forecast": forecast.revenue_forecast(kept),
        "forecast_backtest": forecast.forecast_backtest(kept),
        "scenarios": opportunity.scenario_grid(kept, scenarios),
        "anomalies": trends.anomalies_in_window(anomalies, filters.start_date, filters.end_date),
        "recommendations": recommend.scoped_recommendations(found, filters, top=5),
    }
