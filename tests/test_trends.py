import statistics

import numpy as np
import pytest

from tests.conftest import make_facts, months_from
from tillwise.operators import changes, forecast, opportunity, trends


def flat_facts(spark, revenues, start=(2024, 1), cost=50):
    return make_facts(
        spark,
        [
            (f"{m}-01", "North", "Online", "SMB", "Office", "A", 1, r, 0, cost)
            for m, r in zip(months_from(*start, len(revenues)), revenues)
        ],
    )


def test_month_on_month(facts):
    january, february = trends.monthly_performance(facts).collect()
    assert january.mom_revenue_growth is None and january.revenue_rolling_3m == 340
    assert february.mom_revenue_growth == pytest.approx(100 / 340 - 1)
    assert february.margin_change_pp == pytest.approx((0.6 - 140 / 340) * 100)
    assert february.revenue_rolling_3m == 220


def test_year_on_year_by_row_and_by_calendar(spark):
    rows = flat_facts(spark, [100 + i for i in range(14)])
    last = trends.monthly_performance(rows).collect()[-1]
    assert last.yoy_revenue_growth == pytest.approx(113 / 101 - 1)
    assert last.growth_acceleration == pytest.approx((113 / 112) - (112 / 111))
    gap = rows.where("month <> '2024-06'")
    by_row = trends.monthly_performance(gap).collect()[-1]
    by_calendar = trends.monthly_performance(gap, calendar=True).collect()[-1]
    assert by_row.yoy_revenue_growth == pytest.approx(113 / 100 - 1)
    assert by_calendar.yoy_revenue_growth == pytest.approx(113 / 101 - 1)


def test_growth_from_zero_is_null(spark):
    rows = trends.monthly_performance(flat_facts(spark, [0, 100])).collect()
    assert rows[1].mom_revenue_growth is None


def test_spike_in_a_flat_series_is_flagged_by_the_fallback(spark):
    rows = trends.robust_anomalies(flat_facts(spark, [100] * 11 + [1000])).collect()
    spike = next(r for r in rows if r.metric == "revenue")
    assert (spike.month, spike.direction, spike.method) == ("2024-12", "high", trends.BATCH_FALLBACK_METHOD)
    assert spike.robust_z_score == pytest.approx(900 / np.std([100] * 11 + [1000]), abs=1e-3)


def test_robust_scores(spark):
    revenues = [100, 103, 98, 101, 99, 102, 160, 97]
    rows = trends.robust_anomalies(flat_facts(spark, revenues)).where("metric = 'revenue'").collect()
    middle = statistics.median(revenues)
    mad = statistics.median(abs(r - middle) for r in revenues)
    assert [(r.month, r.value) for r in rows] == [("2024-07", 160)]
    assert rows[0].robust_z_score == pytest.approx(0.6745 * (160 - middle) / mad, abs=1e-3)
    shown = trends.revenue_anomalies(flat_facts(spark, revenues)).collect()
    assert shown[0].robust_z_score == pytest.approx(0.6745 * (160 - middle) / mad)
    assert trends.revenue_anomalies(flat_facts(spark, revenues[:5])).count() == 0
    inside = trends.anomalies_in_window(trends.robust_anomalies(flat_facts(spark, revenues)), "2024-07-20", "2024-08-02")
    assert {r.month for r in inside.collect()} == {"2024-07"}


def test_interactive_fallback_uses_the_sample_deviation(spark):
    rows = trends.revenue_anomalies(flat_facts(spark, [100] * 11 + [1000])).collect()
    assert rows[0].method == trends.VIEW_FALLBACK_METHOD
    assert rows[0].robust_z_score == pytest.approx(900 / np.std([100] * 11 + [1000], ddof=1))


def test_product_profiles(spark):
    series = {
        "rising": ([100, 100, 100, 150, 150, 150], [40] * 6),
        "slipping": ([100, 100, 100, 150, 150, 150], [60, 60, 60, 100, 100, 100]),
        "falling": ([100, 100, 100, 80, 80, 80], [50, 50, 50, 40, 40, 40]),
        "steady": ([100] * 6, [48] * 6),
    }
    rows = [
        (f"2024-0{i + 1}-05", "N", "O", "S", "C", product, 1, revenue, 0, cost)
        for product, (revenues, costs) in series.items()
        for i, (revenue, cost) in enumerate(zip(revenues, costs))
    ]
    got = {r["product"]: r for r in trends.product_economics(make_facts(spark, rows)).collect()}
    assert {p: r.growth_profile for p, r in got.items()} == {
        "rising": "strong-growth-strong-margin",
        "slipping": "growth-margin-pressure",
        "falling": "declining",
        "steady": "stable",
    }
    assert got["rising"].recent_revenue_growth == 0.5
    assert got["slipping"].recent_margin_change_pp == pytest.approx((50 / 150 - 0.4) * 100, abs=0.01)
    assert (got["steady"].orders, got["steady"].units) == (6, 6)


# Changes


def test_briefs(decision_facts):
    mom, yoy = (changes.period_brief(decision_facts, mode).first() for mode in ("mom", "yoy"))
    assert (mom.current_month, mom.previous_month) == ("2025-02", "2025-01")
    assert yoy.previous_month == "2024-02"
    assert mom.revenue_delta == pytest.approx(13)
    assert mom.profit_delta == pytest.approx(13 - 6)
    assert mom.revenue_growth == pytest.approx(389 / 376 - 1)


def test_month_before_a_gap(decision_facts):
    gap = decision_facts.where("month <> '2025-01'")
    assert changes.period_brief(gap, "mom").first().previous_month == "2024-12"
    assert changes.what_changed(gap).first().previous_month == "2024-12"
    assert changes.period_brief(decision_facts.where("month <> '2024-02'"), "yoy").count() == 0
    assert changes.period_brief(decision_facts.where("month = '2025-02'"), "mom").count() == 0
    assert changes.period_drivers(decision_facts.where("month = '2025-02'")).count() == 0


def test_complete_months_only(decision_facts):
    assert changes.compared_months(decision_facts, "mom", complete_only=True) == ("2025-01", "2024-12")


def test_drivers_add_up_to_the_change(decision_facts):
    brief = changes.period_brief(decision_facts, "yoy").first()
    drivers = changes.period_drivers(decision_facts, "yoy", top=100).collect()
    for label in {d.dimension for d in drivers}:
        assert sum(d.delta for d in drivers if d.dimension == label) == pytest.approx(brief.revenue_delta)
    top = changes.period_drivers(decision_facts, "yoy").collect()
    assert len(top) == 5 and [d.rank for d in top] == [1, 2, 3, 4, 5]
    assert top[0].delta == pytest.approx(84)


def test_values_seen_in_one_month_only(spark):
    rows = make_facts(
        spark,
        [("2024-01-05", "N", "O", "S", "C", "old", 1, 70, 0, 10), ("2024-02-05", "N", "O", "S", "C", "new", 1, 100, 0, 10)],
    )
    drivers = {(d.direction, d.value): d for d in changes.period_drivers(rows).collect()}
    assert drivers["positive", "new"].previous == 0 and drivers["negative", "old"].current == 0
    assert drivers["positive", "N"].delta == 30


# Opportunities and scenarios


def test_radar(decision_facts):
    rows = opportunity.opportunity_radar(decision_facts).collect()
    slice_ = next(r for r in rows if r.value == "Distributor")
    assert slice_.id == "channel-Distributor" and slice_.priority == "high"
    assert slice_.peer_discount_rate == pytest.approx(0.14)
    net = sum(120 + 7 * i for i in range(14))
    assert slice_.estimated_discount_recovery == pytest.approx(net / 0.78 * 0.08)
    assert len(rows) == 5


def test_radar_needs_peers(view_facts):
    one_region = view_facts.where("region = 'North'")
    assert opportunity.opportunity_radar(one_region).count() == 0


def test_scenarios(trend_facts):
    rows = {r.scenario: r for r in opportunity.scenario_grid(trend_facts).collect()}
    better = rows["Tighten discount 2pp"]
    assert better.projected_profit > better.baseline_profit
    assert better.projected_revenue == pytest.approx(better.baseline_revenue / 0.9 * 0.92)
    assert rows["Cost +5% shock"].break_even_price_pct > 0
    still = opportunity.scenario_grid(trend_facts, [opportunity.Scenario("none")]).first()
    assert still.break_even_price_pct == pytest.approx(0, abs=1e-9)
    assert still.projected_margin == pytest.approx(still.baseline_margin)


def test_break_even_price_keeps_the_baseline_profit(decision_facts):
    shock = opportunity.Scenario("shock", discount_pp=3, cost_pct=7)
    price = opportunity.scenario_grid(decision_facts, [shock]).first().break_even_price_pct
    held = opportunity.Scenario("held", price_pct=price, discount_pp=3, cost_pct=7)
    row = opportunity.scenario_grid(decision_facts, [held]).first()
    assert row.projected_profit == pytest.approx(row.baseline_profit)
    assert row.price_above_break_even_pp == pytest.approx(0, abs=1e-9)


def test_discount_rates_stay_within_bounds(trend_facts):
    extremes = [opportunity.Scenario("up", discount_pp=500), opportunity.Scenario("down", discount_pp=-500)]
    rows = {r.scenario: r for r in opportunity.scenario_grid(trend_facts, extremes).collect()}
    assert rows["up"].projected_revenue == pytest.approx(rows["up"].baseline_revenue / 0.9 * 0.05)
    assert rows["down"].projected_revenue == pytest.approx(rows["down"].baseline_revenue / 0.9)
    empty = opportunity.scenario_grid(trend_facts.where("false"), extremes).first()
    assert empty.break_even_price_pct is None and empty.projected_margin == 0


# Forecast


def expected_forecast(values, months, horizon):
    """The forecast of one series, straight from its definition."""
    n, x = len(values), np.arange(len(values))
    slope, intercept = np.polyfit(x, values, 1)
    fitted = intercept + slope * x
    rmse = np.sqrt(np.sum((np.array(values) - fitted) ** 2) / max(n - 2, 1))
    points = []
    for h in range(1, horizon + 1):
        year, month = divmod(int(months[-1][:4]) * 12 + int(months[-1][5:]) - 1 + h, 12)
        season = 1.0
        if n >= 18:
            own = [v / max(f, 1) for v, f, m in zip(values, fitted, months) if int(m[5:]) == month + 1]
            season = 0.5 + 0.5 * np.mean(own) if own else 1.0
        revenue = max(0.0, (intercept + slope * (n + h - 1)) * season)
        band = 1.96 * rmse * np.sqrt(1 + h / n)
        points.append((f"{year}-{month + 1:02d}", revenue, max(0.0, revenue - band), revenue + band))
    return points


@pytest.mark.parametrize("count", [6, 8, 17, 18, 27])
def test_forecast_and_backtest_against_the_definition(spark, count):
    values = [float(200 + 9 * i + 40 * np.sin(i / 2) + (i % 5) * 3) for i in range(count)]
    months = months_from(2022, 5, count)
    rows = flat_facts(spark, values, start=(2022, 5))
    got = forecast.revenue_forecast(rows, horizon=14).collect()
    for row, (month, revenue, lower, upper) in zip(got, expected_forecast(values, months, 14), strict=True):
        assert (row.month, row.revenue, row.lower, row.upper) == (
            month,
            pytest.approx(revenue),
            pytest.approx(lower),
            pytest.approx(upper),
        )
    misses = []
    for i in range(max(5, count - 6), count):
        predicted = expected_forecast(values[:i], months[:i], 1)[0][1]
        misses.append(abs(values[i] - predicted) / values[i])
    check = forecast.forecast_backtest(rows).first()
    assert (check.validation_mape, check.folds) == (pytest.approx(np.mean(misses)), len(misses))


def test_forecast_needs_six_months(trend_facts):
    short = trend_facts.where("month <= '2025-05'")
    assert forecast.revenue_forecast(short).count() == forecast.forecast_backtest(short).count() == 0
    assert forecast.revenue_forecast(short, by=["product"]).count() == 0
    rows = forecast.revenue_forecast(trend_facts).collect()
    assert [r.month for r in rows] == ["2025-09", "2025-10", "2025-11"]
    assert all(r.upper >= r.lower for r in rows) and rows[0].method == forecast.LINEAR_METHOD


def test_forecast_by_series_equals_each_series_alone(trend_facts):
    grouped = {(r["product"], r.step): r.revenue for r in forecast.revenue_forecast(trend_facts, by=["product"]).collect()}
    alone = forecast.revenue_forecast(trend_facts.where("product = 'A'")).collect()
    assert [grouped["A", r.step] for r in alone] == pytest.approx([r.revenue for r in alone])


# Layout


def collected(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in row) for row in df.collect())


def test_results_do_not_depend_on_partitioning(decision_facts):
    for operator in (
        trends.monthly_performance,
        changes.period_drivers,
        opportunity.opportunity_radar,
        forecast.revenue_forecast,
        lambda f: trends.robust_anomalies(f, 1.0),
    ):
        one, seven = (operator(decision_facts.repartition(n)) for n in (1, 7))
        assert collected(one.na.fill(-1.0)) == collected(seven.na.fill(-1.0))
