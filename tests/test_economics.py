import pytest

from tillwise.operators import discounts, economics
from tillwise.operators.facts import exact_money, export_facts
from tillwise.operators.filters import Filters, default_filters, filter_facts, previous_period
from tillwise.operators.changes import period_over_period_kpis
from tillwise.schema import DIMENSIONS, FACT_COLUMNS


def test_enriched_line(facts):
    row = facts.where("transaction_id = 'TXN-2'").first()
    assert (row.gross_revenue, row.discount_amount, row.net_revenue, row.cost, row.gross_profit) == (200, 40, 160, 100, 60)
    assert row.gross_margin == pytest.approx(60 / 160)
    assert row.margin_before_discount == pytest.approx(0.5)
    assert (row.year, row.quarter, row.month, row.month_of_year) == (2024, "2024Q1", "2024-01", 1)


def test_kpis(facts):
    row = economics.executive_kpis(facts).first()
    assert (row.gross_revenue, row.discount_amount, row.net_revenue, row.cost, row.gross_profit) == (500, 60, 440, 240, 200)
    assert (row.orders, row.units_sold, row.average_order_value, row.average_selling_price) == (2, 4, 220, 110)
    assert row.gross_margin == pytest.approx(200 / 440, abs=1e-4)


def test_kpis_of_nothing_are_zero(facts, view_facts):
    row = economics.executive_kpis(facts.where("false")).first()
    assert row.gross_margin == row.average_order_value == row.net_revenue == row.orders == 0
    assert set(economics.view_kpis(view_facts.where("false")).first()) == {0}


def test_decimal_and_double_facts_agree(facts):
    doubles, decimals = economics.executive_kpis(facts).first(), economics.executive_kpis(exact_money(facts)).first()
    assert doubles.asDict() == pytest.approx(decimals.asDict())


def test_dimension_summary_adds_up(facts):
    rows = economics.dimension_summary(facts).collect()
    assert {r.dimension for r in rows} == set(DIMENSIONS)
    for dimension in DIMENSIONS:
        own = [r for r in rows if r.dimension == dimension]
        assert sum(r.revenue_share for r in own) == pytest.approx(1)
        assert sum(r.profit_share for r in own) == pytest.approx(1)
        assert sum(r.revenue for r in own) == pytest.approx(440)
        assert [r.revenue for r in own] == sorted((r.revenue for r in own), reverse=True)
    product_a = next(r for r in rows if r.value == "A")
    assert (product_a.orders, product_a.units) == (2, 3)


def test_margin_is_null_on_zero_revenue(spark):
    from tests.conftest import make_facts

    free = make_facts(spark, [("2024-01-01", "N", "O", "S", "C", "P", 1, 100, 100, 10)])
    row = economics.group_economics(free, ["region"]).first()
    assert row.margin is None and row.discount_rate == 1
    assert economics.monthly_series(free).first().margin == 0


def test_combinations_keep_the_largest(facts):
    rows = economics.combination_summary(facts, ("product", "channel"), limit=2).collect()
    assert [(r["product"], r.channel, r.revenue) for r in rows] == [("A", "Online", 180), ("B", "Online", 160)]


def test_series(view_facts):
    months = economics.monthly_series(view_facts).collect()
    assert [(r.month, r.revenue) for r in months] == [("2024-01", 180), ("2024-02", 210)]
    products = economics.product_series(view_facts).collect()
    assert (products[0]["product"], products[0].revenue, products[0].units) == ("A", 270, 3)


def test_product_table_sorts_by_any_column(view_facts):
    by_name = economics.product_table(view_facts, sort_by="product", ascending=False).collect()
    assert [r["product"] for r in by_name] == ["B", "A"]
    assert [r.at_risk for r in economics.product_table(view_facts, risk_margin=0.43).collect()] == [False, True]
    assert economics.product_table(view_facts, top=1).count() == 1
    assert economics.product_table(view_facts, top=None).count() == 2


def test_profitability_map_uses_the_upper_median(view_facts):
    rows = {r["product"]: r for r in economics.profitability_map(view_facts).collect()}
    assert rows["A"].benchmark_margin == pytest.approx(120 / 270)
    assert rows["B"].below_benchmark and not rows["A"].below_benchmark


def test_pareto(facts):
    curve = economics.pareto_curve(facts, "product").orderBy("rank").collect()
    assert [r["product"] for r in curve] == ["A", "B"]
    assert curve[-1].cumulative_revenue_share == pytest.approx(1)
    row = economics.pareto_summary(facts, "product").first()
    assert (row.entities_for_80_percent, row.entity_count, row.share_of_entities_for_80_percent) == (2, 2, 1)
    assert row.top_3_revenue_share == 1


def test_seasonality_groups_across_years(spark):
    from tests.conftest import make_facts

    rows = make_facts(
        spark,
        [(d, "N", "O", "S", c, "P", 1, 100, 0, 10) for d, c in (("2023-05-01", "X"), ("2024-05-09", "X"), ("2024-06-01", "Y"))],
    ).selectExpr("*", "month(order_date) AS month_of_year")
    assert [(r.month_of_year, r.revenue) for r in economics.seasonality(rows).collect()] == [(5, 200), (6, 100)]
    assert economics.seasonality(rows, ["category"]).count() == 2


def test_bridge_identities(decision_facts):
    step = {r.item: r.amount for r in economics.economic_bridge(decision_facts).collect()}
    assert step["gross_revenue"] - step["discount_amount"] == pytest.approx(step["net_revenue"])
    assert step["net_revenue"] - step["cost"] == pytest.approx(step["gross_profit"])
    assert economics.economic_bridge(decision_facts, ["region"]).count() == 10


def test_export(facts):
    exported = export_facts(facts)
    assert tuple(exported.columns) == FACT_COLUMNS
    assert exported.where("transaction_id = 'TXN-1'").first().order_date == "2024-01-02"


# Discounts


def test_discount_bands_are_closed_on_the_right(spark):
    from pyspark.sql import functions as F

    rates = [-0.01, 0.0, 0.05, 0.0501, 0.10, 0.15, 0.2, 0.26, 0.27, 1.0, 1.1, None]
    df = spark.createDataFrame([(r,) for r in rates], "r double").select(discounts.discount_bucket(F.col("r")))
    assert [r[0] for r in df.collect()] == [
        None, "0–5%", "0–5%", "5–10%", "5–10%", "10–15%", "15–20%", "20–26%", "26%+", "26%+", None, None,
    ]


def test_discount_summary(facts):
    row = discounts.discount_summary(facts).first()
    assert (row.revenue_lost_to_discounts, row.weighted_discount_rate, row.average_discount) == (60, 0.12, 0.1)
    assert row.margin_before_discount > row.margin_after_discount
    assert row.margin_erosion_pp == pytest.approx((260 / 500 - 200 / 440) * 100, abs=0.01)


def test_discount_leakage(facts):
    row = discounts.discount_leakage(facts).first()
    assert row.leakage_threshold == pytest.approx(0.17)
    assert (row.leakage_revenue, row.leakage_discount_amount, row.leakage_lines) == (160, 40, 1)


def test_discount_distribution(facts):
    rows = discounts.discount_distribution(facts).collect()
    assert [(r.discount_bucket, r.revenue) for r in rows] == [("0–5%", 100), ("5–10%", 180), ("15–20%", 160)]


def test_discount_margin_spearman(facts):
    # Rates 0.1, 0.2, 0.0 against margins 80/180, 60/160, 60/100: exactly opposite orders.
    assert discounts.discount_margin_spearman(facts).first()[0] == pytest.approx(-1)


# Filters


def test_filters(view_facts):
    kept = filter_facts(view_facts, Filters("2024-01-01", "2024-12-31", region="North", product="A"))
    assert sorted(r.transaction_id for r in kept.collect()) == ["TXN-0", "TXN-2"]
    assert default_filters(view_facts) == Filters("2024-01-10", "2024-02-11")
    edges = filter_facts(view_facts, Filters("2024-01-10", "2024-02-10"))
    assert edges.count() == 2


def test_previous_period():
    window = Filters("2024-03-01", "2024-03-31", region="North")
    assert previous_period(window, "2024-01-01") == Filters("2024-01-30", "2024-02-29", region="North")
    assert previous_period(Filters("2024-01-01", "2024-01-31"), "2024-01-01") is None
    assert previous_period(Filters("2024-02-01", "2024-01-01"), "2020-01-01") is None
    assert previous_period(Filters("bad", "2024-01-01"), "2020-01-01") is None


def test_period_over_period(view_facts):
    rows = {r.metric: r for r in period_over_period_kpis(view_facts, Filters("2024-02-01", "2024-02-29"), "2024-01-01").collect()}
    assert (rows["revenue"].current, rows["revenue"].previous) == (210, 180)
    assert rows["revenue"].change == pytest.approx(210 / 180 - 1)
    assert rows["margin"].change == pytest.approx(90 / 210 - 80 / 180)
    without = period_over_period_kpis(view_facts, Filters("2024-01-01", "2024-02-29"), "2024-01-01").collect()
    assert all(r.change is None and r.previous is None for r in without)


def test_zero_baseline_has_no_relative_change(view_facts):
    rows = {r.metric: r for r in period_over_period_kpis(view_facts, Filters("2024-01-11", "2024-01-15"), "2024-01-01").collect()}
    assert rows["revenue"].current == 0 and rows["revenue"].change == -1
    empty = period_over_period_kpis(view_facts, Filters("2024-01-05", "2024-01-09"), "2024-01-01").collect()
    assert all(r.change is None for r in empty)
