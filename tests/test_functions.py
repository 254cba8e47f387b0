import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillwise.functions import calendar, ratios, text
from tillwise.functions.parsing import as_date, as_number, parse_date, parse_number


def evaluate(spark, values, expression, schema="v string"):
    rows = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in rows.select(expression(F.col("v"))).collect()]


def test_numbers_lose_decoration_and_parentheses_negate(spark):
    written = ["$1,234.50", "(12)", "10%", "₹ 5", "-3", "(-3)", "1e3", ".5", "5.", "€1 000", " 7 ", "(£4.5)"]
    assert evaluate(spark, written, parse_number) == [1234.5, -12, 10, 5, -3, 3, 1000, 0.5, 5, 1000, 7, -4.5]


def test_other_text_is_not_a_number(spark):
    written = ["", "abc", "1d", "2f", "NaN", "Infinity", "--1", "1.2.3", "1e999", None, "()", "0x10"]
    assert evaluate(spark, written, parse_number) == [None] * len(written)


def test_numeric_columns_pass_through(spark):
    assert evaluate(spark, [1.5, float("nan"), float("inf")], lambda c: as_number(c, "double"), "v double") == [1.5, None, None]


@pytest.mark.parametrize(
    ("written", "wanted"),
    [
        ("2025-03-04", "2025-03-04"),
        ("2025/3/4", "2025-03-04"),
        ("2025-03", "2025-03-01"),
        ("2025", "2025-01-01"),
        ("2025-03-04T23:30:00Z", "2025-03-04"),
        ("2025-03-04T23:30:00-02:00", "2025-03-05"),
        ("2025-03-04 10:00", "2025-03-04"),
        ("3/4/2025", "2025-03-04"),
        ("25/12/2025", "2025-12-25"),
        ("25-12-25", "2025-12-25"),
        ("12/25/99", "1999-12-25"),
        ("31/2/2025", "2025-03-03"),
        ("2025-02-30", "2025-03-02"),
        ("Mar 4, 2025", "2025-03-04"),
        ("4 March 2025", "2025-03-04"),
        ("04-Mar-2025", "2025-03-04"),
        (" 2025-03-04 ", "2025-03-04"),
        ("bad-date", None),
        ("", None),
        (None, None),
        ("12/2025", None),
    ],
)
def test_dates(spark, written, wanted):
    assert evaluate(spark, [written], parse_date) == [wanted and dt.date.fromisoformat(wanted)]


def test_day_numbers_count_from_the_spreadsheet_epoch(spark):
    assert evaluate(spark, [45000.0, 45000.9, 20000.0, 80000.0, 5.0], lambda c: as_date(c, "double"), "v double") == [
        dt.date(2023, 3, 15),
        dt.date(2023, 3, 15),
        None,
        None,
        None,
    ]


def test_ratios_with_empty_denominators(spark):
    row = spark.createDataFrame([(1.0, 0.0)], "a double, b double").select(
        ratios.ratio("a", "b"), ratios.ratio_or_zero("a", "b"), ratios.relative_change("a", "b"), ratios.relative_change("b", "a")
    ).first()
    assert tuple(row) == (None, 0.0, None, -1.0)


def test_months_shift_over_year_ends(spark):
    assert evaluate(spark, ["2025-11", "2025-01"], lambda c: calendar.shift_month(c, 3)) == ["2026-02", "2025-04"]
    assert evaluate(spark, ["2025-01"], lambda c: calendar.shift_month(c, -12)) == ["2024-01"]
    assert calendar.shift_month_key("2025-01", -1) == "2024-12"
    assert calendar.month_bounds("2024-12") == (dt.date(2024, 12, 1), dt.date(2025, 1, 1))


def test_texts(spark):
    numbers = [1234.5, 1235.5, -0.4]
    assert evaluate(spark, numbers, text.dollars, "v double") == ["$1,234", "$1,236", "$-0"]
    assert evaluate(spark, [0.1234], text.percent, "v double") == ["12.3%"]
    assert evaluate(spark, ["Mid Market X"], text.slug) == ["mid-market-x"]
    assert evaluate(spark, [-5.0, 2.5], text.plain_number, "v double") == ["-5", "2.5"]
    assert evaluate(spark, ["  x ", "  ", None], lambda c: text.text_or(c, "none")) == ["x", "none", "none"]
