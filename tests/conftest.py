"""Shared session and small fact tables with known answers."""

from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tillwise.operators.facts import enrich
from tillwise.schema import FACT_COLUMNS, RAW_COLUMNS
from tillwise.session import configure

RAW_TEXT = (
    "transaction_id string, order_id string, order_date string, region string, channel string, "
    "customer_segment string, category string, product string, quantity bigint, list_price double, "
    "discount_rate double, unit_cost double"
)
FACT_TEXT = (
    "transaction_id string, order_id string, order_date date, region string, channel string, customer_segment string, "
    "category string, product string, quantity double, gross_revenue double, discount_amount double, "
    "discount_rate double, net_revenue double, cost double, gross_profit double, gross_margin double, month string"
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)


RAW_ROWS = [
    ("TXN-1", "ORD-1", "2024-01-02", "North", "Online", "SMB", "Office", "A", 2, 100.0, 0.10, 50.0),
    ("TXN-2", "ORD-1", "2024-01-02", "North", "Online", "SMB", "Office", "B", 1, 200.0, 0.20, 100.0),
    ("TXN-3", "ORD-2", "2024-02-02", "South", "Retail", "Consumer", "Home", "A", 1, 100.0, 0.00, 40.0),
]


@pytest.fixture(scope="session")
def raw(spark):
    return spark.createDataFrame(RAW_ROWS, RAW_TEXT)


@pytest.fixture(scope="session")
def facts(raw):
    return enrich(raw)


def make_facts(spark, rows):
    """Facts from (date, region, channel, segment, category, product, quantity, gross, discount, cost)."""
    full = []
    for i, (date, region, channel, segment, category, product, quantity, gross, discount, cost) in enumerate(rows):
        net = gross - discount
        rate = discount / gross if gross else 0.0
        margin = (net - cost) / net if net else None
        full.append(
            (f"TXN-{i}", f"ORD-{i}", dt.date.fromisoformat(date), region, channel, segment, category, product,
             float(quantity), float(gross), float(discount), rate, float(net), float(cost), float(net - cost), margin, date[:7])
        )
    return spark.createDataFrame(full, FACT_TEXT)


@pytest.fixture(scope="session")
def view_facts(spark):
    return make_facts(
        spark,
        [
            ("2024-01-10", "North", "Online", "SMB", "Office", "A", 2, 200, 20, 100),
            ("2024-02-10", "South", "Retail", "Consumer", "Home", "B", 1, 120, 0, 70),
            ("2024-02-11", "North", "Online", "SMB", "Office", "A", 1, 100, 10, 50),
        ],
    )


def months_from(start_year, start_month, count):
    return [f"{start_year + (start_month - 1 + i) // 12}-{(start_month - 1 + i) % 12 + 1:02d}" for i in range(count)]


@pytest.fixture(scope="session")
def trend_facts(spark):
    rows = []
    for i, month in enumerate(months_from(2025, 1, 8)):
        for product, region, channel, category, net, cost in (
            ("A", "West", "Distributor", "Office", 100 + 10 * i, 80 + 8 * i),
            ("B", "South", "Online", "Electronics", 80 + 9 * i, 40 + 3 * i),
        ):
            gross = net / 0.9
            rows.append((f"{month}-15", region, channel, "SMB", category, product, 1, gross, gross - net, cost))
    return make_facts(spark, rows)


@pytest.fixture(scope="session")
def decision_facts(spark):
    rows = []
    for i, month in enumerate(months_from(2024, 1, 14)):
        for channel, product, region, segment, category, net, cost, rate in (
            ("Distributor", "Desk", "West", "Enterprise", "Office", 120 + 7 * i, 100 + 4 * i, 0.22),
            ("Online", "Headset", "South", "SMB", "Electronics", 100 + 6 * i, 45 + 2 * i, 0.06),
        ):
            gross = net / (1 - rate)
            rows.append((f"{month}-15", region, channel, segment, category, product, 1, gross, gross - net, cost))
    return make_facts(spark, rows)


assert len(RAW_COLUMNS) == len(RAW_ROWS[0]) and len(FACT_COLUMNS) == 17
