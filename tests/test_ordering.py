import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwise.operators import discounts, ordering
from tillwise.operators.ordering import (
    average_ranks,
    column_statistics,
    order_statistics,
    quantile_position,
    running_totals,
    upper_median_position,
    with_row_index,
)


@pytest.fixture(scope="module")
def skewed():
    """A third of the values are one value, the rest nearly distinct."""
    draw = random.Random(7)
    return [(("hot" if i % 3 else "cold"), 5.0 if i % 3 == 0 else round(draw.gauss(5, 3), 3)) for i in range(900)]


def test_running_totals_match_a_sorted_loop(spark):
    values = [(f"k{i:03d}", (i * 37) % 101) for i in range(200)]
    df = spark.createDataFrame(values, "key string, amount bigint").repartition(6)
    got = {r.key: r.total for r in running_totals(df, [F.desc("amount"), F.col("key")], {"total": "amount"}).collect()}
    total, wanted = 0, {}
    for key, amount in sorted(values, key=lambda v: (-v[1], v[0])):
        total += amount
        wanted[key] = total
    assert got == wanted


def test_running_totals_restart_within_groups(spark):
    values = [(f"g{i % 5}", i, i) for i in range(100)]
    df = spark.createDataFrame(values, "g string, k bigint, n bigint")
    for row in running_totals(df, [F.col("k")], {"total": "n"}, within=["g"]).collect():
        assert row.total == sum(n for g, k, n in values if g == row.g and k <= row.k)


@pytest.mark.parametrize("share", [0.0, 0.25, 0.5, 0.85, 1.0])
def test_quantiles_interpolate(spark, skewed, share):
    df = spark.createDataFrame([(v,) for _, v in skewed] + [(None,)], "v double").repartition(5)
    row = order_statistics(df, "v", {"q": quantile_position(share)}).first()
    assert row["size"] == 900
    assert row.q == pytest.approx(np.quantile([v for _, v in skewed], share), abs=1e-12)


def test_quantiles_per_group(spark, skewed):
    df = spark.createDataFrame(skewed, "g string, v double").withColumn("w", F.col("v") * 2)
    rows = {r.g: r for r in column_statistics(df, {"m": ("v", quantile_position(0.5)), "t": ("w", quantile_position(0.9))}, ["g"]).collect()}
    for group in ("hot", "cold"):
        values = [v for g, v in skewed if g == group]
        assert rows[group].m == pytest.approx(np.median(values))
        assert rows[group].t == pytest.approx(np.quantile(values, 0.9) * 2)
        assert rows[group]["size"] == len(values)


def test_upper_median_takes_the_higher_middle(spark):
    df = spark.createDataFrame([(float(v),) for v in (4, 1, 3, 2)], "v double")
    assert order_statistics(df, "v", {"m": upper_median_position()}).first().m == 3.0


def test_average_ranks_share_ties(spark):
    df = spark.createDataFrame([(float(v),) for v in (10, 20, 20, 20, 30)], "v double")
    got = {r.v: r["rank"] for r in average_ranks(df, "v", "rank").collect()}
    assert got == {10.0: 1.0, 20.0: 3.0, 30.0: 5.0}


@pytest.mark.parametrize("broadcast_rows", [100_000, 3])
def test_spearman_is_exact_with_hot_values(spark, skewed, monkeypatch, broadcast_rows):
    monkeypatch.setattr(ordering, "BROADCAST_ROWS", broadcast_rows)
    monkeypatch.setattr(discounts, "HOT_SHARE", 20)
    pairs = [(v, round(v * v + (i % 13), 2)) for i, (_, v) in enumerate(skewed)] + [(None, 1.0), (1.0, None)]
    df = spark.createDataFrame(pairs, "x double, y double").repartition(7)
    got = discounts.spearman(df, "x", "y", "rho").first().rho

    def ranks(values):
        ordered = np.sort(values)
        return (np.searchsorted(ordered, values, "left") + np.searchsorted(ordered, values, "right") + 1) / 2

    x, y = np.array([p for p in pairs if None not in p]).T
    assert got == pytest.approx(np.corrcoef(ranks(x), ranks(y))[0, 1], abs=1e-12)


@pytest.mark.parametrize("broadcast_rows", [100_000, 1])
def test_rows_are_numbered_consecutively(spark, monkeypatch, broadcast_rows):
    monkeypatch.setattr(ordering, "BROADCAST_ROWS", broadcast_rows)
    df = spark.createDataFrame([((i * 7919) % 1000, f"r{i}") for i in range(1000)], "k bigint, t string").repartition(6)
    rows = with_row_index(df, ["k"], "n").collect()
    assert {r.n for r in rows} == set(range(1000))
    assert all(r.n == r.k for r in rows)
