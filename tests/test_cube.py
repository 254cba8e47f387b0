"""Operators over a cube give what they give over the lines."""

import pytest
from pyspark.sql import functions as F

from tillwise.session import configure
from tillwise.operators import discounts, economics, lineage, recommend, trends
from tillwise.operators.cube import GROUPINGS, sales_cube
from tillwise.operators.economics import MARK, grouping_name
from tillwise.operators.facts import enrich
from tillwise.operators.totals import with_units
from tillwise.plans.report import COMBINATIONS, METHODOLOGY, methodology

OPERATORS = {
    "kpis": economics.executive_kpis,
    "view": economics.view_kpis,
    "months": trends.monthly_performance,
    "dimensions": economics.dimension_summary,
    **{name: (lambda f, pair=pair, limit=limit: economics.combination_summary(f, pair, limit)) for name, (pair, limit) in COMBINATIONS.items()},
    "season": economics.seasonality,
    "season_category": lambda f: economics.seasonality(f, ["category"]),
    "season_channel": lambda f: economics.seasonality(f, ["channel"]),
    "bands": discounts.discount_distribution,
    "discounts": discounts.discount_summary,
    "products": trends.product_economics,
    "pareto": lambda f: economics.pareto_curve(f, "product"),
    "bridge": lambda f: economics.economic_bridge(f, ["region"]),
    "anomalies": trends.robust_anomalies,
    "options": lineage.filter_options,
    "advice": recommend.recommendations,
    "more advice": recommend.dynamic_recommendations,
}


@pytest.fixture(scope="module")
def lines(spark):
    """Orders with several lines, over several months, with the values of a dimension changing within an order."""
    i = F.col("id")
    return spark.range(600).select(
        F.concat(F.lit("TXN-"), i).alias("transaction_id"),
        F.concat(F.lit("ORD-"), F.floor(i / 4)).alias("order_id"),
        F.date_add(F.lit("2023-11-15").cast("date"), (i % 200).cast("int")).alias("order_date"),
        F.when(i % 13 == 0, None).otherwise(F.concat(F.lit("r"), i % 3)).alias("region"),
        F.concat(F.lit("c"), F.floor(i / 8) % 3).alias("channel"),
        F.concat(F.lit("s"), i % 2).alias("customer_segment"),
        F.concat(F.lit("cat"), i % 4).alias("category"),
        F.concat(F.lit("p"), i % 12).alias("product"),
        (i % 9 + 1).alias("quantity"),
        (i % 31 + 1).cast("decimal(15,2)").alias("list_price"),
        (i % 7 / 20).cast("decimal(9,6)").alias("discount_rate"),
        (i % 11).cast("decimal(15,2)").alias("unit_cost"),
    )


@pytest.fixture(scope="module")
def both(lines):
    facts = with_units(enrich(lines)).cache()
    return facts, sales_cube(facts)


def told(df):
    return [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()]


@pytest.mark.parametrize("name", list(OPERATORS))
def test_cube_equals_lines(both, name):
    facts, cube = both
    wanted, got = OPERATORS[name](facts), OPERATORS[name](cube)
    assert got.columns == wanted.columns
    assert sorted(map(str, told(got))) == sorted(map(str, told(wanted)))


def test_cube_is_small_and_refuses_what_it_did_not_count(both):
    _, cube = both
    assert {r[0] for r in cube.select(MARK).distinct().collect()} == {None, *map(grouping_name, GROUPINGS)}
    assert economics.group_economics(cube, ["region", "product"], orders=False).count() > 0
    with pytest.raises(ValueError, match="does not count orders"):
        economics.group_economics(cube, ["region", "product"])


def test_cube_of_plain_doubles_and_of_nothing(facts):
    doubles = facts.withColumns({c: F.col(c).cast("double") for c in ("gross_revenue", "discount_amount", "net_revenue", "cost", "gross_profit")})
    assert told(economics.executive_kpis(sales_cube(doubles))) == told(economics.executive_kpis(doubles))
    assert told(economics.executive_kpis(sales_cube(facts.limit(0)))) == told(economics.executive_kpis(facts.limit(0)))
    texts = {r["topic"]: r["text"] for r in methodology(sales_cube(facts)).collect()}
    assert set(texts) == set(METHODOLOGY) and "observed 2024 history" in texts["seasonality"]


def test_sections_of_a_cube_do_not_read_the_lines(both):
    facts, cube = both
    assert "InMemoryTableScan" in facts._jdf.queryExecution().toString()
    for name in ("kpis", "months", "dimensions", "products", "advice"):
        assert "InMemoryTableScan" not in OPERATORS[name](cube)._jdf.queryExecution().toString()


def test_shuffles_are_sized_by_the_stored_lines(spark, tmp_path):
    """Growing lines start their shuffles with more partitions, so that a task's share of the cube stays the same."""
    import duckdb

    from tillwise.catalog.queries import QUERIES
    from tillwise.session import PARTITION_BYTES
    from tillwise.sources.star import stored_bytes

    orders = 250_000
    tables = {
        "region": "SELECT 0::INT r_regionkey, 'EUROPE' r_name",
        "nation": "SELECT 0::INT n_nationkey, 0::INT n_regionkey",
        "customer": "SELECT i::BIGINT c_custkey, 0::INT c_nationkey, 'BUILDING' c_mktsegment FROM range(10) t(i)",
        "part": "SELECT i::BIGINT p_partkey, 'p' || i p_name, 'STEEL' p_type, 10.0::DOUBLE p_retailprice FROM range(50) t(i)",
        "orders": f"SELECT i::BIGINT o_orderkey, (i % 10)::BIGINT o_custkey, 'O' o_orderstatus, "
        f"TIMESTAMP '1995-01-01' + INTERVAL (i % 700) DAY o_orderdate, '1-URGENT' o_orderpriority FROM range({orders}) t(i)",
        "lineitem": f"SELECT (i // 4)::BIGINT l_orderkey, (hash(i) % 50)::BIGINT l_partkey, 0::BIGINT l_suppkey, (i % 4)::INT l_linenumber, "
        "(1 + hash(i) % 40)::DOUBLE l_quantity, ((1 + hash(i, 1) % 9000000) / 100)::DOUBLE l_extendedprice, "
        "((hash(i, 2) % 10) / 100)::DOUBLE l_discount, 0.0::DOUBLE l_tax, 'N' l_returnflag, 'O' l_linestatus, TIMESTAMP '1995-01-01' l_shipdate "
        f"FROM range({4 * orders}) t(i)",
    }
    for name, rows in tables.items():
        duckdb.sql(f"COPY ({rows}) TO '{tmp_path}/{name}.parquet' (FORMAT parquet)")
    wanted = -(-stored_bytes(spark, str(tmp_path)) // PARTITION_BYTES)
    assert wanted > int(spark.conf.get("spark.sql.shuffle.partitions"))

    result = QUERIES["cube_monthly_performance"](spark, str(tmp_path)).collect()
    assert int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum")) == wanted
    assert sum(r["orders"] for r in result) == orders


def test_sized_shuffles_are_not_merged_back_to_large_partitions(spark):
    """Run-time merging of the cube's join partitions must stay near the start size, else a task's exploded share grows."""
    keys = ("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    saved = {k: spark.conf.get(k, None) for k in keys}
    try:
        configure(spark, 200 * 1024 * 1024)
        assert int(spark.conf.get(keys[0])) >= 200
        assert int(spark.conf.get(keys[1])) <= 4 * 1024 * 1024
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_sized_scans_read_small_splits(spark):
    """A scan task aggregates its split on the map side, so its split must not grow with the stored lines."""
    key = "spark.sql.files.maxPartitionBytes"
    saved = spark.conf.get(key, None)
    try:
        configure(spark, 200 * 1024 * 1024)
        assert int(spark.conf.get(key).rstrip("b")) <= 4 * 1024 * 1024
    finally:
        spark.conf.unset(key) if saved is None else spark.conf.set(key, saved)
