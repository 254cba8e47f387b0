from decimal import Decimal

from pyspark.sql import functions as F

from tillwise.operators import economics
from tillwise.operators.facts import exact_money
from tillwise.operators.totals import money_of, total, with_units
from tillwise.session import configure

AMOUNTS = ["0.0001", "-0.0001", "123456789.1234", "-99999.5", "104.8576", "-104.8577", "90000000000000.9999", "0"]


def test_whole_number_sums_equal_decimal_sums(spark):
    rows = [(i % 2, Decimal(a)) for i, a in enumerate(AMOUNTS * 50)]
    decimals = spark.createDataFrame(rows, "g int, net_revenue decimal(18,4)")
    units = decimals.withColumn("net_units", (F.col("net_revenue") * 10_000).cast("bigint")).repartition(5)
    for where in (None, F.col("g") == 1):
        wanted = decimals.agg(total(decimals, "net_revenue", where).alias("t")).first().t
        assert units.agg(total(units, "net_revenue", where).alias("t")).first().t == wanted
    assert units.where("false").agg(total(units, "net_revenue").alias("t")).first().t is None


def test_sums_may_exceed_a_long(spark):
    rows = spark.range(3_000).select(F.lit(9 * 10**18).alias("net_units"), F.lit(0).alias("net_revenue"))
    assert rows.agg(total(rows, "net_revenue").alias("t")).first().t == Decimal(9 * 10**14 * 3_000)


def test_units_give_the_same_facts_and_kpis(spark, decision_facts):
    exact = exact_money(decision_facts)
    units = with_units(exact)
    assert economics.executive_kpis(units).first() == economics.executive_kpis(exact).first()
    back = units.where(money_of(F.col("profit_units")) != F.col("gross_profit"))
    assert back.count() == 0


def test_shuffles_are_sized_for_the_data(spark):
    configure(spark, stored_bytes=100 * 2**40)
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum") == str(100 * 2**40 // 2**28)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
