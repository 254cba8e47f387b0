"""Bloom filters pass every key, few others, and reduce lines before they are shuffled."""

from pyspark.sql import functions as F

from tillwise.operators import keyfilter
from tillwise.operators.filters import Filters, filter_facts
from tillwise.operators.ingest import ROW_INDEX, first_occurrences
from tillwise.operators.keyfilter import key_filter, reduced, with_match
from tillwise.sources import star

VIEW = Filters("1997-01-01", "1997-03-31", region="ASIA")
COLUMNS = ("cost", "order_date", "month", "region")
FOLDER = "/root/testdata/sf0.001"


def test_filter_passes_all_keys_and_few_others(spark):
    keys = spark.range(0, 20_000, 2)
    words = key_filter(keys, "id")
    passed = reduced(spark.range(20_000), words, "id")
    assert passed.where(F.col("id") % 2 == 0).count() == 10_000
    assert passed.where(F.col("id") % 2 == 1).count() < 100
    marked = with_match(spark.range(20_000), words, "hit", "id")
    assert marked.count() == 20_000 and marked.where("hit").count() == passed.count()


def test_empty_filter_and_null_keys(spark):
    assert reduced(spark.range(9), key_filter(spark.range(0), "id"), "id").count() == 0
    nothing = spark.sql("SELECT CAST(NULL AS BIGINT) AS id")
    assert reduced(nothing, key_filter(nothing, "id"), "id").count() == 1


def test_filter_of_too_many_keys_is_refused(spark, monkeypatch):
    monkeypatch.setattr(keyfilter, "FULL", 1e-6)
    assert key_filter(spark.range(1000), "id") is None


def above_scan_of_lines(df):
    """The operators from the scan of the lines up to the root of the plan, by their indentation."""
    plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    at = next(i for i, line in enumerate(plan) if "FileScan" in line and "l_extendedprice" in line)
    path, level = [], depth(plan[at])
    for line in reversed(plan[:at]):
        if depth(line) < level:
            level = depth(line)
            path.append(line.lstrip(" :+-"))
    return path


def told(df):
    return sorted(map(str, df.select("transaction_id", "region", "net_revenue", "gross_profit").collect()))


def test_view_reads_the_same_lines_however_it_is_reduced(spark, monkeypatch):
    plain = told(filter_facts(star.sales_facts(spark, FOLDER, COLUMNS), VIEW))
    assert plain and told(filter_facts(star.sales_facts(spark, FOLDER, COLUMNS, VIEW), VIEW)) == plain
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        view = star.sales_facts(spark, FOLDER, COLUMNS, VIEW)
        path = above_scan_of_lines(view)
        joins = [i for i, step in enumerate(path) if step.startswith("BroadcastHashJoin") and keyfilter.WORD in step]
        exchanges = [i for i, step in enumerate(path) if step.startswith("Exchange")]
        assert joins and exchanges and joins[0] < exchanges[0]  # reduced below the first exchange
        assert told(filter_facts(view, VIEW)) == plain
        # Orders too many for a filter: joined first.
        monkeypatch.setattr(keyfilter, "FULL", 0.0)
        late = star.sales_facts(spark, FOLDER, COLUMNS, VIEW)
        assert keyfilter.WORD not in late._jdf.queryExecution().executedPlan().toString()
        assert told(filter_facts(late, VIEW)) == plain
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_view_of_lines_without_a_value(spark):
    unknown = Filters("1990-01-01", "2030-01-01", region=star.UNKNOWN, product="PROMO red widget")
    plain = told(filter_facts(star.sales_facts(spark, FOLDER, (*COLUMNS, "product")), unknown))
    assert told(filter_facts(star.sales_facts(spark, FOLDER, (*COLUMNS, "product"), unknown), unknown)) == plain
    product = Filters("1990-01-01", "2030-01-01", product="PROMO red widget")
    wanted = told(filter_facts(star.sales_facts(spark, FOLDER, (*COLUMNS, "product")), product))
    assert wanted and told(filter_facts(star.sales_facts(spark, FOLDER, (*COLUMNS, "product"), product), product)) == wanted


ROWS = [("a", "1"), ("a", "1"), ("b", "1"), ("a", None), ("a", None), (None, "a"), ("b", "2"), ("a", "1")]
FIRSTS = [("a", "1", 0), ("b", "1", 2), ("a", None, 3), (None, "a", 5), ("b", "2", 6)]


def numbered(spark, rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], f"x string, `y z` string, {ROW_INDEX} bigint").repartition(3)


def firsts(df):
    return sorted(map(tuple, df.collect()), key=lambda r: r[2])


def test_first_occurrences(spark):
    assert firsts(first_occurrences(numbered(spark, ROWS))) == FIRSTS
    assert firsts(first_occurrences(numbered(spark, []))) == []


def test_rows_of_equal_digests_stay_apart(spark, monkeypatch):
    assert firsts(first_occurrences(numbered(spark, ROWS), lambda columns: F.lit(7).cast("bigint"))) == FIRSTS
    monkeypatch.setattr(keyfilter, "FULL", 0.0)
    assert firsts(first_occurrences(numbered(spark, ROWS))) == FIRSTS


def test_only_rows_that_may_be_copies_are_grouped(spark):
    rows = [(f"x{i}", "y") for i in range(5000)] + [("x7", "y")]
    grouped = first_occurrences(numbered(spark, rows))
    assert grouped.count() == 5000
    assert "Union" in grouped._jdf.queryExecution().optimizedPlan().toString()
