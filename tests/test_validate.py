import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import RAW_ROWS, RAW_TEXT
from tillwise.operators.facts import enrich
from tillwise.operators.lineage import dataset_fingerprint, filter_options, lineage_metadata
from tillwise.operators.validate import CHECKS, DataValidationError, check_summary, duplicate_ids, validate, validation_report
from tillwise.plans.report import build_report
from tillwise.schema import RAW_COLUMNS
from tillwise.sources.sinks import write_facts
from tillwise.sources.star import sales_facts
from tillwise.sources.tables import read_facts, read_sales_csv, read_sales_parquet


def spoiled(raw, column, value):
    """The table with one value replaced in its first row."""
    kept = F.col(column).cast("string") if isinstance(value, str) else F.col(column)
    return raw.withColumn(column, F.when(F.col("transaction_id") == "TXN-1", F.lit(value)).otherwise(kept))


def test_a_clean_table_passes(raw):
    outcome = validate(raw)
    assert (outcome["status"], outcome["row_count"], outcome["column_count"]) == ("passed", 3, 12)
    assert outcome["checks"] == list(CHECKS)
    summary = check_summary(validation_report(raw)).collect()
    assert [r["check"] for r in summary] == list(CHECKS)
    assert {r.status for r in summary} == {"passed"}


@pytest.mark.parametrize(
    ("column", "value", "message"),
    [
        ("quantity", 0, "Quantity must be greater"),
        ("quantity", -1, "Quantity must be greater"),
        ("quantity", 1.5, "whole units"),
        ("list_price", -5.0, "List price"),
        ("list_price", 0.0, "List price"),
        ("unit_cost", -2.0, "Unit cost"),
        ("discount_rate", -0.1, "Discount rate"),
        ("discount_rate", 1.1, "Discount rate"),
        ("list_price", "abc", "invalid numeric values.*abc"),
        ("region", None, "Null values.*region"),
        ("order_id", "oops", "Malformed order_id.*oops"),
        ("order_date", "not-a-date", "Invalid order_date"),
        ("order_date", "2099-01-01", "future"),
        ("order_date", "1999-12-31", "historical"),
    ],
)
def test_broken_rules_raise(raw, column, value, message):
    with pytest.raises(DataValidationError, match=message):
        validate(spoiled(raw, column, value))


def test_a_full_discount_is_allowed(raw):
    assert validate(spoiled(raw, "discount_rate", 1.0))["status"] == "passed"


def test_schema_rules(spark, raw):
    with pytest.raises(DataValidationError, match="Missing required columns.*product"):
        validate(raw.drop("product"))
    with pytest.raises(DataValidationError, match="Unexpected columns.*extra"):
        validate(raw.withColumn("extra", F.lit("bad")))
    assert validate(raw.withColumn("extra", F.lit("bad")), strict_columns=False)["status"] == "passed"
    with pytest.raises(DataValidationError, match="empty"):
        validate(spark.createDataFrame([], RAW_TEXT))


def test_duplicate_ids(raw):
    twice = raw.union(raw.where("transaction_id <> 'TXN-3'"))
    with pytest.raises(DataValidationError, match="Duplicate transaction.*TXN-1.*TXN-2"):
        validate(twice)
    assert {(r.transaction_id, r.occurrences) for r in duplicate_ids(twice).collect()} == {("TXN-1", 2), ("TXN-2", 2)}


def test_the_first_rule_in_order_is_raised(raw):
    broken = spoiled(spoiled(raw, "unit_cost", -1.0), "order_id", "oops")
    with pytest.raises(DataValidationError, match="Malformed"):
        validate(broken)
    found = {r.message: (r.violations, r.examples) for r in validation_report(broken).collect() if r.violations}
    assert found["Malformed order_id"] == (1, ["oops"])
    assert found["Unit cost cannot be negative."] == (1, ["-1.0"])


def test_examples_are_few(spark):
    rows = [(f"bad-{i:02d}", *row[1:]) for i in range(20) for row in RAW_ROWS[:1]]
    report = validation_report(spark.createDataFrame(rows, RAW_TEXT).repartition(5))
    row = report.where("message = 'Malformed transaction_id'").first()
    assert (row.violations, row.examples) == (20, ["bad-00", "bad-01", "bad-02"])


def test_date_limits_are_parameters(raw):
    assert validate(raw, as_of=dt.date(2024, 2, 2), min_date=dt.date(2024, 1, 2))["status"] == "passed"
    with pytest.raises(DataValidationError, match="future"):
        validate(raw, as_of=dt.date(2024, 2, 1))


# Lineage, sources and the report


def test_fingerprint_ignores_row_order_and_sees_every_change(spark, raw):
    def of(df):
        return tuple(dataset_fingerprint(df, RAW_COLUMNS).first())

    assert of(raw) == of(raw.orderBy(F.desc("transaction_id")).repartition(3))
    assert of(raw) != of(spoiled(raw, "unit_cost", 51.0))
    assert of(raw) != of(raw.limit(2))
    joined = [spark.createDataFrame([x], "a string, b string") for x in (("a|b", "c"), ("a", "b|c"), ("a", None), ("a", "-"))]
    assert len({tuple(dataset_fingerprint(x, ["a", "b"]).first()) for x in joined}) == 4
    seeds = [dataset_fingerprint(raw, RAW_COLUMNS, seed).first().build_id for seed in (0, 1)]
    assert seeds[0] != seeds[1] and len(seeds[0]) == 16


def test_metadata_and_options(facts):
    row = lineage_metadata(facts, 12, "passed").first()
    assert (row.row_count, row.date_min, row.date_max, row.validation_status) == (3, "2024-01-02", "2024-02-02", "passed")
    options = {(r.dimension, r.value) for r in filter_options(facts).collect()}
    assert ("region", "North") in options and len(options) == 10
    blank = facts.withColumn("region", F.lit(""))
    assert filter_options(blank).where("dimension = 'region'").count() == 0


def test_typed_sources_round_trip(spark, raw, tmp_path):
    raw.write.option("header", True).csv(str(tmp_path / "csv"))
    typed = read_sales_csv(spark, str(tmp_path / "csv"))
    typed.write.parquet(str(tmp_path / "parquet"))
    again = read_sales_parquet(spark, str(tmp_path / "parquet"))
    assert again.schema == typed.schema and again.count() == 3
    assert dict(read_sales_csv(spark, str(tmp_path / "csv"), typed=False).dtypes)["list_price"] == "string"
    assert enrich(again).agg(F.sum("net_revenue")).first()[0] == 440


def test_stored_facts_are_pruned_by_month(spark, facts, tmp_path):
    from tillwise.operators.changes import in_months

    write_facts(facts, str(tmp_path / "facts"))
    stored = read_facts(spark, str(tmp_path / "facts"))
    assert stored.count() == 3 and dict(stored.dtypes)["month"] == "string"
    one = in_months(stored, ("2024-02",))
    assert one.count() == 1
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "month" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_report_end_to_end(spark, raw, tmp_path):
    checked = build_report(raw, str(tmp_path / "report"))
    assert checked["row_count"] == 3
    metadata = spark.read.parquet(str(tmp_path / "report/metadata")).first()
    assert metadata.validation_status == "passed" and metadata.row_count == 3 and len(metadata.build_id) == 16
    assert spark.read.parquet(str(tmp_path / "report/summary")).first().net_revenue == 440
    assert spark.read.parquet(str(tmp_path / "report/records")).count() == 3
    assert spark.read.parquet(str(tmp_path / "report/recommendations")).count() > 0
    with pytest.raises(DataValidationError):
        build_report(spoiled(raw, "quantity", 0), str(tmp_path / "bad"))


# The strict gate on text, and sources that round nothing


@pytest.mark.parametrize("column,value,check", [
    ("order_date", "2024-02-30", "date_parse"), ("order_date", "1/15/2024", "date_parse"), ("list_price", "100d", "numeric_types"),
    ("list_price", "2f", "numeric_types"), ("unit_cost", "NaN", "numeric_types"), ("quantity", "Infinity", "numeric_types"), ("quantity", "abc", "numeric_types"),
])
def test_text_that_is_no_value_fails(raw, column, value, check):
    text = raw.select(*[F.col(c).cast("string").alias(c) for c in RAW_COLUMNS])
    bad = text.withColumn(column, F.when(F.col("transaction_id") == "TXN-2", F.lit(value)).otherwise(F.col(column)))
    hits = {r["check"]: r for r in validation_report(bad, dt.date(2025, 1, 1)).where("violations > 0").collect()}
    assert set(hits) == {check} and hits[check].examples == [value]


def test_a_text_table_goes_through_the_whole_report(spark, raw, tmp_path):
    raw.write.option("header", True).csv(str(tmp_path / "csv"))
    text = read_sales_csv(spark, str(tmp_path / "csv"), typed=False)
    assert build_report(text, str(tmp_path / "out"), as_of=dt.date(2025, 1, 1))["status"] == "passed"
    assert spark.read.parquet(str(tmp_path / "out" / "summary")).first().net_revenue == 440


def test_sources_keep_what_is_stored(spark, raw, tmp_path):
    raw.withColumn("list_price", F.lit(10.005)).write.parquet(str(tmp_path / "doubles"))
    again = read_sales_parquet(spark, str(tmp_path / "doubles"))
    assert again.first().list_price == 10.005 and again.schema["list_price"].dataType.typeName() == "double"
    raw.withColumn("list_price", F.lit("10.005")).write.option("header", True).csv(str(tmp_path / "csv"))
    with pytest.raises(Exception, match="does not fit"):
        read_sales_csv(spark, str(tmp_path / "csv")).collect()


def test_lines_without_partners_are_kept(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    for name in ("lineitem", "orders", "customer", "part", "nation", "region"):
        table = spark.read.parquet(f"{folder}/{name}.parquet")
        key = {"part": "p_partkey", "customer": "c_custkey", "orders": "o_orderkey"}.get(name)
        (table.where(f"{key} % 10 <> 3") if key else table).write.parquet(str(tmp_path / f"{name}.parquet"))
    whole = spark.read.parquet(f"{folder}/lineitem.parquet").count()
    for columns in ((), ("cost",), ("order_date",), ("region",), None):
        assert sales_facts(spark, str(tmp_path), columns).count() == whole
    assert sales_facts(spark, str(tmp_path)).where("region = 'Unspecified'").count() > 0
