"""Months and fingerprints of written facts come from their catalogue."""

import os

import pytest
from pyspark.sql import functions as F

from tillwise.catalog.queries import QUERIES
from tillwise.operators import changes
from tillwise.operators.lineage import dataset_fingerprint
from tillwise.schema import FACT_COLUMNS
from tillwise.sources.sinks import RATIOS, append_facts, read_catalogue, stored_fingerprint, write_facts
from tillwise.sources.tables import read_facts

FOLDER = "/root/testdata/sf0.001"


def test_appended_facts_have_the_fingerprint_of_the_whole(spark, facts, tmp_path):
    place = str(tmp_path / "facts")
    write_facts(facts.where("month = '2024-01'"), place)
    append_facts(facts.where("month <> '2024-01'"), place)
    assert read_facts(spark, place).count() == facts.count() == 3
    columns = [c for c in FACT_COLUMNS if c not in RATIOS]
    assert stored_fingerprint(spark, place).first() == dataset_fingerprint(facts, columns).first()
    found = {r["month"]: (r["lines"], str(r["first_day"]), str(r["last_day"])) for r in read_catalogue(spark, place).collect()}
    assert found == {"2024-01": (2, "2024-01-02", "2024-01-02"), "2024-02": (1, "2024-02-02", "2024-02-02")}
    append_facts(facts.where("month = '2024-01'"), place)  # a month that is there already
    again = {r["month"]: r["lines"] for r in read_catalogue(spark, place).collect()}
    assert again == {"2024-01": 4, "2024-02": 1}
    write_facts(facts, place)
    assert stored_fingerprint(spark, place).first() == dataset_fingerprint(facts, columns).first()


@pytest.mark.parametrize("complete_only", [False, True])
def test_months_from_a_catalogue_are_those_of_the_facts(spark, facts, tmp_path, complete_only):
    write_facts(facts, str(tmp_path / "facts"))
    known = read_catalogue(spark, str(tmp_path / "facts"))
    assert changes.months_present(facts, complete_only, known) == changes.months_present(facts, complete_only)
    empty = known.limit(0)
    assert changes.months_present(facts, complete_only, empty) == []
    assert changes.what_changed(facts, empty).collect() == []


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_finding_months_does_not_read_the_lines(spark, monkeypatch):
    plans = []
    kept = changes.merged_catalogue

    def watched(catalogue):
        plans.append(kept(catalogue)._jdf.queryExecution().toString())
        return kept(catalogue)

    def refused(facts):
        raise AssertionError("the facts were read to find months")

    monkeypatch.setattr(changes, "merged_catalogue", watched)
    monkeypatch.setattr(changes, "month_catalogue", refused)
    for name in ("what_changed", "period_brief_yoy", "period_drivers_mom"):
        QUERIES[name](spark, FOLDER)
    assert len(plans) == 3 and all("o_orderdate" in p and "l_orderkey" not in p for p in plans)


def test_lines_without_a_month_are_no_month(spark, facts):
    odd = facts.withColumn("month", F.lit(None).cast("string"))
    assert changes.months_present(odd) == []


def test_catalogue_is_made_from_the_files_just_written(spark, facts, tmp_path, monkeypatch):
    """The facts are joined once for a write, and not again for its catalogue."""
    from tillwise.sources import sinks

    seen, kept = [], sinks.month_catalogue

    def watched(written, *sums):
        seen.append({f.rsplit("/", 1)[-1] for f in written.inputFiles()})
        return kept(written, *sums)

    monkeypatch.setattr(sinks, "month_catalogue", watched)
    place = tmp_path / "some facts"

    def files():
        return {f.name for f in place.glob("month=*/part-*.parquet")}

    undated = facts.withColumn("month", F.when(F.col("month") != "2024-02", F.col("month")))
    write_facts(undated, str(place))
    first = files()
    append_facts(facts, str(place))
    append_facts(facts.limit(0), str(place))
    write_facts(facts, str(place))
    assert seen[0] == first and first and not seen[1] & first and seen[1] and not seen[2] and seen[3] == files()
    columns = [c for c in FACT_COLUMNS if c not in RATIOS]
    assert stored_fingerprint(spark, str(place)).first() == dataset_fingerprint(facts, columns).first()


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_pinned_facts_are_the_facts(spark):
    from tillwise.sources.star import sales_facts

    pinned, plain = sales_facts(spark, FOLDER, pinned=True), sales_facts(spark, FOLDER)
    assert pinned.schema.names == plain.schema.names
    assert "Join" not in pinned._jdf.queryExecution().optimizedPlan().toString()
    assert pinned.count() == plain.count() and pinned.exceptAll(plain).isEmpty()
