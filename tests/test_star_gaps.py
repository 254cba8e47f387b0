"""Lines whose order, part or customer is missing, and stored amounts that do not fit, against SQL over the same tables."""

import os

import duckdb
import pytest

from tests.oracle_check import differences, oracle_connection
from tillwise.catalog.oracles import ORACLES
from tillwise.catalog.queries import QUERIES
from tillwise.sources.star import raw_sales, sales_facts

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")

# Rows that stay; the rest of each table is missing.
KEPT = {
    "part": "p_partkey % 5 <> 0", "customer": "c_custkey % 7 <> 0", "nation": "n_nationkey % 6 <> 0", "region": "r_regionkey <> 0",
    "orders": "o_orderkey % 11 <> 0", "lineitem": "TRUE",
}


def tables(folder, kept, lines="*"):
    for table, rows in kept.items():
        columns = lines if table == "lineitem" else "*"
        duckdb.sql(f"COPY (SELECT {columns} FROM '{FOLDER}/{table}.parquet' WHERE {rows}) TO '{folder}/{table}.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.fixture(scope="module")
def gaps(tmp_path_factory):
    return tables(tmp_path_factory.mktemp("gaps"), KEPT)


NAMES = ("fact_gaps", "kpis", "dimension_summary", "combo_product_channel", "economic_bridge", "ingest_issues", "ingest_facts", "filtered_kpis")


@pytest.mark.parametrize("name", NAMES)
def test_lines_with_gaps_stay(spark, gaps, name):
    got = QUERIES[name](spark, gaps).toPandas()
    assert differences(got, oracle_connection(gaps).execute(ORACLES[name]).df()) == []


def test_gaps_are_counted(spark, gaps):
    row = QUERIES["fact_gaps"](spark, gaps).first()
    lines = duckdb.sql(f"SELECT count(*), count(*) FILTER (l_partkey % 5 = 0), count(*) FILTER (l_orderkey % 11 = 0) FROM '{gaps}/lineitem.parquet'")
    assert (row.lines, row.uncosted_lines, row.undated_lines) == lines.fetchall()[0]
    assert 0 < row.uncosted_lines < row.lines and 0 < row.undated_lines and row.uncosted_revenue > 0


@pytest.mark.parametrize("column, value", [("l_extendedprice", "10.005"), ("l_discount", "0.055"), ("l_quantity", "1.5"), ("l_quantity", "'NaN'::DOUBLE")])
def test_amounts_that_do_not_fit_fail(spark, tmp_path, column, value):
    folder = tables(tmp_path, KEPT, f"* REPLACE (CASE WHEN l_orderkey = 7 THEN {value} ELSE {column} END::DOUBLE AS {column})")
    with pytest.raises(Exception, match="finer than"):
        sales_facts(spark, folder, ("cost",)).agg({"net_units": "sum", "cost_units": "sum"}).collect()
    if column == "l_quantity":
        with pytest.raises(Exception, match="finer than"):
            raw_sales(spark, folder).agg({"quantity": "sum"}).collect()
