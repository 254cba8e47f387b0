"""Every named query against its SQL on another engine, over the whole smallest tables."""

import os

import pandas as pd
import pytest

import __spark_entry__ as entry_module
from tests.oracle_check import differences, oracle_connection
from tillwise.catalog.oracles import ORACLES
from tillwise.catalog.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(FOLDER)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES) <= set(entry_module.queries())
    assert set(ORACLES) <= set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_the_comparison_sees_differences():
    one = pd.DataFrame({"a": [1, 2], "b": ["x", None]})
    assert differences(one, one.copy()) == []
    assert differences(one, one.assign(a=[1, 3]))
    assert differences(one, one.rename(columns={"a": "c"}))
    assert differences(one, one.head(1))
    assert differences(one, one.assign(a=[1.0, 2.0]))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, connection, name):
    got = QUERIES[name](spark, FOLDER).toPandas()
    wanted = connection.execute(ORACLES[name]).df()
    assert len(got.columns) == len(set(got.columns))
    assert differences(got, wanted) == []


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def test_star_keys_hold(connection):
    """The test tables have no line without its order, part, customer or region; `test_star_gaps` makes such lines."""
    lines = connection.execute("SELECT count(*) FROM lineitem").fetchone()[0]
    joined = connection.execute(
        "SELECT count(*) FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey "
        "JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey"
    ).fetchone()[0]
    assert joined == lines


def test_every_row_rule_is_hit(spark):
    """Only the rules on columns, and the null rules of columns that are not spoiled, find nothing."""
    rows = QUERIES["validation_report_spoiled"](spark, FOLDER).where("violations = 0").collect()
    assert {r["check"] for r in rows} == {"required_columns", "unexpected_columns", "null_values"} and len(rows) == 12
