"""The operators' queries against their SQL on another engine, over the whole smallest tables."""

import os

import pytest

import __spark_entry__ as entry_module
from tests.oracle_check import differences, oracle_connection
from tillwise.llm.oracles import ORACLES
from tillwise.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def test_all_are_offered():
    assert set(QUERIES) | {"pipeline"} <= set(entry_module.queries()) and set(ORACLES) <= set(entry_module.oracle_sql())
    assert {int(name[2:].split("_")[0]) for name in QUERIES} == set(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    got = QUERIES[name](spark, FOLDER).toPandas()
    assert differences(got, oracle_connection(FOLDER).execute(ORACLES[name]).df()) == []
