from __future__ import annotations

import pytest

import __spark_entry__ as driver
from basketflow.plans.oracles import ORACLES as SQL
from basketflow.plans.queries import REGISTRY as QUERIES
from tests.compare import oracle, oracle_rows, spark_rows

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return oracle(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, connection, name):
    names, rows = spark_rows(QUERIES[name](spark, SF_DIR))
    expected_names, expected = oracle_rows(connection, SQL[name])
    assert names == expected_names
    assert rows == expected
    assert rows


def test_entry(spark):
    flagged = driver.entry(spark)
    assert flagged.count() == 554
    assert flagged.where("flag = 'High_Discount'").count() == 347
