"""Every registered query of the subpackage runs; those with SQL equal it."""

from __future__ import annotations

import pytest

import corpus_pipeline
from basketflow.llm.oracles import SQL
from basketflow.llm.queries import QUERIES
from tests.compare import oracle, oracle_rows, spark_rows

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    names, rows = spark_rows(QUERIES[name](spark, SF_DIR))
    expected_names, expected = oracle_rows(oracle(SF_DIR), SQL[name])
    assert names == expected_names
    assert rows == expected
    assert rows


def test_a_query_for_each_operator():
    numbers = [int(name.split("_")[0].removeprefix("op")) for name in QUERIES]
    assert sorted(numbers) == list(range(1, 14))
    assert set(SQL) <= set(QUERIES)
    assert len(corpus_pipeline.STAGES) == 5
