"""Operator queries against independent DuckDB SQL on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..", "tools"))

from check_oracle import duck, rows_of  # noqa: E402

from llm.queries import ORACLE, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, con, name):
    got, want = rows_of(QUERIES[name](spark, SF).toPandas()), rows_of(con.execute(ORACLE[name]).df())
    assert got[0] == want[0]
    assert got[1] == want[1]
