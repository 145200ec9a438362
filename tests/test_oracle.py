"""Every registered query against its DuckDB oracle on the smallest test scale."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_oracle import duck, rows_of  # noqa: E402

from salescast.plans import catalog  # noqa: E402, F401
from salescast.plans.registry import ORACLE as SQL  # noqa: E402
from salescast.plans.registry import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF).toPandas()
    want = con.execute(SQL[name]).df()
    gc, gr = rows_of(got)
    wc, wr = rows_of(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


def test_every_query_has_docstring_and_runs_lazily(spark):
    for name, fn in QUERIES.items():
        assert fn.__doc__ or name in SQL, name
