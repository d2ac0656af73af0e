"""Every registered query against its DuckDB twin on the smallest driver
tables (row count, column names, order-insensitive value hash)."""

from __future__ import annotations

import os

import pytest

from perkline.queries import QUERIES, TWINS, load_all
from tools.parity import digest, duck

SF = "/root/testdata/sf0.001"

load_all()
KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip("driver tables not available")
    return duck(SF)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(TWINS)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_twin(spark, con, key):
    sdf = QUERIES[key](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    res = con.execute(TWINS[key])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(sdf.columns, srows)[0] == digest(dcols, drows)[0]
    # no query may pair every row with every row
    plan = sdf._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
