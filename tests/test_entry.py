"""Driver contract of __spark_entry__.py."""

from __future__ import annotations

import importlib.util
import os

import pytest

ENTRY = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")


@pytest.fixture(scope="module")
def entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", ENTRY)
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_contract(spark, entry_module):
    if not os.path.isdir(entry_module.SMOKE_DIR):
        pytest.skip("driver tables not available")
    df = entry_module.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0]["periode_debut"] is not None
    q, o = entry_module.queries(), entry_module.oracle_sql()
    own = {k for k in q if k != "pipeline" and not k.startswith("op")}
    assert own <= set(o) <= set(q) and len(own) >= 100
    for sql in o.values():
        assert sql.lstrip().upper().startswith(("WITH", "SELECT"))
