"""Scale properties checked on the physical plans."""

from __future__ import annotations

import os
import re

import pytest

from perkline.config import DEFAULT_RUN
from perkline.plans.model import BenefitModel

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not available")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_window_filter_reaches_the_parquet_scan(spark):
    m = BenefitModel(spark, SF, DEFAULT_RUN)
    plan = _plan(m.activity_counts)
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", plan)
    assert any("GreaterThanOrEqual(ts" in p and "LessThan(ts" in p for p in pushed), pushed


def test_dedup_combines_map_side_before_the_shuffle(spark):
    m = BenefitModel(spark, SF, DEFAULT_RUN)
    plan = m.bi_activity._jdf.queryExecution().executedPlan().toString()
    # a final aggregate above an exchange above a partial aggregate
    assert re.search(r"Aggregate\(.*\n(.*\n)*?.*Exchange hashpartitioning\(.*\n(.*\n)*?.*Aggregate\(", plan), plan


def test_parameter_values_are_one_reused_subquery(spark):
    m = BenefitModel(spark, SF, DEFAULT_RUN)
    df = m.kpi_extra_days()
    df.collect()
    plan = _plan(df)
    assert "ReusedSubquery" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
