"""Plans as they are at scale: no nested-loop or cartesian joins anywhere."""

import re

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from dssforge.plans.explain import plan_text

PLANNED = sorted(k for k in entry.queries() if re.match(r"q\d\d", k) or k.startswith(("pk_", "fk_", "rule_", "w_")))


@pytest.mark.parametrize("name", PLANNED)
def test_no_nested_loop_or_cartesian_join_at_scale(spark, name):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # nothing but hinted dimensions broadcast
    try:
        plan = plan_text(entry.queries()[name](spark, SF_SMALL), "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan, plan
