"""Plan guards of the training-data queries, on tables of more than one block."""

import pytest

from flowlog.llm import queries

SF = "/root/testdata/sf0.01"
NATIVE = ("op2_url_filter", "op4_exact_dedup", "op13_quality_rules")
CROSS = ("CartesianProduct", "BroadcastNestedLoopJoin")
PYTHON = ("BatchEvalPython", "ArrowEvalPython", "MapInArrow", "MapInPandas", "FlatMapGroupsIn", "FlatMapCoGroupsIn")


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_no_cross_joins_and_no_python_rows(spark, name):
    plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in (*CROSS, "BatchEvalPython") if x in plan]
    if name in NATIVE:
        assert not [x for x in PYTHON if x in plan]
