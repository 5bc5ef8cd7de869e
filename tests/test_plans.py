"""Plan-shape guards for every registered query of the event-log library (sf0.001 for speed)."""

import __spark_entry__ as entry
from flowlog.plans.registry import QUERIES

SMOKE = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "WindowGroupLimit SinglePartition")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cross_joins_or_python_udfs(spark):
    bad = {}
    for name, build in QUERIES.items():
        plan = _plan(build(spark, SMOKE))
        hits = [f for f in FORBIDDEN if f in plan]
        if hits:
            bad[name] = hits
    assert bad == {}


def test_filter_and_projection_reach_the_scan(spark):
    df = entry.queries()["el_case_filter"](spark, SMOKE)
    text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "EqualTo(l_returnflag,R)" in text
    # the hit-set scan reads only the join key and the filtered column
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>" in text


def _scans(df, column: str) -> int:
    """Scans of the optimized plan whose output has ``column``, subqueries' plans too."""
    plan = df._jdf.queryExecution().optimizedPlan().treeString()
    return sum("Relation [" in line and column in line for line in plan.splitlines())


def test_case_sequences_scan_the_log_once_without_hot_keys(spark):
    """The pass itself is one scan of ``events``; sampling for hot keys adds its own."""
    from flowlog.config import MiningConfig, SkewConfig
    from flowlog.operators.variants import case_sequences
    from flowlog.plans.sample_logs import session_log

    log = session_log(spark, SMOKE)
    assert _scans(case_sequences(log, MiningConfig(skew=SkewConfig(mode="off"))), "event_type") == 1
    assert _scans(case_sequences(log, MiningConfig()), "event_type") <= 2     # the sample, and the pass


def test_no_window_of_a_log_runs_in_one_task(spark):
    bad = []
    for name in ("mn_bottleneck", "cf_dfg", "cf_case_fitness", "el_case_duration", "sn_handover_source", "rs_forward_fill"):
        plan = _plan(entry.queries()[name](spark, SMOKE)).splitlines()
        for i, line in enumerate(plan):
            if "Window [" in line and any("SinglePartition" in x for x in plan[i + 1:i + 4]):
                bad.append(name)
    assert bad == []
