"""Plan properties that matter at scale."""

import re

from conftest import MEDIUM
from ledgerline.catalog import QUERIES


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString() + df._jdf.queryExecution().optimizedPlan().toString()


def _explain(spark, name):
    df = QUERIES[name](spark, MEDIUM)
    return _plan(df)


def test_no_python_udf_anywhere(spark):
    for name in QUERIES:
        if name in ("load_raw", "row_counts", "export_marts"):
            continue
        plan = _explain(spark, name)
        assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_one_pass_metrics_scan_the_fact_once(spark):
    for name in ("pipeline_velocity", "engaging_branch_rates", "win_rate_overall"):
        df = QUERIES[name](spark, MEDIUM)
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert len(re.findall(r"Relation \[o_orderkey", plan)) == 1, name


def test_global_ranks_avoid_single_partition(spark):
    """RANK / NTILE are computed from range partitions, not by a rank/ntile
    window: every window left is keyed by the range partition (``__pid``),
    either partitioned by it (groups no larger than a range partition) or
    running over the one-row-per-partition summaries."""
    for name in ("churn_by_size_quartile", "agent_scorecard", "agent_quarter_rank"):
        df = QUERIES[name](spark, MEDIUM)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"\b(rank|ntile|row_number)\(", plan), name
        for line in plan.splitlines():
            if re.search(r"\bWindow \[", line):
                assert "__pid" in line or "sum(__n" in line, (name, line)


def test_unused_lookups_are_pruned(spark):
    plan = QUERIES["win_rate_overall"](spark, MEDIUM)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan and "s_suppkey" not in plan and "p_partkey" not in plan
