"""Plan-shape guards for scale: no registered query plans a cartesian
product or a nested-loop join, and the snapshot scans read only the
columns they use."""

import pytest

import __spark_entry__ as E
from attrix.plans import catalog

catalog.load_all()

SF = "/root/testdata/sf0.001"
TRAINING = {"train_lr", "train_rf", "train_gbt", "search", "train_all", "tree_importance", "shap_linear", "top_shap",
            "shap_tree", "explain_all", "score", "score_stream", "sink_model", "src_model"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - TRAINING))
def test_no_cartesian_or_nested_loop(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_snapshot_scans_are_pruned(spark):
    from attrix.sources.snapshot import customer_snapshot

    plan = customer_snapshot(spark, SF)._jdf.queryExecution().executedPlan().toString()
    # lineitem: only the three columns the snapshot needs
    assert "l_orderkey:bigint,l_returnflag:string,l_linestatus:string>" in plan
    assert "l_extendedprice" not in plan and "l_shipdate" not in plan
    assert "p_partkey" not in plan and "s_suppkey" not in plan
