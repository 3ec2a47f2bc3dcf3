"""Physical-plan properties: pushdown, pruning, no cartesian products, partial aggregation."""

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_segment_filter_pushed_and_columns_pruned(spark):
    plan = _plan(E.queries()["p6_segment_filter"](spark, SF))
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in plan
    scan = [line for line in plan.splitlines() if "ReadSchema" in line][0]
    assert "l_comment" not in scan and "l_shipdate" not in scan and "l_linestatus" not in scan


def test_knn_join_has_no_cartesian_product(spark):
    plan = _plan(E.queries()["j4_knn_join"](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_kde_and_sweep_have_no_cartesian_product(spark):
    for name in ("a11_kde", "j3_grid_expand"):
        plan = _plan(E.queries()[name](spark, SF))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_describe_uses_partial_aggregation(spark):
    plan = _plan(E.queries()["a18_grouping_sets"](spark, SF))
    assert plan.count("HashAggregate") >= 2 and "Expand" in plan   # partial + final over grouping sets
