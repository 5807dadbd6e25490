"""Physical-plan checks: no cartesian products, no tier-wide window sorts, pushdown."""

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_no_cartesian_or_nested_loop(spark):
    for key in ("active_by_month", "churn_rate_rolling", "downgrades_after_tickets", "duplicate_candidates",
                "name_prefix_signals", "team_domain_overlap", "feature_retention", "plan_scorecard",
                "quality_report_activity", "funnel_step_gaps", "churn_contingency", "segment_features",
                "mart_customer_master", "kpi_cards", "customer_360", "ltv_rank_by_tier"):
        p = _plan(E.queries()[key](spark, SF))
        assert "CartesianProduct" not in p, key
        assert "BroadcastNestedLoopJoin" not in p, key


def test_rank_has_no_tier_window(spark):
    df = E.queries()["ltv_rank_by_tier"](spark, SF)
    opt = _optimized(df)
    assert "Window [rank(" not in opt
    assert "RepartitionByExpression" in opt or "RebalancePartitions" in opt or "Sort" in opt


def test_scan_prunes_columns_and_pushes_filters(spark):
    df = E.queries()["ticket_summary"](spark, SF)
    p = _plan(df)
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double," in p
