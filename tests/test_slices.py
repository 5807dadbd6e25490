"""Slicer cubes against the plain KPI cards of each slice."""

import random

from pyspark.sql import functions as F

from cohortium.plans import marts as M
from cohortium.plans import slices as L


def master(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.choice(["free", "pro", None]), rnd.choice(["A", "B", None]), rnd.randrange(3), rnd.randrange(2), rnd.choice([10.0, 2.5, None]),
             rnd.choice(["price", "quality", None])) for i in range(200)]
    return spark.createDataFrame(rows, "customer_id long, plan_tier string, segment_name string, segment int, is_churned int, total_ltv double, churn_reason string")


def test_every_slice_equals_its_cards(spark):
    m = master(spark)
    cube = {(r.grouping_id, r.plan_tier, r.segment_name): tuple(r)[3:] for r in L.kpi_cube(L.kpi_cells(m)).collect()}
    assert len(cube) == 9 + 3 + 3 + 1
    for (gid, tier, name), cards in cube.items():
        part = m
        if not gid & 2:
            part = part.where(F.col("plan_tier").eqNullSafe(F.lit(tier)))
        if not gid & 1:
            part = part.where(F.col("segment_name").eqNullSafe(F.lit(name)))
        assert tuple(M.kpi_cards(part).first()) == cards


def test_several_chosen_values_are_merged(spark):
    m = master(spark)
    got = L.kpi_choice(L.kpi_cells(m), ["free", "pro"], ["B"]).first()
    assert tuple(got) == tuple(M.kpi_cards(m.where("plan_tier IN ('free', 'pro') AND segment_name = 'B'")).first())
    assert tuple(L.kpi_choice(L.kpi_cells(m)).first()) == tuple(M.kpi_cards(m).first())
    none = L.kpi_choice(L.kpi_cells(m), ["absent"]).first()
    assert none.total_customers == 0 and none.churn_rate_pct is None and none.segment_count == 0


def test_reasons_are_ranked_inside_a_slice(spark):
    m = master(spark)
    got = L.churn_reason_cube(m).collect()
    for r in (x for x in got if x.grouping_id == 1):
        want = M.mart_churn_reasons(m.where(F.col("plan_tier").eqNullSafe(F.lit(r.plan_tier)))).collect()
        assert (r.churn_reason, r["count"]) == tuple(want[r.reason_rank - 1])[:2]
    assert sorted(r.reason_rank for r in got if r.grouping_id == 3) == [1, 2]


def test_customers_are_read_once(spark):
    plan = L.kpi_cube(L.kpi_cells(master(spark)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ExistingRDD") == 1 or plan.count("LocalTableScan") == 1
