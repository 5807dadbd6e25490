"""Percentiles by selection against sorted lists; joins with hot keys against plain joins."""

import math
import random

import pytest
from pyspark.sql import functions as F

from cohortium.operators import hotkeys as H
from cohortium.operators import selection as S


def plain(values, p):
    v = sorted(values, key=lambda x: (math.isnan(x), x))
    pos = p * (len(v) - 1)
    lo, hi = v[math.floor(pos)], v[math.ceil(pos)]
    return lo if lo == hi or pos == math.floor(pos) else lo + (pos - math.floor(pos)) * (hi - lo)


def check(spark, data, small):
    df = spark.createDataFrame([(g, v) for g, vs in data.items() for v in [*vs, None]], "g string, v double").repartition(5)
    probs = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p90": 0.9, "p100": 1.0}
    got = {r.g: r for r in S.few_group_percentiles(df, ["g"], "v", probs, small=small).collect()}
    assert set(got) == {g for g, vs in data.items() if vs}
    for g, vs in data.items():
        for name, p in probs.items() if vs else ():
            a, b = got[g][name], plain(vs, p)
            assert a == b or (math.isnan(a) and math.isnan(b)) or abs(a - b) <= 1e-12 * abs(b), (g, name)


@pytest.mark.parametrize("small", [1, 50])
def test_equals_sorted_lists(spark, small):
    """Duplicates, one value only, infinities, NaN, tiny and huge numbers, a NULL group."""
    rnd = random.Random(1)
    check(spark, {
        "spread": [rnd.random() for _ in range(997)], "ties": [float(rnd.randrange(4)) for _ in range(500)], "one": [3.5], "same": [2.0] * 300,
        "two": [1.0, 2.0], "wide": [math.exp(rnd.uniform(-700, 700)) * rnd.choice([-1, 1]) for _ in range(400)], "none": [],
        "ends": [-math.inf] * 40 + [rnd.gauss(0, 1) for _ in range(50)] + [math.inf] * 40, "nan": [math.nan] * 30 + [1.0, 2.0, 5.0], "all nan": [math.nan] * 3,
        None: [float(i) for i in range(200)], "half hot": [7.0] * 400 + [rnd.uniform(6.999, 7.001) for _ in range(400)]}, small)


def test_large_brackets_are_narrowed(spark):
    """60,000 values: a few rounds, and only brackets of at most ``small`` rows are sorted."""
    df = spark.range(60_000).select((F.hash("id") % 10_007 / 7.0).alias("v"))
    want = df.selectExpr("percentile(v, array(0.1, 0.5, 0.999)) AS p").first().p
    got = S.few_group_percentiles(df, [], "v", {"a": 0.1, "b": 0.5, "c": 0.999}, small=20).first()
    assert [got.a, got.b, got.c] == pytest.approx(want, abs=1e-9)


def test_sketch_that_is_off_does_no_harm():
    r = S.Rank(("g",), 500, 1000)
    r.settle(10.0, 20.0, 600, 1, 10, 1)  # both cuts above the rank
    assert (r.low, r.high, r.inside, r.before, r.value) == (None, 10.0, 600, 0, None)
    r.settle(1.0, 2.0, 10, 20, 30, 40)  # both below
    assert (r.low, r.high, r.inside, r.before, r.value) == (2.0, 10.0, 500, 100, None)
    r.settle(3.0, 4.0, 390, 5, 50, 5)
    assert (r.low, r.high, r.inside, r.before) == (3.0, 4.0, 50, 495)
    r.settle(3.5, 3.6, 4, 1, 0, 0)
    assert r.value == 3.5


def test_no_sort_and_no_python_in_the_plan(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("g"), F.rand(1).alias("v"))
    values = df.select(F.col("g").alias("_v0"), F.col("v").alias("_v"))
    plan = S._met(values, [df.schema["g"]], [S.Rank((0,), 5, 100)]).groupBy("_t").agg(F.count("*"))._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "MapInArrow" not in plan and "SortMergeJoin" not in plan and "NestedLoop" not in plan
    with pytest.raises(ValueError):
        old, S.MAX_GROUPS = S.MAX_GROUPS, 2
        try:
            S.few_group_percentiles(df, ["g"], "v", {"m": 0.5})
        finally:
            S.MAX_GROUPS = old


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_join_equals_plain_join(spark, how):
    rows = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 400).alias("k"))
    lookup = spark.range(0, 400, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("x")).unionByName(spark.createDataFrame([(1, -1)], "k long, x long"))
    got, want = H.lookup_join(rows, lookup, ["k"], how), rows.join(lookup, "k", how)
    assert got.columns == want.columns or set(got.columns) == set(want.columns)
    assert got.select(*want.columns).exceptAll(want).count() == 0 and got.count() == want.count()
    assert H.lookup_join(rows.limit(0), lookup, ["k"], how).count() == 0


def test_rows_of_a_heavy_key_are_not_shuffled(spark):
    rows = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"))
    assert [r.k for r in H.heavy_keys(rows, ["k"]).collect()] == [1]
    lookup = rows.groupBy("k").agg(F.count("*").alias("n"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = H.lookup_join(rows, lookup, ["k"])
        per_task = out.where("k = 1").groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(per_task) >= 2 and sum(r["count"] for r in per_task) == 1001
