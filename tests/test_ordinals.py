"""The distributed ordinals must equal the window functions they replace."""

import random

import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from cohortium.operators.ordinals import Key, group_percentiles, lag_within_groups, within_group_ordinals


def _skewed(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        g = "hot" if rnd.random() < 0.5 else rnd.choice(["a", "b", "c", None])
        v = rnd.choice([0.0, 0.0, 0.0, 1.5, None, float(rnd.randint(0, 40))])
        rows.append((i, g, v))
    return spark.createDataFrame(rows, "id long, g string, v double")


def test_rank_and_row_number_match_window(spark):
    df = _skewed(spark)
    for parts in (1, 3, 7, 16):
        got = within_group_ordinals(df, ["g"], [Key("v", ascending=False, nulls_first=True)], ["id"],
                                    num_partitions=parts)
        w = Window.partitionBy("g").orderBy(F.col("v").desc_nulls_first(), F.col("id"))
        wr = Window.partitionBy("g").orderBy(F.col("v").desc_nulls_first())
        exp = df.withColumn("rn_e", F.row_number().over(w)).withColumn("rk_e", F.rank().over(wr))
        bad = got.join(exp, "id").where("rn <> rn_e or rk <> rk_e").count()
        assert bad == 0, parts
        assert got.count() == df.count()


def test_global_ordinals_without_groups(spark):
    df = _skewed(spark, 500)
    got = within_group_ordinals(df, [], [Key("v")], ["id"], num_partitions=5)
    exp = df.withColumn("rn_e", F.row_number().over(Window.orderBy(F.col("v").asc_nulls_first(), "id")))
    assert got.join(exp, "id").where("rn <> rn_e").count() == 0


def test_lag_matches_window(spark):
    df = _skewed(spark, 800)
    got = lag_within_groups(df, ["g"], [Key("v", nulls_first=False)], ["id"], ["id", "v"])
    w = Window.partitionBy("g").orderBy(F.col("v").asc_nulls_last(), "id")
    exp = df.withColumn("pid_e", F.lag("id").over(w))
    bad = got.join(exp.select("id", "pid_e"), "id").where("not (prev_id <=> pid_e)").count()
    assert bad == 0


def test_percentiles_match_builtin(spark):
    df = _skewed(spark, 2000)
    got = group_percentiles(df, ["g"], "v", {"p25": 0.25, "p50": 0.5, "p75": 0.75}, ["id"])
    exp = df.groupBy("g").agg(F.percentile("v", 0.25).alias("e25"), F.percentile("v", 0.5).alias("e50"),
                              F.percentile("v", 0.75).alias("e75"))
    j = got.join(exp, got.g.eqNullSafe(exp.g))
    rows = j.collect()
    assert len(rows) == exp.where("e50 is not null").count()
    for r in rows:
        assert abs(r.p25 - r.e25) < 1e-9 and abs(r.p50 - r.e50) < 1e-9 and abs(r.p75 - r.e75) < 1e-9


def test_hot_group_is_spread_over_many_tasks(spark):
    """Half the rows share one group; its numbering runs in several tasks, not one."""
    df = _skewed(spark, 4000)
    got = within_group_ordinals(df, ["g"], [Key("v")], ["id"], num_partitions=8)
    per_task = got.where(F.col("g") == "hot").groupBy(F.spark_partition_id().alias("p")).count().collect()
    n_hot = df.where(F.col("g") == "hot").count()
    assert len(per_task) >= 3
    assert max(r["count"] for r in per_task) < 0.6 * n_hot
    # and the numbers still run 1..n without gaps across the tasks
    rn = got.where(F.col("g") == "hot").agg(F.min("rn"), F.max("rn"), F.count_distinct("rn")).first()
    assert tuple(rn) == (1, n_hot, n_hot)


def _expected(df):
    w = Window.partitionBy("g").orderBy(F.col("v").asc_nulls_first(), F.col("id"))
    wr = Window.partitionBy("g").orderBy(F.col("v").asc_nulls_first())
    return df.select("id", F.row_number().over(w).alias("rn_e"), F.rank().over(wr).alias("rk_e"),
                     F.lag("id").over(w).alias("prev_e"))


SETTINGS = [{}, {"spark.sql.exchange.reuse": "false"}, {"spark.sql.adaptive.enabled": "false"}]


@pytest.mark.parametrize("conf", SETTINGS, ids=["default", "no-reuse", "no-aqe"])
@pytest.mark.parametrize("parts", [3, 11])
def test_numbers_hold_whatever_stands_above(spark, conf, parts):
    """coalesce, union and changed settings may not disturb the stored numbers."""
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = _skewed(spark, 2000)
        exp = _expected(df)
        num = within_group_ordinals(df, ["g"], [Key("v")], ["id"], num_partitions=parts)
        lag = lag_within_groups(df, ["g"], [Key("v")], ["id"], ["id"], num_partitions=parts)
        for shape in (lambda x: x, lambda x: x.coalesce(1), lambda x: x.coalesce(2), lambda x: x.limit(0).unionByName(x),
                      lambda x: x.repartition(4).unionByName(x.limit(0))):
            bad = shape(num).join(exp, "id").where("rn <> rn_e or rk <> rk_e").count()
            assert bad == 0 and shape(num).count() == 2000
            assert shape(lag).join(exp, "id").where("not (prev_id <=> prev_e)").count() == 0
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_lag_needs_no_join_of_rows(spark):
    df = _skewed(spark, 500)
    plan = lag_within_groups(df, ["g"], [Key("v")], ["id"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan and "BroadcastHashJoin" in plan


def test_exact_large_integers_and_no_rows(spark):
    """Lagged 64-bit integers stay exact beside NULLs; an empty frame gives no rows."""
    big = 9007199254740993
    df = spark.createDataFrame([(1, "a", big), (2, "a", None), (3, "a", big + 2)], "id long, g string, v long")
    got = {r.id: r.prev_v for r in lag_within_groups(df, ["g"], [Key("id")], [], ["v"]).collect()}
    assert got == {1: None, 2: big, 3: None}
    assert within_group_ordinals(df.limit(0), ["g"], [Key("v")], ["id"]).count() == 0
    assert group_percentiles(df.limit(0), ["g"], "v", {"m": 0.5}, ["id"]).count() == 0


def test_positions_of_few_groups_are_broadcast(spark):
    df = _skewed(spark, 500)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = group_percentiles(df, ["g"], "v", {"m": 0.5}, ["id"], few_groups=True)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan
