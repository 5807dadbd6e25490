"""NULL keys, exact ids, hot keys and the checkpoint folder."""

import datetime as dt
import types

import pytest
from pyspark.sql import functions as F

from cohortium import session
from cohortium.functions.ids import to_customer_id
from cohortium.operators.hotkeys import lookup_join
from cohortium.plans import activity as A
from cohortium.plans import cleaning as C

ACT = "event_id long, customer_id long, ts timestamp_ntz, event_type string, session_duration double"


def at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def activity(spark):
    return spark.createDataFrame([
        (1, 1, at(1), "a", 10.0), (2, 1, at(1, 5), "a", 20.0), (3, None, at(2), "a", 30.0), (4, 1, None, "a", 40.0),
        (5, 2, at(3), "b", 50.0), (6, None, None, "b", 60.0)], ACT)


def test_null_keys_form_no_group(spark):
    a = activity(spark)
    lookup = spark.createDataFrame([(1, "pro")], "customer_id long, plan_tier string")
    weeks = {r.plan_tier: r for r in A.sessions_per_week_by_tier(a, lookup).collect()}
    assert {t: r.user_count for t, r in weeks.items()} == {"pro": 1, "unknown": 1}
    assert weeks["pro"].avg_sessions_per_user_per_week == 2.0 and weeks["unknown"].p50_session_duration_sec == 50.0
    dau = {r.feature: r for r in A.feature_dau(a).collect()}
    assert dau["a"].total_days_with_activity == 1 and dau["a"].max_dau == 1
    assert {r.feature: r.total_users for r in A.feature_retention(a).collect()} == {"a": 1, "b": 1}
    top = A.top_engaged_users(a, lookup, "pro").collect()
    assert [r.customer_id for r in top] == [1] and top[0].total_events == 3


def test_null_customers_have_no_funnel(spark):
    o = spark.createDataFrame([(1, "s", at(1)), (1, "t", at(1, 2)), (None, "s", at(1)), (None, "t", at(3)), (2, "s", None)],
                              "customer_id long, step string, ts timestamp_ntz")
    gaps = A.funnel_step_gaps(o, ["s", "t"]).first()
    assert gaps.median_s_to_t_hrs == 2.0
    assert [r.customer_id for r in A.user_step_lists(o).collect()] == [1]


@pytest.mark.parametrize("days", [1, 7])
def test_retention_by_days_is_exact(spark, days):
    import random

    rnd = random.Random(days)
    rows = [(i, rnd.randint(1, 6), dt.datetime(2024, 1, 1) + dt.timedelta(hours=rnd.choice([0, 1, 24, 25, 24 * days, 24 * days + 1, 300])), "f", 1.0)
            for i in range(25)]
    got = A.feature_retention(spark.createDataFrame(rows, ACT), days=days).first()
    times = {}
    for _, u, t, *_ in rows:
        times.setdefault(u, []).append(t)
    kept = sum(any(min(v) < t <= min(v) + dt.timedelta(days=days) for t in v) for v in times.values())
    assert (got.total_users, got.retained_users) == (len(times), kept)


def test_ids_are_exact(spark):
    texts = ["9007199254740993", "9223372036854775807", "-5", " 12 ", "12.0", "1.2e1", "12.5", "9007199254740994.0", "1e300", "x", "", None, "NaN"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.id for r in df.select("i", to_customer_id(F.col("t")).alias("id")).orderBy("i").collect()]
    assert got == [9007199254740993, 9223372036854775807, -5, 12, 12, 12, None, None, None, None, None, None, None]


def test_feature_stands_in_for_the_event_type(spark):
    docs = spark.createDataFrame([("1", "2024-01-01", "export")], "customer_id string, timestamp string, feature string")
    assert C.prepared_activity(docs).first().event_type == "export"
    assert C.prepared_activity(docs.drop("feature")).first().event_type is None


def test_default_time_and_flagged_customers(spark):
    docs = spark.createDataFrame([("1", None, "x"), ("2", "junk", "x")], "customer_id string, timestamp string, event_type string")
    got = {r.customer_id: r.ts for r in C.prepared_activity(docs, default_ts="2024-01-01 00:00:00").collect()}
    assert got == {1: at(1), 2: None}
    cust = spark.createDataFrame([(1202, " a ", "x"), (None, "b", "y")], "customer_id long, company_name string, country_name string")
    assert C.clean_customers(cust).count() == 2 and C.clean_customers(cust, dedupe_customers=True).count() == 1


def test_a_hot_customer_meets_no_join(spark):
    """Half the events on one customer, no broadcast: every join above sees aggregated rows."""
    n = 4000
    a = spark.range(n).select(F.col("id").alias("event_id"), F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).alias("customer_id"),
                              F.expr("timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, int(id % 20))").alias("ts"),
                              F.lit("f").alias("event_type"), F.lit(1.0).alias("session_duration"))
    lookup = a.select("customer_id", F.lit("pro").alias("plan_tier")).distinct()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for out in (A.engagement_by_customer(a, lookup), A.feature_retention(a), A.top_engaged_users(a, lookup, "pro")):
            tree = out._jdf.queryExecution().optimizedPlan()
            joins = [line for line in tree.toString().split("\n") if "Join" in line]
            assert joins
            stack = [tree]
            while stack:
                node = stack.pop()
                kids = [node.children().apply(i) for i in range(node.children().size())]
                if node.nodeName() == "Join":
                    # an aggregate lies between the events and each side of the join
                    assert all("Aggregate" in k.toString() for k in kids)
                stack += kids
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert A.engagement_by_customer(a, lookup).where("customer_id = 1").first().total_events == n // 2 + 1


def test_a_cluster_needs_a_shared_folder():
    conf = types.SimpleNamespace(get=lambda *a: None)
    sc = types.SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master="yarn")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(types.SimpleNamespace(sparkContext=sc, conf=conf))


def test_durations_of_a_hot_customer_are_not_shuffled(spark):
    """Half of the sessions on one customer, no broadcast by size: percentiles are right, and its rows stay spread."""
    n = 3000
    a = spark.range(n).select(F.col("id").alias("event_id"), F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).alias("customer_id"),
                              F.expr("timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, int(id % 20))").alias("ts"),
                              F.lit("f").alias("event_type"), (F.col("id") + 1.0).alias("session_duration"))
    lookup = spark.createDataFrame([(1, "pro"), (3, "free")], "customer_id long, plan_tier string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = {r.plan_tier: r for r in A.sessions_per_week_by_tier(a, lookup).collect()}
        hot = lookup_join(a.select("customer_id", "session_duration"), lookup, ["customer_id"], "left").where("customer_id = 1")
        per_task = [r["count"] for r in hot.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    pro = sorted([i + 1.0 for i in range(0, n, 2)] + [2.0])
    assert got["pro"].p50_session_duration_sec == pro[len(pro) // 2] and got["free"].p50_session_duration_sec == 4.0
    assert got["unknown"].user_count == n // 2 - 2
    assert sum(per_task) == n // 2 + 1 and max(per_task) < n // 4
