"""Activity analyses: sessions per week, DAU, retention, funnels, engagement.

The document-store pipelines of the reference build per-user and per-tier
arrays (``$push``) and filter them. Here every array is replaced by an
aggregate: sessions per week are counted, not listed; retention joins the
first use back instead of scanning a timestamp array; percentiles and
medians are found by selection (counting passes), so no tier or step is
sorted or gathered into one task. The only list kept is the per-user step list, whose length is
bounded by the number of distinct steps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortium.functions.numeric import safe_div, snap_bround, snap_round
from cohortium.functions.time import days_between, hours_between, week_key
from cohortium.operators.hotkeys import lookup_join
from cohortium.operators.scalars import attach_one_row
from cohortium.operators.selection import few_group_percentiles
from cohortium.session import ensure_checkpoint_dir

UNKNOWN_TIER = "unknown"
# Fixed values from the reference: engagement score caps and weights.
ENGAGEMENT_CAPS = dict(events=500, avg_duration_sec=7200, event_types=14, recency_days=90)
ENGAGEMENT_WEIGHTS = dict(events=30, avg_duration_sec=25, event_types=25, recency_days=20)
# Fixed value from the reference: the onboarding funnel, in order.
DEFAULT_FUNNEL = ["signup", "first_login", "workspace_created", "first_project", "invited_teammate"]


def with_tier(df: DataFrame, lookup: DataFrame) -> DataFrame:
    """``$lookup`` + first match + default 'unknown' (lookup is unique on customer_id)."""
    return df.join(lookup.select("customer_id", "plan_tier"), "customer_id", "left") \
        .withColumn("plan_tier", F.coalesce(F.col("plan_tier"), F.lit(UNKNOWN_TIER)))


def sessions_per_week_by_tier(activity: DataFrame, lookup: DataFrame, iso_year: bool = True) -> DataFrame:
    """Sessions (duration > 0) per customer-week → mean per customer → per tier
    mean/min/max, plus p25/p50/p75 of all session durations of the tier.

    Weeks without a session are not counted as 0 (as in the reference). Events
    without a customer or a time belong to no customer-week and are left out.
    Sessions are counted before the tier is attached, so that join sees one row
    per customer however many events a customer has. The durations themselves need
    the tier too: rows of a customer with many of them meet a broadcast copy of its
    one lookup row (:func:`lookup_join`). Cleaned sessions are kept once, narrow.
    """
    ensure_checkpoint_dir(activity.sparkSession)
    lookup = lookup.select("customer_id", "plan_tier").checkpoint()
    s = activity.where((F.coalesce(F.col("session_duration"), F.lit(0.0)) > 0)
                       & F.col("customer_id").isNotNull() & F.col("ts").isNotNull()) \
        .select("customer_id", week_key(F.col("ts"), iso_year).alias("year_week"), F.col("session_duration").alias("dur")).checkpoint()
    per_week = s.groupBy("customer_id", "year_week").agg(F.count(F.lit(1)).alias("n"))
    per_user = with_tier(per_week.groupBy("customer_id").agg(F.avg("n").alias("avg_w")), lookup)
    per_tier = per_user.groupBy("plan_tier").agg(
        F.count(F.lit(1)).alias("user_count"),
        snap_bround(F.avg("avg_w"), 2).alias("avg_sessions_per_user_per_week"),
        snap_bround(F.min("avg_w"), 2).alias("min_sessions_per_week"),
        snap_bround(F.max("avg_w"), 2).alias("max_sessions_per_week"))
    tiered = lookup_join(s.select("customer_id", "dur"), lookup, ["customer_id"], "left").fillna(UNKNOWN_TIER, ["plan_tier"])
    pct = few_group_percentiles(tiered, ["plan_tier"], "dur", {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    pct = pct.select("plan_tier", *[F.col(p).alias(f"{p}_session_duration_sec") for p in ("p25", "p50", "p75")])
    return per_tier.join(pct, "plan_tier", "left").orderBy("plan_tier")


def feature_dau(activity: DataFrame) -> DataFrame:
    """Distinct users per feature-day, then mean/max/min and number of active days."""
    a = activity.where(F.col("event_type").isNotNull() & F.col("customer_id").isNotNull() & F.col("ts").isNotNull())
    daily = a.groupBy("event_type", F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(
        F.count_distinct("customer_id").alias("dau"))
    return daily.groupBy(F.col("event_type").alias("feature")).agg(
        F.avg("dau").alias("avg_dau"), F.max("dau").alias("max_dau"), F.min("dau").alias("min_dau"),
        F.count(F.lit(1)).alias("total_days_with_activity")).orderBy(F.desc("avg_dau"), "feature")


def feature_retention(activity: DataFrame, days: int = 7) -> DataFrame:
    """Share of a feature's users with another use in (first use, first use + days].

    Events are first reduced to the earliest and latest time per (feature, user,
    day), so a hot user shrinks to one row per calendar day. For ``days`` >= 1 this
    is exact: on the first day any later event counts, and of every other day the
    earliest event decides.
    """
    if int(days) < 1:
        raise ValueError("days must be at least 1")
    a = activity.where(F.col("event_type").isNotNull() & F.col("customer_id").isNotNull() & F.col("ts").isNotNull())
    daily = a.groupBy("event_type", "customer_id", F.col("ts").cast("date").alias("day")).agg(
        F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    first = daily.groupBy("event_type", "customer_id").agg(F.min("lo").alias("first_use"))
    j = daily.join(first, ["event_type", "customer_id"])
    limit = F.col("first_use") + F.expr(f"INTERVAL {int(days)} DAYS")
    later = F.when(F.col("lo") == F.col("first_use"), F.col("hi") > F.col("first_use")).otherwise(F.col("lo") <= limit)
    per_user = j.groupBy("event_type", "customer_id").agg(F.max(later.cast("int")).alias("retained"))
    out = per_user.groupBy(F.col("event_type").alias("feature")).agg(
        F.count(F.lit(1)).alias("total_users"), F.sum("retained").cast("long").alias("retained_users"))
    return out.withColumn("retention_rate_pct",
                          snap_bround(safe_div(F.col("retained_users"), F.col("total_users")) * 100, 2)) \
        .orderBy(F.desc("retention_rate_pct"), "feature")


def funnel_step_counts(onboarding: DataFrame) -> DataFrame:
    """Per step: distinct users, first and last time (no step order implied)."""
    o = onboarding.where(F.col("step").isNotNull())
    return o.groupBy("step").agg(F.count_distinct("customer_id").alias("user_count"),
                                 F.min("ts").alias("earliest"), F.max("ts").alias("latest")) \
        .orderBy(F.desc("user_count"), "step")


def step_relation(spark: SparkSession, steps) -> DataFrame:
    """Inline (step, step_order) relation; its size is the parameter's length."""
    return spark.createDataFrame([(s, i + 1) for i, s in enumerate(steps)], "step string, step_order int")


def funnel_dropoff(onboarding: DataFrame, steps) -> DataFrame:
    """Users reaching each listed step and the drop-off from the previous step.

    As in the reference, a step counts without its predecessors. The lag
    runs over one row per listed step.
    """
    spark = onboarding.sparkSession
    users = onboarding.where(F.col("step").isin(*steps)).groupBy("step").agg(
        F.count_distinct("customer_id").alias("users"))
    f = step_relation(spark, steps).join(users, "step", "left") \
        .withColumn("users", F.coalesce(F.col("users"), F.lit(0)).cast("long"))
    f = f.withColumn("prev_users", F.lag("users").over(Window.orderBy("step_order")))
    conv = safe_div(F.col("users"), F.col("prev_users")) * 100
    return f.select("step_order", "step", "users", "prev_users",
                    snap_round(conv, 2).alias("conversion_pct"),
                    snap_round(F.lit(100.0) - conv, 2).alias("dropoff_pct")).orderBy("step_order")


def step_times(onboarding: DataFrame, steps) -> DataFrame:
    """One row per customer, first time of each listed step as a column (pivot by aggregate)."""
    known = onboarding.where(F.col("customer_id").isNotNull() & F.col("ts").isNotNull())
    return known.groupBy("customer_id").agg(*[
        F.min(F.when(F.col("step") == s, F.col("ts"))).alias(s) for s in steps])


def funnel_step_gaps(onboarding: DataFrame, steps) -> DataFrame:
    """Median hours between consecutive listed steps (negative gaps kept) and total users.

    Medians are exact (interpolated) and distributed: the gaps are unpivoted
    to (gap, hours) rows, and the median of each gap is selected by counting.
    """
    wide = step_times(onboarding, steps)
    names = [f"{a}_to_{b}_hrs" for a, b in zip(steps, steps[1:])]
    gaps = F.array(*[F.struct(F.lit(n).alias("gap"), hours_between(F.col(b), F.col(a)).alias("hrs"))
                     for n, (a, b) in zip(names, zip(steps, steps[1:]))])
    long = wide.select("customer_id", F.explode(gaps).alias("g")).select("customer_id", "g.gap", "g.hrs")
    med = few_group_percentiles(long, ["gap"], "hrs", {"p50": 0.5})
    one = med.agg(*[F.max(F.when(F.col("gap") == n, F.col("p50"))).alias(f"median_{n}") for n in names])
    total = onboarding.agg(F.count_distinct("customer_id").alias("total_customers"))
    return attach_one_row(one, total)


def user_step_lists(onboarding: DataFrame) -> DataFrame:
    """Per customer, the steps in order of their first time, as 'step@time>…'.

    Reduced to (customer, step, first time) before listing, so a list is at
    most as long as the number of distinct steps.
    """
    firsts = onboarding.where(F.col("step").isNotNull() & F.col("customer_id").isNotNull() & F.col("ts").isNotNull()).groupBy("customer_id", "step").agg(F.min("ts").alias("t"))
    lists = firsts.groupBy("customer_id").agg(F.array_sort(F.collect_list(F.struct("t", "step"))).alias("steps"))
    rendered = F.transform("steps", lambda x: F.concat(x["step"], F.lit("@"),
                                                      F.date_format(x["t"], "yyyy-MM-dd HH:mm:ss.SSSSSS")))
    return lists.select("customer_id", F.array_join(rendered, ">").alias("step_path"),
                        F.size("steps").alias("n_steps"))


def customer_activity_metrics(activity: DataFrame) -> DataFrame:
    """Per-customer metrics of the engagement score (document-store population)."""
    dur = F.coalesce(F.col("session_duration"), F.lit(0.0))
    return activity.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_distinct("event_type").alias("event_type_count"),
        F.avg(dur).alias("avg_session_duration"),
        F.max(dur).alias("max_session_duration"),
        F.max("ts").alias("last_activity"),
        F.min("ts").alias("first_activity"),
        F.count_if(dur > 0).alias("total_sessions"))


def top_engaged_users(activity: DataFrame, lookup: DataFrame, tier: str, as_of=None, k: int = 20,
                      caps=ENGAGEMENT_CAPS, weights=ENGAGEMENT_WEIGHTS) -> DataFrame:
    """Top-k customers of one tier by a 0-100 engagement score.

    Events are aggregated per customer first (map-side partial), then joined to
    the tier's customers one row each, so a hot customer never meets the join;
    ``as_of`` defaults to the latest event time. Events without a customer are
    left out; a customer without any event time has no recency term. The
    recency term is clamped to [0, 1] on both sides (activity after
    ``as_of`` does not push the score above 100).
    """
    as_of_c = activity.select(F.max("ts")).scalar() if as_of is None else F.lit(as_of).cast("timestamp_ntz")
    members = lookup.where(F.col("plan_tier") == tier).select("customer_id", "plan_tier")
    m = customer_activity_metrics(activity.where(F.col("customer_id").isNotNull())).join(members, "customer_id")
    days = F.coalesce(days_between(as_of_c, F.col("last_activity")), F.lit(float(caps["recency_days"])))
    score = (
        F.least(F.col("total_events") / caps["events"], F.lit(1.0)) * weights["events"]
        + F.least(F.col("avg_session_duration") / caps["avg_duration_sec"], F.lit(1.0)) * weights["avg_duration_sec"]
        + F.least(F.col("event_type_count") / caps["event_types"], F.lit(1.0)) * weights["event_types"]
        + F.least(F.greatest(F.lit(1.0) - F.least(days, F.lit(float(caps["recency_days"]))) / caps["recency_days"],
                             F.lit(0.0)), F.lit(1.0)) * weights["recency_days"])
    out = m.select("customer_id", "plan_tier", snap_bround(score, 2).alias("engagement_score"),
                   "total_events", "total_sessions", "event_type_count",
                   snap_bround(F.col("avg_session_duration"), 1).alias("avg_session_duration_sec"),
                   snap_bround(days, 0).alias("days_since_last_activity"))
    return out.orderBy(F.desc("engagement_score"), "customer_id").limit(k)


def engagement_by_customer(activity_clean: DataFrame, customers: DataFrame | None = None) -> DataFrame:
    """Seven per-customer metrics of the cleaned activity (durations already NULL → 0).

    With ``customers`` the activity may still hold unknown ids: it is aggregated
    first and the known customers are kept afterwards, one row each, because a
    semi-join before the aggregate would bring a hot customer's events into one task.
    """
    out = activity_clean.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_if(F.col("session_duration") > 0).alias("total_sessions"),
        F.avg("session_duration").alias("avg_session_duration"),
        F.count_distinct("event_type").alias("distinct_features"),
        F.max("ts").alias("last_activity"),
        F.min("ts").alias("first_activity"),
        F.sum("session_duration").alias("total_session_time"))
    return out if customers is None else out.join(customers.select("customer_id"), "customer_id", "left_semi")


def nps_by_customer(nps_clean: DataFrame) -> DataFrame:
    """Mean, count and latest score per customer; 'latest' = greatest (ts, response id)."""
    return nps_clean.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.avg("nps_score").alias("avg_nps_mongo"),
        F.count("nps_score").alias("nps_count"),
        F.max_by("nps_score", F.struct("ts", "response_id")).alias("latest_nps"))


def onboarding_depth(onboarding_clean: DataFrame) -> DataFrame:
    """Distinct onboarding steps per customer (NULL step not counted)."""
    return onboarding_clean.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.count_distinct("step").alias("onboarding_steps_completed"))
