"""Registered activity, funnel and per-customer engagement queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortium.catalog import register, sbround, sdiv, sround
from cohortium.entries.cleaning import (ACT_NORM, CLEAN_ACTIVITY_CTES, CLEAN_NPS_CTES, CLEAN_ONB_CTES, PREPARED_CTE,
                                         RAW_ONB_CTES)
from cohortium.entries.rounding import snap6, snapped
from cohortium.entries.subscriptions import _CURRENT_SQL
from cohortium.plans import active_users as U
from cohortium.plans import activity as A
from cohortium.plans import cleaning as C
from cohortium.plans import subscriptions as S
from cohortium.session import ensure_checkpoint_dir
from cohortium.sources import bindings as B
from cohortium.sources.bindings import TEST_STEPS, TEST_TIERS, sql_with

LOOKUP = ("lookup", f"SELECT customer_id, plan_tier FROM ({_CURRENT_SQL}) c")
# The lowest test tier plays the part of the reference's free tier.
UPSELL_TIER = TEST_TIERS[0]


# The activity analyses are bound to the dirty documents after id, time and duration
# cleaning but before unknown ids are removed, so NULL ids and NULL times reach them.
ACT_CTES = [ACT_NORM, PREPARED_CTE]


def _activity(spark, d):
    return C.prepared_activity(B.activity_docs(spark, d)).select("event_id", "customer_id", "ts", "event_type", "session_duration")


def _onboarding(spark, d):
    """Cleaned onboarding documents, with NULL ids (junk) and NULL times (no format) among them."""
    return C.clean_onboarding(B.onboarding_docs(spark, d, dirty=True)).select("event_id", "customer_id", "ts", "step")


def _lookup(spark, d):
    return S.customer_tier_lookup(B.subscriptions(spark, d), B.plans(spark, d))


@register("sessions_per_week_by_tier", sql_with(["plans", "subscriptions", "activity_docs"], f"""
SELECT t.*, {snap6('p.p25')} AS p25_session_duration_sec, {snap6('p.p50')} AS p50_session_duration_sec,
       {snap6('p.p75')} AS p75_session_duration_sec
FROM t LEFT JOIN p ON t.plan_tier = p.plan_tier""", ACT_CTES + [
    LOOKUP,
    ("s", """SELECT a.customer_id, a.event_id, a.session_duration AS dur, COALESCE(l.plan_tier, 'unknown') AS plan_tier,
       strftime(a.ts, '%G-W%V') AS year_week
       FROM activity a LEFT JOIN lookup l ON a.customer_id = l.customer_id
       WHERE a.session_duration > 0 AND a.customer_id IS NOT NULL AND a.ts IS NOT NULL"""),
    ("w", "SELECT customer_id, year_week, plan_tier, COUNT(*) AS n FROM s GROUP BY 1, 2, 3"),
    ("u", "SELECT customer_id, plan_tier, AVG(n) AS avg_w FROM w GROUP BY 1, 2"),
    ("t", f"""SELECT plan_tier, COUNT(*) AS user_count, {sbround('AVG(avg_w)', 2)} AS avg_sessions_per_user_per_week,
       {sbround('MIN(avg_w)', 2)} AS min_sessions_per_week, {sbround('MAX(avg_w)', 2)} AS max_sessions_per_week
       FROM u GROUP BY plan_tier"""),
    ("p", """SELECT plan_tier, quantile_cont(dur, 0.25) AS p25, quantile_cont(dur, 0.5) AS p50,
       quantile_cont(dur, 0.75) AS p75 FROM s GROUP BY plan_tier"""),
]))
def sessions_per_week_by_tier(spark, d):
    out = A.sessions_per_week_by_tier(_activity(spark, d), _lookup(spark, d))
    return snapped(out, *(f"{p}_session_duration_sec" for p in ("p25", "p50", "p75")))


@register("feature_dau", sql_with(["activity_docs"], f"""
SELECT event_type AS feature, {snap6('AVG(dau)')} AS avg_dau, MAX(dau) AS max_dau, MIN(dau) AS min_dau,
       COUNT(*) AS total_days_with_activity
FROM (SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, COUNT(DISTINCT customer_id) AS dau
      FROM activity WHERE event_type IS NOT NULL AND customer_id IS NOT NULL AND ts IS NOT NULL GROUP BY 1, 2) x
GROUP BY 1""", ACT_CTES))
def feature_dau(spark, d):
    return snapped(A.feature_dau(_activity(spark, d)), "avg_dau")


_USERS_SQL = " UNION ALL ".join(f"""SELECT '{p}' AS period, CAST(date_trunc('{p}', ts) AS DATE) AS start, {f} AS feature,
       COUNT(DISTINCT customer_id) AS users FROM seen GROUP BY ALL""" for p in U.PERIODS for f in ("event_type", f"'{U.ALL}'"))


@register("active_users", sql_with(["activity_docs"], _USERS_SQL, ACT_CTES + [
    ("seen", "SELECT event_type, ts, customer_id FROM activity WHERE event_type IS NOT NULL AND customer_id IS NOT NULL AND ts IS NOT NULL")]))
def active_users(spark, d):
    """Daily, weekly and monthly users of every feature from one stored table of bitmaps."""
    ensure_checkpoint_dir(spark)
    events = _activity(spark, d).select("event_type", "ts", "customer_id").checkpoint()
    bitmaps = U.feature_day_bitmaps(events, U.user_numbers(events)).checkpoint()
    return U.active_users(bitmaps)


def _retention_sql(days):
    return sql_with(["activity_docs"], f"""
SELECT event_type AS feature, COUNT(*) AS total_users, CAST(SUM(retained) AS BIGINT) AS retained_users,
       {sbround(sdiv('SUM(retained)', 'COUNT(*)') + ' * 100', 2)} AS retention_rate_pct
FROM pu GROUP BY 1""", ACT_CTES + [
        ("f", """SELECT event_type, customer_id, MIN(ts) AS first_use FROM activity
           WHERE event_type IS NOT NULL AND customer_id IS NOT NULL AND ts IS NOT NULL GROUP BY 1, 2"""),
        ("pu", f"""SELECT f.event_type, f.customer_id,
           MAX(CASE WHEN a.ts > f.first_use AND a.ts <= f.first_use + INTERVAL {days} DAY THEN 1 ELSE 0 END) AS retained
           FROM f JOIN activity a ON a.event_type = f.event_type AND a.customer_id = f.customer_id GROUP BY 1, 2"""),
    ])


@register("feature_retention", _retention_sql(7))
def feature_retention(spark, d):
    return A.feature_retention(_activity(spark, d), days=7)


@register("feature_retention_1d", _retention_sql(1))
def feature_retention_1d(spark, d):
    return A.feature_retention(_activity(spark, d), days=1)


@register("funnel_step_counts", sql_with(["onboarding"], """
SELECT step, COUNT(DISTINCT customer_id) AS user_count, MIN(ts) AS earliest, MAX(ts) AS latest
FROM onboarding WHERE step IS NOT NULL GROUP BY step"""))
def funnel_step_counts(spark, d):
    return A.funnel_step_counts(B.onboarding(spark, d))


_STEPS_VALUES = ", ".join(f"('{s}', {i + 1})" for i, s in enumerate(TEST_STEPS))
_STEPS_IN = ", ".join(f"'{s}'" for s in TEST_STEPS)


@register("funnel_dropoff", sql_with(["onboarding"], f"""
SELECT step_order, step, users, LAG(users) OVER (ORDER BY step_order) AS prev_users,
       {sround(sdiv('users', 'LAG(users) OVER (ORDER BY step_order)') + ' * 100', 2)} AS conversion_pct,
       {sround('100.0 - ' + sdiv('users', 'LAG(users) OVER (ORDER BY step_order)') + ' * 100', 2)} AS dropoff_pct
FROM f""", [
    ("st", f"SELECT * FROM (VALUES {_STEPS_VALUES}) AS t(step, step_order)"),
    ("u", f"""SELECT step, COUNT(DISTINCT customer_id) AS users FROM onboarding WHERE step IN ({_STEPS_IN})
       GROUP BY step"""),
    ("f", """SELECT st.step_order, st.step, CAST(COALESCE(u.users, 0) AS BIGINT) AS users
       FROM st LEFT JOIN u ON st.step = u.step"""),
]))
def funnel_dropoff(spark, d):
    return A.funnel_dropoff(B.onboarding(spark, d), TEST_STEPS)


_PAIRS = list(zip(TEST_STEPS, TEST_STEPS[1:]))


@register("funnel_step_gaps", sql_with(["onboarding_docs_dirty"], "SELECT " + ", ".join(
    f"""{snap6(f'quantile_cont((epoch_us("{b}") - epoch_us("{a}")) / 3.6e9, 0.5)')} AS median_{a}_to_{b}_hrs"""
    for a, b in _PAIRS) + ", (SELECT COUNT(DISTINCT customer_id) FROM onboarding) AS total_customers FROM w", RAW_ONB_CTES + [
    ("w", "SELECT customer_id, " + ", ".join(
        f"""MIN(CASE WHEN step = '{s}' THEN ts END) AS "{s}\"""" for s in TEST_STEPS)
     + " FROM onboarding WHERE customer_id IS NOT NULL AND ts IS NOT NULL GROUP BY customer_id"),
]))
def funnel_step_gaps(spark, d):
    out = A.funnel_step_gaps(_onboarding(spark, d), TEST_STEPS)
    return snapped(out, *(c for c in out.columns if c.startswith("median_")))


@register("user_step_lists", sql_with(["onboarding_docs_dirty"], """
SELECT customer_id, string_agg(step || '@' || strftime(t, '%Y-%m-%d %H:%M:%S.%f'), '>' ORDER BY t, step) AS step_path,
       COUNT(*) AS n_steps
FROM (SELECT customer_id, step, MIN(ts) AS t FROM onboarding
      WHERE step IS NOT NULL AND customer_id IS NOT NULL AND ts IS NOT NULL GROUP BY 1, 2) f
GROUP BY customer_id""", RAW_ONB_CTES))
def user_step_lists(spark, d):
    return A.user_step_lists(_onboarding(spark, d)).withColumn("n_steps", F.col("n_steps").cast("long"))


@register("top_engaged_users", sql_with(["plans", "subscriptions", "activity_docs"], f"""
SELECT customer_id, plan_tier,
       {sbround('''least(total_events / 500, 1.0) * 30 + least(avg_d / 7200, 1.0) * 25
                 + least(event_type_count / 14, 1.0) * 25 + least(greatest(1.0 - least(days, 90.0) / 90, 0.0), 1.0) * 20''', 2)}
         AS engagement_score,
       total_events, total_sessions, event_type_count, {sbround('avg_d', 1)} AS avg_session_duration_sec,
       {sbround('days', 0)} AS days_since_last_activity
FROM x ORDER BY engagement_score DESC, customer_id LIMIT 20""", ACT_CTES + [
    LOOKUP,
    ("m", f"""SELECT customer_id, COUNT(*) AS total_events, COUNT(DISTINCT event_type) AS event_type_count,
       AVG(COALESCE(session_duration, 0)) AS avg_d, MAX(ts) AS last_activity,
       COUNT(*) FILTER (WHERE COALESCE(session_duration, 0) > 0) AS total_sessions
       FROM activity WHERE customer_id IN (SELECT customer_id FROM lookup WHERE plan_tier = '{UPSELL_TIER}')
       GROUP BY 1"""),
    ("x", f"""SELECT m.*, '{UPSELL_TIER}' AS plan_tier,
       COALESCE((epoch_us((SELECT MAX(ts) FROM activity)) - epoch_us(last_activity)) / 8.64e10, 90.0) AS days FROM m"""),
]))
def top_engaged_users(spark, d):
    return A.top_engaged_users(_activity(spark, d), _lookup(spark, d), tier=UPSELL_TIER, k=20)


# -- per-customer aggregates of the cleaned collections (customer-360 inputs) --

def clean_activity_df(spark, d):
    return C.clean_activity(B.activity_docs(spark, d), B.customers(spark, d))


def engagement_df(spark, d):
    out = A.engagement_by_customer(C.prepared_activity(B.activity_docs(spark, d)), B.customers(spark, d))
    return snapped(out, "avg_session_duration", "total_session_time")


def nps_df(spark, d):
    return snapped(A.nps_by_customer(clean_nps_df(spark, d)), "avg_nps_mongo")


def clean_nps_df(spark, d):
    return C.clean_nps(B.nps_docs(spark, d))


def clean_onboarding_df(spark, d):
    return C.clean_onboarding(B.onboarding_docs(spark, d))


ENGAGEMENT_CTE = ("engagement", f"""SELECT customer_id, COUNT(*) AS total_events,
    COUNT(*) FILTER (WHERE session_duration > 0) AS total_sessions,
    {snap6('AVG(session_duration)')} AS avg_session_duration, COUNT(DISTINCT event_type) AS distinct_features,
    MAX(ts) AS last_activity, MIN(ts) AS first_activity, {snap6('SUM(session_duration)')} AS total_session_time
    FROM clean_activity WHERE customer_id IS NOT NULL GROUP BY 1""")
NPS_AGG_CTE = ("nps_agg", f"""SELECT customer_id, {snap6('AVG(nps_score)')} AS avg_nps_mongo,
    COUNT(nps_score) AS nps_count, arg_max(nps_score, (ts, response_id)) AS latest_nps
    FROM clean_nps WHERE customer_id IS NOT NULL GROUP BY 1""")
ONB_CTE = ("onb_steps", """SELECT customer_id, COUNT(DISTINCT step) AS onboarding_steps_completed
    FROM clean_onboarding WHERE customer_id IS NOT NULL GROUP BY 1""")


@register("engagement_by_customer", sql_with(["activity_docs", "customers"], "SELECT * FROM engagement",
                                             CLEAN_ACTIVITY_CTES + [ENGAGEMENT_CTE]))
def engagement_by_customer(spark, d):
    return engagement_df(spark, d)


@register("nps_by_customer", sql_with(["nps_docs"], "SELECT * FROM nps_agg", CLEAN_NPS_CTES + [NPS_AGG_CTE]))
def nps_by_customer(spark, d):
    return nps_df(spark, d)


@register("onboarding_depth", sql_with(["onboarding_docs"], "SELECT * FROM onb_steps", CLEAN_ONB_CTES + [ONB_CTE]))
def onboarding_depth(spark, d):
    return A.onboarding_depth(clean_onboarding_df(spark, d))
