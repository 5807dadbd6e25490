"""Registered customer-360, mart, statistics and segmentation queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cohortium.catalog import register, sbround, sdiv, sround
from cohortium.entries.activity import (ENGAGEMENT_CTE, NPS_AGG_CTE, ONB_CTE, clean_activity_df, clean_onboarding_df,
                                        engagement_df, nps_df)
from cohortium.entries.cleaning import CLEAN_ACTIVITY_CTES, CLEAN_NPS_CTES, CLEAN_ONB_CTES, sql_strip
from cohortium.entries.rounding import snap6, snap6_col, snapped
from cohortium.operators.scalars import attach_one_row
from cohortium.operators.selection import few_group_percentiles
from cohortium.plans import activity as A
from cohortium.plans import cleaning as C
from cohortium.plans import customer360 as X
from cohortium.plans import marts as M
from cohortium.plans import segments as G
from cohortium.plans import slices as L
from cohortium.plans import stats as T
from cohortium.plans import subscriptions as S
from cohortium.session import ensure_checkpoint_dir, shuffle_partitions
from cohortium.sources import bindings as B
from cohortium.sources.bucketed import write_bucketed
from cohortium.sources.bindings import TEST_TIERS, sql_with

C360_COLUMNS = [
    "customer_id", "company_name", "industry", "country_code", "country_name", "contact_name", "contact_email",
    "is_active", "churn_reason", "is_potential_duplicate", "plan_id", "current_sub_status", "current_mrr",
    "plan_name", "plan_tier", "total_events", "total_sessions", "avg_session_duration", "distinct_features",
    "last_activity", "first_activity", "total_session_time", "avg_nps_mongo", "nps_count", "latest_nps",
    "onboarding_steps_completed", "total_ltv", "ticket_count", "escalated_tickets", "avg_satisfaction", "is_churned"]


def _tickets_df(spark, d):
    return snapped(X.ticket_summary(B.tickets(spark, d)), "avg_satisfaction")


def customer_360_df(spark, d):
    cur = S.current_subscription_lastvalue(B.subscriptions(spark, d))
    m = X.customer_360(
        C.clean_customers(B.customers(spark, d)), cur, B.plans(spark, d),
        engagement_df(spark, d), nps_df(spark, d),
        A.onboarding_depth(clean_onboarding_df(spark, d)), S.customer_ltv(B.invoices(spark, d)),
        _tickets_df(spark, d))
    return m.withColumn("current_mrr", F.col("current_mrr").cast("double")).select(*C360_COLUMNS)


C360_ROLES = ["customers", "subscriptions", "plans", "invoices", "tickets", "activity_docs", "nps_docs",
              "onboarding_docs"]
C360_CTES = CLEAN_ACTIVITY_CTES + [ENGAGEMENT_CTE] + CLEAN_NPS_CTES + [NPS_AGG_CTE] + CLEAN_ONB_CTES + [ONB_CTE] + [
    ("customers_clean", f"""SELECT customer_id,
       CASE WHEN {sql_strip('company_name')} = '' THEN 'Unknown' ELSE {sql_strip('company_name')} END AS company_name,
       industry, country_code, {sql_strip('country_name')} AS country_name, contact_name, contact_email,
       is_active, churn_reason, COALESCE(customer_id IN (1202), FALSE) AS is_potential_duplicate FROM customers"""),
    ("cur", """SELECT customer_id,
       arg_max(plan_id, (start_date IS NULL, start_date, subscription_id)) FILTER (WHERE plan_id IS NOT NULL) AS plan_id,
       arg_max(status, (start_date IS NULL, start_date, subscription_id)) FILTER (WHERE status IS NOT NULL)
         AS current_sub_status,
       arg_max(mrr_usd, (start_date IS NULL, start_date, subscription_id)) FILTER (WHERE mrr_usd IS NOT NULL)
         AS current_mrr
       FROM subscriptions GROUP BY customer_id"""),
    ("ltv", "SELECT customer_id, SUM(total_usd) AS total_ltv FROM invoices WHERE status = 'paid' GROUP BY 1"),
    ("tickets_agg", f"""SELECT customer_id, COUNT(ticket_id) AS ticket_count,
       CAST(SUM(CAST(escalated AS INTEGER)) AS BIGINT) AS escalated_tickets,
       {snap6('AVG(satisfaction_score)')} AS avg_satisfaction FROM tickets GROUP BY 1"""),
    ("c360", """SELECT c.customer_id, c.company_name, c.industry, c.country_code, c.country_name, c.contact_name,
       c.contact_email, c.is_active, c.churn_reason, c.is_potential_duplicate, cur.plan_id, cur.current_sub_status,
       CAST(cur.current_mrr AS DOUBLE) AS current_mrr, p.plan_name, p.plan_tier,
       COALESCE(e.total_events, 0) AS total_events, COALESCE(e.total_sessions, 0) AS total_sessions,
       COALESCE(e.avg_session_duration, 0.0) AS avg_session_duration,
       COALESCE(e.distinct_features, 0) AS distinct_features, e.last_activity, e.first_activity,
       COALESCE(e.total_session_time, 0.0) AS total_session_time, n.avg_nps_mongo,
       COALESCE(n.nps_count, 0) AS nps_count, n.latest_nps,
       COALESCE(o.onboarding_steps_completed, 0) AS onboarding_steps_completed,
       COALESCE(CAST(l.total_ltv AS DOUBLE), 0.0) AS total_ltv, COALESCE(t.ticket_count, 0) AS ticket_count,
       COALESCE(t.escalated_tickets, 0) AS escalated_tickets, t.avg_satisfaction,
       CAST(NOT c.is_active AS INTEGER) AS is_churned
       FROM customers_clean c LEFT JOIN cur ON c.customer_id = cur.customer_id
       LEFT JOIN plans p ON cur.plan_id = p.plan_id LEFT JOIN engagement e ON c.customer_id = e.customer_id
       LEFT JOIN nps_agg n ON c.customer_id = n.customer_id LEFT JOIN onb_steps o ON c.customer_id = o.customer_id
       LEFT JOIN ltv l ON c.customer_id = l.customer_id LEFT JOIN tickets_agg t ON c.customer_id = t.customer_id"""),
]


def c360_sql(body, extra=()):
    return sql_with(C360_ROLES, body, C360_CTES + list(extra))


@register("ticket_summary", sql_with(["tickets"], "SELECT * FROM tickets_agg", [C360_CTES[-2]]))
def ticket_summary(spark, d):
    return _tickets_df(spark, d)


@register("customer_360", c360_sql("SELECT * FROM c360"))
def customer_360(spark, d):
    return customer_360_df(spark, d)


@register("customer_360_bucketed", c360_sql("SELECT * FROM c360"))
def customer_360_bucketed(spark, d):
    """The customer-360 from inputs written once as tables bucketed by customer."""
    prefix = f"c360_{uuid.uuid4().hex[:12]}"
    parts = {
        "customers": C.clean_customers(B.customers(spark, d)),
        "subscriptions": X.with_plan(S.current_subscription_lastvalue(B.subscriptions(spark, d)), B.plans(spark, d)),
        "engagement": engagement_df(spark, d), "nps": nps_df(spark, d), "onboarding": A.onboarding_depth(clean_onboarding_df(spark, d)),
        "ltv": S.customer_ltv(B.invoices(spark, d)), "tickets": _tickets_df(spark, d)}
    buckets = shuffle_partitions(spark)
    m = X.customer_360_from_buckets(*(write_bucketed(df, f"{prefix}_{name}", "customer_id", buckets) for name, df in parts.items()))
    return m.withColumn("current_mrr", F.col("current_mrr").cast("double")).select(*C360_COLUMNS)


# -- derived per-customer columns used by exports and tests -------------------

def master_df(spark, d):
    """customer-360 + recency_days + high_engagement (deterministic columns only); computed once."""
    ensure_checkpoint_dir(spark)
    m = customer_360_df(spark, d).checkpoint()
    as_of = m.select(F.max("last_activity")).scalar()
    m = m.withColumn("recency_days", G.recency_days(F.col("last_activity"), as_of))
    m = attach_one_row(m, few_group_percentiles(m, [], "total_events", {"median": 0.5}))
    return m.withColumn("high_engagement", (F.col("total_events") > F.col("median")).cast("int")).drop("median")


MASTER_CTE = ("master", """SELECT c360.*,
   COALESCE(CAST(floor((epoch_us((SELECT MAX(last_activity) FROM c360)) - epoch_us(last_activity)) / 8.64e10)
                 AS BIGINT), 999) AS recency_days,
   CAST(total_events > (SELECT quantile_cont(total_events, 0.5) FROM c360) AS INTEGER) AS high_engagement
   FROM c360""")


def master_sql(body, extra=()):
    return c360_sql(body, [MASTER_CTE] + list(extra))


# Stand-in segmentation for the deterministic checks: the industry column
# plays the part of the k-means cluster id (segment names follow the rules).
def named_master_df(spark, d):
    m = master_df(spark, d)
    names = G.name_segments(G.segment_profile(m, "industry")).select(
        F.col("segment").alias("industry"), "segment_name")
    return m.join(names, "industry", "left")


def _profile_sql():
    return f"""SELECT industry AS segment, COUNT(customer_id) AS "count",
       {sbround('AVG(is_churned)', 2)} AS churn_rate, {sbround('AVG(total_events)', 2)} AS avg_events,
       {sbround('AVG(total_ltv)', 2)} AS avg_ltv, {sbround('AVG(avg_session_duration)', 2)} AS avg_session_dur,
       {sbround('AVG(distinct_features)', 2)} AS avg_features, {sbround('AVG(ticket_count)', 2)} AS avg_tickets,
       {sbround('AVG(recency_days)', 2)} AS avg_recency FROM master GROUP BY industry"""


NAMES_CTES = [
    ("profile", _profile_sql()),
    ("named", f"""SELECT profile.*, CASE
       WHEN avg_ltv > AVG(avg_ltv) OVER () AND churn_rate < AVG(churn_rate) OVER () THEN '{G.SEGMENT_NAMES[0]}'
       WHEN avg_events > AVG(avg_events) OVER () AND avg_ltv < AVG(avg_ltv) OVER () THEN '{G.SEGMENT_NAMES[1]}'
       WHEN churn_rate > AVG(churn_rate) OVER () AND avg_events < AVG(avg_events) OVER () THEN '{G.SEGMENT_NAMES[2]}'
       ELSE '{G.SEGMENT_NAMES[3]}' END AS segment_name FROM profile"""),
    ("named_master", """SELECT master.*, named.segment_name FROM master
       LEFT JOIN named ON master.industry = named.segment"""),
]


@register("segment_profile", master_sql("SELECT * FROM named", NAMES_CTES[:2]))
def segment_profile(spark, d):
    return G.name_segments(G.segment_profile(master_df(spark, d), "industry"))


_IN_MASTER = C360_COLUMNS + ["high_engagement", "recency_days", "segment", "segment_name"]


@register("mart_customer_master", master_sql("SELECT " + ", ".join(c for c in M.MASTER_COLUMNS if c in _IN_MASTER)
          + " FROM (SELECT *, industry AS segment FROM named_master) m", NAMES_CTES))
def mart_customer_master(spark, d):
    return M.mart_customer_master(named_master_df(spark, d).withColumn("segment", F.col("industry")))


@register("mart_monthly_churn", sql_with(["plans", "subscriptions_end"], """
SELECT strftime(s.end_date, '%Y-%m') AS end_month, p.plan_tier, COUNT(*) AS churned_count
FROM subscriptions_end s LEFT JOIN plans p ON s.plan_id = p.plan_id
WHERE s.status IN ('cancelled', 'expired') AND s.end_date IS NOT NULL AND p.plan_tier IS NOT NULL GROUP BY 1, 2"""))
def mart_monthly_churn(spark, d):
    return M.mart_monthly_churn(B.subscriptions(spark, d, with_end=True), B.plans(spark, d))


@register("mart_support_tickets", c360_sql("""
SELECT t.ticket_id, t.customer_id, t.created_at, t.escalated, t.satisfaction_score, c.company_name, c.is_active,
       cur.plan_id, p.plan_tier
FROM tickets t LEFT JOIN customers_clean c ON t.customer_id = c.customer_id
LEFT JOIN cur ON t.customer_id = cur.customer_id LEFT JOIN plans p ON cur.plan_id = p.plan_id"""))
def mart_support_tickets(spark, d):
    cur = S.current_subscription_lastvalue(B.subscriptions(spark, d))
    out = M.mart_support_tickets(B.tickets(spark, d), C.clean_customers(B.customers(spark, d)), cur,
                                 B.plans(spark, d))
    return out.select("ticket_id", "customer_id", "created_at", "escalated", "satisfaction_score", "company_name",
                      "is_active", "plan_id", "plan_tier")


# the stored events cover one month: each is moved back by its id modulo 84 months
@register("mart_monthly_engagement", sql_with(["activity_docs", "customers"], f"""
SELECT strftime(ts, '%Y-%m') AS month, COUNT(customer_id) AS total_events,
       COUNT(DISTINCT customer_id) AS unique_users, {snap6('AVG(session_duration)')} AS avg_session_duration
FROM (SELECT customer_id, session_duration, date_trunc('month', ts) - to_months(CAST(event_id % 84 AS INTEGER)) AS ts
      FROM clean_activity) x WHERE ts IS NOT NULL GROUP BY 1""", CLEAN_ACTIVITY_CTES))
def mart_monthly_engagement(spark, d):
    a = clean_activity_df(spark, d)
    moved = F.add_months(F.trunc("ts", "MM"), -(F.col("event_id") % 84).cast("int")).cast("timestamp_ntz")
    return snapped(M.mart_monthly_engagement(a.withColumn("ts", moved)), "avg_session_duration")


@register("mart_plans", sql_with(["plans"], "SELECT * FROM plans"))
def mart_plans(spark, d):
    return M.mart_plans(B.plans(spark, d))


_REASONS = ("reasons", f"""SELECT churn_reason, COUNT(customer_id) AS "count", {snap6('AVG(total_ltv)')} AS avg_ltv
   FROM c360 WHERE is_churned = 1 AND churn_reason IS NOT NULL GROUP BY churn_reason""")


@register("mart_churn_reasons", c360_sql("SELECT * FROM reasons", [_REASONS]))
def mart_churn_reasons(spark, d):
    return snapped(M.mart_churn_reasons(customer_360_df(spark, d)), "avg_ltv")


@register("top_churn_reason", c360_sql('SELECT * FROM reasons ORDER BY "count" DESC, churn_reason LIMIT 1',
                                       [_REASONS]))
def top_churn_reason(spark, d):
    return snapped(M.top_churn_reason(customer_360_df(spark, d)), "avg_ltv")


def _kpi_sql(src, where=""):
    return f"""SELECT COUNT(*) AS total_customers, CAST(SUM(is_churned) AS BIGINT) AS churned_customers,
       {sround(sdiv('SUM(is_churned)', 'COUNT(*)') + ' * 100', 1)} AS churn_rate_pct,
       {sround('AVG(CASE WHEN is_churned = 0 THEN total_ltv END)', 2)} AS avg_ltv_active,
       {sround('AVG(CASE WHEN is_churned = 1 THEN total_ltv END)', 2)} AS avg_ltv_churned{src}{where}"""


@register("kpi_cards", master_sql(_kpi_sql(", COUNT(DISTINCT industry) AS segment_count FROM named_master"),
                                   NAMES_CTES))
def kpi_cards(spark, d):
    return M.kpi_cards(named_master_df(spark, d).withColumn("segment", F.col("industry")))


@register("kpi_cards_by_tier", c360_sql(_kpi_sql(" FROM c360", f" WHERE plan_tier = '{TEST_TIERS[-1]}'")))
def kpi_cards_by_tier(spark, d):
    return M.kpi_cards(customer_360_df(spark, d), plan_tier=TEST_TIERS[-1])


_CUBE_KPIS = f"""COUNT(*) AS total_customers, CAST(SUM(is_churned) AS BIGINT) AS churned_customers,
       {sround(sdiv('SUM(is_churned)', 'COUNT(*)') + ' * 100', 1)} AS churn_rate_pct,
       {sround('AVG(total_ltv) FILTER (WHERE is_churned = 0)', 2)} AS avg_ltv_active,
       {sround('AVG(total_ltv) FILTER (WHERE is_churned = 1)', 2)} AS avg_ltv_churned, COUNT(DISTINCT industry) AS segment_count"""


def _cells(spark, d):
    return L.kpi_cells(named_master_df(spark, d).withColumn("segment", F.col("industry")))


@register("kpi_cube", master_sql(f"""
SELECT CAST(GROUPING_ID(plan_tier, segment_name) AS BIGINT) AS grouping_id, plan_tier, segment_name, {_CUBE_KPIS}
FROM named_master GROUP BY CUBE (plan_tier, segment_name)""", NAMES_CTES))
def kpi_cube(spark, d):
    """KPI cards for every choice of the two slicers, from one pass over the customers."""
    return L.kpi_cube(_cells(spark, d))


@register("kpi_cards_two_tiers", master_sql(f"""
SELECT {_CUBE_KPIS} FROM named_master
WHERE plan_tier IN ('{TEST_TIERS[0]}', '{TEST_TIERS[-1]}') AND segment_name IN ('{G.SEGMENT_NAMES[0]}', '{G.SEGMENT_NAMES[3]}')""", NAMES_CTES))
def kpi_cards_two_tiers(spark, d):
    """Several values chosen in both slicers: cells are merged, customers aren't read again."""
    return L.kpi_choice(_cells(spark, d), [TEST_TIERS[0], TEST_TIERS[-1]], [G.SEGMENT_NAMES[0], G.SEGMENT_NAMES[3]])


_REASON_SETS = " UNION ALL ".join(f"""SELECT CAST({gid} AS BIGINT) AS grouping_id, {tier} AS plan_tier, {name} AS segment_name, churn_reason,
       COUNT(*) AS "count", {sround('AVG(total_ltv)', 2)} AS avg_ltv FROM gone GROUP BY ALL""" for gid, tier, name in (
    (0, "plan_tier", "segment_name"), (1, "plan_tier", "CAST(NULL AS VARCHAR)"), (2, "CAST(NULL AS VARCHAR)", "segment_name"),
    (3, "CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)")))


@register("churn_reason_cube", master_sql("""
SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY grouping_id, plan_tier, segment_name ORDER BY "count" DESC, churn_reason) AS INTEGER) AS reason_rank
FROM sliced""", NAMES_CTES + [("gone", "SELECT * FROM named_master WHERE is_churned = 1 AND churn_reason IS NOT NULL"), ("sliced", _REASON_SETS)]))
def churn_reason_cube(spark, d):
    return L.churn_reason_cube(named_master_df(spark, d))


@register("segment_distribution", master_sql(
    "SELECT segment_name, COUNT(customer_id) AS customers FROM named_master WHERE segment_name IS NOT NULL GROUP BY 1",
    NAMES_CTES))
def segment_distribution(spark, d):
    return M.segment_distribution(named_master_df(spark, d))


SLICE_SEGMENT = G.SEGMENT_NAMES[3]


@register("engagement_vs_ltv", master_sql(f"""
SELECT customer_id, total_events, total_ltv, ticket_count, segment_name FROM named_master
WHERE plan_tier = '{TEST_TIERS[-1]}' AND segment_name = '{SLICE_SEGMENT}'""", NAMES_CTES))
def engagement_vs_ltv(spark, d):
    return M.engagement_vs_ltv(named_master_df(spark, d), plan_tier=TEST_TIERS[-1], segment_name=SLICE_SEGMENT)


# -- statistics ----------------------------------------------------------------

_WELCH_COLS = ["n_active", "mean_active", "var_active", "std_active", "n_churned", "mean_churned", "var_churned",
               "std_churned", "t_stat", "welch_df", "cohens_d", "effect_size", "n_ok"]
_FLOATS = {"mean_active", "var_active", "std_active", "mean_churned", "var_churned", "std_churned", "t_stat",
           "welch_df", "cohens_d"}


@register("welch_stats", c360_sql(f"""
SELECT n_active, {snap6('mean_active')} AS mean_active, {snap6('var_active')} AS var_active,
       {snap6('sqrt(var_active)')} AS std_active, n_churned, {snap6('mean_churned')} AS mean_churned,
       {snap6('var_churned')} AS var_churned, {snap6('sqrt(var_churned)')} AS std_churned,
       {snap6('t')} AS t_stat, {snap6('dof')} AS welch_df, {snap6('d')} AS cohens_d,
       CASE WHEN abs(d) < 0.2 THEN 'negligible' WHEN abs(d) < 0.5 THEN 'small' WHEN abs(d) < 0.8 THEN 'medium'
            ELSE 'large' END AS effect_size, n_active > 30 AND n_churned > 30 AS n_ok
FROM (SELECT *, (mean_active - mean_churned) / sqrt(var_active / n_active + var_churned / n_churned) AS t,
        power(var_active / n_active + var_churned / n_churned, 2)
          / (power(var_active / n_active, 2) / (n_active - 1) + power(var_churned / n_churned, 2) / (n_churned - 1))
          AS dof,
        CASE WHEN sqrt((var_active + var_churned) / 2) > 0
             THEN (mean_active - mean_churned) / sqrt((var_active + var_churned) / 2) ELSE 0.0 END AS d
      FROM (SELECT COUNT(*) FILTER (WHERE is_churned = 0) AS n_active,
                   AVG(CASE WHEN is_churned = 0 THEN CAST(total_events AS DOUBLE) END) AS mean_active,
                   var_samp(CASE WHEN is_churned = 0 THEN CAST(total_events AS DOUBLE) END) AS var_active,
                   COUNT(*) FILTER (WHERE is_churned = 1) AS n_churned,
                   AVG(CASE WHEN is_churned = 1 THEN CAST(total_events AS DOUBLE) END) AS mean_churned,
                   var_samp(CASE WHEN is_churned = 1 THEN CAST(total_events AS DOUBLE) END) AS var_churned
            FROM c360) a) b"""))
def welch_stats(spark, d):
    s = T.welch_stats(customer_360_df(spark, d))
    return s.select(*[snap6_col(F.col(c)).alias(c) if c in _FLOATS else F.col(c) for c in _WELCH_COLS])


# p-values as numeric integrals: Simpson's rule over 4,000 steps from 0 to the statistic
_SIMPSON = "SUM(CASE WHEN i = 0 OR i = 4000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * {f}) * x / 12000"
_T_DENSITY = "exp(lgamma((v + 1) / 2) - lgamma(v / 2) - (v + 1) / 2 * ln(1 + power(x * i / 4000, 2) / v)) / sqrt(v * pi())"


@register("welch_test", c360_sql(f"""
SELECT n_active, n_churned, {snap6('t')} AS t_stat, {snap6('v')} AS welch_df, {snap6('1 - 2 * half')} AS p_two_sided,
       {snap6('0.5 - half')} AS p_half, {snap6('CASE WHEN t >= 0 THEN 0.5 - half ELSE 0.5 + half END')} AS p_one_sided,
       CASE WHEN 0.5 - half < 0.05 THEN 'reject H0' ELSE 'fail to reject H0' END AS decision
FROM (SELECT any_value(n0) AS n_active, any_value(n1) AS n_churned, any_value(t) AS t, any_value(v) AS v, any_value(x) AS x,
             {_SIMPSON.format(f=_T_DENSITY).replace('* x /', '* any_value(x) /')} AS half
      FROM w, generate_series(0, 4000) AS s(i)) q""", [
    ("mo", """SELECT COUNT(*) FILTER (WHERE is_churned = 0) AS n0, COUNT(*) FILTER (WHERE is_churned = 1) AS n1,
        AVG(total_events) FILTER (WHERE is_churned = 0) - AVG(total_events) FILTER (WHERE is_churned = 1) AS gap,
        var_samp(CAST(total_events AS DOUBLE)) FILTER (WHERE is_churned = 0) / COUNT(*) FILTER (WHERE is_churned = 0) AS e0,
        var_samp(CAST(total_events AS DOUBLE)) FILTER (WHERE is_churned = 1) / COUNT(*) FILTER (WHERE is_churned = 1) AS e1
        FROM c360"""),
    ("w", """SELECT n0, n1, gap / sqrt(e0 + e1) AS t, abs(gap / sqrt(e0 + e1)) AS x,
        power(e0 + e1, 2) / (e0 * e0 / (n0 - 1) + e1 * e1 / (n1 - 1)) AS v FROM mo"""),
]))
def welch_test(spark, d):
    out = T.welch_test(customer_360_df(spark, d))
    floats = ["t_stat", "welch_df", "p_two_sided", "p_half", "p_one_sided"]
    return snapped(out, *floats).select("n_active", "n_churned", *floats, "decision")


@register("churn_contingency", c360_sql("""
SELECT CAST(total_events > (SELECT quantile_cont(total_events, 0.5) FROM c360) AS INTEGER) AS high_engagement,
       COUNT(*) FILTER (WHERE is_churned = 0) AS churned_0, COUNT(*) FILTER (WHERE is_churned = 1) AS churned_1
FROM c360 GROUP BY 1"""))
def churn_contingency(spark, d):
    return T.churn_contingency(customer_360_df(spark, d))


def _chi_sql():
    cells = [("o00", "r0", "c0"), ("o01", "r0", "c1"), ("o10", "r1", "c0"), ("o11", "r1", "c1")]
    terms = " + ".join(
        f"power(abs({o} - CAST({r} AS DOUBLE) * {k} / n) - least(abs({o} - CAST({r} AS DOUBLE) * {k} / n), 0.5), 2)"
        f" / (CAST({r} AS DOUBLE) * {k} / n)" for o, r, k in cells)
    return f"""SELECT o00, o01, o10, o11, {snap6(terms)} AS chi2, 1 AS dof FROM (
  SELECT *, o00 + o01 AS r0, o10 + o11 AS r1, o00 + o10 AS c0, o01 + o11 AS c1, o00 + o01 + o10 + o11 AS n FROM (
    SELECT CAST(COALESCE(SUM(CASE WHEN high_engagement = 0 THEN churned_0 END), 0) AS BIGINT) AS o00,
           CAST(COALESCE(SUM(CASE WHEN high_engagement = 0 THEN churned_1 END), 0) AS BIGINT) AS o01,
           CAST(COALESCE(SUM(CASE WHEN high_engagement = 1 THEN churned_0 END), 0) AS BIGINT) AS o10,
           CAST(COALESCE(SUM(CASE WHEN high_engagement = 1 THEN churned_1 END), 0) AS BIGINT) AS o11
    FROM ct) a) b"""


@register("chi_square_engagement", c360_sql(_chi_sql(), [("ct", """
SELECT CAST(total_events > (SELECT quantile_cont(total_events, 0.5) FROM c360) AS INTEGER) AS high_engagement,
       COUNT(*) FILTER (WHERE is_churned = 0) AS churned_0, COUNT(*) FILTER (WHERE is_churned = 1) AS churned_1
FROM c360 GROUP BY 1""")]))
def chi_square_engagement(spark, d):
    out = T.chi_square_engagement(customer_360_df(spark, d)).drop("p_value")
    return out.withColumn("chi2", snap6_col(F.col("chi2")))


_CT = ("ct", """SELECT CAST(total_events > (SELECT quantile_cont(total_events, 0.5) FROM c360) AS INTEGER) AS high_engagement,
       COUNT(*) FILTER (WHERE is_churned = 0) AS churned_0, COUNT(*) FILTER (WHERE is_churned = 1) AS churned_1
FROM c360 GROUP BY 1""")


@register("chi_square_test", c360_sql(f"""
SELECT {snap6('chi2')} AS chi2, {snap6('1 - 2 * half')} AS p_value,
       CASE WHEN 1 - 2 * half < 0.05 THEN 'reject H0' ELSE 'fail to reject H0' END AS decision
FROM (SELECT any_value(chi2) AS chi2, {_SIMPSON.format(f="exp(-power(x * i / 4000, 2) / 2) / sqrt(2 * pi())")
      .replace('* x /', '* any_value(x) /')} AS half
      FROM (SELECT chi2, sqrt(chi2) AS x FROM chi) c, generate_series(0, 4000) AS s(i)) q""",
          [_CT, ("chi", _chi_sql().replace(" AS chi2, 1 AS dof", " AS chi2"))]))
def chi_square_test(spark, d):
    out = snapped(T.chi_square_test(customer_360_df(spark, d)), "chi2", "p_value")
    return out.select("chi2", "p_value", "decision")


# -- segmentation --------------------------------------------------------------

FEATURE_CTES = [
    ("f", """SELECT customer_id,
       CAST(COALESCE(CAST(floor((epoch_us((SELECT MAX(last_activity) FROM c360)) - epoch_us(last_activity)) / 8.64e10)
                          AS BIGINT), 999) AS DOUBLE) AS recency_days,
       CAST(COALESCE(total_events, 0) AS DOUBLE) AS total_events, COALESCE(total_ltv, 0.0) AS total_ltv,
       COALESCE(avg_session_duration, 0.0) AS avg_session_duration,
       CAST(COALESCE(distinct_features, 0) AS DOUBLE) AS distinct_features FROM c360"""),
    ("st", "SELECT " + ", ".join(f"AVG({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in G.FEATURES) + " FROM f"),
]


@register("segment_features", c360_sql("SELECT customer_id, " + ", ".join(
    [f"f.{c}" for c in G.FEATURES]) + ", " + ", ".join(
    f"{snap6(f'CASE WHEN s_{c} > 0 THEN (f.{c} - m_{c}) / s_{c} ELSE 0.0 END')} AS z_{c}" for c in G.FEATURES)
    + " FROM f, st", FEATURE_CTES))
def segment_features(spark, d):
    f = G.segment_features(customer_360_df(spark, d))
    return f.select("customer_id", *G.FEATURES, *[snap6_col(F.col("z_" + c)).alias("z_" + c) for c in G.FEATURES])


@register("segment_customers")
def segment_customers(spark, d):
    """K-means segments (k=4, best of 10 seeds): rows-only check (labels are arbitrary)."""
    return G.segment_customers(G.segment_features(customer_360_df(spark, d)))


# K-means from given centres with a fixed number of passes, which SQL can repeat
START_CENTRES = [[0.5, 1.0, 1.0, 0.5, 0.5], [0.0, -0.5, 0.5, 0.0, 0.0], [-0.5, 0.5, -0.5, -0.5, 0.0], [0.0, -1.0, -1.0, 0.5, -0.5]]
PASSES = 3


def _lloyd_sql():
    """CTEs: z-scores, then (centres, nearest centre of each customer) per pass."""
    cols = G.FEATURES
    ctes = [("z", "SELECT customer_id, " + ", ".join(
        f"CASE WHEN s_{c} > 0 THEN (f.{c} - m_{c}) / s_{c} ELSE 0.0 END AS x{i}" for i, c in enumerate(cols)) + " FROM f, st")]
    values = ", ".join(f"({j}, " + ", ".join(f"CAST({v} AS DOUBLE)" for v in c) + ")" for j, c in enumerate(START_CENTRES))
    names = ", ".join(f"c{i}" for i in range(len(cols)))
    ctes.append(("cen0", f"SELECT * FROM (VALUES {values}) AS t(j, {names})"))
    dist = " + ".join(f"(x{i} - c{i}) * (x{i} - c{i})" for i in range(len(cols)))
    for p in range(PASSES + 1):
        ctes.append((f"near{p}", f"SELECT customer_id, arg_min(j, (d, j)) AS j FROM (SELECT customer_id, j, {dist} AS d FROM z, cen{p}) q GROUP BY 1"))
        if p < PASSES:
            mean = ", ".join(f"COALESCE(AVG(x{i}), any_value(c{i})) AS c{i}" for i in range(len(cols)))
            ctes.append((f"cen{p + 1}", f"SELECT c.j, {mean} FROM cen{p} c LEFT JOIN (near{p} JOIN z USING (customer_id)) m ON m.j = c.j GROUP BY c.j"))
    return ctes


_LTV = G.FEATURES.index("total_ltv")


@register("segment_customers_fixed", c360_sql(f"""
SELECT customer_id, CAST(place - 1 AS INTEGER) AS segment FROM near{PASSES}
JOIN (SELECT j, ROW_NUMBER() OVER (ORDER BY c{_LTV} DESC, j) AS place FROM cen{PASSES}) o USING (j)""", FEATURE_CTES + _lloyd_sql()))
def segment_customers_fixed(spark, d):
    """The same k-means from given centres, three passes."""
    f = G.segment_features(customer_360_df(spark, d))
    return G.segment_customers(f, max_iter=PASSES, tol=-1.0, centres=START_CENTRES)
