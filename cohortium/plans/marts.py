"""Dashboard marts and KPI cards over the customer-360 and the role tables.

pandas ``groupby`` drops NULL keys; Spark keeps a NULL group, so every mart
filters NULL keys explicitly. Slicers (plan tier, segment name) are plain
optional filters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortium.functions.numeric import safe_div, snap_round
from cohortium.functions.time import month_key
from cohortium.plans.subscriptions import CHURNED_STATUSES

# Fixed values from the reference: the customer master export columns, in order.
MASTER_COLUMNS = [
    "customer_id", "company_name", "industry", "company_size", "country_code",
    "country_name", "signup_date", "signup_source", "is_active", "churned_at",
    "churn_reason", "nps_score", "plan_name", "plan_tier", "current_sub_status",
    "current_mrr", "total_events", "total_sessions", "avg_session_duration",
    "distinct_features", "total_ltv", "ticket_count", "escalated_tickets",
    "avg_satisfaction", "onboarding_steps_completed", "is_churned",
    "segment", "segment_name", "high_engagement", "recency_days",
]


def slice_by(df: DataFrame, plan_tier=None, segment_name=None) -> DataFrame:
    if plan_tier is not None:
        df = df.where(F.col("plan_tier") == plan_tier)
    if segment_name is not None:
        df = df.where(F.col("segment_name") == segment_name)
    return df


def mart_customer_master(master: DataFrame, columns=MASTER_COLUMNS) -> DataFrame:
    """Listed columns that exist, in the listed order (a missing column is skipped)."""
    return master.select(*[c for c in columns if c in master.columns])


def mart_monthly_churn(subs_end: DataFrame, plans: DataFrame, statuses=CHURNED_STATUSES) -> DataFrame:
    """Churned subscriptions per end month ('yyyy-MM') and tier; unknown month or tier dropped."""
    s = subs_end.join(plans.select("plan_id", "plan_tier"), "plan_id", "left").where(F.col("status").isin(*statuses))
    s = s.where(F.col("end_date").isNotNull() & F.col("plan_tier").isNotNull())
    return s.groupBy(month_key(F.col("end_date")).alias("end_month"), "plan_tier").agg(
        F.count(F.lit(1)).alias("churned_count"))


def mart_support_tickets(tickets: DataFrame, customers: DataFrame, current_sub: DataFrame,
                         plans: DataFrame) -> DataFrame:
    """Tickets enriched with company, active flag, current plan id and tier."""
    t = tickets.join(customers.select("customer_id", "company_name", "is_active"), "customer_id", "left")
    t = t.join(current_sub.select("customer_id", "plan_id"), "customer_id", "left")
    return t.join(plans.select("plan_id", "plan_tier"), "plan_id", "left")


def mart_monthly_engagement(activity_clean: DataFrame) -> DataFrame:
    """Events, distinct users and mean session duration per month of the cleaned activity."""
    a = activity_clean.where(F.col("ts").isNotNull())
    return a.groupBy(month_key(F.col("ts")).alias("month")).agg(
        F.count("customer_id").alias("total_events"), F.count_distinct("customer_id").alias("unique_users"),
        F.avg("session_duration").alias("avg_session_duration"))


def mart_plans(plans: DataFrame) -> DataFrame:
    return plans


def mart_churn_reasons(master: DataFrame) -> DataFrame:
    """Churned customers per reason and their mean LTV, most frequent first."""
    c = master.where((F.col("is_churned") == 1) & F.col("churn_reason").isNotNull())
    return c.groupBy("churn_reason").agg(
        F.count("customer_id").alias("count"), F.avg("total_ltv").alias("avg_ltv")) \
        .orderBy(F.desc("count"), "churn_reason")


def top_churn_reason(master: DataFrame) -> DataFrame:
    """The first row of the churn-reason mart (ties broken by reason text)."""
    return mart_churn_reasons(master).limit(1)


def kpi_cards(master: DataFrame, plan_tier=None, segment_name=None) -> DataFrame:
    """Customer count, churn rate %, mean LTV of active and churned customers (one row)."""
    m = slice_by(master, plan_tier, segment_name)
    aggs = [
        F.count(F.lit(1)).alias("total_customers"),
        F.sum("is_churned").cast("long").alias("churned_customers"),
        snap_round(safe_div(F.sum("is_churned"), F.count(F.lit(1))) * 100, 1).alias("churn_rate_pct"),
        snap_round(F.avg(F.when(F.col("is_churned") == 0, F.col("total_ltv"))), 2).alias("avg_ltv_active"),
        snap_round(F.avg(F.when(F.col("is_churned") == 1, F.col("total_ltv"))), 2).alias("avg_ltv_churned"),
    ]
    if "segment" in m.columns:
        # segments, not names: several segments may share a name
        aggs.append(F.count_distinct("segment").alias("segment_count"))
    return m.agg(*aggs)


def segment_distribution(master: DataFrame, plan_tier=None) -> DataFrame:
    """Customers per segment name (donut)."""
    m = slice_by(master, plan_tier).where(F.col("segment_name").isNotNull())
    return m.groupBy("segment_name").agg(F.count("customer_id").alias("customers"))


def engagement_vs_ltv(master: DataFrame, plan_tier=None, segment_name=None) -> DataFrame:
    """Scatter data: events vs LTV per customer, sized by tickets, coloured by segment."""
    m = slice_by(master, plan_tier, segment_name)
    return m.select("customer_id", "total_events", "total_ltv", "ticket_count", "segment_name")
