"""Customer-360: one wide row per customer from every per-customer aggregate.

Every right side of the chained left joins is aggregated to one row per
``customer_id`` first, so each join is 1:1 and all of them share the same
hash partitioning on ``customer_id`` (one exchange per input, none between
the joins). The small plan dimension joins by ``plan_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value from the reference: metrics whose absence means zero.
ZERO_FILLED = ["total_events", "total_sessions", "avg_session_duration", "distinct_features", "total_session_time",
               "ticket_count", "escalated_tickets", "total_ltv", "onboarding_steps_completed", "nps_count"]


def ticket_summary(tickets: DataFrame) -> DataFrame:
    """Tickets, escalated tickets and mean satisfaction per customer."""
    return tickets.groupBy("customer_id").agg(
        F.count("ticket_id").alias("ticket_count"),
        F.sum(F.col("escalated").cast("int")).cast("long").alias("escalated_tickets"),
        F.avg("satisfaction_score").alias("avg_satisfaction"))


def customer_360(customers: DataFrame, current_sub: DataFrame, plans: DataFrame, engagement: DataFrame,
                 nps_agg: DataFrame, onb_steps: DataFrame, ltv: DataFrame, tickets_agg: DataFrame) -> DataFrame:
    m = customers.join(current_sub, "customer_id", "left")
    m = m.join(plans.select("plan_id", "plan_name", "plan_tier"), "plan_id", "left")
    return zero_filled(m, engagement, nps_agg, onb_steps, ltv, tickets_agg)


def with_plan(current_sub: DataFrame, plans: DataFrame) -> DataFrame:
    """Current subscriptions with the name and tier of their plan."""
    return current_sub.join(plans.select("plan_id", "plan_name", "plan_tier"), "plan_id", "left")


def customer_360_from_buckets(customers: DataFrame, subs_with_plan: DataFrame, engagement: DataFrame, nps_agg: DataFrame,
                              onb_steps: DataFrame, ltv: DataFrame, tickets_agg: DataFrame) -> DataFrame:
    """:func:`customer_360` of inputs bucketed by ``customer_id`` alike: joins without an exchange.

    The plan is attached before a table is written, as a join by ``plan_id`` here would deal
    the rows anew.
    """
    return zero_filled(customers.join(subs_with_plan, "customer_id", "left"), engagement, nps_agg, onb_steps, ltv, tickets_agg)


def zero_filled(m: DataFrame, engagement: DataFrame, nps_agg: DataFrame, onb_steps: DataFrame, ltv: DataFrame, tickets_agg: DataFrame) -> DataFrame:
    """``m`` with the per-customer aggregates, absent metrics as zero, and ``is_churned``."""
    for right in (engagement, nps_agg, onb_steps, ltv, tickets_agg):
        m = m.join(right, "customer_id", "left")
    fills = {}
    for c in ZERO_FILLED:
        if c in m.columns:
            dtype = dict(m.dtypes)[c]
            zero = F.lit(0.0) if dtype in ("double", "float") or dtype.startswith("decimal") else F.lit(0)
            col = F.col(c).cast("double") if dtype.startswith("decimal") else F.col(c)
            fills[c] = F.coalesce(col, zero)
    m = m.withColumns(fills)
    return m.withColumn("is_churned", (~F.col("is_active")).cast("int"))
