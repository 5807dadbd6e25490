"""Subscription analyses: plan scorecard, LTV ranking, downgrades, growth, churn.

All functions take role DataFrames (see :mod:`cohortium.sources.bindings`)
and return lazy DataFrames. Scalar "max date" filters are real scalar
subqueries (``DataFrame.scalar()``), never cross joins. Rank, lag and
running values inside low-cardinality groups (tiers) use the distributed
ordinal operator, so no tier is ever sorted by a single task; windows are
only used over relations already aggregated to (tier, month) rows, whose
size is bounded by the calendar, not by the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortium.functions.numeric import safe_div, snap_round
from cohortium.operators.intervals import points_in_spans
from cohortium.operators.ordinals import Key, lag_within_groups, within_group_ordinals

# Fixed values from the reference: tier order, lowest first.
DEFAULT_TIERS = ["free", "starter", "professional", "enterprise"]
CHURNED_STATUSES = ["cancelled", "expired"]


def tier_rank_relation(spark: SparkSession, tiers=DEFAULT_TIERS) -> DataFrame:
    """Inline literal relation (tier, ordinal); its size is the parameter's length."""
    return spark.createDataFrame([(t, i + 1) for i, t in enumerate(tiers)],
                                 "plan_tier string, tier_level int")


def plans_with_levels(plans: DataFrame, tier_levels: DataFrame) -> DataFrame:
    return plans.join(F.broadcast(tier_levels), "plan_tier")


def _latest_key() -> F.Column:
    # ORDER BY start_date DESC (NULLS FIRST, as the SQL host does), then id
    return F.struct(F.col("start_date").isNull(), F.col("start_date"), F.col("subscription_id"))


def current_plan(subs: DataFrame, plans: DataFrame) -> DataFrame:
    """``DISTINCT ON (customer_id) … ORDER BY start_date DESC``: latest plan-matched subscription.

    A ``max_by`` aggregate: partial aggregation on the map side, so a
    customer with millions of rows never lands in one task.
    """
    j = subs.join(plans.select("plan_id", "plan_name", "plan_tier"), "plan_id")
    cols = [c for c in j.columns if c != "customer_id"]
    return (j.groupBy("customer_id")
            .agg(F.max_by(F.struct(*cols), _latest_key()).alias("s"))
            .select("customer_id", "s.*"))


def customer_tier_lookup(subs: DataFrame, plans: DataFrame) -> DataFrame:
    """customer → tier of the latest subscription; unique on customer_id by construction."""
    return current_plan(subs, plans).select("customer_id", "plan_tier")


def customer_tier_distribution(lookup: DataFrame) -> DataFrame:
    """Post-load verification: customers per tier."""
    return lookup.groupBy("plan_tier").agg(F.count(F.lit(1)).alias("customers"))


def current_subscription_lastvalue(subs: DataFrame, columns=("plan_id", "status", "mrr_usd", "billing_cycle")) -> DataFrame:
    """pandas ``sort_values('start_date').groupby(customer).last()``.

    ``last()`` takes the last *non-null* value of each column separately,
    with null start dates sorted last. One ``max_by`` per column whose
    ordering is NULL when the value is NULL (``max_by`` skips those rows). A
    column that ``subs`` lacks is skipped.
    """
    columns = [c for c in columns if c in subs.columns]
    order = F.struct(F.col("start_date").isNull(), F.col("start_date"), F.col("subscription_id"))
    aggs = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c) for c in columns]
    out = subs.groupBy("customer_id").agg(*aggs)
    return out.withColumnsRenamed({"status": "current_sub_status", "mrr_usd": "current_mrr"})


def customer_ltv(invoices: DataFrame, paid=("paid",)) -> DataFrame:
    """Paid invoice total per customer (customers with a paid invoice only)."""
    return (invoices.where(F.col("status").isin(*paid)).groupBy("customer_id")
            .agg(F.sum("total_usd").alias("total_ltv")))


def ltv_rank_by_tier(customers: DataFrame, invoices: DataFrame, subs: DataFrame, plans: DataFrame) -> DataFrame:
    """Rank customers by paid LTV inside the tier of their latest subscription.

    LTV is aggregated per customer *before* the join (partial aggregate);
    rank uses the distributed ordinals (ties share a rank, gaps follow);
    the tier mean is a grouped aggregate joined back (one row per tier).
    """
    ltv = customer_ltv(invoices)
    cl = (customers.select("customer_id", "company_name").join(ltv, "customer_id", "left")
          .withColumn("total_ltv", F.coalesce(F.col("total_ltv"), F.lit(0).cast("decimal(28,2)"))))
    cp = current_plan(subs, plans).select("customer_id", "plan_name", "plan_tier")
    base = cl.join(cp, "customer_id")
    tier = base.groupBy("plan_tier").agg(
        safe_div(F.sum("total_ltv"), F.count(F.lit(1))).alias("_tier_avg"))
    ranked = within_group_ordinals(base, ["plan_tier"], [Key("total_ltv", ascending=False)],
                                   ["customer_id"], rn_col="_rn", rank_col="ltv_rank")
    out = ranked.join(F.broadcast(tier), "plan_tier")  # one row per tier of the plan dimension
    ltv_d = F.col("total_ltv").cast("double")
    return out.select(
        "plan_tier", "plan_name", "customer_id", "company_name",
        ltv_d.alias("customer_ltv"),
        "ltv_rank",
        snap_round(F.col("_tier_avg"), 2).alias("tier_avg_ltv"),
        snap_round(safe_div(ltv_d - F.col("_tier_avg"), F.col("_tier_avg")) * 100, 2).alias("pct_diff_from_tier_avg"),
    ).orderBy("plan_tier", "ltv_rank", "customer_id")


def plan_changes(subs: DataFrame, plans: DataFrame, tier_levels: DataFrame) -> DataFrame:
    """Each subscription with the previous subscription's plan, tier, level and MRR.

    ``LAG(x) OVER (PARTITION BY customer ORDER BY start_date)``, nulls last
    and subscription_id as tie-break, computed inside range partitions.
    """
    sh = subs.join(plans_with_levels(plans, tier_levels), "plan_id")
    lagged = lag_within_groups(sh, ["customer_id"], [Key("start_date", nulls_first=False)],
                               ["subscription_id"], ["plan_name", "plan_tier", "tier_level", "mrr_usd"])
    return lagged.withColumnRenamed("prev_mrr_usd", "prev_mrr")


def downgrades_after_tickets(subs: DataFrame, plans: DataFrame, tier_levels: DataFrame, customers: DataFrame,
                             tickets: DataFrame, recent_days: int = 90, before_days: int = 30,
                             min_tickets: int = 3) -> DataFrame:
    """Downgrades in the last ``recent_days`` (before the latest start date) with
    more than ``min_tickets`` tickets in ``[downgrade − before_days, downgrade)``.
    """
    max_start = subs.select(F.max("start_date")).scalar()
    recent = F.col("start_date") >= F.date_sub(max_start, recent_days)
    # only customers with a subscription in the window need their history
    # ordered; all of their rows are kept, so the lag values are unchanged
    movers = subs.where(recent).select("customer_id").distinct()
    sh = plan_changes(subs.join(movers, "customer_id", "left_semi"), plans, tier_levels)
    rd = (sh.where(F.col("prev_tier_level").isNotNull()
                   & (F.col("tier_level") < F.col("prev_tier_level"))
                   & recent)
          .join(customers.select("customer_id", "company_name", "contact_name", "contact_email"), "customer_id"))
    counts = count_in_window_before(rd.select("subscription_id", "customer_id", "start_date"), tickets, before_days)
    counted = rd.join(counts, "subscription_id", "left").withColumn(
        "tickets_before_downgrade", F.coalesce(F.col("tickets_before_downgrade"), F.lit(0)).cast("long"))
    return counted.where(F.col("tickets_before_downgrade") > min_tickets).select(
        "customer_id", "company_name", "contact_name",
        F.col("prev_plan_name").alias("previous_plan"), F.col("prev_plan_tier").alias("previous_tier"),
        F.col("plan_name").alias("current_plan"), F.col("plan_tier").alias("current_tier"),
        F.col("start_date").alias("downgrade_date"),
        F.col("prev_mrr").cast("double").alias("previous_mrr"), F.col("mrr_usd").cast("double").alias("current_mrr"),
        F.round(F.col("prev_mrr") - F.col("mrr_usd"), 2).cast("double").alias("mrr_loss"),
        "tickets_before_downgrade",
    ).orderBy(F.desc("tickets_before_downgrade"), F.desc("mrr_loss"), "customer_id", "downgrade_date")


def count_in_window_before(events: DataFrame, tickets: DataFrame, days: int) -> DataFrame:
    """Tickets of the same customer in ``[start_date − days, start_date)`` per event row.

    Interval join without a per-customer cross product: tickets are bucketed
    by ``days``-wide day buckets, each event looks up the (at most two)
    buckets its window overlaps, and the equi-join runs on (customer,
    bucket) with the exact range as a residual. It is an inner join, so AQE
    may split a hot customer on either side; events without tickets get
    their 0 from the caller's left join on the unique event key.
    """
    width = max(int(days), 1)
    day = F.unix_date(F.col("created_at").cast("date"))
    t = tickets.select(F.col("customer_id").alias("_tc"), "ticket_id", F.col("created_at").alias("_tat"),
                       F.floor(day / width).alias("_b"))
    lo_day = F.unix_date(F.date_sub(F.col("start_date"), days))
    hi_day = F.unix_date(F.col("start_date")) - 1
    e = events.select("subscription_id", "customer_id", "start_date",
                      F.explode(F.sequence(F.floor(lo_day / width), F.floor(hi_day / width))).alias("_b"))
    lo = F.date_sub(F.col("start_date"), days).cast("timestamp_ntz")
    hi = F.col("start_date").cast("timestamp_ntz")
    j = e.join(t, (e.customer_id == t._tc) & (e._b == t._b) & (t._tat >= lo) & (t._tat < hi))
    return j.groupBy("subscription_id").agg(F.count("ticket_id").alias("tickets_before_downgrade"))


def plan_scorecard(plans: DataFrame, subs: DataFrame, tickets: DataFrame, months: int = 6) -> DataFrame:
    """Per plan: active customers, mean MRR, tickets of the last ``months`` months and
    the ticket rate per customer per month.

    The window ends at the latest ticket *date* (midnight), as in the
    reference; tickets are counted per customer before the join.
    """
    ref = tickets.select(F.max("created_at").cast("date")).scalar()
    lo = F.add_months(ref, -months).cast("timestamp_ntz")
    hi = ref.cast("timestamp_ntz")
    tc = (tickets.where((F.col("created_at") >= lo) & (F.col("created_at") <= hi))
          .groupBy("customer_id").agg(F.count(F.lit(1)).alias("ticket_count")))
    active = subs.where(F.col("status") == "active").join(plans.select("plan_id", "plan_name", "plan_tier"), "plan_id")
    j = active.join(tc, "customer_id", "left")
    g = j.groupBy("plan_name", "plan_tier").agg(
        F.count_distinct("customer_id").alias("active_customers"),
        safe_div(F.sum("mrr_usd"), F.count("mrr_usd")).alias("_avg_mrr"),
        F.coalesce(F.sum("ticket_count"), F.lit(0)).cast("long").alias("total_tickets_6mo"))
    return g.select(
        "plan_name", "plan_tier", "active_customers",
        snap_round(F.col("_avg_mrr"), 2).alias("avg_monthly_revenue"),
        "total_tickets_6mo",
        snap_round(safe_div(F.col("total_tickets_6mo"), F.col("active_customers") * months), 4)
        .alias("ticket_rate_per_customer_per_month"),
    ).orderBy(F.desc("active_customers"), "plan_name")


def new_subs_mom_growth(subs: DataFrame) -> DataFrame:
    """New subscriptions per month and growth against the previous month present.

    The window runs over one row per month (bounded by the calendar).
    """
    m = subs.groupBy(F.trunc("start_date", "MM").alias("sub_month")).agg(
        F.count(F.lit(1)).alias("new_subscriptions"))
    w = Window.orderBy("sub_month")
    m = m.withColumn("prev_month_subs", F.lag("new_subscriptions").over(w))
    return m.withColumn(
        "mom_growth_rate_pct",
        snap_round(safe_div(F.col("new_subscriptions") - F.col("prev_month_subs"), F.col("prev_month_subs")) * 100, 2),
    ).orderBy("sub_month")


def monthly_churn_by_tier(subs_end: DataFrame, plans: DataFrame, statuses=CHURNED_STATUSES) -> DataFrame:
    """Churned subscriptions per end month and tier (status in ``statuses``, end date known)."""
    s = subs_end.where(F.col("status").isin(*statuses) & F.col("end_date").isNotNull())
    return (s.join(plans.select("plan_id", "plan_tier"), "plan_id")
            .groupBy(F.trunc("end_date", "MM").alias("churn_month"), "plan_tier")
            .agg(F.count(F.lit(1)).alias("churned_count")))


def _months_from(first: F.Column, d: F.Column) -> F.Column:
    """Index of the first month start on or after ``d`` (``first`` is a month start)."""
    k = F.months_between(F.trunc(d, "MM"), first).cast("int")
    return k + F.when(F.dayofmonth(d) > 1, 1).otherwise(0)


def month_calendar(subs_end: DataFrame, as_of=None) -> DataFrame:
    """One row: the first month start and the number of month starts of the calendar.

    The calendar runs from the month of the earliest start to the latest of
    ``end_date`` / ``as_of`` (``as_of`` defaults to the latest date in the
    data). All bounds come from a single aggregate pass.
    """
    b = subs_end.agg(F.trunc(F.min("start_date"), "MM").alias("first"), F.max("start_date").alias("max_start"),
                     F.max("end_date").alias("max_end"), F.count_if(F.col("end_date").isNull()).alias("open_n"))
    as_of_c = F.greatest("max_start", "max_end") if as_of is None else F.lit(as_of).cast("date")
    # MAX(COALESCE(end_date, as_of)) from the same row
    last = F.when(F.col("open_n") > 0, F.greatest(F.col("max_end"), as_of_c)).otherwise(F.col("max_end"))
    return b.select("first", (F.months_between(F.trunc(last, "MM"), F.col("first")).cast("int") + 1).alias("n_points"))


def active_by_month(subs_end: DataFrame, plans: DataFrame, as_of=None) -> DataFrame:
    """Subscriptions active at each month start, per tier (interval stabbing).

    Active at m ⇔ start ≤ m and (end is NULL or end > m). Instead of joining
    every span to every month, each subscription contributes +1 at the first
    month start it covers and −1 at the first month start after it ends; a
    running sum over the (tier, month) totals gives the counts. Input work is
    linear; the running sum runs over tiers × months rows. The one-row
    calendar (:func:`month_calendar`) enters as two merged scalar subqueries.
    """
    cal = month_calendar(subs_end, as_of)
    # two scalar subqueries over the same one-row aggregate: merged and run once
    first, n_points = cal.select("first").scalar(), cal.select("n_points").scalar()
    s = subs_end.join(plans.select("plan_id", "plan_tier"), "plan_id").select(
        "plan_tier",
        _months_from(first, F.col("start_date")).alias("k0"),
        F.when(F.col("end_date").isNull(), n_points)
        .otherwise(F.least(_months_from(first, F.col("end_date")), n_points)).alias("k1"))
    s = s.where((F.col("k0") < F.col("k1")) & (F.col("k0") < n_points))
    deltas = (s.select("plan_tier", F.col("k0").alias("k"), F.lit(1).alias("d"))
              .unionByName(s.where(F.col("k1") < n_points).select("plan_tier", F.col("k1").alias("k"), F.lit(-1).alias("d")))
              .groupBy("plan_tier", "k").agg(F.sum("d").alias("d")))
    # every month of each tier from its first delta on (tiers × months rows)
    span = deltas.groupBy("plan_tier").agg(F.min("k").alias("kmin")).select(
        "plan_tier", F.explode(F.sequence(F.col("kmin"), n_points - 1)).alias("k"))
    filled = span.join(deltas, ["plan_tier", "k"], "left")
    w = Window.partitionBy("plan_tier").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    run = filled.withColumn("active_at_start", F.sum(F.coalesce(F.col("d"), F.lit(0))).over(w))
    return run.where(F.col("active_at_start") > 0).select(
        F.add_months(first, F.col("k")).alias("month_start"), "plan_tier",
        F.col("active_at_start").cast("long").alias("active_at_start"))


# Fixed value from the reference: the text of the alert.
ALERT = "ALERT: Churn > 2x rolling avg"


def churn_rate_rolling(subs_end: DataFrame, plans: DataFrame, as_of=None) -> DataFrame:
    """Churn rate per tier-month, 3-row rolling mean and a 2× alert flag.

    Rows exist only for months with active subscriptions (inner join in the
    reference), so the 3-row frame can span a gap. The rate can exceed 100:
    a subscription that starts and ends inside one month is counted as
    churned but was never active at a month start. The rounded rate is kept
    as an exact DECIMAL, so the frame mean and the alert compare exactly.
    """
    ma = active_by_month(subs_end, plans, as_of)
    mc = monthly_churn_by_tier(subs_end, plans).withColumnRenamed("churn_month", "month_start")
    j = ma.join(mc, ["month_start", "plan_tier"], "left").withColumn(
        "churned_count", F.coalesce(F.col("churned_count"), F.lit(0)).cast("long"))
    rate = F.round((safe_div(F.col("churned_count"), F.col("active_at_start")) * 100).cast("decimal(30,6)"), 4) \
        .cast("decimal(20,4)")
    j = j.withColumn("_rate", rate)
    w = Window.partitionBy("plan_tier").orderBy("month_start").rowsBetween(-2, 0)
    j = j.withColumn("_sum3", F.sum("_rate").over(w)).withColumn("_n3", F.count("_rate").over(w))
    return j.select(
        F.col("month_start").alias("churn_month"), "plan_tier", "churned_count", "active_at_start",
        F.col("_rate").cast("double").alias("churn_rate_pct"),
        snap_round(safe_div(F.col("_sum3"), F.col("_n3")), 4).alias("rolling_3mo_avg_churn"),
        F.when(F.col("_rate") * F.col("_n3") > F.col("_sum3") * 2, F.lit(ALERT)).otherwise(F.lit("Normal"))
        .alias("churn_flag"),
    ).orderBy("plan_tier", "churn_month")


def tickets_in_subscription(subs_end: DataFrame, tickets: DataFrame) -> DataFrame:
    """(subscription, ticket) pairs of a customer: tickets on a day of the subscription's span.

    Spans have any length and may be open; the pairs come from an equi-join on dyadic runs
    of days (:mod:`cohortium.operators.intervals`).
    """
    spans = subs_end.select("subscription_id", "customer_id", "start_date", "end_date")
    found = points_in_spans(spans, tickets.select("ticket_id", "customer_id", "created_at"), ["customer_id"], "start_date", "end_date", "created_at")
    return found.withColumn("days_in", F.datediff(F.col("created_at").cast("date"), "start_date"))
