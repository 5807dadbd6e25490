"""End-to-end batch job: clean → customer-360 → tests → segments → dashboard marts.

The same work the reference's analysis program does in one run, as one
Spark application. The customer-360 is built once and its lineage is cut
with a reliable checkpoint (in the folder named by ``spark.checkpoint.dir``),
because the statistics, the segmentation and three marts all read it. Every
output is written with ``overwrite``, so a re-run after a failure gives the
same files.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortium.plans import activity as A
from cohortium.plans import cleaning as C
from cohortium.plans import customer360 as X
from cohortium.plans import marts as M
from cohortium.plans import segments as G
from cohortium.plans import slices as L
from cohortium.plans import stats as T
from cohortium.plans import subscriptions as S
from cohortium.session import ensure_checkpoint_dir
from cohortium.sources.bucketed import write_bucketed
from cohortium.sources.sinks import write_mart


@dataclass
class Roles:
    """Input role tables (see :mod:`cohortium.sources.bindings` for the columns)."""

    customers: DataFrame
    plans: DataFrame
    subscriptions: DataFrame          # with end_date
    invoices: DataFrame
    tickets: DataFrame
    activity_docs: DataFrame
    nps_docs: DataFrame
    onboarding_docs: DataFrame


def build_customer_360(r: Roles, flagged_ids=C.DEFAULT_FLAGGED_IDS) -> DataFrame:
    activity = C.prepared_activity(r.activity_docs)
    return X.customer_360(
        C.clean_customers(r.customers, flagged_ids), S.current_subscription_lastvalue(r.subscriptions), r.plans,
        A.engagement_by_customer(activity, r.customers), A.nps_by_customer(C.clean_nps(r.nps_docs)),
        A.onboarding_depth(C.clean_onboarding(r.onboarding_docs)), S.customer_ltv(r.invoices),
        X.ticket_summary(r.tickets))


def staged_customer_360(r: Roles, prefix: str, buckets: int, flagged_ids=C.DEFAULT_FLAGGED_IDS, folder: str | None = None) -> DataFrame:
    """The customer-360 over tables bucketed by ``customer_id`` (``<prefix>_customers`` ...).

    Each input is shuffled once, when its table is written; the 360 and whatever else
    joins these tables per customer then shuffles nothing.
    """
    activity = C.prepared_activity(r.activity_docs)
    inputs = {
        "customers": C.clean_customers(r.customers, flagged_ids),
        "subscriptions": X.with_plan(S.current_subscription_lastvalue(r.subscriptions), r.plans),
        "engagement": A.engagement_by_customer(activity, r.customers),
        "nps": A.nps_by_customer(C.clean_nps(r.nps_docs)),
        "onboarding": A.onboarding_depth(C.clean_onboarding(r.onboarding_docs)),
        "ltv": S.customer_ltv(r.invoices), "tickets": X.ticket_summary(r.tickets)}
    return X.customer_360_from_buckets(*(write_bucketed(df, f"{prefix}_{name}", "customer_id", buckets, folder) for name, df in inputs.items()))


def export_dashboard(r: Roles, out_dir: str, as_of=None, k: int = 4, seeds=range(42, 52)) -> dict[str, str]:
    """Run the whole analysis and write the six marts plus the test results.

    Returns {name: path}. ``as_of`` fixes "today" for recency (default: the
    latest activity in the data).
    """
    ensure_checkpoint_dir(r.customers.sparkSession)
    c360 = build_customer_360(r).checkpoint(eager=True)
    # events are cleaned once: the engagement mart and the quality report read the stored rows
    staged = C.staged_activity(r.activity_docs, r.customers).checkpoint(eager=True)
    feats = G.segment_features(c360, as_of)
    segs = G.segment_customers(feats, k=k, seeds=seeds)
    master = (c360.join(feats.select("customer_id", "recency_days"), "customer_id", "left")
              .join(segs, "customer_id", "left"))
    names = G.name_segments(G.segment_profile(master)).select("segment", "segment_name")
    master = master.join(F.broadcast(names), "segment", "left")
    hi = _high_engagement(c360)
    master = master.join(hi, "customer_id", "left")
    out = {
        "customer_master": M.mart_customer_master(master),
        "monthly_churn_by_tier": M.mart_monthly_churn(r.subscriptions, r.plans),
        "support_tickets": M.mart_support_tickets(r.tickets, C.clean_customers(r.customers),
                                                  S.current_subscription_lastvalue(r.subscriptions), r.plans),
        "monthly_engagement": M.mart_monthly_engagement(C.activity_from_staged(staged)),
        "plans": M.mart_plans(r.plans),
        "churn_reasons": M.mart_churn_reasons(master),
        "kpi_cards": M.kpi_cards(master),
        "welch_test": T.welch_test(c360),
        "chi_square_test": T.chi_square_engagement(c360),
        "churn_contingency": T.churn_contingency(c360),
        "segment_profile": G.name_segments(G.segment_profile(master)),
        "quality_report_activity": C.report_from_staged(staged),
        "quality_report_nps": C.quality_report_nps(r.nps_docs),
        "quality_report_onboarding": C.quality_report_onboarding(r.onboarding_docs),
        "quality_report_customers": C.quality_report_customers(r.customers),
        "kpi_cube": L.kpi_cube(L.kpi_cells(master)),
        "churn_reason_cube": L.churn_reason_cube(master),
    }
    paths = {}
    bounded = {"monthly_churn_by_tier", "monthly_engagement", "plans", "kpi_cards", "welch_test",
               "chi_square_test", "churn_contingency", "segment_profile", "quality_report_activity", "quality_report_nps",
               "quality_report_onboarding", "quality_report_customers", "kpi_cube", "churn_reason_cube"}
    for name, df in out.items():
        paths[name] = write_mart(df, f"{out_dir}/{name}", fmt="csv", single_file=name in bounded)
    return paths


def _high_engagement(c360: DataFrame) -> DataFrame:
    """customer → 1 when total_events is above the exact median (as in the chi-square test)."""
    from cohortium.operators.scalars import attach_one_row
    from cohortium.operators.selection import few_group_percentiles

    j = attach_one_row(c360.select("customer_id", "total_events"), few_group_percentiles(c360, [], "total_events", {"m": 0.5}))
    return j.select("customer_id", (F.col("total_events") > F.col("m")).cast("int").alias("high_engagement"))
