"""RFM-style segmentation: features, standardisation, k-means, profiles and names.

Standardisation statistics are one aggregate row attached to every row;
k-means is best-of-n k-means++/Lloyd with all starts sharing each pass over
the data (:mod:`cohortium.operators.kmeans`). Cluster ids are arbitrary, so
they are relabelled by descending centre LTV to make runs comparable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortium.functions.numeric import snap_bround
from cohortium.functions.time import days_between
from cohortium.operators.kmeans import assign_clusters, multi_start_kmeans
from cohortium.operators.scalars import attach_one_row
from cohortium.session import ensure_checkpoint_dir

FEATURES = ["recency_days", "total_events", "total_ltv", "avg_session_duration", "distinct_features"]
# Fixed value from the reference: recency of a customer without activity.
NO_ACTIVITY_DAYS = 999
# Fixed values from the reference: segment names, in rule order.
SEGMENT_NAMES = ["Champions", "Engaged Free/Low-Tier", "At-Risk / Dormant", "Steady Users"]


def recency_days(last_activity, as_of) -> F.Column:
    """Whole days since the last activity (floor), 999 when there is none."""
    return F.coalesce(F.floor(days_between(as_of, last_activity)).cast("long"), F.lit(NO_ACTIVITY_DAYS).cast("long"))


def segment_features(c360: DataFrame, as_of=None) -> DataFrame:
    """The five features (NULL → 0) and their z-scores (population sd; constant → 0)."""
    as_of_c = c360.select(F.max("last_activity")).scalar() if as_of is None else F.lit(as_of).cast("timestamp_ntz")
    f = c360.select("customer_id", recency_days(F.col("last_activity"), as_of_c).cast("double").alias("recency_days"),
                    *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in FEATURES[1:]])
    stats = f.agg(*[F.avg(c).alias("_m_" + c) for c in FEATURES], *[F.stddev_pop(c).alias("_s_" + c) for c in FEATURES])
    j = attach_one_row(f, stats)
    z = {"z_" + c: F.when(F.col("_s_" + c) > 0, (F.col(c) - F.col("_m_" + c)) / F.col("_s_" + c)).otherwise(F.lit(0.0))
         for c in FEATURES}
    return j.withColumns(z).drop(*[x for x in j.columns if x.startswith("_m_") or x.startswith("_s_")])


def segment_customers(features: DataFrame, k: int = 4, seeds=range(42, 52), max_iter: int = 300,
                      tol: float = 1e-4, centres=None) -> DataFrame:
    """K-means on the z-scores: k-means++ seeding, best of ``len(seeds)`` starts by
    inertia (ties: first start).

    All starts advance in the same passes over the data
    (:mod:`cohortium.operators.kmeans`). Returns (customer_id, segment) with
    segment 0 = highest centre LTV. ``centres`` (k points in z-score space) replaces
    the seeding by one given start.
    """
    zcols = ["z_" + c for c in FEATURES]
    # the starts iterate over the same rows many times: cut the lineage once
    # (reliable checkpoint in the shared checkpoint folder)
    ensure_checkpoint_dir(features.sparkSession)
    spark = features.sparkSession
    data = features.select("customer_id", *zcols).repartition(spark.sparkContext.defaultParallelism).checkpoint(eager=True)
    if centres is not None:
        k, centres = len(centres), [centres]
    centres, _, _ = multi_start_kmeans(data, "customer_id", zcols, k, seeds, max_iter=max_iter, tol=tol, init_centres=centres)
    if centres is None:  # no customers
        return data.select("customer_id", F.lit(None).cast("int").alias("segment"))
    ltv_pos = FEATURES.index("total_ltv")
    order = sorted(range(len(centres)), key=lambda i: (-centres[i][ltv_pos], i))
    relabel = F.create_map(*[x for new, old in enumerate(order) for x in (F.lit(old), F.lit(new))])
    return data.select("customer_id", relabel[assign_clusters(zcols, centres)].alias("segment"))


def segment_profile(master: DataFrame, segment_col: str = "segment") -> DataFrame:
    """Eight means per segment, rounded half-even to 2 decimals."""
    p = master.groupBy(F.col(segment_col).alias("segment")).agg(
        F.count("customer_id").alias("count"),
        snap_bround(F.avg("is_churned"), 2).alias("churn_rate"),
        snap_bround(F.avg("total_events"), 2).alias("avg_events"),
        snap_bround(F.avg("total_ltv"), 2).alias("avg_ltv"),
        snap_bround(F.avg("avg_session_duration"), 2).alias("avg_session_dur"),
        snap_bround(F.avg("distinct_features"), 2).alias("avg_features"),
        snap_bround(F.avg("ticket_count"), 2).alias("avg_tickets"),
        snap_bround(F.avg("recency_days"), 2).alias("avg_recency"))
    return p


def name_segments(profile: DataFrame) -> DataFrame:
    """First matching rule against the unweighted mean over segments of the rounded
    profile values (strict inequalities); several segments may share a name.

    The means run over one row per segment (k rows).
    """
    w = Window.partitionBy()
    m = {c: F.avg(c).over(w) for c in ("avg_ltv", "churn_rate", "avg_events")}
    name = (F.when((F.col("avg_ltv") > m["avg_ltv"]) & (F.col("churn_rate") < m["churn_rate"]), SEGMENT_NAMES[0])
            .when((F.col("avg_events") > m["avg_events"]) & (F.col("avg_ltv") < m["avg_ltv"]), SEGMENT_NAMES[1])
            .when((F.col("churn_rate") > m["churn_rate"]) & (F.col("avg_events") < m["avg_events"]), SEGMENT_NAMES[2])
            .otherwise(SEGMENT_NAMES[3]))
    return profile.withColumn("segment_name", name)
