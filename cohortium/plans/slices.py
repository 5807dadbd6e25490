"""Dashboard datasets for every choice of the slicers, from one pass over the customers.

The two slicers are plan tier and segment name. One aggregate reduces the customer master to
*cells*, a row of mergeable sums and counts per (tier, segment name, segment); everything a
slicer can ask is then a merge of cells:

* :func:`kpi_cube`: the KPI cards of all single choices at once (both slicers set, either, or
  none), told apart by ``grouping_id`` (bit 2: any tier, bit 1: any segment name);
* :func:`kpi_choice`: the cards of a choice of several tiers and segment names;
* :func:`churn_reason_cube`: churn reasons with their rank inside every slice.

Cells number at most tiers × segments (× reasons), whatever the number of customers, so the
cubes cost nothing beside the one aggregate, which combines on the map side. NULL tiers and
names are cells like any other: under a set slicer they are their own slice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortium.functions.numeric import safe_div, snap_round

SLICERS = ["plan_tier", "segment_name"]
_SUMS = ["customers", "churned", "active_ltv", "active_n", "churned_ltv", "churned_n"]


def kpi_cells(master: DataFrame) -> DataFrame:
    """Mergeable partials per (plan_tier, segment_name, segment); money as exact decimals."""
    ltv = F.col("total_ltv").cast("decimal(30,6)")
    active, churned = F.col("is_churned") == 0, F.col("is_churned") == 1
    return master.groupBy(*SLICERS, "segment").agg(
        F.count(F.lit(1)).alias("customers"), F.count_if(churned).alias("churned"),
        F.sum(F.when(active, ltv)).alias("active_ltv"), F.count(F.when(active, ltv)).alias("active_n"),
        F.sum(F.when(churned, ltv)).alias("churned_ltv"), F.count(F.when(churned, ltv)).alias("churned_n"))


def _merged() -> list:
    return [*(F.sum(c).alias(c) for c in _SUMS), F.count_distinct("segment").alias("segment_count")]


def _cards(merged: DataFrame, *keys: str) -> DataFrame:
    return merged.select(
        *keys, F.coalesce("customers", F.lit(0)).cast("long").alias("total_customers"), F.coalesce("churned", F.lit(0)).cast("long").alias("churned_customers"),
        snap_round(safe_div(F.col("churned"), F.col("customers")) * 100, 1).alias("churn_rate_pct"),
        snap_round(safe_div(F.col("active_ltv"), F.col("active_n")), 2).alias("avg_ltv_active"),
        snap_round(safe_div(F.col("churned_ltv"), F.col("churned_n")), 2).alias("avg_ltv_churned"), "segment_count")


def kpi_cube(cells: DataFrame) -> DataFrame:
    """The KPI cards of every slice of ``cells``, a row per slice."""
    return _cards(cells.cube(*SLICERS).agg(F.grouping_id().alias("grouping_id"), *_merged()), "grouping_id", *SLICERS)


def kpi_choice(cells: DataFrame, plan_tiers=None, segment_names=None) -> DataFrame:
    """The KPI cards (one row) of the chosen tiers and segment names; None chooses all."""
    for column, chosen in zip(SLICERS, (plan_tiers, segment_names)):
        if chosen is not None:
            cells = cells.where(F.col(column).isin(*chosen))
    return _cards(cells.agg(*_merged()))


def churn_reason_cube(master: DataFrame) -> DataFrame:
    """Churned customers and mean LTV per reason in every slice, ranked inside the slice
    (ties by reason text). The ranking sees a row per slice and reason."""
    churned = master.where((F.col("is_churned") == 1) & F.col("churn_reason").isNotNull())
    ltv = F.col("total_ltv").cast("decimal(30,6)")
    cells = churned.groupBy(*SLICERS, "churn_reason").agg(F.count(F.lit(1)).alias("n"), F.sum(ltv).alias("ltv"), F.count(ltv).alias("n_ltv"))
    every = cells.groupingSets([[*SLICERS, "churn_reason"], ["plan_tier", "churn_reason"], ["segment_name", "churn_reason"], ["churn_reason"]],
                               *SLICERS, "churn_reason").agg(F.grouping_id().alias("gid"), F.sum("n").alias("count"), F.sum("ltv").alias("ltv"), F.sum("n_ltv").alias("n_ltv"))
    # the reason is in every set: its bit is never set
    every = every.withColumn("grouping_id", F.expr("gid div 2"))
    place = Window.partitionBy("grouping_id", *SLICERS).orderBy(F.desc("count"), "churn_reason")
    return every.select("grouping_id", *SLICERS, "churn_reason", "count", snap_round(safe_div(F.col("ltv"), F.col("n_ltv")), 2).alias("avg_ltv"),
                        F.row_number().over(place).alias("reason_rank"))
