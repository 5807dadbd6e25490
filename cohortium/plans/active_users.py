"""Distinct users per feature and period from bitmaps that can be merged.

A count of distinct users can't be added up: a week's users aren't the sum of its days'. Here
users get dense numbers once, and a stored table holds, per feature and day, a bitmap of the
users seen (a row per ``32,768`` user numbers). Any longer period, and any set of features, is
then an OR of stored bitmaps and a count of their ones: exact, and without reading an event
again. Events shrink to one row per (feature, day, user) before they meet the user numbers, so
a customer with a third of all events is a single row a day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortium.operators.ordinals import within_group_ordinals

PERIODS = ("day", "week", "month")
ALL = "(all)"


def user_numbers(activity: DataFrame) -> DataFrame:
    """(customer_id, uid): the customers with activity, numbered from 1 without gaps."""
    users = activity.where("customer_id IS NOT NULL").select("customer_id").distinct().withColumn("all", F.lit(0))
    return within_group_ordinals(users, ["all"], ["customer_id"], rn_col="rn", rank_col=None).select("customer_id", F.col("rn").alias("uid"))


def feature_day_bitmaps(activity: DataFrame, numbers: DataFrame) -> DataFrame:
    """(feature, day, bucket, users): the stored table; events without feature, user or time are left out."""
    known = activity.where("event_type IS NOT NULL AND customer_id IS NOT NULL AND ts IS NOT NULL")
    seen = known.select(F.col("event_type").alias("feature"), F.col("ts").cast("date").alias("day"), "customer_id").distinct()
    return seen.join(numbers, "customer_id").groupBy("feature", "day", F.bitmap_bucket_number("uid").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("uid")).alias("users"))


def active_users(bitmaps: DataFrame, periods=PERIODS) -> DataFrame:
    """(period, start, feature, users): distinct users of each feature, and of all (``(all)``),
    in every day, ISO week and month. The merge of one period starts from the one before."""
    out = None
    days = bitmaps.withColumnRenamed("day", "start")
    for period in periods:
        start = F.trunc("start", period) if period != "day" else F.col("start")
        merged = days.groupBy("feature", start.alias("start"), "bucket").agg(F.bitmap_or_agg("users").alias("users"))
        every = merged.groupBy(F.lit(ALL).alias("feature"), "start", "bucket").agg(F.bitmap_or_agg("users").alias("users"))
        counts = merged.unionByName(every).groupBy("feature", "start").agg(F.sum(F.bitmap_count("users")).alias("users"))
        counts = counts.select(F.lit(period).alias("period"), "start", "feature", "users")
        out = counts if out is None else out.unionByName(counts)
    return out
