"""The customer-360 over bucketed tables: same rows, and no exchange however often it is read."""

import uuid

from pyspark.sql import functions as F

from cohortium import jobs
from cohortium.sources.bindings import roles
from cohortium.sources.bucketed import buckets_for, write_bucketed

SF = "/root/testdata/sf0.001"


def test_no_exchange_between_per_customer_tables(spark):
    r = roles(spark, SF)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = jobs.staged_customer_360(r, f"t{uuid.uuid4().hex[:8]}", 4)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 6 and "Exchange" not in plan
        again = got.groupBy("customer_id").agg(F.max("total_ltv").alias("ltv"))._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in again  # dependants by customer need none either
        want = jobs.build_customer_360(r).select(*got.columns)
        assert got.exceptAll(want).count() == 0 and got.count() == want.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_null_keys_and_bucket_counts(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c"), (None, "d")], "k long, v string")
    t = write_bucketed(df, f"t{uuid.uuid4().hex[:8]}", "k", 4)
    assert sorted(r.v for r in t.collect()) == ["a", "b", "c", "d"] and t.join(t.withColumnRenamed("v", "w"), "k").count() == 2
    assert write_bucketed(df.limit(0), f"t{uuid.uuid4().hex[:8]}", "k", 4).count() == 0
    assert [buckets_for(n) for n in (0, 1, 16_000_000, 2_000_000_000)] == [8, 8, 8, 1024]
