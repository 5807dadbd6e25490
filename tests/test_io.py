"""Sinks, document reading and the streaming twin of activity cleaning."""

import json
import os
import tempfile

import pytest

from cohortium.plans import cleaning as C
from cohortium.sources import sinks
from cohortium.sources.tables import read_json_documents
from cohortium.streaming.activity import clean_activity_stream, read_activity_stream, start_clean_activity_sink


def test_lookup_requires_unique_key(spark):
    out = tempfile.mkdtemp(prefix="cohortium-lookup-")
    ok = spark.createDataFrame([(1, "free"), (2, "pro")], "customer_id long, plan_tier string")
    sinks.write_lookup_table(ok, out + "/t")
    sinks.write_lookup_table(ok, out + "/t")   # idempotent full refresh
    assert spark.read.parquet(out + "/t").count() == 2
    dup = spark.createDataFrame([(1, "free"), (1, "pro")], "customer_id long, plan_tier string")
    with pytest.raises(sinks.DuplicateKeyError):
        sinks.write_lookup_table(dup, out + "/t")
    assert spark.read.parquet(out + "/t").count() == 2   # a failed check leaves the old table


def test_csv_mart_keeps_nulls(spark):
    out = tempfile.mkdtemp(prefix="cohortium-mart-") + "/plans"
    df = spark.createDataFrame([(1, "Ent", None), (2, "Pro", 10)], "plan_id int, plan_name string, max_users int")
    sinks.write_mart(df, out, single_file=True)
    back = spark.read.option("header", True).schema(df.schema).csv(out).orderBy("plan_id").collect()
    assert back[0].max_users is None and back[1].max_users == 10


def _docs_dir():
    d = tempfile.mkdtemp(prefix="cohortium-docs-")
    docs = [{"_id": "a", "customer_id": "1", "timestamp": "2024-01-01 10:00:00", "event_type": "x",
             "session_duration_sec": -3},
            {"_id": "b", "customerId": 2, "timestamp": "2024-01-02T10:00:00Z", "event_type": "y"},
            {"_id": "c", "userID": "99", "timestamp": "2024-01-02", "event_type": "y", "session_duration_sec": 5}]
    with open(os.path.join(d, "part-0.json"), "w") as f:
        for x in docs:
            f.write(json.dumps(x) + "\n")
    return d


def test_read_json_documents_superset(spark):
    docs = read_json_documents(spark, _docs_dir())
    assert "_id" not in docs.columns and docs.count() == 3
    cust = spark.createDataFrame([(1,), (2,)], "customer_id long")
    clean = {r.customer_id: r.session_duration for r in C.clean_activity(docs, cust).collect()}
    assert clean == {1: 0.0, 2: 0.0}


def test_streaming_clean_matches_batch(spark):
    src = _docs_dir()
    out = tempfile.mkdtemp(prefix="cohortium-stream-")
    cust = spark.createDataFrame([(1,), (2,)], "customer_id long")
    q = start_clean_activity_sink(clean_activity_stream(read_activity_stream(spark, src), cust),
                                  out + "/table", out + "/ckpt", trigger_once=True)
    q.awaitTermination(120)
    got = {r.customer_id: r.session_duration for r in spark.read.parquet(out + "/table").collect()}
    assert got == {1: 0.0, 2: 0.0}


def test_export_dashboard_end_to_end(spark):
    from cohortium.jobs import export_dashboard
    from cohortium.sources.bindings import roles

    out = tempfile.mkdtemp(prefix="cohortium-export-")
    paths = export_dashboard(roles(spark, "/root/testdata/sf0.001"), out, seeds=range(42, 45))
    assert set(paths) >= {"customer_master", "monthly_churn_by_tier", "support_tickets", "monthly_engagement",
                          "plans", "churn_reasons"}
    master = spark.read.option("header", True).csv(paths["customer_master"])
    assert master.count() == spark.read.parquet("/root/testdata/sf0.001/customer.parquet").count()
    assert {"segment", "segment_name", "high_engagement", "recency_days"} <= set(master.columns)
    plans = spark.read.option("header", True).csv(paths["plans"])
    assert plans.count() == 5
    kpi = spark.read.option("header", True).csv(paths["kpi_cards"]).first()
    assert int(kpi["segment_count"]) >= 1
