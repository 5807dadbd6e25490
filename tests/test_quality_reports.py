"""Quality reports in one scan, and the cleaned events that the same stored rows give."""

import pytest

import __spark_entry__ as E
from cohortium.plans import cleaning as C
from cohortium.sources import bindings as B

SF = "/root/testdata/sf0.001"


def test_staged_rows_give_the_cleaned_events_and_their_report(spark):
    docs, customers = B.activity_docs(spark, SF), B.customers(spark, SF)
    staged = C.staged_activity(docs, customers)
    want = C.clean_activity(docs, customers)
    got = C.activity_from_staged(staged).select(*want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    r = C.report_from_staged(staged).first()
    assert r.rows_before == docs.count() and r.rows_after == want.count()
    assert r.rows_after_dedupe == C.normalize_activity(docs).distinct().count() == r.rows_after + r.orphan_rows


def test_repeated_and_null_customers(spark):
    customers = spark.createDataFrame([(1,), (1,), (None,)], "customer_id long")
    docs = spark.createDataFrame([("1", "2024-01-01", "a", 5.0)] * 3 + [("2", "2024-01-01", "a", None), (None, None, None, -1.0), ("1", "2024-01-02", "a", -2.0)],
                                 "customer_id string, timestamp string, event_type string, session_duration_sec double")
    r = C.quality_report_activity(docs, customers).first()
    assert tuple(r) == (6, 4, 2, 0, 1, 2)
    assert tuple(C.quality_report_activity(docs.limit(0), customers).first()) == (0, 0, 0, 0, 0, 0)


@pytest.mark.parametrize("key, table", [("quality_report_activity", "events"), ("quality_report_nps", "events"), ("quality_report_customers", "customer")])
def test_one_scan_per_report(spark, key, table):
    plan = E.queries()[key](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    scans = [line for line in plan.split("\n") if "Relation" in line and f"{'c_custkey' if table == 'customer' else 'event_id'}" in line]
    # the documents are a union of two readings of the events, the second for purchases
    assert len(scans) <= (2 if key == "quality_report_activity" else 1), plan
