"""Driver contract and a full oracle sweep at the smallest scale factor."""


import duckdb
import pytest

import __spark_entry__ as E
from cohortium.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["plan_tier", "plan_name", "customer_id", "company_name", "customer_ltv", "ltv_rank",
                          "tier_avg_ltv", "pct_diff_from_tier_avg"]


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 60


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _norm(v):
    import datetime as dt
    import decimal
    if v is None:
        return None
    if isinstance(v, float):
        return None if v != v else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)


KEYS = sorted(E.oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF)
    s_rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[key])
    o_cols = [c[0] for c in cur.description]
    o_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(o_cols)
    assert _rows(df.columns, s_rows) == _rows(o_cols, o_rows)
