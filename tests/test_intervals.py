"""Dyadic interval join and mergeable distinct users, against plain search and counting."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cohortium.operators import intervals as I
from cohortium.plans import active_users as U

DAY0 = dt.date(1970, 1, 1)


def test_cover_is_the_disjoint_union(spark):
    rnd = random.Random(1)
    cases = [(a, a + n) for a in (0, 1, 7, 8, 15, 16, 1000) for n in (-1, 0, 1, 2, 7, 8, 9)] + [
        tuple(sorted(rnd.randrange(1 << I.LEVELS) for _ in "ab")) for _ in range(150)] + [(0, (1 << I.LEVELS) - 1), (5, None), (None, 5)]
    df = spark.createDataFrame(cases, "a int, b int")
    for r in df.select("a", "b", I.dyadic_cover(F.col("a"), F.col("b")).alias("runs")).collect():
        if r.a is None or r.b is None:
            assert r.runs is None
            continue
        parts = sorted((x.run << x.level, (x.run + 1 << x.level) - 1) for x in r.runs)
        assert len(parts) <= 2 * max(1, (r.b - r.a + 1).bit_length())
        assert (parts[0][0], parts[-1][1]) == (r.a, r.b) if parts else r.b < r.a
        assert all(p[1] + 1 == q[0] for p, q in zip(parts, parts[1:]))


def test_points_in_spans_equal_a_search(spark):
    rnd = random.Random(2)
    spans = [(i, rnd.choice([1, 2, 3, None]), rnd.choice([None, *range(0, 900, 7)]), rnd.choice([None, *range(0, 1200, 11)])) for i in range(200)]
    points = [(i, rnd.choice([1, 1, 1, 2, None]), rnd.choice([None, *range(0, 1300)])) for i in range(400)]

    def date(d):
        return None if d is None else DAY0 + dt.timedelta(days=d)

    s = spark.createDataFrame([(i, k, date(a), date(b)) for i, k, a, b in spans], "sid int, k int, a date, b date")
    p = spark.createDataFrame([(i, k, None if d is None else dt.datetime.combine(date(d), dt.time(23, 59))) for i, k, d in points], "pid int, k int, at timestamp_ntz")
    out = I.points_in_spans(s, p, ["k"], "a", "b", "at")
    assert set(out.columns) == {"k", "sid", "a", "b", "pid", "at"}
    got = sorted((r.sid, r.pid) for r in out.collect())
    assert got == sorted((i, j) for i, k, a, b in spans for j, q, d in points if k == q and None not in (k, a, d) and a <= d and (b is None or d <= b))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner, (" in plan and ">=" not in plan.split("Join Inner")[1].split("\n")[0]


def test_points_of_few_spans_are_not_multiplied(spark, monkeypatch):
    """Keys of few spans meet without the tree, whose rows for every point made the shuffle large."""
    rnd = random.Random(5)
    spans = [(i, k, rnd.choice([None, *range(0, 900, 7)]), rnd.choice([None, *range(0, 1200, 11)])) for k in (*range(12), None) for i in range(k * 9 if k else 5)]
    points = [(i, rnd.choice([*range(14), None]), rnd.choice([None, *range(0, 1300)])) for i in range(900)]

    def date(d):
        return None if d is None else DAY0 + dt.timedelta(days=d)

    s = spark.createDataFrame([(i, k, date(a), date(b)) for i, k, a, b in spans], "sid int, k int, a date, b date")
    p = spark.createDataFrame([(i, k, date(d)) for i, k, d in points], "pid int, k int, at date")
    want = sorted((k, i, j) for i, k, a, b in spans for j, q, d in points if k == q and None not in (k, a, d) and a <= d and (b is None or d <= b))
    seen = []
    by_run = I._by_run
    monkeypatch.setattr(I, "_by_run", lambda s, p, keys: seen.append({r.k for r in p.select("k").collect()}) or by_run(s, p, keys))
    out = I.points_in_spans(s, p, ["k"], "a", "b", "at")
    assert out.columns == ["k", "sid", "a", "b", "pid", "at"]
    assert sorted((r.k, r.sid, r.pid) for r in out.collect()) == want
    assert seen == [{k for k in range(12) if k * 9 > I.FEW}]
    few = I.points_in_spans(s.where("k < 4"), p, ["k"], "a", "b", "at")
    assert few.columns == out.columns and len(seen) == 1
    assert sorted((r.k, r.sid, r.pid) for r in few.collect()) == [w for w in want if w[0] < 4]


def test_days_before_the_tree_are_an_error(spark):
    s = spark.createDataFrame([(1, dt.date(1960, 1, 1), None)], "k int, a date, b date")
    p = spark.createDataFrame([(1, dt.date(2020, 1, 1))], "k int, at date")
    with pytest.raises(Exception, match="before 1970"):
        I.points_in_spans(s, p, ["k"], "a", "b", "at").collect()


def test_periods_merge_days(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice(["a", "b", "c", None]), rnd.choice([None, -5, 10 ** 12, *range(50)]), dt.datetime(2024, 1, 1) + dt.timedelta(hours=rnd.randrange(24 * 70))) for _ in range(1500)]
    rows += [("a", 7, None)] + [("hot", 7, dt.datetime(2024, 1, 1, 5))] * 800
    act = spark.createDataFrame(rows, "event_type string, customer_id long, ts timestamp_ntz")
    got = {(r.period, r.start, r.feature): r.users for r in U.active_users(U.feature_day_bitmaps(act, U.user_numbers(act))).collect()}
    want = {}
    for f, c, t in rows:
        if None in (f, c, t):
            continue
        d = t.date()
        for period, start in (("day", d), ("week", d - dt.timedelta(days=d.weekday())), ("month", d.replace(day=1))):
            for name in (f, U.ALL):
                want.setdefault((period, start, name), set()).add(c)
    assert got == {k: len(v) for k, v in want.items()}


def test_user_numbers_have_no_gaps(spark):
    act = spark.range(40_000).select((F.col("id") * 1_000_003).alias("customer_id"), F.lit("x").alias("event_type"), F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("ts"))
    numbers = U.user_numbers(act).agg(F.min("uid"), F.max("uid"), F.count_distinct("uid")).first()
    assert tuple(numbers) == (1, 40_000, 40_000)
    bitmaps = U.feature_day_bitmaps(act, U.user_numbers(act))
    assert bitmaps.count() == 2  # 32,768 users a row
