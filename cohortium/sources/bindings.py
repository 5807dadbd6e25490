"""Role bindings: the generic subscription / activity roles over the test tables.

The analyses in :mod:`cohortium.plans` take role DataFrames with fixed
column names (``customer_id``, ``plan_id``, ``start_date`` ...). The driver's
tables are a TPC-H-like star plus an event stream, so each role is defined
here once as a Spark plan and once as the equivalent SQL text (used by the
DuckDB oracle in :mod:`cohortium.catalog`). The two definitions must stay
identical in meaning; every role reads whole tables.

=================  =======================================================
role               binding
=================  =======================================================
plans              one plan per ``o_orderpriority``; id = leading digit,
                   tier = lower-cased text after the dash
tier levels        low < not specified < medium < high < urgent
customers          ``customer`` + ``nation``; active = ``c_acctbal >= 0``;
                   churn reason = market segment of inactive customers
subscriptions      ``orders``: start = order date, status O/F/P →
                   active/cancelled/expired, mrr = total price; end date of
                   F/P orders = first ship date after the order date
invoices           ``orders``; status 'paid' when ``o_orderstatus = 'F'``
tickets            returned line items (``l_returnflag = 'R'``) of the
                   customer's orders; escalated = open line
activity           ``events``: user, time, type, value as session seconds
nps                ``events``: score = (props.k mod 13) − 1, so −1..11
onboarding         ``events``: the event type is the onboarding step
team members       suppliers of a customer's line items, e-mail domain =
                   supplier nation
=================  =======================================================
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortium.sources.tables import read_table

# Fixed values of the binding: tier order of the test plans (lowest first).
TEST_TIERS = ["low", "not specified", "medium", "high", "urgent"]
# Funnel steps of the test onboarding role, in funnel order.
TEST_STEPS = ["signup", "view", "click", "purchase"]


def _t(spark, d, name):
    return read_table(spark, d, name)


def plans(spark: SparkSession, d: str) -> DataFrame:
    return (_t(spark, d, "orders").select("o_orderpriority").distinct()
            .select(F.expr("CAST(substr(o_orderpriority, 1, 1) AS INT)").alias("plan_id"),
                    F.col("o_orderpriority").alias("plan_name"),
                    F.expr("lower(substr(o_orderpriority, 3))").alias("plan_tier")))


def customers(spark: SparkSession, d: str) -> DataFrame:
    c = _t(spark, d, "customer")
    n = _t(spark, d, "nation").select("n_nationkey", "n_name")
    j = c.join(n, c.c_nationkey == n.n_nationkey, "left")
    return j.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("company_name"),
        F.col("c_mktsegment").alias("industry"),
        F.col("c_nationkey").cast("string").alias("country_code"),
        F.col("n_name").alias("country_name"),
        F.col("c_name").alias("contact_name"),
        F.concat(F.lit("contact"), F.col("c_custkey").cast("string"), F.lit("@"),
                 F.lower("n_name"), F.lit(".example")).alias("contact_email"),
        (F.col("c_acctbal") >= 0).alias("is_active"),
        F.when(F.col("c_acctbal") < 0, F.col("c_mktsegment")).alias("churn_reason"),
    )


def _status():
    return (F.when(F.col("o_orderstatus") == "O", "active")
            .when(F.col("o_orderstatus") == "F", "cancelled")
            .when(F.col("o_orderstatus") == "P", "expired"))


def subscriptions(spark: SparkSession, d: str, with_end: bool = False) -> DataFrame:
    o = _t(spark, d, "orders")
    if not with_end:
        return o.select(
            F.col("o_orderkey").alias("subscription_id"),
            F.col("o_custkey").alias("customer_id"),
            F.expr("CAST(substr(o_orderpriority, 1, 1) AS INT)").alias("plan_id"),
            F.col("o_orderdate").cast("date").alias("start_date"),
            _status().alias("status"),
            F.col("o_totalprice").cast("decimal(18,2)").alias("mrr_usd"))
    # end date: one left join on the order key, then an aggregate that reuses
    # the join's hash partitioning (grouping keys include o_orderkey).
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_shipdate")
    cond = ((li.l_orderkey == o.o_orderkey) & (o.o_orderstatus != "O")
            & (li.l_shipdate > o.o_orderdate))
    j = o.join(li, cond, "left")
    g = j.groupBy("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate", "o_orderstatus",
                  "o_totalprice").agg(F.min("l_shipdate").alias("_end"))
    return g.select(
        F.col("o_orderkey").alias("subscription_id"),
        F.col("o_custkey").alias("customer_id"),
        F.expr("CAST(substr(o_orderpriority, 1, 1) AS INT)").alias("plan_id"),
        F.col("o_orderdate").cast("date").alias("start_date"),
        F.col("_end").cast("date").alias("end_date"),
        _status().alias("status"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("mrr_usd"))


def invoices(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "orders").select(
        F.col("o_orderkey").alias("invoice_id"),
        F.col("o_custkey").alias("customer_id"),
        F.when(F.col("o_orderstatus") == "F", "paid").otherwise("open").alias("status"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("total_usd"))


def tickets(spark: SparkSession, d: str) -> DataFrame:
    li = _t(spark, d, "lineitem").where(F.col("l_returnflag") == "R")
    o = _t(spark, d, "orders").select("o_orderkey", "o_custkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ticket_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_shipdate").alias("created_at"),
        (F.col("l_linestatus") == "O").alias("escalated"),
        F.col("l_quantity").alias("satisfaction_score"))


def activity(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "events").select(
        "event_id", F.col("user_id").alias("customer_id"), "ts", "event_type",
        F.col("value").alias("session_duration"))


def nps(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "events").select(
        F.col("event_id").alias("response_id"), F.col("user_id").alias("customer_id"), "ts",
        (F.get_json_object("props", "$.k").cast("int") % 13 - 1).cast("double").alias("nps_score"))


def onboarding(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "events").select(
        "event_id", F.col("user_id").alias("customer_id"), "ts", F.col("event_type").alias("step"))


def team_members(spark: SparkSession, d: str) -> DataFrame:
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_suppkey")
    o = _t(spark, d, "orders").select("o_orderkey", "o_custkey")
    s = _t(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = _t(spark, d, "nation").select("n_nationkey", "n_name")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(s, li.l_suppkey == s.s_suppkey) \
        .join(n, s.s_nationkey == n.n_nationkey)
    return j.select(F.col("o_custkey").alias("customer_id"),
                    F.concat(F.lower(F.regexp_replace("s_name", "#", ".")), F.lit("@"),
                             F.lower("n_name"), F.lit(".com")).alias("email"))


# --------------------------------------------------------------------------
# The same roles as SQL text (DuckDB dialect for the oracle). Keep in step
# with the Spark definitions above.

SQL = {
    "plans": """SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS plan_id,
        o_orderpriority AS plan_name, lower(substr(o_orderpriority, 3)) AS plan_tier FROM orders""",
    "tier_levels": "SELECT * FROM (VALUES " + ", ".join(
        f"('{t}', {i + 1})" for i, t in enumerate(TEST_TIERS)) + ") AS t(plan_tier, tier_level)",
    "customers": """SELECT c.c_custkey AS customer_id, c.c_name AS company_name, c.c_mktsegment AS industry,
        CAST(c.c_nationkey AS VARCHAR) AS country_code, n.n_name AS country_name, c.c_name AS contact_name,
        'contact' || CAST(c.c_custkey AS VARCHAR) || '@' || lower(n.n_name) || '.example' AS contact_email,
        c.c_acctbal >= 0 AS is_active,
        CASE WHEN c.c_acctbal < 0 THEN c.c_mktsegment END AS churn_reason
        FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "subscriptions": """SELECT o_orderkey AS subscription_id, o_custkey AS customer_id,
        CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS plan_id, CAST(o_orderdate AS DATE) AS start_date,
        CASE o_orderstatus WHEN 'O' THEN 'active' WHEN 'F' THEN 'cancelled' WHEN 'P' THEN 'expired' END AS status,
        CAST(o_totalprice AS DECIMAL(18,2)) AS mrr_usd FROM orders""",
    "subscriptions_end": """SELECT o.o_orderkey AS subscription_id, o.o_custkey AS customer_id,
        CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS plan_id, CAST(o.o_orderdate AS DATE) AS start_date,
        CAST(min(l.l_shipdate) AS DATE) AS end_date,
        CASE o.o_orderstatus WHEN 'O' THEN 'active' WHEN 'F' THEN 'cancelled' WHEN 'P' THEN 'expired' END AS status,
        CAST(o.o_totalprice AS DECIMAL(18,2)) AS mrr_usd
        FROM orders o LEFT JOIN lineitem l
          ON l.l_orderkey = o.o_orderkey AND o.o_orderstatus <> 'O' AND l.l_shipdate > o.o_orderdate
        GROUP BY o.o_orderkey, o.o_custkey, o.o_orderpriority, o.o_orderdate, o.o_orderstatus, o.o_totalprice""",
    "invoices": """SELECT o_orderkey AS invoice_id, o_custkey AS customer_id,
        CASE WHEN o_orderstatus = 'F' THEN 'paid' ELSE 'open' END AS status,
        CAST(o_totalprice AS DECIMAL(18,2)) AS total_usd FROM orders""",
    "tickets": """SELECT l.l_orderkey * 10 + l.l_linenumber AS ticket_id, o.o_custkey AS customer_id,
        l.l_shipdate AS created_at, l.l_linestatus = 'O' AS escalated, l.l_quantity AS satisfaction_score
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE l.l_returnflag = 'R'""",
    "activity": """SELECT event_id, user_id AS customer_id, ts, event_type, value AS session_duration FROM events""",
    "nps": """SELECT event_id AS response_id, user_id AS customer_id, ts,
        CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 13 - 1 AS DOUBLE) AS nps_score FROM events""",
    "onboarding": """SELECT event_id, user_id AS customer_id, ts, event_type AS step FROM events""",
    "team_members": """SELECT o.o_custkey AS customer_id,
        lower(replace(s.s_name, '#', '.')) || '@' || lower(n.n_name) || '.com' AS email
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
        JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey""",
}


def sql_with(roles, body: str, ctes=()) -> str:
    """``WITH <roles>, <extra ctes> <body>`` for the oracle."""
    ordered = []
    for r in roles:
        for dep in DEPENDS.get(r, []):
            if dep not in ordered:
                ordered.append(dep)
        if r not in ordered:
            ordered.append(r)
    parts = [f"{r} AS ({SQL[r]})" for r in ordered] + [f"{n} AS ({q})" for n, q in ctes]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


# --------------------------------------------------------------------------
# Raw document collections. The stored events are clean, so the documents a
# store would hold are *rendered* from every event by fixed rules: the id
# lands under one of three key names (and is text with a junk prefix on some
# documents), the timestamp is text in one of four formats or junk, 'view'
# events carry no duration, durations are shifted by −5 s (negatives appear),
# and every 'purchase' event is delivered twice. No row is dropped.

# The text formats that the cleaning accepts (see functions/time.py).
_DOC_TS = {
    0: ("yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'", "%Y-%m-%dT%H:%M:%S.%fZ"),
    1: ("yyyy-MM-dd'T'HH:mm:ss'Z'", "%Y-%m-%dT%H:%M:%SZ"),
    2: ("yyyy-MM-dd HH:mm:ss", "%Y-%m-%d %H:%M:%S"),
    3: ("yyyy-MM-dd", "%Y-%m-%d"),
}


def activity_docs(spark: SparkSession, d: str) -> DataFrame:
    e = _t(spark, d, "events")
    uid = F.col("user_id").cast("string")
    r3 = F.col("event_id") % 3
    r5 = F.col("event_id") % 5
    docs = e.select(
        "event_id",
        F.when(r3 == 0, uid).alias("customer_id"),
        F.when(r3 == 1, uid).alias("customerId"),
        F.when(r3 == 2, F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("u"), uid)).otherwise(uid)).alias("userId"),
        F.when(r5 == 4, F.lit("not a date")).otherwise(F.coalesce(*[
            F.when(r5 == k, F.date_format("ts", fmt)) for k, (fmt, _) in _DOC_TS.items()])).alias("timestamp"),
        "event_type",
        F.when(F.col("event_type") != "view", F.col("value") - 5).alias("session_duration_sec"),
    )
    return docs.unionByName(docs.where(F.col("event_type") == "purchase"))


def nps_docs(spark: SparkSession, d: str) -> DataFrame:
    e = _t(spark, d, "events")
    uid = F.col("user_id").cast("string")
    score = (F.get_json_object("props", "$.k").cast("int") % 13 - 1).cast("string")
    even = F.col("event_id") % 2 == 0
    return e.select(
        F.col("event_id").alias("response_id"),
        F.when(even, uid).alias("customer_id"),
        F.when(~even, uid).alias("userId"),
        F.when(even, score).alias("nps_score"),
        F.when(~even, score).alias("score"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"))


def onboarding_docs(spark: SparkSession, d: str, dirty: bool = False) -> DataFrame:
    """With ``dirty`` some ids are junk text and some times are missing."""
    e = _t(spark, d, "events")
    uid = F.col("user_id").cast("string")
    r3 = F.col("event_id") % 3
    noisy = F.when(r3 == 0, F.col("event_type")).when(r3 == 1, F.upper("event_type")) \
        .otherwise(F.concat(F.lit("  "), F.initcap("event_type"), F.lit(" ")))
    even = F.col("event_id") % 2 == 0
    docs = e.select(
        "event_id",
        F.when(even, uid).alias("customerId"),
        F.when(~even, uid).alias("customer_id"),
        F.when(even, noisy).alias("step"),
        F.when(~even, noisy).alias("event_step"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"))
    if dirty:
        docs = docs.withColumns({
            "customer_id": F.when(F.col("event_id") % 14 == 7, "none").otherwise(F.col("customer_id")),
            "timestamp": F.when(F.col("event_id") % 13 != 5, F.col("timestamp"))})
    return docs.unionByName(docs.where(F.col("step").isNotNull() & (F.lower(F.trim("step")) == "signup")))


_TS_SQL = " ".join(f"WHEN event_id % 5 = {k} THEN strftime(ts, '{py}')" for k, (_, py) in _DOC_TS.items())
SQL["activity_docs_once"] = f"""SELECT event_id,
    CASE WHEN event_id % 3 = 0 THEN CAST(user_id AS VARCHAR) END AS customer_id,
    CASE WHEN event_id % 3 = 1 THEN CAST(user_id AS VARCHAR) END AS customerId,
    CASE WHEN event_id % 3 = 2 THEN CASE WHEN event_id % 7 = 0 THEN 'u' || CAST(user_id AS VARCHAR)
         ELSE CAST(user_id AS VARCHAR) END END AS userId,
    CASE WHEN event_id % 5 = 4 THEN 'not a date' {_TS_SQL} END AS "timestamp",
    event_type,
    CASE WHEN event_type <> 'view' THEN value - 5 END AS session_duration_sec
    FROM events"""
SQL["activity_docs"] = """SELECT * FROM activity_docs_once
    UNION ALL SELECT * FROM activity_docs_once WHERE event_type = 'purchase'"""
SQL["nps_docs"] = """SELECT event_id AS response_id,
    CASE WHEN event_id % 2 = 0 THEN CAST(user_id AS VARCHAR) END AS customer_id,
    CASE WHEN event_id % 2 <> 0 THEN CAST(user_id AS VARCHAR) END AS userId,
    CASE WHEN event_id % 2 = 0 THEN CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 13 - 1 AS VARCHAR) END
      AS nps_score,
    CASE WHEN event_id % 2 <> 0 THEN CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 13 - 1 AS VARCHAR) END
      AS score,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS "timestamp" FROM events"""
SQL["onboarding_docs_once"] = """SELECT event_id,
    CASE WHEN event_id % 2 = 0 THEN CAST(user_id AS VARCHAR) END AS customerId,
    CASE WHEN event_id % 2 <> 0 THEN CAST(user_id AS VARCHAR) END AS customer_id,
    CASE WHEN event_id % 2 = 0 THEN (CASE WHEN event_id % 3 = 0 THEN event_type WHEN event_id % 3 = 1
         THEN upper(event_type) ELSE '  ' || upper(substr(event_type, 1, 1)) || lower(substr(event_type, 2)) || ' '
         END) END AS step,
    CASE WHEN event_id % 2 <> 0 THEN (CASE WHEN event_id % 3 = 0 THEN event_type WHEN event_id % 3 = 1
         THEN upper(event_type) ELSE '  ' || upper(substr(event_type, 1, 1)) || lower(substr(event_type, 2)) || ' '
         END) END AS event_step,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS "timestamp" FROM events"""
SQL["onboarding_docs"] = """SELECT * FROM onboarding_docs_once UNION ALL
    SELECT * FROM onboarding_docs_once WHERE step IS NOT NULL AND lower(trim(step)) = 'signup'"""

SQL["onboarding_docs_dirty"] = """SELECT event_id, customerId,
    CASE WHEN event_id % 14 = 7 THEN 'none' ELSE customer_id END AS customer_id, step, event_step,
    CASE WHEN event_id % 13 <> 5 THEN "timestamp" END AS "timestamp" FROM onboarding_docs"""

# roles that need other roles first
DEPENDS = {"onboarding_docs_dirty": ["onboarding_docs_once", "onboarding_docs"], "activity_docs": ["activity_docs_once"], "onboarding_docs": ["onboarding_docs_once"]}


# --------------------------------------------------------------------------
# Duplicate-account roles: every part is an account (name = p_name, e-mail
# domain from the brand); its team members are the suppliers of its line
# items (domain = supplier nation).

# Binding parameters: the first ten brands and first five nations play the
# part of the generic (free-mail) domains.
TEST_GENERIC_ACCOUNT_DOMAINS = [f"brand{i}.example" for i in range(1, 11)]
TEST_GENERIC_TEAM_DOMAINS = [f"nation_{i}.com" for i in range(5)]


def accounts(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "part").select(
        F.col("p_partkey").alias("customer_id"),
        # some names extend others at their end or at their front
        F.when(F.col("p_partkey") % 10 == 3, F.concat("p_name", F.lit(" works")))
        .when(F.col("p_partkey") % 10 == 7, F.concat(F.lit("old "), "p_name")).otherwise(F.col("p_name")).alias("company_name"),
        F.concat(F.lit("sales@"), F.lower(F.replace("p_brand", F.lit("#"), F.lit(""))), F.lit(".example"))
        .alias("contact_email"))


def account_team_members(spark: SparkSession, d: str) -> DataFrame:
    # one row per (account, supplier) before any text is built
    li = _t(spark, d, "lineitem").select("l_partkey", "l_suppkey").distinct()
    s = _t(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = _t(spark, d, "nation").select("n_nationkey", "n_name")
    j = li.join(s, li.l_suppkey == s.s_suppkey).join(n, s.s_nationkey == n.n_nationkey)
    return j.select(F.col("l_partkey").alias("customer_id"),
                    F.concat(F.lower(F.replace("s_name", F.lit("#"), F.lit("."))), F.lit("@"),
                             F.lower("n_name"), F.lit(".com")).alias("email"))


SQL["accounts"] = """SELECT p_partkey AS customer_id, CASE p_partkey % 10 WHEN 3 THEN p_name || ' works'
    WHEN 7 THEN 'old ' || p_name ELSE p_name END AS company_name,
    'sales@' || lower(replace(p_brand, '#', '')) || '.example' AS contact_email FROM part"""
SQL["account_team_members"] = """SELECT l.l_partkey AS customer_id,
    lower(replace(s.s_name, '#', '.')) || '@' || lower(n.n_name) || '.com' AS email
    FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) l JOIN supplier s ON l.l_suppkey = s.s_suppkey
    JOIN nation n ON s.s_nationkey = n.n_nationkey"""


def roles(spark: SparkSession, d: str):
    """All input roles of the end-to-end job (:mod:`cohortium.jobs`) over the test tables."""
    from cohortium.jobs import Roles

    return Roles(customers=customers(spark, d), plans=plans(spark, d),
                 subscriptions=subscriptions(spark, d, with_end=True), invoices=invoices(spark, d),
                 tickets=tickets(spark, d), activity_docs=activity_docs(spark, d), nps_docs=nps_docs(spark, d),
                 onboarding_docs=onboarding_docs(spark, d))
