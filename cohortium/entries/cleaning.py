"""Registered normalisation, cleaning and data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortium.catalog import register
from cohortium.functions.text import email_domain as _email_domain
from cohortium.functions.time import parse_mixed_timestamp, parse_with_default
from cohortium.functions.ids import normalized_customer_id
from cohortium.plans import cleaning as C
from cohortium.sources import bindings as B
from cohortium.sources.bindings import sql_with

# SQL twins of the column functions ------------------------------------------------
TS_PARSE = """COALESCE(try_strptime({c}, '%Y-%m-%dT%H:%M:%S.%fZ'), try_strptime({c}, '%Y-%m-%dT%H:%M:%SZ'),
  try_strptime({c}, '%Y-%m-%d %H:%M:%S'), try_strptime({c}, '%Y-%m-%d'))"""


def sql_ts(c):
    return TS_PARSE.format(c=c)


def sql_id(*aliases):
    text = f"CAST(COALESCE({', '.join(aliases)}) AS VARCHAR)"
    v = f"TRY_CAST({text} AS DOUBLE)"
    return f"""CASE WHEN regexp_full_match(trim({text}), '[+-]?[0-9]+') THEN TRY_CAST({text} AS BIGINT)
      WHEN {v} = floor({v}) AND abs({v}) <= 9007199254740992 THEN CAST({v} AS BIGINT) END"""


def sql_strip(c):
    return f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"


ACT_NORM = ("n", f"""SELECT event_id, {sql_id('customer_id', 'customerId', 'userId')} AS customer_id,
    customerId, userId, {sql_ts('"timestamp"')} AS ts, event_type, session_duration_sec AS session_duration
    FROM activity_docs""")


def _accounts(spark, d):
    """Accounts role for name checks: every part, name = p_name."""
    return B._t(spark, d, "part").select(F.col("p_partkey").alias("customer_id"),
                                         F.col("p_name").alias("company_name"))


ACCOUNTS_SQL = ("accounts", "SELECT p_partkey AS customer_id, p_name AS company_name FROM part")


@register("scan_table_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS n_rows FROM {t}" for t in
    ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
     "embeddings", "pages", "benchmark", "labels", "conversations")))
def scan_table_counts(spark, d):
    from cohortium.sources.tables import scan_table_counts as f
    return f(spark, d)


# the stored documents carry keys that no list names: a device on some, an attempt that is a
# number or a word, a flag, a list, an object, and a key with a full stop in its name
_EXTRA_KEYS = """CASE WHEN event_id % 4 = 1 THEN '"device":"d' || CAST(event_id % 9 AS VARCHAR(4)) || '"' END AS device_part,
    CASE WHEN event_id % 5 = 0 THEN '"attempt":"none"' WHEN event_id % 5 < 4 THEN '"attempt":' || CAST(event_id % 7 AS VARCHAR(4)) END AS attempt_part,
    CASE WHEN event_id % 6 = 0 THEN '"vip":true' WHEN event_id % 6 = 1 THEN '"vip":false' WHEN event_id % 6 = 2 THEN '"vip":null' END AS vip_part,
    CASE WHEN event_id % 8 = 0 THEN '"tags":["a",' || CAST(event_id % 3 AS VARCHAR(4)) || ']' END AS tags_part,
    CASE WHEN event_id % 8 = 4 THEN '"geo":{"zone":' || CAST(event_id % 3 AS VARCHAR(4)) || '}' END AS geo_part,
    CASE WHEN event_id % 10 = 3 THEN '"app.version":' || CAST(event_id % 4 AS VARCHAR(4)) || '.5' END AS version_part"""
_PARTS = "device_part, attempt_part, vip_part, tags_part, geo_part, version_part"
_KNOWN_KEYS = ["customer_id", "customerId", "userId", "timestamp", "event_type"]


def _document_texts(spark, d):
    """Activity documents as JSON text, absent keys omitted, with the unlisted keys spliced in."""
    docs = B.activity_docs(spark, d)
    known = F.to_json(F.struct(*(c for c in docs.columns if c != "event_id")))
    parts = docs.withColumn("known", known).selectExpr("known", *_sql_columns(_EXTRA_KEYS))
    return parts.selectExpr(f"concat('{{\"_id\":\"x\",', concat_ws(',', substr(known, 2, length(known) - 2), {_PARTS}), '}}') AS doc")


def _sql_columns(text):
    return [c.strip().rstrip(",") for c in text.split("\n")]


_DOC_TEXTS = ("texts", f"""SELECT *, {_EXTRA_KEYS} FROM activity_docs""")


def _json_text(col, key):
    """Value text of a rendered key in the oracle."""
    return f"CASE WHEN {col} IS NOT NULL AND NOT ends_with({col}, ':null') THEN trim(substr({col}, {len(key) + 4}), '\"') END"


@register("scan_json_documents", sql_with(["activity_docs"], f"""
SELECT customer_id, customerId, NULL::VARCHAR AS customerID_, NULL::VARCHAR AS user_id, userId,
       NULL::VARCHAR AS userID_, "timestamp", event_type, session_duration_sec,
       {_json_text('device_part', 'device')} AS device, {_json_text('attempt_part', 'attempt')} AS attempt,
       CAST({_json_text('vip_part', 'vip')} AS BOOLEAN) AS vip, {_json_text('tags_part', 'tags')} AS tags,
       {_json_text('geo_part', 'geo')} AS geo, CAST({_json_text('version_part', 'app.version')} AS DOUBLE) AS "app.version"
FROM texts""", [_DOC_TEXTS]))
def scan_json_documents(spark, d):
    """Documents as JSON text, then read back with the union of the keys found and the
    expected ones: keys a document lacks come back NULL, ``_id`` is dropped, and keys that
    differ only by case keep distinct columns."""
    from cohortium.sources.documents import read_union
    from cohortium.sources.tables import ACTIVITY_DOC_KEYS, NUMERIC_KEYS
    expected = {k: "double" if k in NUMERIC_KEYS else "string" for k in ACTIVITY_DOC_KEYS}
    return read_union(_document_texts(spark, d), "doc", expected)


def _profile_sql(key, part, kinds):
    cases = f"COUNT({part})" if part else f'COUNT("{key}")'
    nulls = f"COUNT(CASE WHEN ends_with({part}, ':null') THEN 1 END)" if part else "0"
    return f"SELECT '{key}' AS key, {cases} AS n_docs, {nulls} AS n_null, '{kinds}' AS kinds FROM texts"


@register("document_key_profile", sql_with(["activity_docs"], " UNION ALL ".join(
    [_profile_sql(k, None, "text") for k in _KNOWN_KEYS] +
    ["SELECT '_id', COUNT(*), 0, 'text' FROM texts",
     "SELECT 'session_duration_sec', COUNT(session_duration_sec), 0, 'number' FROM texts",
     _profile_sql("device", "device_part", "text"), _profile_sql("attempt", "attempt_part", "integer,text"),
     _profile_sql("vip", "vip_part", "boolean"), _profile_sql("tags", "tags_part", "array"),
     _profile_sql("geo", "geo_part", "object"), _profile_sql("app.version", "version_part", "number")]), [_DOC_TEXTS]))
def document_key_profile(spark, d):
    from cohortium.sources.documents import key_profile
    return key_profile(_document_texts(spark, d), "doc")


@register("normalize_names", sql_with([], """
SELECT customer_id, company_name, lower(trim(replace(replace(company_name, ' ', ''), '.', ''))) AS norm_name
FROM accounts""", [ACCOUNTS_SQL]))
def normalize_names(spark, d):
    return C.normalize_names(_accounts(spark, d))


@register("email_domain", sql_with(["customers"], """
SELECT customer_id, contact_email, lower(split_part(contact_email, '@', 2)) AS email_domain FROM customers"""))
def email_domain(spark, d):
    return B.customers(spark, d).select("customer_id", "contact_email",
                                        _email_domain(F.col("contact_email")).alias("email_domain"))


@register("duplicate_company_names", sql_with([], f"""
SELECT customer_id, company_name, name_key, name_count, name_count > 1 AS is_duplicate_name FROM (
  SELECT customer_id, company_name, replace(lower({sql_strip('company_name')}), ' ', '') AS name_key,
         COUNT(*) OVER (PARTITION BY replace(lower({sql_strip('company_name')}), ' ', '')) AS name_count
  FROM accounts) x""", [ACCOUNTS_SQL]))
def duplicate_company_names(spark, d):
    return C.name_duplicates(_accounts(spark, d)).select(
        "customer_id", "company_name", "name_key", "name_count", "is_duplicate_name")


# some ids near 2^53 and near 2^63, where DOUBLE is no longer exact, and some spelt as decimals
_BIG = ("big", """SELECT event_id, CASE WHEN event_id % 11 = 0 THEN CAST(9007199254740993 + event_id AS VARCHAR)
    WHEN event_id % 11 = 1 THEN CAST(9223372036800000001 + event_id AS VARCHAR)
    WHEN event_id % 11 = 2 THEN customer_id || '.0' ELSE customer_id END AS customer_id, customerId, userId
    FROM activity_docs""")


@register("coalesce_id_aliases", sql_with(["activity_docs"], f"""
SELECT event_id, customer_id AS raw_customer_id, customerId AS raw_customerId, userId AS raw_userId,
       {sql_id('customer_id', 'customerId', 'userId')} AS customer_id FROM big""", [_BIG]))
def coalesce_id_aliases(spark, d):
    docs = B.activity_docs(spark, d)
    r = F.col("event_id") % 11
    docs = docs.withColumn("customer_id", F.when(r == 0, (F.col("event_id") + 9007199254740993).cast("string"))
                           .when(r == 1, (F.col("event_id") + 9223372036800000001).cast("string"))
                           .when(r == 2, F.concat("customer_id", F.lit(".0"))).otherwise(F.col("customer_id")))
    return docs.select("event_id", F.col("customer_id").alias("raw_customer_id"),
                       F.col("customerId").alias("raw_customerId"), F.col("userId").alias("raw_userId"),
                       normalized_customer_id(docs).alias("customer_id"))


# every ninth document has no time at all
_NO_TIME = ("timed", """SELECT event_id, CASE WHEN event_id % 9 <> 0 THEN "timestamp" END AS "timestamp" FROM activity_docs""")


@register("parse_mixed_timestamps", sql_with(["activity_docs"], f"""
SELECT event_id, "timestamp" AS ts_text, {sql_ts('"timestamp"')} AS ts_parsed,
       CASE WHEN "timestamp" IS NULL THEN TIMESTAMP '2024-01-01 00:00:00' ELSE {sql_ts('"timestamp"')} END
         AS ts_with_default
FROM timed""", [_NO_TIME]))
def parse_mixed_timestamps(spark, d):
    docs = B.activity_docs(spark, d)
    docs = docs.withColumn("timestamp", F.when(F.col("event_id") % 9 != 0, F.col("timestamp")))
    return docs.select("event_id", F.col("timestamp").alias("ts_text"),
                       parse_mixed_timestamp(F.col("timestamp")).alias("ts_parsed"),
                       parse_with_default(F.col("timestamp")).alias("ts_with_default"))


@register("clean_customers", sql_with(["customers"], f"""
SELECT customer_id, CASE WHEN {sql_strip('company_name')} = '' THEN 'Unknown' ELSE {sql_strip('company_name')} END
         AS company_name,
       industry, country_code, {sql_strip('country_name')} AS country_name, contact_name, contact_email,
       is_active, churn_reason, COALESCE(customer_id IN (1202), FALSE) AS is_potential_duplicate
FROM customers"""))
def clean_customers(spark, d):
    return C.clean_customers(B.customers(spark, d))


@register("quality_report_customers", sql_with(["customers"], f"""
SELECT COUNT(*) AS rows_before, COUNT(*) FILTER (WHERE name_count > 1) AS duplicate_name_rows,
       COUNT(*) FILTER (WHERE company_name IS NULL OR {sql_strip('company_name')} = '') AS empty_or_null_names,
       COUNT(*) FILTER (WHERE customer_id IN (1202)) AS flagged_duplicates
FROM (SELECT *, COUNT(*) OVER (PARTITION BY replace(lower({sql_strip('company_name')}), ' ', '')) AS name_count
      FROM customers) x"""))
def quality_report_customers(spark, d):
    return C.quality_report_customers(B.customers(spark, d))


@register("dedupe_exact_rows", sql_with(["activity_docs"], "SELECT DISTINCT * FROM activity_docs"))
def dedupe_exact_rows(spark, d):
    return C.dedupe_exact_rows(B.activity_docs(spark, d))


@register("orphan_activity", sql_with(["activity_docs", "customers"], """
SELECT DISTINCT * FROM n WHERE NOT EXISTS (SELECT 1 FROM customers c WHERE c.customer_id = n.customer_id)""",
                                      [ACT_NORM]))
def orphan_activity(spark, d):
    return C.orphan_activity(B.activity_docs(spark, d), B.customers(spark, d)).select(
        "event_id", "customer_id", "customerId", "userId", "ts", "event_type", "session_duration")


# cleaned activity with unknown and NULL ids still in it
PREPARED_CTE = ("activity", """SELECT event_id, customer_id, ts, event_type,
    CASE WHEN COALESCE(session_duration, 0) < 0 THEN 0.0 ELSE COALESCE(session_duration, 0.0) END AS session_duration
    FROM (SELECT DISTINCT * FROM n) x""")
CLEAN_ACTIVITY_CTES = [ACT_NORM, ("k", """SELECT DISTINCT * FROM n
    WHERE customer_id IN (SELECT customer_id FROM customers)"""),
                       ("clean_activity", """SELECT event_id, customer_id, ts, event_type,
    CASE WHEN COALESCE(session_duration, 0) < 0 THEN 0.0 ELSE COALESCE(session_duration, 0.0) END
      AS session_duration FROM k""")]


@register("clean_activity", sql_with(["activity_docs", "customers"], "SELECT * FROM clean_activity",
                                     CLEAN_ACTIVITY_CTES))
def clean_activity(spark, d):
    return C.clean_activity(B.activity_docs(spark, d), B.customers(spark, d)).select(
        "event_id", "customer_id", "ts", "event_type", "session_duration")


@register("quality_report_activity", sql_with(["activity_docs", "customers"], """
SELECT (SELECT COUNT(*) FROM n) AS rows_before, COUNT(*) AS rows_after_dedupe,
       COUNT(*) FILTER (WHERE c.customer_id IS NULL) AS orphan_rows,
       COUNT(*) FILTER (WHERE c.customer_id IS NOT NULL AND d.session_duration IS NULL) AS null_durations,
       COUNT(*) FILTER (WHERE c.customer_id IS NOT NULL AND d.session_duration < 0) AS negative_durations,
       COUNT(*) FILTER (WHERE c.customer_id IS NOT NULL) AS rows_after
FROM (SELECT DISTINCT * FROM n) d LEFT JOIN customers c ON d.customer_id = c.customer_id""", [ACT_NORM]))
def quality_report_activity(spark, d):
    return C.quality_report_activity(B.activity_docs(spark, d), B.customers(spark, d))


NPS_NORM = ("nn", f"""SELECT response_id, {sql_id('customer_id', 'userId')} AS customer_id,
    {sql_ts('"timestamp"')} AS ts, TRY_CAST(COALESCE(nps_score, score) AS DOUBLE) AS nps_score FROM nps_docs""")
CLEAN_NPS_CTES = [NPS_NORM, ("clean_nps", "SELECT * FROM nn WHERE nps_score >= 0 AND nps_score <= 10")]


@register("clean_nps", sql_with(["nps_docs"], "SELECT * FROM clean_nps", CLEAN_NPS_CTES))
def clean_nps(spark, d):
    return C.clean_nps(B.nps_docs(spark, d))


@register("quality_report_nps", sql_with(["nps_docs"], """
SELECT COUNT(*) AS rows_before, COUNT(*) FILTER (WHERE nps_score < 0 OR nps_score > 10) AS invalid_scores,
       COUNT(*) FILTER (WHERE nps_score IS NULL) AS null_scores,
       COUNT(*) FILTER (WHERE nps_score BETWEEN 0 AND 10) AS rows_after FROM nn""", [NPS_NORM]))
def quality_report_nps(spark, d):
    return C.quality_report_nps(B.nps_docs(spark, d))


CLEAN_ONB_CTES = [("clean_onboarding", f"""SELECT DISTINCT event_id,
    {sql_id('customer_id', 'customerId')} AS customer_id, customerId,
    lower({sql_strip('COALESCE(step, event_step)')}) AS step, {sql_ts('"timestamp"')} AS ts
    FROM onboarding_docs""")]


RAW_ONB_CTES = [("onboarding", CLEAN_ONB_CTES[0][1].replace("FROM onboarding_docs", "FROM onboarding_docs_dirty"))]


@register("quality_report_onboarding", sql_with(["onboarding_docs"], """
SELECT (SELECT COUNT(*) FROM onboarding_docs) AS rows_before, COUNT(*) AS rows_after,
       (SELECT COUNT(*) FROM onboarding_docs) - COUNT(*) AS duplicates_removed FROM clean_onboarding""", CLEAN_ONB_CTES))
def quality_report_onboarding(spark, d):
    return C.quality_report_onboarding(B.onboarding_docs(spark, d))


# documents of another export: neither event_type nor session_duration, but a feature
@register("clean_activity_by_feature", sql_with(["activity_docs"], f"""
SELECT DISTINCT event_id, {sql_id('customer_id', 'customerId', 'userId')} AS customer_id, {sql_ts('"timestamp"')} AS ts,
       event_type, 0.0::DOUBLE AS session_duration FROM activity_docs"""))
def clean_activity_by_feature(spark, d):
    docs = B.activity_docs(spark, d).withColumnRenamed("event_type", "feature").drop("session_duration_sec")
    return C.prepared_activity(docs).select("event_id", "customer_id", "ts", "event_type", "session_duration")


@register("clean_onboarding", sql_with(["onboarding_docs"],
                                       "SELECT event_id, customer_id, ts, step FROM clean_onboarding",
                                       CLEAN_ONB_CTES))
def clean_onboarding(spark, d):
    return C.clean_onboarding(B.onboarding_docs(spark, d)).select("event_id", "customer_id", "ts", "step")
