"""Cleaning of customers and of the three document collections, plus quality reports.

Every step is a column expression or one grouped aggregate; nothing is
collected. Step order follows the reference (id coalesce → numeric →
timestamp parse → exact dedupe → known ids only → duration fixes), because
the order changes the counts (a duplicate of an orphan is removed before
the orphan is counted).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortium.functions.ids import ACTIVITY_ID_ALIASES, SURVEY_ID_ALIASES, normalized_customer_id
from cohortium.functions.text import compact_name, normalize_company_name, strip_ws
from cohortium.functions.time import parse_mixed_timestamp, parse_with_default
from cohortium.sources.tables import with_columns_if_absent

# Fixed value from the reference: the one customer id flagged as a known duplicate.
DEFAULT_FLAGGED_IDS = [1202]


def clean_customers(customers: DataFrame, flagged_ids=DEFAULT_FLAGGED_IDS, dedupe_customers: bool = False) -> DataFrame:
    """Trim names, flag listed ids as potential duplicates, empty name → 'Unknown'.

    ``dedupe_customers`` also drops the flagged rows (the reference only flags them).
    """
    if dedupe_customers:
        customers = customers.where(~F.coalesce(F.col("customer_id").isin(*flagged_ids), F.lit(False)))
    c = customers.withColumns({
        "company_name": strip_ws(F.col("company_name")),
        "country_name": strip_ws(F.col("country_name")),
        "is_potential_duplicate": F.coalesce(F.col("customer_id").isin(*flagged_ids), F.lit(False)),
    })
    return c.withColumn("company_name", F.when(F.col("company_name") == "", F.lit("Unknown"))
                        .otherwise(F.col("company_name")))


def name_duplicates(accounts: DataFrame, key_fn=compact_name) -> DataFrame:
    """All members of a repeated normalised name (``duplicated(keep=False)``).

    Group sizes come from an aggregate joined back on the key, not from a
    window, so a very common name is counted with partial aggregation and
    joined with AQE's skew split instead of one sort task.
    """
    keyed = accounts.withColumn("name_key", key_fn(F.col("company_name")))
    counts = keyed.groupBy("name_key").agg(F.count(F.lit(1)).alias("name_count"))
    j = keyed.join(counts, keyed.name_key.eqNullSafe(counts.name_key)).drop(counts.name_key)
    return j.withColumn("is_duplicate_name", F.col("name_count") > 1)


def quality_report_customers(customers: DataFrame, flagged_ids=DEFAULT_FLAGGED_IDS) -> DataFrame:
    """Defect counts before cleaning: rows, repeated names, empty/NULL names, flagged ids.

    One scan: customers are counted per normalised name, and the names are summed up.
    """
    name = F.col("company_name")
    per_name = customers.groupBy(compact_name(name)).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(name.isNull() | (strip_ws(name) == "")).alias("blank"),
        F.count_if(F.col("customer_id").isin(*flagged_ids)).alias("flagged"))
    return per_name.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("duplicate_name_rows"),
        F.coalesce(F.sum("blank"), F.lit(0)).alias("empty_or_null_names"), F.coalesce(F.sum("flagged"), F.lit(0)).alias("flagged_duplicates"))


def _time(docs: DataFrame, default_ts=None) -> F.Column:
    """Parsed ``timestamp``; with ``default_ts`` a NULL one gets that time. NULL without the column."""
    if "timestamp" not in docs.columns:
        return F.lit(default_ts).cast("timestamp_ntz")
    if default_ts is None:
        return parse_mixed_timestamp(F.col("timestamp"))
    return parse_with_default(F.col("timestamp"), default_ts)


def normalize_activity(docs: DataFrame, aliases=ACTIVITY_ID_ALIASES, default_ts=None) -> DataFrame:
    """Id coalesce + numeric id, parsed timestamp; raw alias columns are kept (they
    take part in the exact-duplicate test, as in the reference). Documents without
    ``event_type`` take it from ``feature``."""
    out = docs.withColumn("customer_id", normalized_customer_id(docs, aliases))
    ts = _time(docs, default_ts)
    out = out.withColumn("ts", ts).drop("timestamp")
    if "session_duration_sec" in out.columns:
        out = out.withColumnRenamed("session_duration_sec", "session_duration")
    named = F.col("feature").cast("string") if "feature" in out.columns else F.lit(None).cast("string")
    return with_columns_if_absent(out, {"session_duration": F.lit(0.0), "event_type": named})


def dedupe_exact_rows(df: DataFrame, subset=None) -> DataFrame:
    """``drop_duplicates()``: whole-row by default, or on ``subset``."""
    return df.dropDuplicates(subset) if subset else df.dropDuplicates()


def orphan_activity(docs: DataFrame, customers: DataFrame) -> DataFrame:
    """Deduplicated activity whose id is not a known customer (NULL ids included)."""
    n = dedupe_exact_rows(normalize_activity(docs))
    return n.join(customers.select("customer_id"), "customer_id", "left_anti")


def prepared_activity(docs: DataFrame, subset=None, default_ts=None) -> DataFrame:
    """Normalise → exact dedupe → NULL/negative duration → 0; unknown and NULL ids are kept."""
    n = dedupe_exact_rows(normalize_activity(docs, default_ts=default_ts), subset)
    dur = F.coalesce(F.col("session_duration").cast("double"), F.lit(0.0))
    return n.withColumn("session_duration", F.when(dur < 0, F.lit(0.0)).otherwise(dur))


def clean_activity(docs: DataFrame, customers: DataFrame, subset=None, default_ts=None) -> DataFrame:
    """Normalise → exact dedupe → known customers only → NULL/negative duration → 0."""
    return prepared_activity(docs, subset, default_ts).join(customers.select("customer_id"), "customer_id", "left_semi")


def counted_rows(df: DataFrame, subset=None) -> DataFrame:
    """:func:`dedupe_exact_rows` that remembers, in ``_copies``, how many rows became one."""
    keys = subset or df.columns
    rest = [F.first(c).alias(c) for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"), *rest).select(*df.columns, "_copies")


def staged_activity(docs: DataFrame, customers: DataFrame, subset=None, default_ts=None) -> DataFrame:
    """Every distinct normalised event with ``_copies`` and ``_known`` (is its id a customer?).

    Written once (see :mod:`cohortium.jobs`) this table gives the cleaned events and their
    quality report without running the parsing, the de-duplication or the join again.
    Counts come from stored rows, not from metrics collected along the way, which a retried
    stage would add up twice.
    """
    n = counted_rows(normalize_activity(docs, default_ts=default_ts), subset)
    known = customers.select("customer_id", F.lit(True).alias("_known")).where("customer_id IS NOT NULL").distinct()
    return n.join(known, "customer_id", "left").select(*n.columns, F.coalesce("_known", F.lit(False)).alias("_known"))


def activity_from_staged(staged: DataFrame) -> DataFrame:
    """:func:`clean_activity` of the events in ``staged``."""
    dur = F.coalesce(F.col("session_duration").cast("double"), F.lit(0.0))
    return staged.where("_known").drop("_copies", "_known").withColumn("session_duration", F.when(dur < 0, F.lit(0.0)).otherwise(dur))


def report_from_staged(staged: DataFrame) -> DataFrame:
    """Row and defect counts around each activity cleaning step (one row)."""
    known = F.col("_known")
    return staged.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows_before"), F.count(F.lit(1)).alias("rows_after_dedupe"),
        F.count_if(~known).alias("orphan_rows"),
        F.count_if(known & F.col("session_duration").isNull()).alias("null_durations"),
        F.count_if(known & (F.col("session_duration") < 0)).alias("negative_durations"),
        F.count_if(known).alias("rows_after"))


def quality_report_activity(docs: DataFrame, customers: DataFrame) -> DataFrame:
    """:func:`report_from_staged` in one scan of the documents."""
    return report_from_staged(staged_activity(docs, customers))


def clean_nps(docs: DataFrame, aliases=SURVEY_ID_ALIASES, default_ts=None) -> DataFrame:
    """Id coalesce, score from ``nps_score`` else ``score`` (per row), keep 0..10."""
    n = normalize_nps(docs, aliases, default_ts)
    return n.where(F.col("nps_score").between(0, 10))


def normalize_nps(docs: DataFrame, aliases=SURVEY_ID_ALIASES, default_ts=None) -> DataFrame:
    score_cols = [F.col(c) for c in ("nps_score", "score") if c in docs.columns]
    score = F.coalesce(*score_cols).try_cast("double") if score_cols else F.lit(None).cast("double")
    ts = _time(docs, default_ts)
    keep = [c for c in ("response_id",) if c in docs.columns]
    return docs.select(*keep, normalized_customer_id(docs, aliases).alias("customer_id"), ts.alias("ts"),
                       score.alias("nps_score"))


def quality_report_nps(docs: DataFrame) -> DataFrame:
    """Invalid scores (outside 0..10, NULL not counted), NULL scores, rows kept."""
    n = normalize_nps(docs)
    s = F.col("nps_score")
    return n.agg(F.count(F.lit(1)).alias("rows_before"),
                 F.count_if((s < 0) | (s > 10)).alias("invalid_scores"),
                 F.count_if(s.isNull()).alias("null_scores"),
                 F.count_if(s.between(0, 10)).alias("rows_after"))


def clean_onboarding(docs: DataFrame, aliases=SURVEY_ID_ALIASES, default_ts=None) -> DataFrame:
    """Id coalesce, parsed time, step = lower/trim of ``step`` else ``event_step``, dedupe.

    A missing step stays NULL (it is not turned into a step named 'nan').
    """
    return dedupe_exact_rows(normalize_onboarding(docs, aliases, default_ts))


def normalize_onboarding(docs: DataFrame, aliases=SURVEY_ID_ALIASES, default_ts=None) -> DataFrame:
    step_cols = [F.col(c) for c in ("step", "event_step") if c in docs.columns]
    step = F.lower(strip_ws(F.coalesce(*step_cols))) if step_cols else F.lit("unknown")
    ts = _time(docs, default_ts)
    return docs.withColumns({"customer_id": normalized_customer_id(docs, aliases), "ts": ts, "step": step}) \
        .drop("timestamp", "event_step")


def quality_report_onboarding(docs: DataFrame) -> DataFrame:
    """Rows before and after the exact-duplicate removal (one row, one scan)."""
    n = counted_rows(normalize_onboarding(docs))
    one = n.agg(F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows_before"), F.count(F.lit(1)).alias("rows_after"))
    return one.withColumn("duplicates_removed", F.col("rows_before") - F.col("rows_after"))


def normalize_names(accounts: DataFrame) -> DataFrame:
    return accounts.select("customer_id", "company_name",
                           normalize_company_name(F.col("company_name")).alias("norm_name"))
