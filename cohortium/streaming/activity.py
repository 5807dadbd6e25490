"""Incremental activity cleaning with Structured Streaming.

The reference cleans a document collection in one batch. The same cleaning
functions accept a streaming DataFrame, so newly landed activity documents
can be cleaned as they arrive: documents are read with the superset
schema, normalised, de-duplicated within an event-time watermark (exact
duplicates re-delivered later than the watermark are not caught, which is
the price of bounded state), restricted to known customers (stream–static
join) and appended to a table by the Parquet file sink. The checkpoint
folder makes the query restartable after a failure.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortium.plans.cleaning import normalize_activity
from cohortium.sources.tables import parse_json_documents


def read_activity_stream(spark: SparkSession, docs_dir: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """New JSON-lines files of ``docs_dir`` as documents (same parsing as the batch reader)."""
    lines = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger).text(docs_dir)
    return parse_json_documents(lines, "value")


def clean_activity_stream(docs: DataFrame, customers: DataFrame, watermark: str = "1 day") -> DataFrame:
    """Streaming twin of :func:`cohortium.plans.cleaning.clean_activity`."""
    n = normalize_activity(docs)
    cols = list(n.columns)
    # the watermark needs a zoned timestamp; ts itself stays timestamp_ntz
    n = n.withColumn("_event_time", F.col("ts").cast("timestamp")).withWatermark("_event_time", watermark)
    n = n.dropDuplicatesWithinWatermark(cols).drop("_event_time")
    known = n.join(customers.select("customer_id"), "customer_id", "left_semi")
    dur = F.coalesce(F.col("session_duration").cast("double"), F.lit(0.0))
    return known.withColumn("session_duration", F.when(dur < 0, F.lit(0.0)).otherwise(dur))


def start_clean_activity_sink(cleaned: DataFrame, table_path: str, checkpoint: str, trigger_once: bool = False):
    """Append to a Parquet table with the file sink; returns the running query.

    The sink's own log names the files of each batch, so a batch that is run again
    after a failure replaces its files instead of adding rows twice.
    """
    w = cleaned.writeStream.format("parquet").option("path", table_path).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start()
