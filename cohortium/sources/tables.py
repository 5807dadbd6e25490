"""Readers for the stored tables and for document collections.

Tables are Parquet (column pruning and filter pushdown reach the scan);
document collections are JSON lines read with an explicit superset schema,
so documents that lack a key get NULL and no schema inference pass runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str, names=TABLES, database: str | None = None) -> list[str]:
    """Namespace selection for SQL users: each table becomes a temp view
    (optionally after ``USE database``), so ``spark.sql`` can name tables
    without paths. Views are lazy; nothing is read here."""
    if database:
        spark.catalog.setCurrentDatabase(database)
    for n in names:
        read_table(spark, sf_dir, n).createOrReplaceTempView(n)
    return list(names)


def scan_table_counts(spark: SparkSession, sf_dir: str, names=TABLES) -> DataFrame:
    """(table, n_rows) for every table: the load log of a full extract.

    Each count is answered from Parquet footers/column-less scans; the
    union is a handful of rows.
    """
    parts = [read_table(spark, sf_dir, n).agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(n).alias("table_name"), "n_rows") for n in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# Superset of the keys an activity document may carry. Ids and timestamps
# vary in name and type between documents; every value is read as text and
# typed later. Spark resolves column names case-insensitively, so keys that
# differ only by case get distinct column names (see ``column_name``).
ACTIVITY_DOC_KEYS = ["customer_id", "customerId", "customerID", "user_id", "userId", "userID",
                     "timestamp", "event_type", "session_duration_sec"]
NUMERIC_KEYS = {"session_duration_sec"}
CASE_CLASH = {"customerID": "customerID_", "userID": "userID_"}


def column_name(key: str) -> str:
    return CASE_CLASH.get(key, key)


def _from_doc_text(text: F.Column, keys) -> list[F.Column]:
    """Look keys up case-sensitively in the parsed document (a string map).

    A value stored as a typed date (``{"$date": ...}``) is unwrapped to its text.
    """
    m = F.from_json(text, T.MapType(T.StringType(), T.StringType()))
    cols = []
    for k in keys:
        v = F.element_at(m, F.lit(k))
        v = F.coalesce(F.get_json_object(v, "$.$date"), v) if k == "timestamp" else v
        cols.append((v.try_cast("double") if k in NUMERIC_KEYS else v).alias(column_name(k)))
    return cols


def read_json_documents(spark: SparkSession, path: str, keys=ACTIVITY_DOC_KEYS) -> DataFrame:
    """``find({}, {_id: 0})``: all documents, ``_id`` not read, absent keys NULL."""
    return spark.read.text(path).select(*_from_doc_text(F.col("value"), keys))


def parse_json_documents(docs: DataFrame, text_col: str, keys=ACTIVITY_DOC_KEYS) -> DataFrame:
    """Same as :func:`read_json_documents` for documents held in a string column."""
    return docs.select(*_from_doc_text(F.col(text_col), keys))


def with_columns_if_absent(df: DataFrame, defaults: dict[str, F.Column]) -> DataFrame:
    """Create a column only when the input does not have it (decided at plan time)."""
    missing = {k: v for k, v in defaults.items() if k not in df.columns}
    return df.withColumns(missing) if missing else df
