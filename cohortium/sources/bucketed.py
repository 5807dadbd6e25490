"""Tables bucketed by their join key, so that joins between them need no exchange.

Rows are dealt to buckets once, when a table is written, one sorted file per bucket. Tables
of one key and bucket count then join bucket by bucket: whatever reads them, and however
often, shuffles nothing by that key. Worth it for results that several jobs join again
(the per-customer inputs of the customer-360); the number of buckets is the parallelism of
those joins and should follow the size of the largest table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortium.session import ensure_checkpoint_dir

#: what a bucket of the largest table should hold on a large run
ROWS_PER_BUCKET = 2_000_000


def buckets_for(rows: int, least: int = 8) -> int:
    """Bucket count for a table of ``rows`` rows (a power of two, so that counts divide each other)."""
    return max(least, 1 << max(0, (rows - 1) // ROWS_PER_BUCKET).bit_length())


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int, folder: str | None = None) -> DataFrame:
    """Write ``df`` as table ``name`` with ``buckets`` sorted buckets of ``key`` and return the table.

    Files go to ``folder`` (default: the shared folder of the session). Rows without a key
    stay: they share a bucket and match nothing.
    """
    spark = df.sparkSession
    path = f"{(folder or ensure_checkpoint_dir(spark)).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    (df.repartition(buckets, F.col(key)).write.bucketBy(buckets, key).sortBy(key)
     .option("path", path).mode("overwrite").format("parquet").saveAsTable(name))
    return spark.table(name)
