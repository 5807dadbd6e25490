"""Sinks: full-refresh lookup tables and dashboard mart exports.

Writes are whole-table overwrites, so re-running a job after a failure (or
after a lost executor forced a retry) leaves the same result. Output goes
to the folder the caller names (on a cluster: shared storage).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class DuplicateKeyError(ValueError):
    pass


def assert_unique(df: DataFrame, key: str) -> None:
    """Fail when ``key`` repeats (the unique index of a lookup collection).

    One aggregate job; only two numbers reach the driver.
    """
    r = df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(key).alias("k"),
               F.count_if(F.col(key).isNull()).alias("nulls")).first()
    if r["n"] != r["k"] or r["nulls"]:
        raise DuplicateKeyError(f"{key}: {r['n']} rows, {r['k']} distinct, {r['nulls']} null")


def write_lookup_table(df: DataFrame, path: str, key: str = "customer_id") -> str:
    """Drop-and-recreate a lookup table whose key is unique (idempotent).

    ``df`` runs once: it is written beside the table, what was written is checked,
    and only then takes the table's place, so a failed check leaves the old table.
    """
    spark = df.sparkSession
    staged, old = f"{path}._new", f"{path}._old"
    df.write.mode("overwrite").parquet(staged)
    assert_unique(spark.read.schema(df.schema).parquet(staged), key)
    jvm = spark.sparkContext._jvm
    place = {p: jvm.org.apache.hadoop.fs.Path(p) for p in (path, staged, old)}
    fs = place[path].getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(place[old], True)
    if fs.exists(place[path]) and not fs.rename(place[path], place[old]):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(place[staged], place[path]):
        raise OSError(f"cannot move {staged} to {path}")
    fs.delete(place[old], True)
    return path


def write_mart(df: DataFrame, path: str, fmt: str = "csv", single_file: bool = False) -> str:
    """Export a mart: CSV with a header (no index) or Parquet, overwriting.

    ``single_file=True`` coalesces to one task first; only for marts whose
    size is bounded (monthly or per-tier rollups), never for per-customer data.
    """
    out = df.coalesce(1) if single_file else df
    w = out.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "parquet":
        w.parquet(path)
    else:
        raise ValueError(fmt)
    return path
