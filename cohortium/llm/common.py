"""Shared helpers of the training-data operators."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortium.session import ensure_checkpoint_dir

TEXT_SCHEMA = "doc_id long, text string"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the shared folder of the session."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, and expressions that are
    not repeatable (row ids) keep one value for every later use.
    """
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Return what Arrow and malloc hold unused to the system."""
    pa.default_memory_pool().release_unused()
    pa.system_memory_pool().release_unused()


def lean(fn):
    """``fn`` for ``mapInArrow``, whose worker gives unused memory back before and after the task.

    A Python worker serves one task after the other; without that it holds the most that any of them needed.
    """
    def run(batches):
        give_back()
        yield from fn(batches)
        give_back()
    return run


def doc_texts(documents: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` only; extra or clashing columns are left out."""
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def packed_rows(documents: DataFrame) -> DataFrame:
    """One column ``row``, the whole row as a struct, so that no inner name can clash with a column."""
    return documents.select(F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("row"))


def text_key(prefix: str = "row.") -> list:
    """(doc, th): the id (NULL as the smallest number) and the hash of the text of a row."""
    doc = F.coalesce(F.col(f"{prefix}doc_id").cast("long"), F.lit(-(1 << 63)))
    return [doc.alias("doc"), F.xxhash64(F.coalesce(F.col(f"{prefix}text").cast("string"), F.lit(""))).alias("th")]


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
