"""Bounded, balanced samples of labelled documents for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled_sample(documents: DataFrame, labels: DataFrame, column: str, per_class: int, allowed: Column | None = None) -> DataFrame:
    """About ``per_class`` documents of each value (0, 1) of ``column``: ``doc_id, text, y, weight``.

    Labels are drawn by a hash of the id, at one rate per class (all of them where a
    class is small); ``weight`` is the inverse rate. Only the drawn ids, at most about
    2 x ``per_class`` rows, are broadcast; texts are not shuffled. Rows with a NULL id
    or label are left out; of an id labelled twice the larger label counts.
    """
    y = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("y"))
    y = y.where("doc_id IS NOT NULL AND y IN (0, 1)")
    if allowed is not None:
        y = y.where(allowed)
    y = y.groupBy("doc_id").agg(F.max("y").alias("y"))
    counts = {r["y"]: r["n"] for r in y.groupBy("y").agg(F.count("*").alias("n")).collect()}
    rate = {k: min(1.0, per_class / max(1, n)) for k, n in counts.items()}
    scale = 1 << 30
    draw = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(scale))
    one, zero = rate.get(1, 1.0), rate.get(0, 1.0)
    drawn = y.where(draw < F.when(F.col("y") == 1, int(one * scale)).otherwise(int(zero * scale)))
    drawn = drawn.withColumn("weight", F.when(F.col("y") == 1, 1 / one).otherwise(1 / zero))
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.join(F.broadcast(drawn), "doc_id")


def adam(params: list, gradients, steps: int, rate: float):
    """Plain Adam: ``gradients(params)`` returns one array per parameter."""
    import numpy as np

    m = [np.zeros_like(p) for p in params]
    v = [np.zeros_like(p) for p in params]
    for t in range(1, steps + 1):
        for i, g in enumerate(gradients(params)):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            params[i] = params[i] - rate * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8)
    return params
