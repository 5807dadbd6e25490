"""Attach a one-row result (bounds, medians, totals) to every row of a frame.

Each column of the one-row frame becomes a scalar subquery. Spark merges
scalar subqueries over the same plan (``MergeScalarSubqueries``), so the
one-row aggregate runs once and its values reach the tasks as literals: no
join, no cross product, no nested-loop join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """``df`` with every column of the (exactly) one-row frame ``one_row`` added."""
    return df.withColumns({c: one_row.select(F.col(c)).scalar() for c in one_row.columns})
