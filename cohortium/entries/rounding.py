"""Rounding of reported floats, applied where results are compared, not inside the library.

Sums of doubles depend on their order; six decimals hide that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def snap6_col(c: Column) -> Column:
    return F.round(c.cast("decimal(38,10)"), 6).cast("double")


def snapped(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` with the named float columns rounded."""
    return df.withColumns({c: snap6_col(F.col(c)) for c in columns})


def snap6(expr) -> str:
    """SQL twin of :func:`snap6_col`."""
    return f"CAST(round(CAST({expr} AS DECIMAL(38,10)), 6) AS DOUBLE)"
