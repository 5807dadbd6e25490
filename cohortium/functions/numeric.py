"""Rounding and guarded arithmetic shared by every analysis.

Rounding rule (decided once): money is summed exactly as DECIMAL; ratios
and means are divided as DOUBLE, snapped to DECIMAL(30,6) and only then
rounded. Snapping first makes an exact ``.xx5`` written as a binary double
(0.125 → 0.12499999...) round the same way on every engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SNAP = "decimal(30,6)"


def snap_round(c: Column, scale: int) -> Column:
    """Half-up rounding (SQL ``ROUND``) of a double, via the snap decimal."""
    return F.round(c.cast(SNAP), scale).cast("double")


def snap_bround(c: Column, scale: int) -> Column:
    """Half-even rounding (pandas / document-store ``round``) via the snap decimal."""
    return F.bround(c.cast(SNAP), scale).cast("double")


def safe_div(num: Column, den: Column) -> Column:
    """``num / NULLIF(den, 0)``: NULL instead of an ANSI division error."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def money_mean(total: Column, n: Column) -> Column:
    """Mean of an exact DECIMAL sum over a count, as a double."""
    return safe_div(total, n)
