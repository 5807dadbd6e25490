"""Registry of named queries: the Spark plan and its DuckDB oracle SQL.

Each entry binds one analysis of :mod:`cohortium.plans` to the test tables
(via :mod:`cohortium.sources.bindings`) and gives the same question as plain
SQL over the same tables. Column names and types agree on both sides:
money and ratios leave as DOUBLE after the snap rounding, counts as BIGINT.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortium.deploy import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[key] = run
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def sround(expr: str, n: int) -> str:
    """SQL twin of :func:`cohortium.functions.numeric.snap_round`."""
    return f"CAST(round(CAST({expr} AS DECIMAL(30,6)), {n}) AS DOUBLE)"


def sbround(expr: str, n: int) -> str:
    """SQL twin of :func:`cohortium.functions.numeric.snap_bround`."""
    return f"CAST(round_even(CAST({expr} AS DECIMAL(30,6)), {n}) AS DOUBLE)"


def sdiv(num: str, den: str) -> str:
    return f"(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0))"


# import the entry modules so their @register calls run
from cohortium import entries  # noqa: E402,F401
