"""Join with a lookup (one row per key) when a key may hold a third of all rows.

A shuffle join sends every row of a key to one task. AQE splits such a task only where its
rows come straight from an exchange, not when the lookup is an aggregate on the very key of
the join. Here the keys that hold more than ``SHARE`` of the rows are found first, by an exact
count with map-side combine; there are at most 1 / ``SHARE`` of them, so their lookup rows are
broadcast and their rows never shuffled. All other rows take the usual shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortium.session import ensure_checkpoint_dir

SHARE = 1 / 200


def heavy_keys(rows: DataFrame, keys: list[str], share: float = SHARE) -> DataFrame:
    """The keys of more than ``share`` of all rows (at most 1 / ``share``), NULLs left out; stored."""
    ensure_checkpoint_dir(rows.sparkSession)
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).checkpoint()
    total = counts.agg(F.sum("_n")).first()[0] or 0
    heavy = counts.where(F.col("_n") > total * share)
    for k in keys:
        heavy = heavy.where(F.col(k).isNotNull())
    return heavy.select(*keys)


def lookup_join(rows: DataFrame, lookup: DataFrame, keys: list[str], how: str = "inner", share: float = SHARE) -> DataFrame:
    """``rows`` joined (``inner``, ``left``, ``left_semi`` or ``left_anti``) to ``lookup``, which
    has at most one row per key. Rows of heavy keys stay where they are."""
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(how)
    heavy = heavy_keys(rows, keys, share)
    hot_lookup = lookup.join(F.broadcast(heavy), keys, "left_semi")
    hot = rows.join(F.broadcast(heavy), keys, "left_semi").join(F.broadcast(hot_lookup), keys, how)
    # NULL keys match nothing; beside the others they would meet in one task
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    cold = rows.where(known).join(F.broadcast(heavy), keys, "left_anti").join(lookup.join(F.broadcast(heavy), keys, "left_anti"), keys, how)
    out = hot.unionByName(cold)
    if how in ("left", "left_anti"):
        missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in out.schema.fields if f.name not in rows.columns]
        out = out.unionByName(rows.where(~known).select(*rows.columns, *missing))
    return out
