"""Join of spans with the points inside them, by dyadic intervals.

Days are cut into the intervals of a binary tree: level l holds runs of 2^l days. Any span
is the disjoint union of at most two runs a level, so at most 2·log2(range) rows; a day lies
in exactly one run of each level. A span and a day inside it therefore meet under exactly one
key, and "which points lie in which spans" is a plain equi-join on (keys, level, run): no
nested loop, no residual condition, and the rows are linear in spans and points whatever the
spans' lengths. A key with very many spans and points is spread over its runs.

That is some twenty rows for each point. Where a key has at most ``FEW`` spans it is cheaper to
meet them all: a point is held against ``FEW`` spans at most, so this too is linear in the points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortium.session import ensure_checkpoint_dir

#: days from 1970 that a date may have: 2^LEVELS (about the year 2840)
LEVELS = 18
#: spans of a key up to which its points are held against each of them
FEW = 48


def day_number(c: Column) -> Column:
    """Days since 1970-01-01 of a date or time."""
    return F.datediff(c.cast("date"), F.lit("1970-01-01").cast("date"))


def dyadic_cover(first: Column, last: Column) -> Column:
    """The runs (level, run) whose disjoint union is the days ``first`` to ``last``, both included.

    Empty if ``last`` is before ``first``; NULL if either is NULL.
    """
    start = F.struct(first.cast("int").alias("a"), last.cast("int").alias("b"),
                     F.array().cast("array<struct<level:int,run:int>>").alias("runs"))

    def step(s: Column, level: Column) -> Column:
        a, b = s["a"], s["b"]
        own = a.bitwiseAND(F.lit(1)) == 1  # the right child alone: its parent would begin too early
        end = b.bitwiseAND(F.lit(1)) == 0  # the left child alone: its parent would end too late
        run = lambda x: F.array(F.struct(level.cast("int").alias("level"), x.alias("run")))
        none = F.array().cast("array<struct<level:int,run:int>>")
        runs = F.concat(s["runs"], F.when((a <= b) & own, run(a)).otherwise(none), F.when((a <= b) & end & ~(own & (a == b)), run(b)).otherwise(none))
        up = F.struct(F.shiftright(F.when(own, a + 1).otherwise(a), 1).alias("a"), F.shiftright(F.when(end, b - 1).otherwise(b), 1).alias("b"), runs.alias("runs"))
        return F.when(a <= b, up).otherwise(s)

    cover = F.aggregate(F.sequence(F.lit(0), F.lit(LEVELS)), start, step, lambda s: s["runs"])
    return F.when(first.isNotNull() & last.isNotNull(), cover)


def points_in_spans(spans: DataFrame, points: DataFrame, keys: list[str], first: str, last: str, at: str) -> DataFrame:
    """Every pair of a span and a point of equal ``keys`` whose day lies in the span.

    ``first`` and ``last`` are the span's first and last day (a NULL ``last`` is open, a NULL
    ``first`` no span); ``at`` is the point's day or time. The columns of both follow, those of
    ``keys`` once. NULL keys match nothing; days before 1970 are an error.
    """
    ensure_checkpoint_dir(spans.sparkSession)
    low, high = day_number(F.col(first)), F.coalesce(day_number(F.col(last)), F.lit((1 << LEVELS) - 1))
    checked = F.when(low < 0, F.raise_error(F.lit("span before 1970")).cast("int")).otherwise(low)
    day = F.when(day_number(F.col(at)) < 0, F.raise_error(F.lit("point before 1970")).cast("int")).otherwise(day_number(F.col(at)))
    spans = spans.withColumns({"_low": checked, "_high": high}).checkpoint()
    points = points.where(F.col(at).isNotNull()).withColumn("_day", day).checkpoint()
    many = spans.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > FEW).select(*keys).checkpoint()
    if many.isEmpty():
        return _by_key(spans, points, keys)
    met = _by_run(spans.join(many, keys, "left_semi"), points.join(many, keys, "left_semi"), keys)
    return met.unionByName(_by_key(spans.join(many, keys, "left_anti"), points.join(many, keys, "left_anti"), keys))


def _by_key(spans: DataFrame, points: DataFrame, keys: list[str]) -> DataFrame:
    """Every point held against all spans of its key."""
    # the rows of a key are kept in memory for the right side only
    met = points.join(spans, keys).where((F.col("_day") >= F.col("_low")) & (F.col("_day") <= F.col("_high")))
    columns = [*keys, *(c for frame in (spans, points) for c in frame.columns if c not in keys)]
    return met.select(*columns).drop("_low", "_high", "_day")


def _by_run(spans: DataFrame, points: DataFrame, keys: list[str]) -> DataFrame:
    """Spans and points met at the one dyadic run that both have."""
    def key(run: Column) -> Column:
        return F.shiftleft(run["level"].cast("long"), 32) + run["run"]

    runs = spans.select("*", F.explode(F.transform(dyadic_cover(F.col("_low"), F.col("_high")), key)).alias("_run"))
    held = points.select("*", F.explode(F.transform(F.sequence(F.lit(0), F.lit(LEVELS)), lambda lv: key(
        F.struct(lv.alias("level"), F.floor(F.col("_day") / F.pow(F.lit(2), lv)).cast("int").alias("run"))))).alias("_run"))
    return runs.join(held, [*keys, "_run"]).drop("_run", "_low", "_high", "_day")
