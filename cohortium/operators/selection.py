"""Exact percentiles of few groups by distributed selection: no sort, no row is shuffled.

A percentile needs the values at two ranks. Each wanted rank is enclosed by a bracket of
values, and the bracket is narrowed a round at a time:

1. a sketch (``percentile_approx``) of the values inside the bracket proposes ``GRID``
   cuts, of which one a little below and one a little above the rank are taken;
2. counting the rows below, at and between the two tells *exactly* where the rank lies: at
   one of the two values (however often it is repeated), strictly between them, or, should
   the sketch be off, outside; the bracket becomes that range;
3. once a bracket holds at most ``SMALL`` rows, they are sorted in one small aggregate per
   rank, which returns the one value.

Every step is an aggregate with map-side combine over the values, kept once as narrow rows
in the shared folder. A round narrows a bracket some 300-fold, so a trillion rows take four
rounds of two passes. The driver holds a few numbers for each group and rank: this is for
groups that a parameter bounds (tiers, steps, a constant).

NULL values are ignored; NaN counts as larger than every number, as in Spark's order, and
infinities are numbers. A group without values has no row; NULL is a group like any other.
Values become DOUBLE (whole numbers beyond 2^53 are rounded).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortium.session import ensure_checkpoint_dir

ACCURACY = 10_000
GRID = 1_000
SMALL = 2_000
MAX_GROUPS = 10_000


@dataclass
class Rank:
    """A wanted rank (from 1) among the numbers of a group, and the bracket that holds it."""

    group: tuple
    rank: int
    inside: int  # rows in the bracket
    before: int = 0  # rows below it
    low: float | None = None  # open bounds, None for none
    high: float | None = None
    value: float | None = None

    def settle(self, a: float, b: float, below: int, at_a: int, between: int, at_b: int) -> None:
        """Narrow the bracket by its rows below ``a``, at ``a``, between ``a`` and ``b``, and at ``b``."""
        k = self.rank - self.before
        rest = below + at_a + between + at_b
        if k <= below:
            self.high, self.inside = a, below
        elif k <= below + at_a:
            self.value = a
        elif k <= below + at_a + between:
            self.low, self.high, self.inside, self.before = a, b, between, self.before + below + at_a
        elif k <= rest:
            self.value = b
        else:
            self.low, self.inside, self.before = b, self.inside - rest, self.before + rest


def _met(values: DataFrame, groups: list[T.StructField], ranks: list[Rank], **numbers: list[float]) -> DataFrame:
    """Values inside the brackets of their group's ranks, with the rank's number ``_t`` and ``numbers``."""
    fields = [*(T.StructField(f"_g{i}", f.dataType) for i, f in enumerate(groups)), T.StructField("_t", T.IntegerType()),
              T.StructField("_low", T.DoubleType()), T.StructField("_high", T.DoubleType()), *(T.StructField(n, T.DoubleType()) for n in numbers)]
    rows = [(*r.group, i, r.low, r.high, *(numbers[n][i] for n in numbers)) for i, r in enumerate(ranks)]
    brackets = F.broadcast(values.sparkSession.createDataFrame(rows, T.StructType(fields)))
    on = [F.col(f"_v{i}").eqNullSafe(F.col(f"_g{i}")) for i in range(len(groups))]
    inside = (F.col("_low").isNull() | (F.col("_v") > F.col("_low"))) & (F.col("_high").isNull() | (F.col("_v") < F.col("_high")))
    return values.join(brackets, [*on, inside])


def _narrow(values: DataFrame, groups: list[T.StructField], ranks: list[Rank]) -> None:
    """One sketch pass and one counting pass for ranks whose brackets are large."""
    cuts = [i / GRID for i in range(GRID + 1)]
    grids = {r["_t"]: r["grid"] for r in _met(values, groups, ranks).groupBy("_t").agg(F.percentile_approx("_v", cuts, ACCURACY).alias("grid")).collect()}
    a, b = [], []
    for i, r in enumerate(ranks):
        at = (r.rank - r.before) / r.inside * GRID
        a.append(float(grids[i][max(0, math.floor(at) - 1)]))
        b.append(float(grids[i][min(GRID, math.ceil(at) + 1)]))
    v, va, vb = F.col("_v"), F.col("_a"), F.col("_b")
    counts = _met(values, groups, ranks, _a=a, _b=b).groupBy("_t").agg(
        F.count_if(v < va).alias("below"), F.count_if(v == va).alias("at_a"), F.count_if((v > va) & (v < vb)).alias("between"),
        F.count_if((v == vb) & (va < vb)).alias("at_b"))
    for c in counts.collect():
        ranks[c["_t"]].settle(a[c["_t"]], b[c["_t"]], c["below"], c["at_a"], c["between"], c["at_b"])


def _read(values: DataFrame, groups: list[T.StructField], ranks: list[Rank]) -> None:
    """The values of ranks whose brackets are small."""
    at = [float(r.rank - r.before - 1) for r in ranks]
    inside = _met(values, groups, ranks, _at=at).groupBy("_t").agg(F.sort_array(F.collect_list("_v")).alias("all"), F.first("_at").cast("int").alias("at"))
    for r in inside.select("_t", F.get("all", F.col("at")).alias("value")).collect():
        ranks[r["_t"]].value = r["value"]


def select_ranks(values: DataFrame, groups: list[T.StructField], ranks: list[Rank], small: int = SMALL) -> None:
    """Find the value of every rank; ``values`` has the groups as ``_v0, _v1, ...`` and ``_v``."""
    while open_ranks := [r for r in ranks if r.value is None]:
        large = [r for r in open_ranks if r.inside > small]
        if large:
            _narrow(values, groups, large)
        else:
            _read(values, groups, open_ranks)


def few_group_percentiles(df: DataFrame, group_cols, value_col: str, probs: dict[str, float], small: int = SMALL) -> DataFrame:
    """Exact interpolated percentiles per group (as ``percentile``/``quantile_cont``).

    Position 1 + p·(n−1) in the value order, linear between its two neighbours; columns are
    the groups and the names of ``probs``. More than ``MAX_GROUPS`` groups are an error.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    groups = [df.schema[c] for c in group_cols] or [T.StructField("all", T.IntegerType())]
    keys = [F.col(c) for c in group_cols] or [F.lit(0)]
    values = df.select(*(k.alias(f"_v{i}") for i, k in enumerate(keys)), F.col(value_col).cast("double").alias("_v")).where("_v IS NOT NULL").checkpoint()
    names = [f"_v{i}" for i in range(len(groups))]
    sizes = values.groupBy(*names).agg(F.count("*").alias("n"), F.count_if(F.isnan("_v")).alias("n_nan")).limit(MAX_GROUPS + 1).collect()
    if len(sizes) > MAX_GROUPS:
        raise ValueError(f"more than {MAX_GROUPS} groups")
    numbers = values.where(~F.isnan("_v"))
    ranks: dict[tuple, Rank] = {}

    def wanted(group: tuple, rank: int, n: int) -> Rank:
        return ranks.setdefault((group, rank), Rank(group, rank, n, value=None if rank <= n else math.nan))

    ends = []
    for s in sizes:
        group, n = tuple(s[c] for c in names), s["n"] - s["n_nan"]
        for p in probs.values():
            pos = 1 + float(p) * (s["n"] - 1)
            ends.append((wanted(group, math.floor(pos), n), wanted(group, math.ceil(pos), n), pos - math.floor(pos)))
    select_ranks(numbers, groups, list(ranks.values()), small)

    def between(lo: Rank, hi: Rank, share: float) -> float:
        return lo.value if lo.value == hi.value or not share else lo.value + share * (hi.value - lo.value)

    found = iter(ends)
    rows = [(*(s[c] for c in names), *(between(*next(found)) for _ in probs)) for s in sizes]
    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in groups), *(T.StructField(name, T.DoubleType()) for name in probs)])
    return spark.createDataFrame(rows, schema).select(*group_cols, *probs)
