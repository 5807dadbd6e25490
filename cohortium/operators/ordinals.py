"""Row numbers, ranks, lags and percentiles inside groups without a per-group task.

``Window.partitionBy(g).orderBy(k)`` moves every row of a group into one
task. With a handful of tiers, or one customer holding a third of all rows,
that single task sorts a third of the data. The operators here give the
values of ``row_number``, ``rank`` and ``lag`` using only range partitioning:

1. ``repartitionByRange(g, k, tiebreak)`` spreads a hot group (and even a
   hot tie) over many partitions; equal keys may straddle a boundary.
2. Each partition is sorted and numbered locally in Arrow batches: partition
   number, local row number, local rank, the previous row's values, and
   whether a row belongs to the partition's first group / first tie. The
   result is checkpointed once, so the partition number is a stored property
   of a row: whatever Spark does above it (coalesce, union, another
   partitioning, no exchange reuse), both uses below read the same numbers.
3. One statistics row per partition (first and last key, last local numbers)
   is collected, at most the number of partitions; running sums over them
   give each partition's offsets, which are broadcast.
4. Rows that continue a group or a tie from earlier partitions receive the
   offset, the first row of a partition the last row before it; all others
   keep their local values. A partition without an offset is an error.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortium.session import ensure_checkpoint_dir, shuffle_partitions


@dataclass(frozen=True)
class Key:
    """One ordering column: name, direction and null placement."""

    name: str
    ascending: bool = True
    nulls_first: bool | None = None  # None = Spark default for the direction

    def sort_col(self) -> Column:
        c = F.col(self.name)
        nf = self.nulls_first
        if self.ascending:
            return c.asc_nulls_first() if nf in (None, True) else c.asc_nulls_last()
        return c.desc_nulls_last() if nf in (None, False) else c.desc_nulls_first()


def _as_keys(cols) -> list[Key]:
    return [c if isinstance(c, Key) else Key(c) for c in cols]


def _changed(rows: pa.Table, cols: list[str]) -> np.ndarray:
    """For each row but the first: does its key differ from the row before (NULL = NULL, NaN = NaN)?"""
    n = rows.num_rows - 1
    out = np.zeros(n, dtype=bool)
    for c in cols:
        col = rows.column(c).combine_chunks()
        a, b = col.slice(1), col.slice(0, n)
        same = pc.fill_null(pc.equal(a, b), False)
        same = pc.or_(same, pc.and_(pc.is_null(a), pc.is_null(b)))
        if pa.types.is_floating(col.type):
            same = pc.or_(same, pc.and_(pc.fill_null(pc.is_nan(a), False), pc.fill_null(pc.is_nan(b), False)))
        out |= ~np.asarray(same)
    return out


def _same(a, b) -> bool:
    return all(x == y or (x is None and y is None) or (x is not None and y is not None and x != x and y != y)
               for x, y in zip(a, b))


def _number_locally(g: list[str], k: list[str], lag: list[str]):
    def run(batches):
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        last = None
        seq = rn_last = rk_last = g_seen = k_seen = 0
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            rows = pa.Table.from_batches([b])
            if last is None:
                new_g, new_k = np.zeros(n, bool), np.zeros(n, bool)
                new_g[1:] = _changed(rows, g)
                new_k[1:] = new_g[1:] | _changed(rows, k)
                new_g[0] = new_k[0] = True
                before = pa.concat_tables([rows.slice(0, 1), rows])
            else:
                before = pa.concat_tables([last, rows])
                new_g = _changed(before, g)
                new_k = new_g | _changed(before, k)
            at = np.arange(n)
            g_start = np.maximum.accumulate(np.where(new_g, at, -1))
            rn = np.where(g_start >= 0, at - g_start + 1, rn_last + at + 1)
            k_start = np.maximum.accumulate(np.where(new_k, at, -1))
            rk = np.where(k_start >= 0, rn[np.maximum(k_start, 0)], rk_last)
            g_count, k_count = g_seen + np.cumsum(new_g), k_seen + np.cumsum(new_k)
            cols = [pa.array(np.full(n, pid, "i4")), pa.array(seq + at), pa.array(rn.astype("i8")), pa.array(rk.astype("i8")),
                    pa.array(g_count == 1), pa.array(k_count == 1)]
            names = ["_pid", "_seq", "_lrn", "_lrk", "_head_g", "_head_k"]
            for c in lag:
                col = before.column(c).combine_chunks().slice(0, n)
                cols.append(pc.if_else(pa.array(new_g), pa.scalar(None, col.type), col))
                names.append("_lag_" + c)
            yield pa.RecordBatch.from_arrays([*b.columns, *cols], names=[*b.schema.names, *names])
            last = rows.slice(n - 1, 1)
            rn_last, rk_last, g_seen, k_seen = int(rn[-1]), int(rk[-1]), int(g_count[-1]), int(k_count[-1])
            seq += n
    return run


def _numbered(df: DataFrame, group_cols, order_cols, tiebreak_cols, lag_cols, num_partitions) -> DataFrame:
    """Locally numbered rows (checkpointed) with the offsets of their partition."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    g, lag = list(group_cols), list(lag_cols)
    keys, ties = _as_keys(order_cols), _as_keys(tiebreak_cols)
    k = [x.name for x in keys]
    sort_cols = [F.col(c).asc_nulls_first() for c in g] + [x.sort_col() for x in [*keys, *ties]]
    ranged = df.repartitionByRange(num_partitions or shuffle_partitions(spark), *sort_cols).sortWithinPartitions(*sort_cols)
    helper = [T.StructField("_pid", T.IntegerType()), T.StructField("_seq", T.LongType()),
              T.StructField("_lrn", T.LongType()), T.StructField("_lrk", T.LongType()),
              T.StructField("_head_g", T.BooleanType()), T.StructField("_head_k", T.BooleanType())]
    helper += [T.StructField("_lag_" + c, df.schema[c].dataType) for c in lag]
    local = ranged.mapInArrow(_number_locally(g, k, lag), T.StructType([*df.schema.fields, *helper])).checkpoint()

    def ends(pick, cols):
        return pick(F.struct(F.lit(0).alias("_"), *cols), F.col("_seq"))

    stats = local.groupBy("_pid").agg(
        ends(F.min_by, g).alias("first_g"), ends(F.min_by, k).alias("first_k"),
        ends(F.max_by, g).alias("last_g"), ends(F.max_by, k).alias("last_k"), ends(F.max_by, lag).alias("last_values"),
        F.max_by("_lrn", "_seq").alias("lrn"), F.max_by("_lrk", "_seq").alias("lrk"))
    rows = []
    before = None  # (group, key, rows of the group so far, rank of the last tie, lag values)
    for s in sorted(stats.collect(), key=lambda r: r["_pid"]):  # at most one row per partition
        first_g, first_k, last_g, last_k = (tuple(s[c])[1:] for c in ("first_g", "first_k", "last_g", "last_k"))
        goes_on = before is not None and _same(first_g, before[0])
        offset = before[2] if goes_on else 0
        carry = before[3] if goes_on and _same(first_k, before[1]) else None
        rows.append((s["_pid"], offset, carry, *(before[4] if goes_on else [None] * len(lag))))
        whole_g = _same(first_g, last_g)
        rank = (offset if whole_g else 0) + s["lrk"]
        if whole_g and _same(first_k, last_k) and carry is not None:
            rank = carry
        before = (last_g, last_k, (offset if whole_g else 0) + s["lrn"], rank, tuple(s["last_values"])[1:])
    schema = T.StructType([T.StructField("_pid", T.IntegerType()), T.StructField("_g_off", T.LongType()),
                           T.StructField("_k_carry", T.LongType()),
                           *(T.StructField("_last_" + c, df.schema[c].dataType) for c in lag)])
    offsets = F.broadcast(spark.createDataFrame(rows, schema))
    joined = local.join(offsets, "_pid", "left")
    missing = F.raise_error(F.concat(F.lit("no offset for partition "), F.col("_pid").cast("string"))).cast("long")
    return joined.withColumn("_g_off", F.when(F.col("_head_g"), F.coalesce("_g_off", missing)).otherwise(F.lit(0)))


def within_group_ordinals(df: DataFrame, group_cols, order_cols, tiebreak_cols=(),
                          rn_col: str = "rn", rank_col: str | None = "rk",
                          num_partitions: int | None = None) -> DataFrame:
    """Add ``row_number`` (``rn_col``) and ``rank`` (``rank_col``) within groups.

    ``order_cols`` decide rank ties; ``tiebreak_cols`` (a unique key) make
    ``rn`` deterministic. Same values as the window functions
    ``row_number()/rank() OVER (PARTITION BY g ORDER BY k, tiebreak)``.
    """
    x = _numbered(df, group_cols, order_cols, tiebreak_cols, (), num_partitions)
    out = {rn_col: F.col("_lrn") + F.col("_g_off")}
    if rank_col:
        out[rank_col] = (F.when(F.col("_head_k") & F.col("_k_carry").isNotNull(), F.col("_k_carry"))
                         .otherwise(F.col("_lrk") + F.col("_g_off")))
    return x.select(*df.columns, *(c.alias(n) for n, c in out.items()))


def lag_within_groups(df: DataFrame, group_cols, order_cols, tiebreak_cols, lag_cols,
                      prefix: str = "prev_", num_partitions: int | None = None) -> DataFrame:
    """``LAG(c) OVER (PARTITION BY g ORDER BY k, tiebreak)`` for each c in ``lag_cols``.

    Rows are sorted within range partitions, so the previous row is at hand;
    only a partition's first row takes the last row of the partition before
    it, through the broadcast offsets. One shuffle, no join of rows.
    """
    x = _numbered(df, group_cols, order_cols, tiebreak_cols, lag_cols, num_partitions)
    first = F.col("_seq") == 0
    return x.select(*df.columns, *(F.when(first, F.col("_last_" + c)).otherwise(F.col("_lag_" + c)).alias(prefix + c) for c in lag_cols))


def group_percentiles(df: DataFrame, group_cols, value_col: str, probs: dict[str, float],
                      tiebreak_cols=(), few_groups: bool = False) -> DataFrame:
    """Exact interpolated percentiles per group (``percentile``/``quantile_cont``).

    Position 1 + p·(n−1) in the value order; linear interpolation between
    the two neighbouring rows. Null values are ignored. No group is ever
    gathered into one task: only the two rows at each position are kept.
    ``few_groups`` says that the groups are bounded (tiers, funnel steps, one
    constant): their positions, two per group and probability, are broadcast,
    so the values are not shuffled again.
    """
    g = list(group_cols)
    vals = df.select(*g, value_col, *[c for c in tiebreak_cols]).where(F.col(value_col).isNotNull())
    numbered = within_group_ordinals(vals, g, [value_col], tiebreak_cols, rn_col="_rn", rank_col=None)
    sizes = numbered.groupBy(*g).agg(F.max("_rn").alias("_n"))
    want = []
    for name, p in probs.items():
        pos = F.lit(1.0) + F.lit(float(p)) * (F.col("_n") - 1)
        want.append(F.struct(F.lit(name).alias("pname"), pos.alias("pos")))
    positions = sizes.where("_n IS NOT NULL").select(*g, F.explode(F.array(*want)).alias("w")).select(
        *g, F.col("w.pname").alias("_pname"), F.col("w.pos").alias("_pos"))
    positions = positions.select(*g, "_pname", "_pos", F.explode(F.array_distinct(F.array(
        F.floor("_pos").cast("long"), F.ceil("_pos").cast("long")))).alias("_rn"))
    if few_groups:
        positions = F.broadcast(positions)
    nums = numbered.select(*[F.col(c).alias("_v_" + c) for c in g], F.col("_rn").alias("_v_rn"), value_col)
    cond = [positions[c].eqNullSafe(nums["_v_" + c]) for c in g] + [positions["_rn"] == nums["_v_rn"]]
    joined = nums.join(positions, cond, "inner")
    per = joined.groupBy(*g, "_pname", "_pos").agg(
        F.min_by(value_col, "_rn").alias("_lo"), F.max_by(value_col, "_rn").alias("_hi"))
    frac = F.col("_pos") - F.floor("_pos")
    per = per.select(*g, "_pname", (F.col("_lo") + frac * (F.col("_hi") - F.col("_lo"))).alias("_val"))
    return per.groupBy(*g).agg(*[F.max(F.when(F.col("_pname") == name, F.col("_val"))).alias(name)
                                 for name in probs])
