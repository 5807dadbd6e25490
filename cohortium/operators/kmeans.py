"""Multi-start k-means where every start advances in the same pass over the data.

Best-of-n k-means (k-means++ seeding, Lloyd iterations, lowest inertia
wins) fitted as n separate models reads the data n times per iteration.
Here the starts share the passes:

* seeding: one aggregate pass per centre index picks the next centre of
  *every* start at once. Each start draws with D² weights through
  exponential keys (``-ln(u) / D²``, the smallest wins), where ``u`` is a
  hash of (row id, start seed, step). The draw does not depend on
  partitioning or task retries.
* Lloyd: each row is paired with the still-moving starts (``explode`` of
  at most n small integers, never shuffled) and assigned per start. A
  ``groupBy(start, cluster)`` sum, with map-side partial aggregation,
  returns at most n·k rows of centre sums to the driver.

The centres travel to the tasks as a broadcast table of at most n rows of
k·d doubles.
Starts stop when their total squared centre shift is at most
``tol × mean feature variance`` (the usual relative tolerance), or
after ``max_iter`` iterations. An empty cluster keeps its previous centre.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_U53 = float(1 << 53)


def _uniform(id_col: str, seed, step: int) -> Column:
    """Deterministic uniform draw in (0, 1) from (row id, seed, step)."""
    seed = seed if isinstance(seed, Column) else F.lit(seed)
    h = F.xxhash64(F.col(id_col), seed.cast("long"), F.lit(step)).bitwiseAND(F.lit((1 << 53) - 1))
    return (h.cast("double") + F.lit(0.5)) / F.lit(_U53)


def _sq_dist(xs: list[Column], centre: list[Column]) -> Column:
    return sum(((x - c) * (x - c) for x, c in zip(xs, centre)), F.lit(0.0))


def _centre_table(spark, centres: list[list[list[float]]], starts: list[int]) -> DataFrame:
    """One row per start: ``_s`` and the k·d centre coordinates as columns ``_c{j}_{i}``."""
    k, d = len(centres[0]), len(centres[0][0])
    cols = ["_s"] + [f"_c{j}_{i}" for j in range(k) for i in range(d)]
    rows = [(s, *[float(v) for c in centres[s] for v in c]) for s in starts]
    return spark.createDataFrame(rows, cols)


def _mean_variance(data: DataFrame, xcols: list[str]) -> float:
    """Mean over the features of their population variance (one aggregate row)."""
    v = data.agg(*[F.var_pop(c).alias(f"v{j}") for j, c in enumerate(xcols)]).first()
    return sum(v[f"v{j}"] or 0.0 for j in range(len(xcols))) / len(xcols)


def _seed_centres(data: DataFrame, id_col: str, xcols: list[str], k: int, seeds: list[int]):
    """k-means++ seeding for every start (one pass per centre index); also returns
    the mean feature variance (from the first pass)."""
    spark = data.sparkSession
    xs = [F.col(c) for c in xcols]
    point = F.array(*xs)
    starts = list(range(len(seeds)))
    mean_var = 0.0
    centres: list[list[list[float]]] = [[] for _ in starts]
    for step in range(k):
        rows = [(s, seeds[s], *[float(x) for c in centres[s] for x in c]) for s in starts]
        cen = spark.createDataFrame(rows, ["_s", "_seed"] + [f"_c{j}_{i}" for j in range(step)
                                                             for i in range(len(xcols))])
        e = data.select(F.col(id_col), *xs, F.explode(F.array(*[F.lit(s) for s in starts])).alias("_s")) \
            .join(F.broadcast(cen), "_s")
        u = _uniform(id_col, F.col("_seed"), step)
        if step == 0:
            key = u
        else:
            _, d2 = _nearest(xs, [[F.col(f"_c{j}_{i}") for i in range(len(xs))] for j in range(step)])
            key = F.when(d2 > 0, -F.log(u) / d2)
        # step 0 also yields the feature variances: every start's group holds each row once
        var = [F.var_pop(c).alias(f"_v{j}") for j, c in enumerate(xcols)] if step == 0 else []
        got = e.groupBy("_s").agg(F.min_by(point, key).alias("_p"), *var).collect()
        picked = {r["_s"]: r["_p"] for r in got}
        if step == 0:
            if not any(p is not None for p in picked.values()):
                return None, mean_var  # no rows
            mean_var = sum(got[0][f"_v{j}"] or 0.0 for j in range(len(xcols))) / len(xcols)
        for s in starts:
            # fewer distinct points than k: repeat the first centre
            p = picked.get(s)
            centres[s].append(list(p) if p is not None else list(centres[s][0]))
    return centres, mean_var


def _nearest(xs: list[Column], centres: list[list[Column]]) -> tuple[Column, Column]:
    """(index of the nearest centre, squared distance to it); ties → lowest index."""
    d = F.array(*[_sq_dist(xs, c) for c in centres])
    dmin = F.array_min(d)
    return (F.array_position(d, dmin) - 1).cast("int"), dmin


def _pass(data: DataFrame, xcols: list[str], centres, starts: list[int], k: int):
    """One Lloyd pass for ``starts``: {start: {cluster: (n, sums, sum_d2)}}.

    The centres arrive through a broadcast equi-join on the start id (at most
    n rows), so the generated code is the same in every iteration.
    """
    xs = [F.col(c) for c in xcols]
    cen = _centre_table(data.sparkSession, centres, starts)
    e = data.select(*xs, F.explode(F.array(*[F.lit(s) for s in starts])).alias("_s")).join(F.broadcast(cen), "_s")
    cl, dmin = _nearest(xs, [[F.col(f"_c{j}_{i}") for i in range(len(xs))] for j in range(k)])
    agg = e.select("_s", *xs, cl.alias("_cl"), dmin.alias("_d")).groupBy("_s", "_cl").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_d").alias("_sd"), *[F.sum(c).alias(f"_x{j}") for j, c in enumerate(xcols)])
    out: dict[int, dict[int, tuple]] = {s: {} for s in starts}
    for r in agg.collect():
        out[r["_s"]][r["_cl"]] = (r["_n"], [r[f"_x{j}"] for j in range(len(xcols))], r["_sd"])
    return out


def multi_start_kmeans(data: DataFrame, id_col: str, xcols: list[str], k: int, seeds, max_iter: int = 300,
                       tol: float = 1e-4, init_centres=None):
    """Fit k-means from ``len(seeds)`` starts; return (best centres, inertia per start, iterations per start).
    Without rows: ``(None, [], [])``.

    ``data`` is read once per seeding step and once per iteration; persist or
    checkpoint it first. ``init_centres`` (starts × k × d) skips the seeding.
    """
    seeds = list(seeds)
    if init_centres is None:
        centres, mean_var = _seed_centres(data, id_col, xcols, k, seeds)
    else:
        centres = [[list(map(float, c)) for c in cs] for cs in init_centres]
        mean_var = _mean_variance(data, xcols)
    if centres is None:
        return None, [], []
    tol_abs = tol * mean_var
    active = list(range(len(centres)))
    iters = [0] * len(centres)
    for _ in range(max_iter):
        if not active:
            break
        stats = _pass(data, xcols, centres, active, k)
        still = []
        for s in active:
            new = []
            for j in range(k):
                n, sums, _ = stats[s].get(j, (0, None, None))
                new.append([x / n for x in sums] if n else centres[s][j])
            shift = sum((a - b) ** 2 for c0, c1 in zip(centres[s], new) for a, b in zip(c0, c1))
            centres[s] = new
            iters[s] += 1
            if shift > tol_abs:
                still.append(s)
        active = still
    # inertia of every start with its final centres: one more shared pass
    final = _pass(data, xcols, centres, list(range(len(centres))), k)
    inertia = [sum(v[2] for v in final[s].values()) for s in range(len(centres))]
    best = min(range(len(centres)), key=lambda s: (inertia[s], s))
    return centres[best], inertia, iters


def assign_clusters(xcols: list[str], centres) -> Column:
    """Column expression: index of the nearest of ``centres`` (ties → lowest index)."""
    return _nearest([F.col(c) for c in xcols], [[F.lit(float(v)) for v in c] for c in centres])[0]

