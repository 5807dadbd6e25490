"""Shared-pass multi-start k-means against a brute-force Lloyd in NumPy."""

import numpy as np

from cohortium.operators.kmeans import assign_clusters, multi_start_kmeans


def _frame(spark, pts, parts=4):
    rows = [(i, *map(float, p)) for i, p in enumerate(pts)]
    return spark.createDataFrame(rows, ["id", "a", "b", "c"]).repartition(parts)


def _lloyd(x, centres, tol, max_iter):
    c = np.array(centres, dtype=float)
    tol_abs = tol * x.var(axis=0).mean()
    for _ in range(max_iter):
        d = ((x[:, None, :] - c[None, :, :]) ** 2).sum(axis=2)
        lab = d.argmin(axis=1)
        new = np.array([x[lab == j].mean(axis=0) if (lab == j).any() else c[j] for j in range(len(c))])
        shift = ((new - c) ** 2).sum()
        c = new
        if shift <= tol_abs:
            break
    d = ((x[:, None, :] - c[None, :, :]) ** 2).sum(axis=2)
    return c, d.min(axis=1).sum()


def test_lloyd_matches_numpy_from_the_same_starts(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(400, 3)) + np.repeat(rng.normal(scale=3, size=(4, 3)), 100, axis=0)
    starts = [x[rng.choice(len(x), 4, replace=False)].tolist() for _ in range(3)]
    best, inertia, _ = multi_start_kmeans(_frame(spark, x), "id", ["a", "b", "c"], 4, seeds=range(3),
                                          init_centres=starts, tol=1e-6)
    ref = [_lloyd(x, s, 1e-6, 300) for s in starts]
    for got, (_, want) in zip(inertia, ref):
        assert abs(got - want) <= 1e-6 * max(1.0, want)
    b = min(range(3), key=lambda i: (ref[i][1], i))
    np.testing.assert_allclose(np.array(best), ref[b][0], rtol=1e-9, atol=1e-9)


def test_separated_blobs_are_recovered(spark):
    rng = np.random.default_rng(3)
    centres = np.array([[0, 0, 0], [20, 0, 0], [0, 20, 0], [0, 0, 20]], dtype=float)
    x = np.vstack([c + rng.normal(scale=0.5, size=(50, 3)) for c in centres])
    df = _frame(spark, x)
    best, _, _ = multi_start_kmeans(df, "id", ["a", "b", "c"], 4, seeds=range(42, 52))
    lab = {r["id"]: r["cl"] for r in df.select("id", assign_clusters(["a", "b", "c"], best).alias("cl")).collect()}
    groups = [{lab[i] for i in range(g * 50, g * 50 + 50)} for g in range(4)]
    assert all(len(g) == 1 for g in groups) and len(set.union(*groups)) == 4


def test_seeding_does_not_depend_on_partitioning(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(300, 3))
    a = multi_start_kmeans(_frame(spark, x, 2), "id", ["a", "b", "c"], 3, seeds=[1, 2], max_iter=5)
    b = multi_start_kmeans(_frame(spark, x, 7), "id", ["a", "b", "c"], 3, seeds=[1, 2], max_iter=5)
    np.testing.assert_allclose(np.array(a[0]), np.array(b[0]), rtol=1e-9)
    assert a[2] == b[2]


def test_no_rows(spark):
    df = spark.createDataFrame([], "id long, a double, b double, c double")
    assert multi_start_kmeans(df, "id", ["a", "b", "c"], 4, seeds=range(3)) == (None, [], [])
