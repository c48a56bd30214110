"""Cross-implementation and invariant tests for the iterative operators."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowtriage.operators import density, iforest, segment, triage
from flowtriage.operators.graph import connected_components


def _textbook_dbscan(X: np.ndarray, eps: float, min_samples: int) -> np.ndarray:
    n = len(X)
    d = np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(-1))
    nb = [np.flatnonzero(d[i] <= eps) for i in range(n)]
    core = np.array([len(v) >= min_samples for v in nb])
    lab = np.full(n, -1)
    c = 0
    for i in range(n):
        if lab[i] != -1 or not core[i]:
            continue
        lab[i] = c
        stack = [i]
        while stack:
            p = stack.pop()
            if not core[p]:
                continue
            for q in nb[p]:
                if lab[q] == -1:
                    lab[q] = c
                    stack.append(q)
        c += 1
    return lab


@pytest.mark.parametrize("leaf", [12, 1500])
@pytest.mark.parametrize("seed,eps,ms", [(0, 0.6, 5), (1, 0.9, 8), (2, 0.4, 3)])
def test_dbscan_matches_sequential(spark, seed, eps, ms, leaf):
    rng = np.random.default_rng(seed)
    X = np.vstack([rng.normal(0, 0.5, (80, 3)), rng.normal(3, 0.7, (70, 3)), rng.uniform(-3, 6, (50, 3))])
    X = np.round(X, 3)
    X[10] = X[11]  # exact duplicates collapse to one weighted point
    df = spark.createDataFrame([(i, *map(float, X[i])) for i in range(len(X))], "session_id long, a double, b double, c double")
    got = {r["session_id"]: r["cluster"] for r in density.dbscan(df, ["a", "b", "c"], eps, ms, leaf_rows=leaf).collect()}
    want = _textbook_dbscan(X, eps, ms)
    assert [got[i] for i in range(len(X))] == want.tolist()


def test_connected_components_long_path(spark):
    n = 40
    edges = [(i, i + 1) for i in range(n - 1)] + [(i + 1, i) for i in range(n - 1)]
    e = spark.createDataFrame(edges, "a long, b long")
    nodes = spark.createDataFrame([(i,) for i in range(n)], "node long")
    comps = connected_components(e, nodes)
    assert {r["comp"] for r in comps.collect()} == {0}


def _blobs(spark, seed=0):
    rng = np.random.default_rng(seed)
    X = np.vstack([rng.normal(c, 0.3, (60, 2)) for c in ((0, 0), (4, 0), (0, 4))])
    return X, spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(X)], "session_id long, x double, y double")


def test_kmeans_invariants_and_partition_independence(spark):
    X, df = _blobs(spark)
    m1 = segment.fit_kmeans_many(df.repartition(1), ["x", "y"], [2, 3], n_init=3)
    m8 = segment.fit_kmeans_many(df.repartition(8), ["x", "y"], [2, 3], n_init=3)
    for k in (2, 3):
        assert np.allclose(np.sort(m1[k].centers, axis=0), np.sort(m8[k].centers, axis=0))
    C = m1[3].centers
    lab = df.select("session_id", "x", "y", segment.assign_expr(C, ["x", "y"]).alias("c")).toPandas()
    d = ((lab[["x", "y"]].to_numpy()[:, None, :] - C[None]) ** 2).sum(-1)
    assert (d.argmin(1) == lab["c"].to_numpy()).all()
    assert lab["c"].value_counts().sum() == len(X)
    assert m1[3].inertia < m1[2].inertia


def test_kmeans_search_picks_three_blobs(spark):
    _, df = _blobs(spark, 1)
    res = segment.kmeans_search(df, ["x", "y"], range(2, 5), n_init=3, sample_size=1000)
    assert res["best_k"] == 3
    assert res["labels"].select("cluster").distinct().count() == 3


def test_isolation_forest_flags_planted_outliers(spark):
    rng = np.random.default_rng(0)
    X = np.vstack([rng.normal(0, 1, (2000, 4)), [[9, 9, 9, 9], [-9, 8, -9, 8], [10, -10, 10, -10]]])
    df = spark.createDataFrame([(i, *map(float, X[i])) for i in range(len(X))], "session_id long, a double, b double, c double, d double")
    forest = iforest.fit_isolation_forest(df, ["a", "b", "c", "d"], n_trees=50)
    scored, _ = triage.contamination_flags(iforest.score(df, forest), 0.04)
    assert scored.agg(F.sum("anomaly_flag")).first()[0] == int(np.floor(0.04 * (len(X) - 1))) + 1
    top = [r["session_id"] for r in scored.orderBy("anomaly_score").limit(3).collect()]
    assert set(top) == {2000, 2001, 2002}


def test_isolation_forest_partition_independent(spark):
    rng = np.random.default_rng(1)
    X = rng.normal(0, 1, (600, 3))
    df = spark.createDataFrame([(i, *map(float, X[i])) for i in range(len(X))], "session_id long, a double, b double, c double")
    f1 = iforest.fit_isolation_forest(df.repartition(1), ["a", "b", "c"], n_trees=20)
    f8 = iforest.fit_isolation_forest(df.repartition(8), ["a", "b", "c"], n_trees=20)
    s1 = {r[0]: r[1] for r in iforest.score(df, f1).collect()}
    s8 = {r[0]: r[1] for r in iforest.score(df, f8).collect()}
    assert all(abs(s1[k] - s8[k]) < 1e-12 for k in s1)


def test_dbscan_hot_duplicate_vector(spark):
    """A third of all rows share one vector: collapsed to one weighted point, same labels."""
    rng = np.random.default_rng(7)
    X = np.round(np.vstack([rng.normal(0, 0.6, (120, 2)), np.tile([[2.0, 2.0]], (100, 1)), rng.uniform(-4, 4, (80, 2))]), 3)
    df = spark.createDataFrame([(i, *map(float, X[i])) for i in range(len(X))], "session_id long, a double, b double")
    got = {r["session_id"]: r["cluster"] for r in density.dbscan(df, ["a", "b"], 0.5, 6, leaf_rows=15).collect()}
    assert [got[i] for i in range(len(X))] == _textbook_dbscan(X, 0.5, 6).tolist()


def test_dbscan_keeps_rows_with_missing_features(spark):
    nan = float("nan")
    rows = [(i, 0.1 * i, 0.0) for i in range(12)] + [(100, None, 0.0), (101, nan, 1.0), (102, 50.0, 50.0)]
    df = spark.createDataFrame(rows, "session_id long, a double, b double")
    got = {r["session_id"]: r["cluster"] for r in density.dbscan(df, ["a", "b"], 0.25, 3, leaf_rows=4).collect()}
    assert got == {**{i: 0 for i in range(12)}, 100: None, 101: None, 102: -1}
    assert density.dbscan(df.limit(0), ["a", "b"], 0.25, 3).count() == 0


def test_dbscan_links_far_components_across_leaves(spark):
    """Two rings of core points: the exact pass finds the one bridge between their components."""
    t = np.linspace(0, 2 * np.pi, 400, endpoint=False)
    rings = np.vstack([np.c_[np.cos(t) * 10, np.sin(t) * 10], np.c_[np.cos(t) * 14, np.sin(t) * 14], [[10.9, 0.0], [11.8, 0.0], [12.7, 0.0], [13.4, 0.0]]])
    for cut in (len(rings), len(rings) - 4):
        df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(rings[:cut])], "session_id long, a double, b double")
        got = {r["session_id"]: r["cluster"] for r in density.dbscan(df, ["a", "b"], 1.0, 3, leaf_rows=20).collect()}
        assert [got[i] for i in range(cut)] == _textbook_dbscan(rings[:cut], 1.0, 3).tolist()


def test_kmeans_empty_partitions_and_more_centres_than_points(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 0.0), (3, 5.0)], "session_id long, x double").repartition(8)
    models = segment.fit_kmeans_many(df, ["x"], [2, 4], n_init=2)
    assert sorted(models[2].centers[:, 0].tolist()) == [0.0, 5.0] and len(models[4].centers) == 2
    with pytest.raises(ValueError):
        segment.fit_kmeans_many(df.limit(0), ["x"], [2], n_init=1)


def test_forest_trees_draw_from_all_rows(spark):
    n = 5000
    df = spark.range(n).selectExpr("id session_id", "cast(id as double) x", "cast(id % 7 as double) y").repartition(6)
    f = iforest.fit_isolation_forest(df, ["x", "y"], n_trees=60, max_samples=64)
    roots = f.nodes[f.nodes["node"] == 0]
    assert len(roots) == 60 and (roots["size"] == 64).all()
    cuts = f.nodes[(f.nodes["feature"] == 0)]["threshold"]
    assert cuts.min() < 0.05 * n and cuts.max() > 0.95 * n
    small = iforest.fit_isolation_forest(df.limit(10), ["x", "y"], n_trees=5)
    assert small.psi == 10 and (small.nodes[small.nodes["node"] == 0]["size"] == 10).all()
