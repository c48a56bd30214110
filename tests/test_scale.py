"""What grows with the input: visits of points, passes over rows and baskets."""

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from flowtriage.operators import baskets, density, iforest, segment


def test_a_point_visits_an_area_once(spark, monkeypatch):
    """Points are sent to areas, not to every leaf within eps, and only what is short of neighbours or not core is sent."""
    sent = []
    keep = density.materialise

    def watched(df, name):
        out = keep(df, name)
        if name == "visits":
            sent.append((out.count(), out.select("pid", "dest").distinct().count()))
        return out

    monkeypatch.setattr(density, "materialise", watched)
    rng = np.random.default_rng(3)
    x = np.round(np.concatenate([rng.normal(size=(500, 2)), rng.normal(size=(300, 2)) + 9]), 2)
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "session_id long, a double, b double").repartition(3)
    got = {r["session_id"]: r["cluster"] for r in density.dbscan(df, ["a", "b"], 1.0, 5, leaf_rows=8).collect()}
    near = ((x[:, None, :] - x[None, :, :]) ** 2).sum(2) <= 1.0
    core = near.sum(1) >= 5
    assert all((got[i] == -1) == (not (near[i] & core).any()) for i in range(len(x)))
    assert all(got[i] == got[j] for i in np.flatnonzero(core) for j in np.flatnonzero(near[i] & core))
    assert all(n == once for n, once in sent)
    assert sum(n for n, _ in sent) < 5 * len(x)


def test_lloyd_pass_of_models_of_any_k(spark):
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(size=(700, 3)), 2)
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "k long, a double, b double, c double").repartition(3)
    models = {"two": x[:2], "same": np.vstack([x[:1]] * 3), "five": x[5:10], "two again": x[20:22]}
    got = segment.lloyd_pass(df, ["a", "b", "c"], models)
    for name, centres in models.items():
        d = ((x[:, None, :] - centres[None, :, :]) ** 2).sum(2)
        own = d.argmin(1)
        sums, n, inertia = got[name]
        assert n.tolist() == np.bincount(own, minlength=len(centres)).tolist()
        assert np.allclose(sums, [x[own == k].sum(0) for k in range(len(centres))])
        assert np.allclose(inertia, [d[own == k, k].sum() for k in range(len(centres))])


def test_bit_planes_count_as_the_prefix_tree_does():
    rng = np.random.default_rng(2)
    items = [f"i{k}" for k in range(9)]
    rows = [sorted(rng.choice(items, size=rng.integers(0, 7), replace=False).tolist()) for _ in range(133)]
    sets = [(n, sorted(rng.choice([*items, "absent"], size=n % 5, replace=False).tolist())) for n in range(60)]
    want: dict = {}
    tree = baskets.PrefixTree(sets)
    for r in rows:
        tree.walk(r, want)
    planes = baskets.BitPlanes(sets)
    table = pa.array([["i0"], *rows], pa.list_(pa.string())).slice(1)
    got = dict(zip(planes.numbers.tolist(), planes.count(table).tolist()))
    assert {n: c for n, c in got.items() if c} == want and len(got) == len(sets)


def test_eps_pairs_are_handed_on_in_small_frames(monkeypatch):
    """However many pairs an area has, a frame holds at most ``PAIRS``, and visits come batch by batch; their union is every pair once."""
    monkeypatch.setattr(density, "PAIRS", 50)
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(160, 2)), 1)
    x = x[np.sort(np.unique(x, axis=0, return_index=True)[1])]
    n = len(x)
    points = pd.DataFrame({"pid": rng.permutation(n), "area": np.arange(n) % 2, "leaf": np.arange(n) % 8, "w": 1, "a": x[:, 0], "b": x[:, 1]})
    rows = []
    for at in (0, 1):
        here = points[points["area"] == at].assign(__at=at, __part=0, __visit=0)
        visits = points[points["area"] <= at].assign(__at=at, __part=0, __visit=1)
        rows.append(pd.concat([here, visits]))
    rows = pd.concat(rows, ignore_index=True)
    batches = [rows.iloc[lo : lo + 33] for lo in range(0, len(rows), 33)]
    frames = list(density._by_area(iter(batches), lambda a, b: density._pairs(a, b, ["a", "b"], 1.0)))
    assert max(len(f) for f in frames) <= 50 < sum(len(f) for f in frames)
    got = pd.concat(frames)
    at = dict(zip(points["pid"], map(tuple, x)))
    gap = lambda i, j: sum((p - q) ** 2 for p, q in zip(at[i], at[j]))
    assert sorted(zip(got["a"], got["b"])) == [(i, j) for i in range(n) for j in range(i + 1, n) if gap(i, j) <= 1.0]
    assert np.allclose(got["distance"], [gap(i, j) ** 0.5 for i, j in zip(got["a"], got["b"])])


def test_rows_walk_trees_in_few_steps():
    """Path lengths by tables that have a leaf as its own child equal a walk row by row, missing and infinite values included."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 3))
    x[::7, 1], x[::11, 0], x[::13, 2] = np.nan, np.inf, -np.inf
    nodes = []
    for t in range(5):
        grown = iforest._grow(np.nan_to_num(rng.normal(size=(2 if t else 40, 3))), rng.random((64, 2)), 5)
        nodes.append(pd.DataFrame({"tree": t, "node": np.arange(len(grown[0])), **dict(zip(("place", "feature", "threshold", "left", "right", "size"), grown))}))
    tables = iforest.Forest(["a", "b", "c"], 40, 5, pd.concat(nodes)).arrays()
    want = []
    for r in x:
        total = 0.0
        for t in range(5):
            node = depth = 0
            while tables["feature"][t, node] >= 0:
                node = tables["left" if r[tables["feature"][t, node]] <= tables["threshold"][t, node] else "right"][t, node]
                depth += 1
            total += depth + float(iforest.c_factor([tables["size"][t, node]])[0])
        want.append(total)
    assert iforest._path_lengths(list(iforest._walks(tables)), x).tolist() == want


def test_kmeans_reads_cells_for_most_passes(spark, monkeypatch):
    """Of a table with more rows than cells, centres settle on weighted cells of all rows; passes over rows are few and their end is the same."""
    rng = np.random.default_rng(2)
    x = np.round(np.concatenate([rng.normal(m, 1.0, (400, 2)) for m in ((0, 0), (2.5, 0), (0, 2.5), (2.5, 2.5))]), 3)
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "session_id long, x double, y double").repartition(4)
    passes = []
    keep = segment.lloyd_pass
    monkeypatch.setattr(segment, "lloyd_pass", lambda *a, **k: passes.append(1) or keep(*a, **k))
    monkeypatch.setattr(segment, "CELLS", 10**9)
    rows = segment.fit_kmeans_many(df, ["x", "y"], [3, 4], n_init=4)
    before, passes[:] = len(passes), []
    monkeypatch.setattr(segment, "CELLS", 500)
    cells = segment.fit_kmeans_many(df, ["x", "y"], [3, 4], n_init=4)
    assert len(passes) < before
    for k in (3, 4):
        assert cells[k].inertia == pytest.approx(rows[k].inertia, rel=2e-3)
        # the centres are where a pass over all rows leaves them
        own = ((x[:, None, :] - cells[k].centers[None]) ** 2).sum(2).argmin(1)
        assert np.allclose([x[own == j].mean(0) for j in range(k)], cells[k].centers, atol=0.02)


def test_cells_hold_all_rows(spark, monkeypatch):
    monkeypatch.setattr(segment, "CELLS", 20)
    monkeypatch.setattr(segment, "CELL_SAMPLE", 50)
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(700, 3)), 2)
    x[5, 1] = np.inf
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "session_id long, a double, b double, c double").repartition(4)
    means, rows = segment._cells(df, segment._pack(df, ["a", "b", "c"], "session_id"), ["a", "b", "c"], "session_id", 1)
    whole = np.delete(x, 5, axis=0)
    assert len(rows) == 20 and rows.sum() == 699
    assert np.allclose((means * rows[:, None]).sum(0), whole.sum(0))
    assert segment._cells(df.limit(20), df, ["a"], "session_id", 1) is None
