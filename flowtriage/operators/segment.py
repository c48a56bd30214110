"""K-Means segmentation with silhouette-chosen K.

Batched Lloyd: every (K, restart) model is fitted at once.  One pass over the
cached points per iteration, as ``mapInPandas`` that assigns each row to its
nearest centre in every active model and emits per-partition partial sums per
(model, cluster) — map-side combine, so the shuffle carries at most
``partitions × Σk`` small rows and the driver receives ``Σk`` rows.  The
centre matrix passed to the tasks is bounded by Σk × n_features.

Initialisation is k-means‖ (Bahmani et al. 2012): per restart, ``ROUNDS``
passes draw twice the largest K of candidates each, with probability ∝ D² by
an exponential race whose uniforms come from a hash of (key, restart, round),
so the result does not depend on partitioning.  One more pass weighs each
candidate by the rows nearest to it; the driver clusters these few weighted
candidates (k-means++ and Lloyd) to the starts of every K.  The number of
passes doesn't depend on K.  Restarts use seeds ``seed .. seed+n_init-1``;
the lowest-inertia run per K is kept.

Of a table with more than ``CELLS`` rows, one pass sums all rows by cell of a
split tree.  Every model's centres first settle on these cells (mean, number of
rows), a model per task; then a pass over all rows moves them, and they settle
again with what cells miss of its sums added, until a pass over all rows moves
them no more than the tolerance.  So nearly all Lloyd passes read cells, and every model still ends
where a pass over all rows leaves its centres; ``n_iter`` counts the passes over rows.

Silhouette (Rousseeuw 1987) is exact Euclidean on a bounded sample
(``sample_size`` rows chosen by a seeded hash order), computed for all K in
one distributed pass: sample blocks are spread over tasks and each task
measures its block against the whole (bounded) sample.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowtriage.config import DEFAULTS
from flowtriage.functions.scalar import bounded_sample
from flowtriage.operators.density import _descend

#: Passes of k-means‖ that draw candidates, draws of the start among them, and Lloyd passes over them.
ROUNDS = 4
TRIES = 4
TRY_PASSES = 20
#: Rows that a Lloyd pass measures at a time.
PASS_ROWS = 256
PACK_ROWS = 4096
#: Cells that rows are summed by, rows whose spread places their borders, and the part of the tolerance that centres settle to.
CELLS = 32_768
CELL_SAMPLE = 200_000
SETTLED = 0.01


def _splitmix(x: np.ndarray) -> np.ndarray:
    """Vectorised splitmix64 finaliser on uint64 (wrapping arithmetic)."""
    with np.errstate(over="ignore"):
        z = x + np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def hash_uniform(keys: np.ndarray, salt: int | np.ndarray) -> np.ndarray:
    """Deterministic U(0,1] per (key, salt); ``salt`` is a number or one per key."""
    with np.errstate(over="ignore"):
        k = keys.astype(np.int64).view(np.uint64) ^ _splitmix(np.atleast_1d(np.asarray(salt, dtype=np.int64)).view(np.uint64))
    h = _splitmix(k) >> np.uint64(11)
    return (h.astype(np.float64) + 1.0) / float(1 << 53)


def _sqdist_exact(X: np.ndarray, Y: np.ndarray) -> np.ndarray:
    """Squared distances by per-dimension differences (no cancellation)."""
    out = np.zeros((X.shape[0], Y.shape[0]))
    for j in range(X.shape[1]):
        diff = X[:, j][:, None] - Y[:, j][None, :]
        out += diff * diff
    return out


def _sqdist(X: np.ndarray, C: np.ndarray) -> np.ndarray:
    d = (X * X).sum(1)[:, None] - 2.0 * X @ C.T + (C * C).sum(1)[None, :]
    return np.maximum(d, 0.0)


@dataclass
class KMeansModel:
    k: int
    centers: np.ndarray
    inertia: float
    n_iter: int
    seed: int

    def centers_df(self, spark, feature_names: list) -> DataFrame:
        rows = [(i, f, float(self.centers[i, j])) for i in range(self.centers.shape[0]) for j, f in enumerate(feature_names)]
        return spark.createDataFrame(rows, "cluster int, feature string, value double")


def _pack(points: DataFrame, cols: list, key: str) -> DataFrame:
    """(keys, x): the rows of ``points`` as bytes, a few thousand at a time, so that a pass over them converts no single values."""

    def fn(it):
        for pdf in it:
            X, keys = pdf[cols].to_numpy(dtype=np.float64), pdf[key].to_numpy()
            for lo in range(0, len(X), PACK_ROWS):
                yield pd.DataFrame({"keys": [keys[lo : lo + PACK_ROWS].astype(np.int64).tobytes()], "x": [np.ascontiguousarray(X[lo : lo + PACK_ROWS]).tobytes()]})

    return points.select(key, *cols).mapInPandas(fn, "keys binary, x binary")


def _matrices(it, cols: list, packed: bool):
    """(keys, rows as a matrix) of batches that ``_pack`` made, or of plain ones without keys."""
    for pdf in it:
        if packed:
            for keys, x in zip(pdf["keys"], pdf["x"]):
                yield np.frombuffer(keys, dtype=np.int64), np.frombuffer(x, dtype=np.float64).reshape(-1, len(cols))
        elif len(pdf):
            yield None, pdf[cols].to_numpy(dtype=np.float64)


def _candidates(points: DataFrame, cols: list, groups: int, seed: int, size: int) -> list:
    """k-means‖ on packed rows: per restart (candidate centres, rows nearest to each), 1 + ``ROUNDS`` x ``size`` candidates at most."""
    found = [np.zeros((0, len(cols))) for _ in range(groups)]
    for step in range(ROUNDS + 1):
        take = size if step else 1

        def race(it, found=found, step=step, take=take):
            best = [(np.zeros(0), np.zeros((0, len(cols))))] * groups
            begin = np.cumsum([0, *map(len, found)])
            at = np.vstack(found)
            lines = np.hstack([-2.0 * at, (at * at).sum(1)[:, None]])
            for keys, X in _matrices(it, cols, True):
                w = np.ones((groups, len(X)))
                for lo in range(0, len(X) if step else 0, PASS_ROWS):
                    sub = X[lo : lo + PASS_ROWS]
                    D = lines @ np.hstack([sub, np.ones((len(sub), 1))]).T  # without the rows' own norms
                    w[:, lo : lo + PASS_ROWS] = np.stack([D[i:j].min(0) for i, j in zip(begin, begin[1:])]) + (sub * sub).sum(1)
                w = np.maximum(w, 0.0)
                for g in range(groups):
                    with np.errstate(divide="ignore", invalid="ignore"):
                        lot = np.where(w[g] > 0, -np.log(hash_uniform(keys, (seed + g) * 1000003 + step)) / w[g], np.inf)
                    # only lots below the last one held can enter
                    held = best[g][0][-1] if len(best[g][0]) == take else np.inf
                    first = np.flatnonzero(lot < held)
                    first = first[np.argsort(lot[first], kind="stable")[:take]]
                    lots, rows = np.concatenate([best[g][0], lot[first]]), np.vstack([best[g][1], X[first]])
                    kept = np.argsort(lots, kind="stable")[:take]
                    best[g] = lots[kept], rows[kept]
            for g, (lots, rows) in enumerate(best):
                if len(lots):  # a partition may be empty, or hold no candidate
                    yield pd.DataFrame({"g": g, "lot": lots, "x": list(rows)})

        drawn = points.mapInPandas(race, "g int, lot double, x array<double>")
        for part in (F.pmod(F.hash("lot"), F.lit(64)), F.lit(0)):
            drawn = drawn.withColumn("rn", F.row_number().over(Window.partitionBy("g", part).orderBy("lot"))).where(F.col("rn") <= take).drop("rn")
        for r in drawn.orderBy("g", "lot").collect():
            found[r["g"]] = np.vstack([found[r["g"]], r["x"]])
        found = [c[np.sort(np.unique(c, axis=0, return_index=True)[1])] for c in found]
    if not all(len(c) for c in found):
        raise ValueError("k-means needs at least one point")
    near = lloyd_pass(points, cols, dict(enumerate(found)), packed=True)
    return [(c, near[g][1]) for g, c in enumerate(found)]


def _start(candidates: np.ndarray, weight: np.ndarray, k: int, seed: int) -> np.ndarray:
    """At most ``k`` centres of weighted points: the best of a few k-means++ draws, each followed by Lloyd passes."""
    rng = np.random.default_rng(seed)
    best, least = candidates[:1], np.inf
    for _ in range(TRIES):
        chosen = [int(rng.choice(len(candidates), p=weight / weight.sum()))]
        while len(chosen) < k:
            chance = weight * _sqdist(candidates, candidates[chosen]).min(1)
            chance[chosen] = 0.0
            if not chance.sum() > 0:
                break
            chosen.append(int(rng.choice(len(candidates), p=chance / chance.sum())))
        centers = candidates[chosen].copy()
        for _ in range(TRY_PASSES):
            own = _sqdist(candidates, centers).argmin(1)
            n = np.bincount(own, weights=weight, minlength=len(centers))
            sums = np.stack([np.bincount(own, weights=weight * c, minlength=len(centers)) for c in candidates.T], axis=1)
            centers[n > 0] = sums[n > 0] / n[n > 0][:, None]
        cost = float((weight * _sqdist(candidates, centers).min(1)).sum())
        if cost < least:
            best, least = centers, cost
    return best


def _cell_tree(x: np.ndarray, cells: int):
    """Arrays (dim, cut, left, right) of a split tree: the cell of the largest sum of squares is halved at its mean until there are ``cells``."""
    dim, cut, left, right = [-1], [0.0], [-1], [-1]
    rows, heap, n = {0: np.arange(len(x))}, [], 1

    def queue(node):
        spread = x[rows[node]].var(0)
        if spread.max(initial=0.0) > 0:
            heapq.heappush(heap, (-float(spread.sum()) * len(rows[node]), node, int(spread.argmax())))

    if len(x):
        queue(0)
    while heap and n < cells:
        _, node, d = heapq.heappop(heap)
        at = rows.pop(node)
        c = float(x[at, d].mean())
        low = x[at, d] <= c
        if low.all() or not low.any():
            continue
        dim[node], cut[node] = d, c
        for part, side in ((at[low], left), (at[~low], right)):
            side[node] = len(dim)
            rows[len(dim)] = part
            dim.append(-1), cut.append(0.0), left.append(-1), right.append(-1)
            queue(side[node])
        n += 1
    return tuple(np.array(a) for a in (dim, cut, left, right))


def _cells(points: DataFrame, packed: DataFrame, cols: list, key: str, seed: int) -> tuple[np.ndarray, np.ndarray] | None:
    """(means, numbers of rows) of the cells of all rows; None if there are no more than ``CELLS`` rows."""
    if points.count() <= CELLS:
        return None
    sample = bounded_sample(points.select(key, *cols), key, CELL_SAMPLE, seed).toPandas()[cols].to_numpy(dtype=np.float64)
    tree = _cell_tree(sample[np.isfinite(sample).all(1)], CELLS)

    def fn(it):
        sums = np.zeros((len(tree[0]), len(cols) + 1))
        for _, X in _matrices(it, cols, True):
            X = X[np.isfinite(X).all(1)]  # a row with a missing value has no place
            cell = _descend(tree, X)
            for j, v in enumerate([*X.T, np.ones(len(X))]):
                sums[:, j] += np.bincount(cell, weights=v, minlength=len(sums))
        at = np.flatnonzero(sums[:, -1])
        if len(at):
            yield pd.DataFrame({"cell": at, "s": list(sums[at])})

    added = [F.sum(F.col("s")[j]).alias(f"s{j}") for j in range(len(cols) + 1)]
    found = packed.mapInPandas(fn, "cell int, s array<double>").groupBy("cell").agg(*added).orderBy("cell").drop("cell").toPandas().to_numpy(dtype=np.float64)
    return (found[:, :-1] / found[:, -1:], found[:, -1]) if len(found) else None


def _settle(spark, start: dict, cells, max_iter: int, tol_abs: float, seen: dict | None = None) -> dict:
    """{model: centres} after Lloyd passes over weighted cells (broadcast) from ``start``, a model per task.

    ``seen[model]`` has the centres of a pass over rows and its (sums, counts): what cells miss of these is added to every pass.
    """
    names = list(start)

    def fn(it):
        means, weight = cells.value
        parts = np.hstack([means, np.ones((len(means), 1))]) * weight[:, None]

        def added(C):
            own = ((C * C).sum(1) - 2.0 * (means @ C.T)).argmin(1)
            return np.stack([np.bincount(own, weights=v, minlength=len(C)) for v in parts.T], axis=1)

        for pdf in it:
            for i in pdf["id"].tolist():
                C, missed = start[names[i]], 0.0
                if seen:
                    at, sums, n = seen[names[i]]
                    missed = np.hstack([sums, n[:, None]]) - added(at)
                for _ in range(max_iter):
                    sums = added(C) + missed
                    new, has = C.copy(), sums[:, -1] > 0.5
                    new[has] = sums[has, :-1] / sums[has, -1:]
                    shift, C = float(((new - C) ** 2).sum()), new
                    if shift <= SETTLED * tol_abs:
                        break
                yield pd.DataFrame({"id": [i], "c": [C.ravel()]})

    done = spark.range(0, len(names), 1, max(1, len(names))).mapInPandas(fn, "id long, c array<double>").collect()
    return {names[r["id"]]: np.array(r["c"]).reshape(start[names[r["id"]]].shape) for r in done}


def lloyd_pass(points: DataFrame, cols: list, active: dict, packed: bool = False) -> dict:
    """One assignment pass for all active models → {model: (sums, counts, inertia) per cluster}; ``points`` may be ``packed``.

    Every (model, cluster) gets a global index.  A task takes ``PASS_ROWS`` rows at a
    time, so that its tables stay in the processor's cache: one matrix product measures
    them against all centres, models of equal K pick their nearest centres together, and a
    second product sums the rows of every cluster.
    """
    blocks = [(m, np.asarray(C, dtype=np.float64)) for m, C in active.items()]
    allc = np.vstack([C for _, C in blocks])
    offsets = np.cumsum([0] + [C.shape[0] for _, C in blocks])
    total = int(offsets[-1])
    d = len(cols)
    alike: dict = {}
    for bi, (_, C) in enumerate(blocks):
        alike.setdefault(C.shape[0], []).append(int(offsets[bi]))
    # centres in the order (K, place, model): (K, models of this K), and where each stands in ``allc``
    shapes = [(k, len(begin)) for k, begin in sorted(alike.items())]
    order = np.concatenate([(np.array(alike[k])[None, :] + np.arange(k)[:, None]).ravel() for k, _ in shapes])

    def missing(X, at, sums):
        """Adds rows that a product can't sum, as one missing value would reach every cluster."""
        D, begin = _sqdist(X, at), 0
        with_norm = np.hstack([X, np.ones((len(X), 1)), (X * X).sum(1)[:, None]])
        for k, models in shapes:
            own = D[:, begin : begin + k * models].reshape(-1, k, models).argmin(1)
            flat = (begin + own * models + np.arange(models)).ravel()
            for j in range(d + 2):
                sums[:, j] += np.bincount(flat, weights=np.repeat(with_norm[:, j], models), minlength=total)
            begin += k * models

    def fn(it):
        at = allc[order]
        norm = (at * at).sum(1)
        lines = np.hstack([-2.0 * at, norm[:, None]])
        sums = np.zeros((total, d + 2))
        # tables made once; a fresh one for every few rows costs more than filling it
        far, near = np.empty((total, PASS_ROWS)), np.empty((total, PASS_ROWS))
        seen = False
        for _, whole in _matrices(it, cols, packed):
            seen = True
            if not (np.isfinite(whole).all() and np.isfinite(at).all()):
                missing(whole, at, sums)
                continue
            for lo in range(0, len(whole), PASS_ROWS):
                X = whole[lo : lo + PASS_ROWS]
                n = len(X)
                if n != far.shape[1]:
                    far, near = np.empty((total, n)), np.empty((total, n))
                with_one = np.hstack([X, np.ones((n, 1))])
                D, own = np.matmul(lines, with_one.T, out=far), near  # without the row's own norm, which is the same for every centre
                begin = 0
                for k, models in shapes:
                    end = begin + k * models
                    d2 = D[begin:end].reshape(k, models, n)
                    first = d2 == d2.min(0)
                    if np.count_nonzero(first) > models * n:  # equally near centres: the lower number
                        first &= np.cumsum(first, axis=0) == 1
                    own[begin:end] = first.reshape(-1, n)
                    begin = end
                sums += own @ np.hstack([with_one, (X * X).sum(1)[:, None]])
        if seen:
            cnt = np.rint(sums[:, d])
            iner = np.maximum(sums[:, d + 1] - 2.0 * (at * sums[:, :d]).sum(1) + cnt * norm, 0.0)
            yield pd.DataFrame({"g": order, "n": cnt.astype(np.int64), "inertia": iner, "s": list(sums[:, :d])})

    agg = (
        points.mapInPandas(fn, "g int, n bigint, inertia double, s array<double>")
        .groupBy("g")
        .agg(
            F.sum("n").alias("n"),
            F.sum("inertia").alias("inertia"),
            F.array(*[F.sum(F.col("s")[j]) for j in range(d)]).alias("s"),
        )
        .collect()
    )
    by_g = {r["g"]: r for r in agg}
    out: dict = {}
    for bi, (m, C) in enumerate(blocks):
        k = C.shape[0]
        s_m, n_m, i_m = np.zeros((k, d)), np.zeros(k), np.zeros(k)
        for c in range(k):
            r = by_g.get(int(offsets[bi]) + c)
            if r is not None:
                s_m[c] = np.asarray(r["s"], dtype=np.float64)
                n_m[c] = r["n"]
                i_m[c] = r["inertia"]
        out[m] = (s_m, n_m, i_m)
    return out


def fit_kmeans_many(
    points: DataFrame,
    feature_cols: list,
    ks,
    n_init: int = DEFAULTS.kmeans_n_init,
    seed: int = DEFAULTS.seed,
    max_iter: int = DEFAULTS.kmeans_max_iter,
    tol: float = DEFAULTS.kmeans_tol,
    key: str = "session_id",
    init: dict | None = None,
) -> dict:
    """C1 for every K in ``ks``: best of ``n_init`` seeded k-means‖ / Lloyd runs, or the run from the centres ``init[k]``.

    ``max_iter`` bounds the passes over rows, and those over cells before them (none from given centres).

    The projected points are persisted for the duration of the fit (one scan
    per iteration); pass a checkpointed table so a lost block is re-read, not
    recomputed.  Returns ``{k: KMeansModel}``.
    """
    ks = list(ks)
    models = dict(enumerate((k, r) for k in ks for r in range(1 if init else n_init)))
    # Scanned once per iteration: keep the projected points cached for the fit.
    pts = _pack(points, feature_cols, key).persist()
    try:
        if init:
            start = {m: np.asarray(init[k], dtype=np.float64) for m, (k, _) in models.items()}
        else:
            pool = _candidates(pts, feature_cols, n_init, seed, 2 * max(ks))
            start = {m: _start(*pool[r], k, seed + r + 7919 * k) for m, (k, r) in models.items()}
        var = points.agg(*[F.var_pop(c).alias(c) for c in feature_cols]).first()
        tol_abs = tol * float(np.mean([var[c] or 0.0 for c in feature_cols]))
        cells = None if init else _cells(points, pts, feature_cols, key, seed)
        if cells is not None:
            cells = points.sparkSession.sparkContext.broadcast(cells)
            start = _settle(points.sparkSession, start, cells, max_iter, tol_abs)
        return _fit_batched(pts, feature_cols, models, start, max_iter, tol_abs, seed, cells)
    finally:
        pts.unpersist()


def _fit_batched(pts, feature_cols, models, start, max_iter, tol_abs, seed, cells=None) -> dict:
    C = dict(start)
    n_iter = {m: 0 for m in models}
    active = {m: C[m] for m in models}
    last = {m: np.inf for m in models}
    for _ in range(max_iter):
        if not active:
            break
        res = lloyd_pass(pts, feature_cols, active, packed=True)
        nxt, seen = {}, {}
        for m, Cm in active.items():
            s, n, _ = res[m]
            new = Cm.copy()
            nz = n > 0
            new[nz] = s[nz] / n[nz][:, None]
            shift = float(((new - Cm) ** 2).sum())
            C[m] = new
            n_iter[m] += 1
            if shift > tol_abs:
                nxt[m] = new
                better = shift < last[m] / 2  # where cells don't bring them on, passes over rows alone do
                if cells is not None and better:
                    seen[m] = Cm, s, n
                last[m] = shift if better else 0.0
        if seen:
            nxt |= _settle(pts.sparkSession, {m: nxt[m] for m in seen}, cells, max_iter, tol_abs, seen)
        active = nxt
    final = lloyd_pass(pts, feature_cols, C, packed=True)
    best: dict = {}
    for m, (k, r) in models.items():
        inertia = float(final[m][2].sum())
        if k not in best or inertia < best[k].inertia:
            best[k] = KMeansModel(k, C[m], inertia, n_iter[m], seed + r + 7919 * k)
    return best


def assign_expr(centers: np.ndarray, features: list | str) -> Column:
    """Nearest centre as one projection (no join): argmin over K distances.

    ``features`` is a list of columns or one array column.  Ties go to the lower
    cluster number; a row with a missing feature has no cluster.
    """
    if isinstance(features, str):
        v = F.transform(F.col(features), lambda x: x.cast("double"))
    else:
        v = F.array(*[F.col(c).cast("double") for c in features])
    parts = []
    for i in range(centers.shape[0]):
        c = F.array(*[F.lit(float(x)) for x in centers[i]])
        d = F.aggregate(F.zip_with(v, c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, x: acc + x)
        parts.append(F.struct(d.alias("d"), F.lit(i).alias("c")))
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x))
    return F.when(whole, F.array_min(F.array(*parts))["c"])


def vector_columns(df: DataFrame, vec_col: str, prefix: str = "e") -> tuple[DataFrame, list]:
    """``df`` with one double column per vector component, and their names."""
    first = df.where(F.col(vec_col).isNotNull()).select(F.size(vec_col)).first()
    names = [f"{prefix}{i}" for i in range(first[0] if first else 0)]
    return df.select("*", *[F.col(vec_col)[i].cast("double").alias(c) for i, c in enumerate(names)]), names


def vector_centroids(df: DataFrame, vec_col: str, label_col: str) -> tuple[list, np.ndarray]:
    """Mean vector per label: one average per component; labels × dim numbers reach the driver as literals."""
    wide, names = vector_columns(df.select(label_col, vec_col), vec_col, "__e")
    if not names:
        return [], np.zeros((0, 0))
    rows = wide.groupBy(label_col).agg(*[F.avg(c).alias(c) for c in names]).orderBy(label_col).collect()
    return [r[label_col] for r in rows], np.array([[r[c] for c in names] for r in rows], dtype=np.float64)


# --- C3 --------------------------------------------------------------------------


def silhouette_sample(
    df: DataFrame, key: str, n: int = DEFAULTS.silhouette_sample, seed: int = DEFAULTS.seed, label_col: str | None = None
) -> DataFrame:
    """Seeded, partition-independent sample of at most ``n`` rows; F8: noise (-1 in ``label_col``) leaves first."""
    if label_col is not None:
        df = df.where(F.col(label_col) != -1)
    return bounded_sample(df, key, n, seed)


def silhouette_scores(
    sample: DataFrame, feature_cols: list, label_cols: list, key: str = "session_id", block_rows: int = 512
) -> dict:
    """Mean silhouette for each labelling column over the (bounded) sample.

    Noise (-1) rows are excluded per labelling; fewer than 2 clusters → -1.0.
    The sample matrix (≤ sample size × features) is shipped to every task;
    each task scores its own block of sample rows.
    """
    local = sample.select(key, *feature_cols, *label_cols).toPandas()
    if local.empty:
        return {c: -1.0 for c in label_cols}
    X = local[feature_cols].to_numpy(dtype=np.float64)
    L = {c: local[c].to_numpy() for c in label_cols}
    keys = local[key].to_numpy()
    spark = sample.sparkSession
    n_blocks = max(1, math.ceil(len(X) / block_rows))
    blocks = spark.range(n_blocks).repartition(min(n_blocks, spark.sparkContext.defaultParallelism * 2), "id")

    def fn(it):
        for pdf in it:
            out = {"label_col": [], "s": []}
            for b in pdf["id"].tolist():
                lo, hi = b * block_rows, min((b + 1) * block_rows, len(X))
                D = np.sqrt(_sqdist_exact(X[lo:hi], X))
                for c in label_cols:
                    lab = L[c]
                    valid = lab != -1
                    uniq = np.unique(lab[valid])
                    if len(uniq) < 2:
                        continue
                    rows = np.arange(lo, hi)
                    rows = rows[valid[lo:hi]]
                    Dv = D[rows - lo][:, valid]
                    lv = lab[valid]
                    sums = np.stack([Dv[:, lv == u].sum(1) for u in uniq], axis=1)
                    counts = np.array([(lv == u).sum() for u in uniq], dtype=np.float64)
                    own = np.searchsorted(uniq, lab[rows])
                    own_cnt = counts[own]
                    with np.errstate(divide="ignore", invalid="ignore"):
                        a = sums[np.arange(len(rows)), own] / (own_cnt - 1)
                        mean_other = sums / counts[None, :]
                        mean_other[np.arange(len(rows)), own] = np.inf
                        bb = mean_other.min(1)
                        s = (bb - a) / np.maximum(a, bb)
                    s = np.where(own_cnt <= 1, 0.0, np.nan_to_num(s))
                    out["label_col"] += [c] * len(s)
                    out["s"] += s.tolist()
            if out["s"]:  # nothing to score with fewer than two clusters
                yield pd.DataFrame(out)

    res = (
        blocks.mapInPandas(fn, "label_col string, s double")
        .groupBy("label_col")
        .agg(F.avg("s").alias("s"))
        .collect()
    )
    got = {r["label_col"]: r["s"] for r in res}
    return {c: float(got[c]) if c in got else -1.0 for c in label_cols}


def silhouette_simplified(df: DataFrame, feature_cols: list, label_col: str) -> DataFrame:
    """C3, ``method='simplified'``: (silhouette, n_rows, n_clusters) over all rows, by squared Euclidean distance.

    A row's mean squared distance to a cluster is ‖x‖² − 2 x·m + q, from the
    cluster's size, mean m and mean squared norm q; its own one excludes the row
    itself.  Two passes, no sample, no pairs.  Noise (-1), null labels and rows with a
    missing feature leave first; a row alone in its cluster scores 0; with fewer
    than two clusters the value is -1.  The driver holds clusters × features numbers.
    """
    values = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in feature_cols]
    rows = df.select(F.col(label_col).alias("__own"), *values).where(F.col("__own").isNotNull() & (F.col("__own") != -1))
    for c in feature_cols:
        rows = rows.where(F.col(c).isNotNull())
    whole = rows.agg(*[F.avg(c).alias(c) for c in feature_cols]).first()
    # around the common mean little cancels
    rows = rows.select("__own", *[(F.col(c) - F.lit(whole[c])).alias(c) for c in feature_cols])
    norm = sum((F.col(c) * F.col(c) for c in feature_cols), F.lit(0.0))
    means = [F.avg(c).alias(c) for c in feature_cols]
    found = rows.groupBy("__own").agg(F.count(F.lit(1)).alias("__n"), F.avg(norm).alias("__q"), *means).orderBy("__own").collect()
    n_rows, k = sum(r["__n"] for r in found), len(found)
    if k < 2:
        return df.sparkSession.createDataFrame([(-1.0, n_rows, k)], "silhouette double, n_rows long, n_clusters int")
    far = {r["__own"]: norm + F.lit(r["__q"]) - 2 * sum((F.col(c) * F.lit(r[c]) for c in feature_cols), F.lit(0.0)) for r in found}
    far = {o: F.greatest(d, F.lit(0.0)) for o, d in far.items()}
    own = F.coalesce(*[F.when(F.col("__own") == F.lit(r["__own"]), far[r["__own"]] * F.lit(r["__n"] / max(r["__n"] - 1, 1))) for r in found])
    other = F.array_min(F.array(*[F.when(F.col("__own") != F.lit(o), d) for o, d in far.items()]))
    alone = F.col("__own").isin([r["__own"] for r in found if r["__n"] == 1])
    measured = rows.select(alone.alias("alone"), own.alias("a"), other.alias("b"))
    score = F.when(F.col("alone") | (F.greatest("a", "b") == 0), 0.0).otherwise((F.col("b") - F.col("a")) / F.greatest("a", "b"))
    return measured.agg(F.avg(score).alias("silhouette"), F.count(F.lit(1)).alias("n_rows"), F.lit(k).alias("n_clusters"))


# --- C4, W3 ---------------------------------------------------------------------------


def best_k(scores: DataFrame) -> DataFrame:
    """Highest silhouette rounded to 4; the smallest K wins ties."""
    return scores.orderBy(F.desc(F.round("silhouette", 4)), F.asc("k")).limit(1)


def kmeans_search(
    x: DataFrame,
    feature_cols: list,
    k_range=range(DEFAULTS.k_min, DEFAULTS.k_max + 1),
    n_init: int = DEFAULTS.kmeans_n_init,
    sample_size: int = DEFAULTS.silhouette_sample,
    seed: int = DEFAULTS.seed,
    key: str = "session_id",
    **fit,
) -> dict:
    """C4: fit every K, score each on the same sample, pick the best (W3); ``fit`` goes to ``fit_kmeans_many``."""
    spark = x.sparkSession
    models = fit_kmeans_many(x, feature_cols, k_range, n_init=n_init, seed=seed, key=key, **fit)
    sample = silhouette_sample(x, key, sample_size, seed)
    labelled = sample.select(key, *feature_cols, *[assign_expr(models[k].centers, feature_cols).alias(f"k{k}") for k in models])
    sil = silhouette_scores(labelled, feature_cols, [f"k{k}" for k in models], key)
    rows = [(k, round(sil[f"k{k}"], 4), float(models[k].inertia), models[k].n_iter) for k in sorted(models)]
    scores = spark.createDataFrame(rows, "k int, silhouette double, inertia double, n_iter int")
    top = best_k(scores).first()
    if top is None or top["silhouette"] <= -1.0:
        raise ValueError("no K produced a silhouette above -1.0")
    chosen = top["k"]
    labels = x.select(key, assign_expr(models[chosen].centers, feature_cols).alias("cluster"))
    return {"scores": scores, "best_k": chosen, "model": models[chosen], "models": models, "labels": labels}


# --- W1, W2, F12 ----------------------------------------------------------------------


def centroid_top_features(centroids: DataFrame, n: int = DEFAULTS.top_features_n) -> DataFrame:
    """Per cluster the N highest and N lowest centroid features."""
    hi = Window.partitionBy("cluster").orderBy(F.desc("value"), F.asc("feature"))
    lo = Window.partitionBy("cluster").orderBy(F.asc("value"), F.asc("feature"))
    r = centroids.withColumn("rank_high", F.row_number().over(hi)).withColumn("rank_low", F.row_number().over(lo))
    high = r.where(F.col("rank_high") <= n).select("cluster", F.lit("high").alias("side"), F.col("rank_high").alias("rank"), "feature", "value")
    low = r.where(F.col("rank_low") <= n).select("cluster", F.lit("low").alias("side"), F.col("rank_low").alias("rank"), "feature", "value")
    return high.unionByName(low)


def discriminating_features(centroids: DataFrame, n: int = DEFAULTS.heatmap_features_n) -> DataFrame:
    """Features ranked by mean |centroid value| over clusters; their cells."""
    score = centroids.groupBy("feature").agg(F.avg(F.abs("value")).alias("mean_abs"))
    top = score.orderBy(F.desc("mean_abs"), F.asc("feature")).limit(n)
    top = top.withColumn("feature_rank", F.row_number().over(Window.orderBy(F.desc("mean_abs"), F.asc("feature"))))
    return centroids.join(F.broadcast(top), "feature").select("feature_rank", "feature", "cluster", "value", "mean_abs")


def centroids_long(means: DataFrame, feature_names: list) -> DataFrame:
    """Wide (cluster, f1..fn) → long (cluster, feature, value)."""
    return means.unpivot("cluster", feature_names, "feature", "value")


def scatter_sample(
    x: DataFrame,
    clusters: DataFrame | None,
    fx: str = DEFAULTS.scatter_x,
    fy: str = DEFAULTS.scatter_y,
    n: int = DEFAULTS.scatter_sample,
    seed: int = DEFAULTS.seed,
    key: str = "session_id",
) -> DataFrame:
    """seeded sample (≤ n) of two named features with the cluster label."""
    if fx not in x.columns or fy not in x.columns:
        raise KeyError(f"scatter features {fx!r}/{fy!r} not in the feature table")
    j = x.select(key, fx, fy, "cluster") if clusters is None else x.select(key, fx, fy).join(clusters, key)
    return bounded_sample(j, key, n, seed)
