"""Model store, box tree and ε-pairs, simplified silhouette, baskets, quarantine."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtriage.functions import sketches as sk
from flowtriage.operators import baskets, density, features, iforest, mining, prep, segment, triage
from flowtriage.plans import report
from flowtriage.runtime import release, shared_dir
from flowtriage.sources import model_store
from flowtriage.sources import sessions as src
from flowtriage.streaming.scoring import FittedTriage, score_sessions

# --- model store ------------------------------------------------------------------------


def test_stored_model_scores_batch_and_stream_as_the_original(spark, tmp_path):
    sessions = src.derive_sessions(spark, "/root/testdata/sf0.001")
    m = prep.fit_preprocessor(features.engineer_features(sessions), unseen="null")
    x = m.transform(features.engineer_features(sessions)).cache()
    models = segment.fit_kmeans_many(x, m.feature_names, [3], n_init=1)
    forest = iforest.fit_isolation_forest(x, m.feature_names, n_trees=8)
    _, offset = triage.contamination_flags(iforest.score(x, forest), 0.04)
    fitted = FittedTriage(m, models[3].centers, forest, offset)
    want = sorted(map(tuple, score_sessions(sessions, fitted).collect()))
    inverse = sorted(map(tuple, m.inverse(x).collect()))
    path = f"file://{tmp_path}/models"
    assert model_store.versions(spark, path) == []
    assert model_store.save(spark, fitted, path) == 1 and model_store.save(spark, FittedTriage(m), path) == 2
    # a version whose manifest was never written is passed over, and its number not used again
    spark.range(1).write.parquet(f"{path}/v000003/columns")
    assert model_store.versions(spark, path) == [1, 2] and model_store.load(spark, path).forest is None
    assert model_store.save(spark, FittedTriage(m, offset=0.5), path) == 4 and model_store.load(spark, path).offset == 0.5
    sessions.write.parquet(f"file://{tmp_path}/in")
    release(spark)  # the fit's own tables are gone
    other = spark.newSession()
    got = model_store.load(other, path, 1)
    assert (got.prep.medians, got.prep.modes, got.prep.means, got.prep.stds, got.prep.unseen) == (m.medians, m.modes, m.means, m.stds, "null")
    assert got.prep.feature_names == m.feature_names and (got.centers == fitted.centers).all() and got.offset == offset
    batch = other.read.parquet(f"file://{tmp_path}/in")
    assert sorted(map(tuple, score_sessions(batch, got).collect())) == want
    again = got.prep.transform(features.engineer_features(batch))
    assert sorted(map(tuple, got.prep.inverse(again).collect())) == inverse
    stream = other.readStream.schema(batch.schema).parquet(f"file://{tmp_path}/in")
    q = score_sessions(stream, got).writeStream.format("memory").queryName("stored_scores").outputMode("append").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert sorted(map(tuple, other.table("stored_scores").collect())) == want
    with pytest.raises(ValueError, match="no version 9"):
        model_store.load(spark, path, 9)
    spark.createDataFrame([(9, "z", 0.0, 1.0)], "position int, name string, mean double, std double").write.mode("append").parquet(f"{path}/v000001/features")
    with pytest.raises(ValueError, match="rows instead of"):
        model_store.load(spark, path, 1)


def test_shared_folder_is_the_checkpoint_folder(spark):
    assert shared_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir"))


# --- boxes and pairs --------------------------------------------------------------------


@pytest.mark.parametrize("dims", [1, 3, 12])
def test_box_tree_reaches_what_all_tests_reach(dims):
    rng = np.random.default_rng(dims)
    lo = rng.normal(size=(300, dims))
    hi = lo + rng.random((300, dims)) * rng.integers(0, 2, (300, 1))
    x = rng.normal(size=(200, dims))
    gap = np.maximum(np.maximum(lo[None] - x[:, None], x[:, None] - hi[None]), 0)
    d = (gap * gap).sum(2)
    for reach in (0.0, 0.3, 2.0, 1e9):
        q, b, got = density.BoxTree(lo, hi).reached(x, reach)
        assert sorted(zip(q.tolist(), b.tolist())) == sorted(zip(*map(np.ndarray.tolist, np.nonzero(d <= reach))))
        assert got == pytest.approx(d[q, b])


def test_distances_at_eps_are_exact():
    x = np.array([[i * 0.1 + 1e6, j * 0.1] for i in range(20) for j in range(20)])
    for eps in (0.1, 0.3, 0.5):
        want = np.zeros((len(x), len(x)))
        for k in range(2):
            diff = x[:, k][:, None] - x[:, k][None, :]
            want += diff * diff
        got = np.concatenate([m for _, m in density._within(x, x, eps * eps, 64)])
        assert (got == (want <= eps * eps)).all()


@pytest.mark.parametrize("most", [20_000, 5])
def test_eps_pairs_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(density, "BOXES", most)
    monkeypatch.setattr(density, "SAMPLE", 100)
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(240, 3)), 1)
    x[200:] = x[0]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)] + [(999, None, 0.0, 0.0)], "session_id long, a double, b double, c double").repartition(4)
    pairs, points = density.eps_pairs(df, ["a", "b", "c"], 0.7, leaf_rows=12)
    rows = [tuple(r) for r in pairs.collect()]
    first, w = {}, {}
    for i, r in enumerate(map(tuple, x)):
        first.setdefault(r, i)
        w[first[r]] = w.get(first[r], 0) + 1
    at = {i: r for r, i in first.items()}
    gap = lambda i, j: float(np.sqrt(sum((p - q) ** 2 for p, q in zip(at[i], at[j]))))
    want = {(i, j, w[i], w[j]): gap(i, j) for i, j in combinations(sorted(at), 2) if sum((p - q) ** 2 for p, q in zip(at[i], at[j])) <= 0.7 * 0.7}
    assert sorted(r[:4] for r in rows) == sorted(want) and all(r[4] == pytest.approx(want[r[:4]]) for r in rows)
    assert {r.pid: r.w for r in points.collect()} == w
    counts = {r.session_id: r.n for r in density.neighbour_counts(df, ["a", "b", "c"], 0.7).collect()}
    total = dict(w)
    for a, b, wa, wb, _ in rows:
        total[a] += wb
        total[b] += wa
    assert counts == {i: total[first[tuple(r)]] for i, r in enumerate(x)}
    assert density.eps_pairs(df.limit(0), ["a", "b", "c"], 0.7)[0].count() == 0


def test_dbscan_by_parts_of_boxes_is_the_same(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(c, 0.25, size=(60, 2)) for c in (0, 1.2, 4)])
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "session_id long, a double, b double")
    monkeypatch.setattr(density, "SAMPLE", 64)
    want = sorted(map(tuple, density.dbscan(df, ["a", "b"], 0.4, 5, leaf_rows=9).collect()))
    monkeypatch.setattr(density, "BOXES", 3)
    assert sorted(map(tuple, density.dbscan(df, ["a", "b"], 0.4, 5, leaf_rows=9).collect())) == want


# --- simplified silhouette --------------------------------------------------------------


def test_simplified_silhouette_from_all_pairs(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(80, 2)) + 1e4
    label = [i % 3 if i < 70 else -1 for i in range(79)] + [7]
    df = spark.createDataFrame([(*map(float, r), c) for r, c in zip(x, label)] + [(None, 1.0, 2), (1.0, 1.0, None)], "a double, b double, cluster int")
    keep = [i for i, c in enumerate(label) if c != -1]
    s = []
    for i in keep:
        mean = {}
        for c in {label[j] for j in keep}:
            own = [((x[i] - x[j]) ** 2).sum() for j in keep if j != i and label[j] == c]
            if own:
                mean[c] = sum(own) / len(own)
        a, b = mean.get(label[i]), min(v for c, v in mean.items() if c != label[i])
        s.append(0.0 if a is None else (b - a) / max(a, b))
    got = segment.silhouette_simplified(df, ["a", "b"], "cluster").first()
    assert got.silhouette == pytest.approx(np.mean(s), abs=1e-9) and (got.n_rows, got.n_clusters) == (len(keep), 4)
    one = segment.silhouette_simplified(df.where("cluster = 0"), ["a", "b"], "cluster").first()
    assert (one.silhouette, one.n_clusters) == (-1.0, 1)
    assert segment.silhouette_simplified(df.limit(0), ["a", "b"], "cluster").first().silhouette == -1.0


# --- baskets ----------------------------------------------------------------------------


def some_baskets():
    rng = np.random.default_rng(3)
    rows = [[f"i{j}" for j in np.flatnonzero(rng.random(12) < 0.35)] + ["i0"] * int(rng.integers(0, 2)) for _ in range(200)]
    return rows + [[], None, [None, "i1"]]


@pytest.mark.parametrize("tree", [10**6, 2])
def test_itemset_support_brute_force(spark, tree):
    rows = some_baskets()
    given = [["i1", "i2"], ["i2", "i1", "i1"], [], ["i3"], ["x"], ["i0", "i4", "i5", "i6"], None, ["i3"], ["i1", None]]
    df = spark.createDataFrame([(r,) for r in rows], "items array<string>").repartition(3)
    got = baskets.itemset_support(df, spark.createDataFrame([(g,) for g in given], "items array<string>"), tree=tree).collect()
    n = lambda g: sum(set(g) - {None} <= set(r or []) for r in rows)
    want = [(g, None if g is None else n(g), None if g is None else n(g) / len(rows)) for g in given]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert baskets.itemset_support(df, spark.createDataFrame([], "items array<string>")).count() == 0
    none = baskets.itemset_support(df.limit(0), spark.createDataFrame([(["a"],)], "items array<string>")).first()
    assert (none.n, none.support) == (0, None)


def test_apriori_brute_force_and_rules(spark):
    rows = some_baskets()
    df = spark.createDataFrame([(r,) for r in rows], "items array<string>").repartition(3)
    found, rules = baskets.mine_baskets(df, min_support=0.06, min_confidence=0.4)
    items = sorted({x for r in rows for x in r or [] if x})
    want = {}
    for size in range(1, 6):
        for c in combinations(items, size):
            n = sum(set(c) <= set(r or []) for r in rows)
            if n / len(rows) >= 0.06:
                want[c] = n
    assert {tuple(r["items"]): r["n"] for r in found.collect()} == want and max(map(len, want)) >= 3
    share = lambda c: want[tuple(sorted(c))] / len(rows)
    for r in rules.collect():
        both = share([*r.antecedent, *r.consequent])
        assert r.support == pytest.approx(both) and r.confidence == pytest.approx(both / share(r.antecedent)) and r.lift > 1
    assert baskets.apriori(df, min_support=0.06, max_size=1).agg(F.max("size")).first()[0] == 1
    assert baskets.apriori(df.limit(0), min_support=0.06).count() == 0


# --- quarantine -------------------------------------------------------------------------


def test_quarantine_accounts_for_every_line(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("dur", T.DoubleType()), T.StructField("proto", T.StringType()), T.StructField("label", T.IntegerType())])
    lines = ["id,extra,proto,dur,label", "1,x,tcp,0.5,0", "2,x,udp,,1", "three,x,udp,fast,1", "", '4,"a, b",tcp,1.5,0', "5,x,tcp,1.5", "6,x,tcp,1.5,0,more", "7,x,tcp,2,1.5"]
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "one.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "a" / "two.csv").write_text("\n".join([lines[0], "8,y,icmp,3,0"]) + "\n")
    good, rejected = src.quarantine_sessions(spark, f"file://{tmp_path}/a", schema)
    assert sorted(map(tuple, good.collect())) == [(1, 0.5, "tcp", 0), (2, None, "udp", 1), (4, 1.5, "tcp", 0), (8, 3.0, "icmp", 0)]
    rows = {(r.line, r.column, r.reason, r.value) for r in rejected.collect()}
    assert rows == {
        (lines[3], "id", "not bigint", "three"), (lines[3], "dur", "not double", "fast"), (lines[6], None, "number of fields", None),
        (lines[7], None, "number of fields", None), (lines[8], "label", "not int", "1.5"),
    }
    assert all(r.file.endswith("one.csv") for r in rejected.collect())
    assert {(r["column"], r["reason"]): r["n"] for r in src.reject_counts(rejected).collect()}[(None, "number of fields")] == 2


# --- quantile sketches ------------------------------------------------------------------


def test_sketches_merge_and_replace_parts(spark, tmp_path):
    rng = np.random.default_rng(8)
    days = {f"d{i}": rng.lognormal(size=n) for i, n in enumerate((30000, 200, 1, 12000))}
    rows = [(d, float(x), None) for d, xs in days.items() for x in xs]
    odd = [("d1", float("nan"), None), ("d1", None, None), ("d2", float("inf"), None), ("d2", float("-inf"), None)]
    df = spark.createDataFrame(rows + odd, "day string, x double, none double")
    path = f"file://{tmp_path}/sketches"
    sk.keep(sk.sketch(df.where("day <> 'd3'"), ["x", "none"], F.col("day")), path)
    sk.keep(sk.sketch(df.where("day >= 'd2'"), ["x", "none"], F.col("day")), path)  # a new day, and one again
    parts = sk.kept(spark, path)
    assert sorted((r.part, r.n, r.neg, r.pos) for r in parts.collect()) == [("d0", 30000, 0, 0), ("d1", 200, 0, 0), ("d2", 1, 1, 1), ("d3", 12000, 0, 0)]
    steps = [0.0, 0.01, 1 / 3, 0.5, 0.99, 1.0]
    got = sk.quantiles(parts, {"x": steps, "none": [0.5]})
    assert got["none"] == [None] and got["x"][0] == float("-inf") and got["x"][-1] == float("inf")
    everything = np.sort(np.concatenate([*days.values(), [np.inf, -np.inf]]))
    for p, v in zip(steps[1:-1], got["x"][1:-1]):
        assert abs(np.searchsorted(everything, v) / len(everything) - p) <= sk.RANK_ERROR
    # fits from sketches, whose rows aren't read
    gone = df.limit(0)
    medians, (low, high) = prep.fit_medians(gone, ["x", "none"], parts), mining.tercile_edges(gone, ["x"], parts)["x"]
    assert list(medians) == ["x"]
    for p, v in ((1 / 3, low), (1 / 2, medians["x"]), (2 / 3, high)):
        assert abs(np.searchsorted(everything, v) / len(everything) - p) <= sk.RANK_ERROR
    scores = df.select(F.col("x").alias("anomaly_score")).where("x is not null")
    flagged, offset = triage.contamination_flags(scores, 0.04, sk.sketch(scores, ["anomaly_score"]))
    assert abs(flagged.agg(F.avg("anomaly_flag")).first()[0] - 0.04) <= sk.RANK_ERROR
    assert sk.quantiles(sk.sketch(gone, ["x"]), {"x": [0.5]}) == {"x": [None]}


# --- metrics while writing ----------------------------------------------------------------


def test_report_from_the_writes_is_that_of_the_tables(spark):
    rows = [(i, i % 7 if i % 50 else 11) for i in range(400)]
    clusters = spark.createDataFrame(rows, "session_id long, cluster int").repartition(5)
    labels = spark.createDataFrame([(i, -1 if i % 9 == 0 else i % 4) for i in range(400)], "session_id long, cluster int")
    scores = spark.createDataFrame([(2, 0.25), (3, 0.5)], "k int, silhouette double")
    table, sizes = report.write_segments(clusters, range(12))
    assert table.count() == 400 and sizes == {**{c: sum(x == c for _, x in rows) for c in range(7)}, 11: 8}
    assert report.write_segments(clusters, range(3))[1] == sizes  # ids that the write didn't count
    labelled, seen = report.write_density(labels)
    want = sorted(map(tuple, report.run_metrics(spark, table, labelled, scores, 3, 12, rare_threshold=0.03).collect()))
    assert sorted(map(tuple, report.observed_metrics(spark, sizes, seen, scores, 3, 12, rare_threshold=0.03).collect())) == want
    none, seen = report.write_density(labels.limit(0))
    assert none.count() == 0 and seen == {"n": 0, "n_noise": 0, "n_clusters": 0}
