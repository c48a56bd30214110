"""Micro fixtures for the semantic contracts."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowtriage.functions.quantiles import exact_quantiles
from flowtriage.functions.scalar import safe_divide, tercile_token
from flowtriage.operators import mining, prep, segment, triage, validate


def test_safe_divide_edges(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (None, 2.0), (6.0, 3.0), (float("inf"), 1.0)], "n double, d double")
    got = [r[0] for r in df.select(safe_divide("n", "d")).collect()]
    assert got[:4] == [0.0, 0.0, 0.0, 2.0]
    assert math.isinf(got[4])


def test_median_even_count_and_mode_tie(spark):
    df = spark.createDataFrame(
        [(1, 4.0, "a"), (2, 1.0, "a"), (3, 3.0, "b"), (4, 2.0, "b"), (5, None, None)], "session_id long, v double, t string"
    )
    m = prep.fit_preprocessor(df, label_cols=())
    assert m.medians["v"] == pytest.approx(2.5)
    assert m.modes["t"] == "a"
    r = {x["session_id"]: x for x in m.impute(df).collect()}
    assert r[5]["v"] == pytest.approx(2.5) and r[5]["t"] == "a"


def test_scaling_population_std_and_constant(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 3.0, 5.0)], "session_id long, a double, c double")
    m = prep.fit_preprocessor(df, label_cols=())
    x = {r["session_id"]: r for r in m.transform(df).collect()}
    assert x[1]["a"] == pytest.approx(-1.0) and x[2]["a"] == pytest.approx(1.0)
    assert x[1]["c"] == 0.0 and x[2]["c"] == 0.0
    back = {r["session_id"]: r for r in m.inverse(m.transform(df)).collect()}
    assert back[1]["a"] == pytest.approx(1.0) and back[2]["a"] == pytest.approx(3.0)


def test_label_encoding_is_sorted_rank(spark):
    df = spark.createDataFrame([(1, "udp"), (2, "tcp"), (3, "arp"), (4, "tcp")], "session_id long, proto string")
    m = prep.fit_preprocessor(df, label_cols=())
    codes = {r["session_id"]: r["proto"] for r in m.encode(df).collect()}
    assert codes == {1: 2, 2: 1, 3: 0, 4: 1}


def test_tercile_bins_nan_is_high(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (2.0,), (3.0,), (float("nan"),), (None,)], "x double")
    q = exact_quantiles(df, {"x": [1 / 3, 2 / 3]})["x"]
    assert q == pytest.approx([np.percentile([1, 1, 2, 3], 100 / 3), np.percentile([1, 1, 2, 3], 200 / 3)])
    toks = [r[0] for r in df.select(tercile_token("x", *q)).collect()]
    assert toks[4] == "x_high" and toks[5] == "x_high"
    assert toks[0] == "x_low"


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_exact_quantiles_match_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    vals = np.concatenate([rng.lognormal(0, 3, 3000), rng.integers(0, 5, 1000).astype(float), [1e12, -1e9]])
    df = spark.createDataFrame([(float(v),) for v in vals], "x double").repartition(4)
    ps = [0.0, 0.04, 1 / 3, 0.5, 2 / 3, 0.999, 1.0]
    got = exact_quantiles(df, {"x": ps})["x"]
    want = [np.percentile(vals, 100 * p) for p in ps]
    assert got == pytest.approx(want, rel=1e-12, abs=1e-12)


def _txn(spark, rows):
    cols = ["a", "b", "c"]
    return spark.createDataFrame(rows, "session_id long, a string, b string, c string"), cols


def test_support_exactly_at_threshold_is_kept(spark):
    rows = [(i, "a_x" if i < 7 else "a_y", "b_1", "c_1") for i in range(100)]
    txn, cols = _txn(spark, rows)
    its = mining.frequent_itemsets(txn, cols, 0.07)
    got = {tuple(r["items"]): r["n"] for r in its.collect()}
    assert got[("a_x",)] == 7


def test_multi_item_consequents(spark):
    rows = [(i, "a_1", "b_1", "c_1") for i in range(10)]
    txn, cols = _txn(spark, rows)
    its = mining.frequent_itemsets(txn, cols, 0.01)
    rules = mining.association_rules(its, 0.5).collect()
    # all lifts are exactly 1 (every item is always present) → no rule kept
    assert rules == []
    rows = [(i, "a_1" if i < 5 else "a_2", "b_1" if i < 5 else "b_2", "c_1" if i < 5 else "c_2") for i in range(10)]
    txn, cols = _txn(spark, rows)
    rules = mining.association_rules(mining.frequent_itemsets(txn, cols, 0.01), 0.7).collect()
    assert any(len(r["consequent"]) == 2 for r in rules)
    for r in rules:
        assert r["confidence"] == pytest.approx(1.0) and r["lift"] == pytest.approx(2.0)


def test_cube_matches_fpgrowth(spark):
    from pyspark.ml.fpm import FPGrowth

    rng = np.random.default_rng(5)
    rows = [(i, f"a_{rng.integers(3)}", f"b_{rng.integers(2)}", f"c_{rng.integers(4)}") for i in range(400)]
    txn, cols = _txn(spark, rows)
    its = {tuple(r["items"]): r["n"] for r in mining.frequent_itemsets(txn, cols, 0.05).collect()}
    fp = FPGrowth(itemsCol="items", minSupport=0.05 * (1 - 1e-9)).fit(txn.select(F.array(*cols).alias("items")))
    ref = {tuple(sorted(r["items"])): r["freq"] for r in fp.freqItemsets.collect() if r["freq"] >= 0.05 * 400}
    assert its == ref


def test_dominant_category_tie_is_alphabetical(spark):
    ct = spark.createDataFrame([(0, "b", 2), (0, "a", 2), (1, "c", 1)], "cluster int, category string, n long")
    d = {r["cluster"]: r["dominant_category"] for r in validate.dominant_category(ct).collect()}
    assert d == {0: "a", 1: "c"}


def _ari(spark, a, b):
    df = spark.createDataFrame([(i, int(x), str(y)) for i, (x, y) in enumerate(zip(a, b))], "session_id long, cluster int, attack_cat string")
    ct = validate.crosstab_long(validate.label_join(df.select("session_id", "cluster"), df.select("session_id", "attack_cat")))
    return validate.agreement(ct).first()["ari"]


def _ari_ref(a, b):
    from math import comb

    n = len(a)
    cont = {}
    for x, y in zip(a, b):
        cont[(x, y)] = cont.get((x, y), 0) + 1
    sa, sb = {}, {}
    for (x, y), v in cont.items():
        sa[x] = sa.get(x, 0) + v
        sb[y] = sb.get(y, 0) + v
    idx = sum(comb(v, 2) for v in cont.values())
    ea = sum(comb(v, 2) for v in sa.values())
    eb = sum(comb(v, 2) for v in sb.values())
    exp = ea * eb / comb(n, 2)
    mx = (ea + eb) / 2
    return 1.0 if mx == exp else (idx - exp) / (mx - exp)


def test_adjusted_rand(spark):
    assert _ari(spark, [0, 0, 1, 1, 2, 2], ["x", "x", "y", "y", "z", "z"]) == 1.0
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 4, 300), rng.integers(0, 3, 300)
    assert _ari(spark, a, b) == pytest.approx(_ari_ref(list(a), list(b)), abs=1e-12)


def _sil_ref(X, lab):
    s = []
    for i in range(len(X)):
        d = np.sqrt(((X - X[i]) ** 2).sum(1))
        own = lab == lab[i]
        if own.sum() == 1:
            s.append(0.0)
            continue
        a = d[own].sum() / (own.sum() - 1)
        b = min(d[lab == u].mean() for u in set(lab) if u != lab[i])
        s.append((b - a) / max(a, b))
    return float(np.mean(s))


def test_silhouette_with_singleton(spark):
    rng = np.random.default_rng(1)
    X = np.vstack([rng.normal(0, 1, (40, 3)), rng.normal(5, 1, (30, 3)), [[20.0, 20.0, 20.0]]])
    lab = np.array([0] * 40 + [1] * 30 + [2])
    df = spark.createDataFrame(
        [(i, *map(float, X[i]), int(lab[i])) for i in range(len(X))], "session_id long, x double, y double, z double, k int"
    )
    got = segment.silhouette_scores(df, ["x", "y", "z"], ["k"])["k"]
    assert got == pytest.approx(_sil_ref(X, lab), abs=1e-12)


def test_best_k_tie_picks_smallest(spark):
    s = spark.createDataFrame([(2, 0.30001), (3, 0.30004), (4, 0.2)], "k int, silhouette double")
    assert segment.best_k(s).first()["k"] == 2


def test_equal_scores_ordered_by_key(spark):
    df = spark.createDataFrame(
        [(4, -0.5, 1, 0), (2, -0.5, 1, 0), (3, -0.5, 1, 0), (1, -0.1, 1, 0)],
        "session_id long, anomaly_score double, anomaly_flag int, km_cluster int",
    )
    q = triage.soc_queue(df, None, 3).orderBy("rank").collect()
    assert [r["session_id"] for r in q] == [2, 3, 4]


def test_contamination_threshold_count(spark):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(rng.normal(size=1000))], "session_id long, anomaly_score double")
    scored, _ = triage.contamination_flags(df, 0.04)
    assert scored.agg(F.sum("anomaly_flag")).first()[0] == math.floor(0.04 * 999) + 1


def test_fpgrowth_path_matches_cube_at_threshold(spark):
    rows = [(i, "a_x" if i < 7 else "a_y", "b_1", "c_1" if i % 2 else "c_2") for i in range(100)]
    txn, cols = _txn(spark, rows)
    cube = {tuple(r["items"]): r["n"] for r in mining.frequent_itemsets(txn, cols, 0.07).collect()}
    arr = {tuple(r["items"]): r["n"] for r in mining.frequent_itemsets_arrays(txn.select(F.array(*cols).alias("b")), "b", 0.07).collect()}
    assert cube == arr and cube[("a_x",)] == 7


# --- awkward inputs -------------------------------------------------------------------


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1, 1.0), (2, float("nan")), (3, 3.0), (4, None)], "session_id long, v double")
    m = prep.fit_preprocessor(df, label_cols=())
    assert m.medians["v"] == 2.0 and m.means["v"] == 2.0
    assert [r["v"] for r in m.impute(df).orderBy("session_id").collect()] == [1.0, 2.0, 3.0, 2.0]
    assert all(math.isfinite(r["v"]) for r in m.transform(df).collect())


def test_many_categories_unseen_values_and_null_features(spark):
    df = spark.range(3000).selectExpr("id session_id", "concat('v', id % 1500) t", "cast(id as double) x")
    new = spark.createDataFrame([(1, "v7", 1.0), (2, "zzz", 2.0), (3, None, None)], "session_id long, t string, x double")
    want = {v: i for i, v in enumerate(sorted(f"v{i}" for i in range(1500)))}
    codes = lambda unseen: [r["t"] for r in prep.fit_preprocessor(df, label_cols=(), unseen=unseen).encode(new).orderBy("session_id").collect()]
    assert codes("other") == [want["v7"], 1500, want["v0"]]  # a null takes the mode
    assert codes("null") == [want["v7"], None, want["v0"]]
    with pytest.raises(Exception, match="not seen"):
        codes("error")
    x = prep.fit_preprocessor(df, label_cols=(), unseen="null").transform(new)
    got = {r[0]: r[1] for r in x.select("session_id", segment.assign_expr(np.zeros((2, 2)), ["t", "x"]).alias("c")).collect()}
    assert got == {1: 0, 2: None, 3: 0}


def test_key_can_be_a_feature(spark):
    df = spark.createDataFrame([(1, 5.0), (3, 7.0)], "session_id long, v double")
    m = prep.fit_preprocessor(df, label_cols=(), feature_cols=["session_id", "v"])
    assert m.feature_names == ["session_id_value", "v"]
    got = m.transform(df).orderBy("session_id").collect()
    assert [(r["session_id"], r["session_id_value"], r["v"]) for r in got] == [(1, -1.0, -1.0), (3, 1.0, 1.0)]
    assert [r["session_id_value"] for r in m.inverse(m.transform(df)).orderBy("session_id").collect()] == [1.0, 3.0]


def test_quantiles_with_infinite_values(spark):
    inf = float("inf")
    vals = [-inf, 1.0, 2.0, 3.0, inf, inf]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    assert exact_quantiles(df, {"x": [0.0, 0.2, 0.4, 0.5, 0.6, 1.0]})["x"] == [-inf, 1.0, 2.0, 2.5, 3.0, inf]
    assert exact_quantiles(df.where("x = 0"), {"x": [0.5]})["x"] == [None]


def test_report_rounding_is_half_even(spark):
    df = spark.createDataFrame([(100 / 800,), (0.375,), (2.5,)], "x double")
    assert [r[0] for r in df.select(validate.round_even("x", 2)).collect()] == [0.12, 0.38, 2.5]


def test_agreement_of_huge_cells(spark):
    n = 4_000_000_000
    ct = spark.createDataFrame([(0, "a", n), (0, "b", 0), (1, "a", 0), (1, "b", n)], "cluster int, category string, n long")
    r = validate.agreement(ct).first()
    assert r["ari"] == 1.0 and r["overall_purity"] == 1.0 and r["n_sessions"] == 2 * n


def test_zero_vectors_have_no_similarity(spark):
    from flowtriage.operators import search

    df = spark.createDataFrame([(1, [0.0, 0.0], 0.0), (2, [1.0, 0.0], 1.0)], "session_id long, v array<double>, x double")
    got = search.top_k(search.cosine_to_vector(df, "v", [1.0, 1.0]), "session_id", 5).collect()
    assert [r["session_id"] for r in got] == [2]
    assert [r["session_id"] for r in search.similar_to_profile(df, {"x": 2.0}, "session_id").collect()] == [2]


def test_silhouette_of_one_cluster_and_noise(spark):
    rows = [(i, float(i), 0, 0 if i < 5 else -1, i % 2) for i in range(10)]
    df = spark.createDataFrame(rows, "session_id long, x double, one int, noisy int, two int")
    assert segment.silhouette_scores(df, ["x"], ["one"]) == {"one": -1.0}
    got = segment.silhouette_scores(df, ["x"], ["one", "noisy", "two"])
    assert got["one"] == got["noisy"] == -1.0 and got["two"] == pytest.approx(_sil_ref(np.array([[float(i)] for i in range(10)]), np.array([i % 2 for i in range(10)])))
    big = spark.range(4000).selectExpr("id session_id", "if(id % 2 = 0, -1, 1) c")
    sample = segment.silhouette_sample(big, "session_id", 100, 1, "c")
    assert sample.count() == 100 and sample.where("c = -1").count() == 0


def test_bounded_sample_is_the_smallest_hashes(spark):
    from flowtriage.functions.scalar import bounded_sample, sample_key

    df = spark.range(5000).withColumnRenamed("id", "session_id").repartition(7)
    got = {r[0] for r in bounded_sample(df, "session_id", 50, 3).collect()}
    assert got == {r[0] for r in df.orderBy(sample_key("session_id", 3), "session_id").limit(50).collect()}


def test_risk_tiers_come_from_the_caller(spark):
    c = spark.createDataFrame([(1, 3), (2, 3), (3, 4)], "session_id long, cluster int")
    got = {r["cluster"]: (r["sessions"], r["tier"], r["subtitle"]) for r in triage.risk_annotation(spark, c, [(3, "HIGH", "x")]).collect()}
    assert got == {3: (2, "HIGH", "x"), 4: (1, "ELEVATED RISK", "Anomalous Cluster 4")}
    assert {r["tier"] for r in triage.risk_annotation(spark, c, []).collect()} == {"ELEVATED RISK"}


def test_segment_mining_equals_mining_each_segment(spark):
    rng = np.random.default_rng(4)
    rows = [(i, int(rng.integers(3)), f"a_{rng.integers(6)}", f"b_{rng.integers(2)}", f"c_{rng.integers(9)}") for i in range(300)]
    df = spark.createDataFrame(rows, "session_id long, cluster int, a string, b string, c string")
    got = {(r["cluster"], tuple(r["items"])): (r["n"], r["support"]) for r in mining.frequent_itemsets(df, ["a", "b", "c"], 0.15, "cluster").collect()}
    want = {}
    for k in range(3):
        for r in mining.frequent_itemsets(df.where(F.col("cluster") == k), ["a", "b", "c"], 0.15).collect():
            want[k, tuple(r["items"])] = (r["n"], r["support"])
    assert got == want


def test_phrases_by_literal_values(spark):
    from flowtriage.operators import rules_view

    df = spark.createDataFrame([(["packet_asymmetry_low", "sbytes_high", "proto_tcp"], ["bytes_per_packet_high", "dur_low"])], "a array<string>, c array<string>")
    r = df.select(rules_view.humanize("a").alias("h"), rules_view.humanize("c").alias("k"), rules_view.pattern_title("c", "c", 99).alias("t")).first()
    assert r["h"] == "Dest-Dominant Traffic + High Outbound Bytes + proto_tcp"
    assert r["k"] == "Large Bytes Per Packet + Short Session Duration"
    assert r["t"] == "High Bytes/Packet + Low Session Duration -> High Bytes/Packet + Low Session Duration"
