"""End-to-end run: the reference's twelve stages as Spark jobs.

load → features (F6) → preprocess (T6) → K search (C4) → segment stats
(A1, W1, A2) → DBSCAN (C5) → rules on the imputed, unscaled frame (M8) →
label validation (A7) → Isolation Forest (I1–I3) → queue and summaries
(W4, A8, A9, I4) → reports (S2–S8).

The engineered sessions, the scaled features, labels, itemsets and scores are
each written once to the shared folder, so the source tables are read once, the
iterative stages re-read Parquet, and a lost executor costs a re-read, not a
recomputation.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtriage.config import DEFAULTS, Defaults
from flowtriage.operators import density, features, iforest, mining, prep, rules_view, segment, triage, validate
from flowtriage.plans import report
from flowtriage.runtime import materialise, spread

KEY = "session_id"


def run_triage(
    spark: SparkSession,
    sessions: DataFrame,
    out_dir: str | None = None,
    p: Defaults = DEFAULTS,
    feature_cols: list | None = None,
    engineered: bool = True,
) -> dict:
    """Run every stage; returns the result DataFrames (lazy where possible).

    ``engineered`` switches the ratio features (F6) on or off.
    """
    feat = materialise(features.engineer_features(sessions, engineered), "sessions")
    model = prep.fit_preprocessor(feat, KEY, p.label_cols, feature_cols)
    names = model.feature_names
    x = spread(model.transform(feat), KEY, "features")
    _, labels = model.split_labels(feat)

    search = segment.kmeans_search(
        x, names, range(p.k_min, p.k_max + 1), p.kmeans_n_init, p.silhouette_sample, p.seed, KEY
    )
    clusters, sizes = report.write_segments(search["labels"], range(search["best_k"]))
    dist = validate.cluster_distribution(clusters)
    centroids = search["model"].centers_df(spark, names)
    top_feats = segment.centroid_top_features(centroids, p.top_features_n)
    heat = segment.discriminating_features(centroids, p.heatmap_features_n)
    means = validate.cluster_feature_means(x, clusters, names)
    scatter = segment.scatter_sample(x, clusters, p.scatter_x, p.scatter_y, p.scatter_sample, p.seed) if (
        p.scatter_x in names and p.scatter_y in names
    ) else None

    db, density_seen = report.write_density(density.dbscan(x, names, p.dbscan_eps, p.dbscan_min_samples, KEY))
    db_summary = validate.dbscan_summary(db)

    imputed = model.impute(feat)
    itemsets, rules = mining.mine_rules(imputed, p.min_support, p.min_confidence, KEY)
    rules = materialise(rules, "rules")
    top_rules = mining.top_rules_by_lift(rules, p.rules_top_n)
    quality = mining.rule_quality_checks(rules, p.label_cols)

    evaluation = validate.evaluate_against_labels(clusters, labels)

    forest = iforest.fit_isolation_forest(x, names, p.n_trees, seed=p.seed, key=KEY)
    raw = materialise(iforest.score(x, forest, KEY), "scores")
    scored, offset = triage.contamination_flags(raw, p.contamination)
    tri = materialise(triage.attach(scored, clusters, db), "triage")
    queue = triage.soc_queue(tri, x, p.queue_top_n)
    by_cluster = triage.anomaly_by_cluster(tri)
    totals = triage.anomaly_totals(tri)
    rare = validate.rare_clusters(clusters, p.rare_share)
    consensus = triage.consensus_rank(triage.consensus_votes(tri, rare), p.queue_top_n)
    metrics = report.observed_metrics(
        spark, sizes, density_seen, search["scores"], search["best_k"], len(names), p.dbscan_eps, p.dbscan_min_samples, p.rare_share
    )

    out = {
        "features": x,
        "prep": model,
        "kmeans_scores": search["scores"],
        "best_k": search["best_k"],
        "clusters": clusters,
        "cluster_distribution": dist,
        "centroids": centroids,
        "centroid_top_features": top_feats,
        "discriminating_features": heat,
        "cluster_summary": means,
        "scatter": scatter,
        "dbscan": db,
        "dbscan_summary": db_summary,
        "itemsets": itemsets,
        "rules": rules,
        "top_rules": top_rules,
        "rule_quality": quality,
        "crosstab": evaluation["crosstab"],
        "purity": evaluation["purity"],
        "dominant": evaluation["dominant"],
        "agreement": evaluation["agreement"],
        "scores": tri,
        "offset": offset,
        "queue": queue,
        "anomaly_by_cluster": by_cluster,
        "anomaly_totals": totals,
        "consensus": consensus,
        "metrics": metrics,
    }
    if out_dir:
        write_outputs(spark, out, out_dir)
    return out


def write_outputs(spark: SparkSession, r: dict, out_dir: str) -> None:
    """S2–S8 sinks under ``out_dir``."""
    j = lambda name: os.path.join(out_dir, name)
    rules_view.save_rules(r["rules"], j("association_rules"))
    report.write_table(validate.crosstab_wide(r["crosstab"]), j("label_crosstab"), sort=["cluster"], single_file=True)
    pct = lambda df, c: df.withColumn(c, validate.round_even(c, 2))
    report.write_table(pct(r["dominant"], "purity_pct"), j("dominant_category_per_cluster"), sort=["cluster"], single_file=True)
    report.write_table(r["queue"], j("if_soc_queue"), sort=["rank"], single_file=True)
    report.write_table(pct(r["anomaly_by_cluster"], "if_anomaly_rate_pct"), j("if_cluster_summary"), sort=["cluster"], single_file=True)
    report.write_table(r["cluster_summary"], j("cluster_summary"), sort=["cluster"], single_file=True)
    report.write_report(spark, r["metrics"], j("summary"))
    report.write_table(r["scores"], j("scores"), fmt="parquet")
    report.write_table(r["clusters"].join(r["dbscan"].withColumnRenamed("cluster", "dbscan_cluster"), KEY), j("labels"), fmt="parquet")


def triage_queue(r: dict) -> DataFrame:
    """The flagship result: consensus-ranked analyst queue with scores."""
    return r["consensus"].select(
        "rank", KEY, "km_cluster", "votes", "rare_segment", "dbscan_noise", "anomaly_flag", F.round("anomaly_score", 6).alias("anomaly_score")
    )
