"""Segment statistics and label agreement.

All inputs are long tables keyed by ``session_id``; the cross-tab stays long
(cluster, category, n) — its size is clusters × categories — and is pivoted
only for output.  Every statistic is an aggregate over that small table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowtriage.config import DEFAULTS
from flowtriage.runtime import materialise


def round_even(c, digits: int) -> Column:
    """Report rounding: half to even on the scaled value, as NumPy's ``round``."""
    s = float(10**digits)
    col = F.col(c) if isinstance(c, str) else c
    return F.rint(col * F.lit(s)) / F.lit(s)


# --- A1, A2, A11 ---------------------------------------------------------------


def cluster_distribution(clusters: DataFrame, cluster_col: str = "cluster") -> DataFrame:
    """A1: sessions per cluster (noise under -1) with percentage of all sessions."""
    counts = clusters.groupBy(cluster_col).agg(F.count(F.lit(1)).alias("n"))
    # the grouped table has one row per cluster, so a whole-table window is small
    counts = counts.withColumn("__total", F.sum("n").over(Window.partitionBy()))
    return counts.select(
        F.col(cluster_col).alias("cluster"),
        "n",
        (F.col("n") * 100.0 / F.col("__total")).alias("pct"),
        (F.col("n") / F.col("__total")).alias("share"),
    )


def rare_clusters(clusters: DataFrame, threshold: float = DEFAULTS.rare_share, cluster_col: str = "cluster") -> DataFrame:
    """Clusters whose share of all sessions is strictly below ``threshold``."""
    return cluster_distribution(clusters, cluster_col).where(F.col("share") < F.lit(threshold))


def cluster_feature_means(
    features: DataFrame, clusters: DataFrame | None, feature_names: list, key: str = "session_id"
) -> DataFrame:
    """A2: mean of every (scaled) feature per cluster, noise row kept.

    ``clusters=None`` when ``features`` already carries a ``cluster`` column.
    """
    j = features if clusters is None else features.join(clusters, key)
    return j.groupBy("cluster").agg(*[F.avg(c).alias(c) for c in feature_names])


# --- J1, A3–A7 ---------------------------------------------------------------


def label_join(clusters: DataFrame, labels: DataFrame, category_col: str = "attack_cat", key: str = "session_id") -> DataFrame:
    """J1 + A7 fill: (session_id, cluster, category) with null category → 'Normal'."""
    return clusters.join(labels.select(key, category_col), key).select(
        key, "cluster", F.coalesce(F.col(category_col), F.lit("Normal")).alias("category")
    )


def crosstab_long(joined: DataFrame) -> DataFrame:
    """A3 (long): every cluster × category pair, zero-filled.

    One pass counts with map-side combine; the small counts table is written
    once and filled from its own distinct values.
    """
    counts = materialise(joined.groupBy("cluster", "category").agg(F.count(F.lit(1)).alias("n")), "crosstab")
    names = counts.agg(F.collect_set("cluster").alias("cs"), F.collect_set("category").alias("ks"))
    pairs = names.select(F.explode("cs").alias("cluster"), "ks").select("cluster", F.explode("ks").alias("category"))
    return pairs.join(counts, ["cluster", "category"], "left").select("cluster", "category", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def crosstab_wide(ct: DataFrame) -> DataFrame:
    """A3 (output form): one count column per category, categories sorted."""
    cats = sorted(r[0] for r in ct.select("category").distinct().collect())
    return ct.groupBy("cluster").pivot("category", cats).agg(F.sum("n")).fillna(0)


def crosstab_log1p(ct: DataFrame) -> DataFrame:
    """log(1 + n) of the cross-tab (heat-map data)."""
    return ct.withColumn("log1p_n", F.log1p(F.col("n").cast("double")))


def purity(ct: DataFrame) -> DataFrame:
    """A4 per cluster: dominant count / cluster total."""
    per = ct.groupBy("cluster").agg(F.max("n").alias("n_dominant"), F.sum("n").alias("cluster_total"))
    return per.withColumn("purity", F.col("n_dominant") / F.col("cluster_total"))


def dominant_category(ct: DataFrame) -> DataFrame:
    """A5: most common category per cluster (alphabetically first on ties)."""
    w = Window.partitionBy("cluster").orderBy(F.desc("n"), F.asc("category"))
    tot = Window.partitionBy("cluster")
    r = ct.withColumn("rk", F.row_number().over(w)).withColumn("cluster_total", F.sum("n").over(tot))
    return r.where(F.col("rk") == 1).select(
        "cluster",
        F.col("category").alias("dominant_category"),
        F.col("n").alias("sessions_in_cat"),
        F.col("cluster_total").cast("bigint").alias("cluster_total"),
        (F.col("n") * 100.0 / F.col("cluster_total")).alias("purity_pct"),
    )


def agreement(ct: DataFrame) -> DataFrame:
    """A4 overall purity and A6 adjusted Rand index, one row.

    Pair counts from the long cross-tab (Hubert & Arabie): S = Σn², A = Σ
    cluster², B = Σ category²; tp = S−n, fp = A−S, fn = B−S, tn = n²+S−A−B.
    Computed in double from the counts on, so that no product overflows.
    """
    ct = ct.withColumn("n", F.col("n").cast("double"))
    # ct is clusters × categories rows; per-row marginals by window, then one
    # aggregate: Σa² = Σ n·a, Σb² = Σ n·b, Σ max = Σ n over the first row per cluster.
    wa = Window.partitionBy("cluster")
    wb = Window.partitionBy("category")
    wr = Window.partitionBy("cluster").orderBy(F.desc("n"), F.asc("category"))
    m = ct.select(
        "n",
        F.sum("n").over(wa).alias("a"),
        F.sum("n").over(wb).alias("b"),
        (F.row_number().over(wr) == 1).alias("top"),
    )
    x = m.agg(
        F.sum(F.col("n") * F.col("n")).alias("S"),
        F.sum("n").alias("N"),
        F.sum(F.col("n") * F.col("a")).alias("A"),
        F.sum(F.col("n") * F.col("b")).alias("B"),
        (F.sum(F.when(F.col("top"), F.col("n"))) / F.sum("n")).alias("overall"),
    )
    S, N, A, B = (F.col(c).cast("double") for c in ("S", "N", "A", "B"))
    tp, fp, fn = S - N, A - S, B - S
    tn = N * N + S - A - B
    num = F.lit(2.0) * (tp * tn - fn * fp)
    den = (tp + fn) * (fn + tn) + (tp + fp) * (fp + tn)
    ari = F.when((fn == 0) & (fp == 0), F.lit(1.0)).otherwise(num / den)
    return x.select(
        F.col("overall").alias("overall_purity"),
        ari.alias("ari"),
        F.col("N").cast("bigint").alias("n_sessions"),
    )


def evaluate_against_labels(clusters: DataFrame, labels: DataFrame, category_col: str = "attack_cat") -> dict:
    """One long cross-tab feeding A3–A6."""
    ct = crosstab_long(label_join(clusters, labels, category_col))
    return {
        "crosstab": ct,
        "purity": purity(ct),
        "dominant": dominant_category(ct),
        "agreement": agreement(ct),
    }


# --- A10 -------------------------------------------------------------------------


def dbscan_summary(labels: DataFrame) -> DataFrame:
    """A10: clusters (excluding -1), noise count and %, clustered sessions."""
    return labels.agg(
        F.count_distinct(F.when(F.col("cluster") >= 0, F.col("cluster"))).alias("n_clusters"),
        F.count_if(F.col("cluster") == -1).cast("bigint").alias("n_noise"),
        F.count(F.lit(1)).alias("n_total"),
    ).select(
        F.col("n_clusters").cast("bigint").alias("n_clusters"),
        "n_noise",
        F.try_divide(F.col("n_noise") * 100.0, F.col("n_total")).alias("noise_pct"),
        (F.col("n_total") - F.col("n_noise")).alias("n_clustered"),
    )
