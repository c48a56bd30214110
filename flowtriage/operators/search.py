"""Q1, Q2: cosine-similarity search, top-k.

The query vector is a literal (its size is the feature dimension), so
scoring is one projection over the data and the top-k is a
TakeOrderedAndProject — no join and no global sort.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowtriage.operators.segment import vector_centroids


def _dsum(arr):
    return F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x)


def cosine_to_vector(df: DataFrame, vec_col: str, query: list) -> DataFrame:
    """Adds ``similarity_score`` = cos(vec, query) for an array column; null for a zero vector."""
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    q = F.array(*[F.lit(float(x)) for x in query])
    qn = math.sqrt(sum(float(x) * float(x) for x in query))
    dot = _dsum(F.zip_with(v, q, lambda a, b: a * b))
    vn = F.sqrt(_dsum(F.transform(v, lambda a: a * a)))
    return df.withColumn("similarity_score", F.try_divide(dot, vn * F.lit(qn)))


def cosine_to_profile(df: DataFrame, profile: dict) -> DataFrame:
    """Adds ``similarity_score`` against a named-feature profile (wide columns)."""
    cols = list(profile)
    dot = None
    nn = None
    for c in cols:
        t = F.col(c) * F.lit(float(profile[c]))
        s = F.col(c) * F.col(c)
        dot = t if dot is None else dot + t
        nn = s if nn is None else nn + s
    qn = math.sqrt(sum(float(v) * float(v) for v in profile.values()))
    return df.withColumn("similarity_score", F.try_divide(dot, F.sqrt(nn) * F.lit(qn)))


def top_k(scored: DataFrame, key: str, k: int, extra: list | None = None) -> DataFrame:
    order = [F.desc("similarity_score"), F.asc(key)]
    top = scored.where(F.col("similarity_score").isNotNull()).orderBy(*order).limit(k)
    return top.select(key, *(extra or []), "similarity_score").withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def similar_to_centroid(
    df: DataFrame, vec_col: str, label_col: str, target_label, key: str, k: int = 10
) -> DataFrame:
    """Q1: sessions most similar to the centroid of segment ``target_label``."""
    labels, C = vector_centroids(df.where(F.col(label_col) == F.lit(target_label)), vec_col, label_col)
    if not len(labels):
        raise ValueError(f"segment {target_label!r} is empty")
    scored = cosine_to_vector(df, vec_col, C[0].tolist())
    return top_k(scored, key, k, [F.col(label_col).alias("cluster")])


def similar_to_profile(df: DataFrame, profile: dict, key: str, k: int = 10, cluster_col: str | None = None) -> DataFrame:
    """Q2: sessions most similar to a caller-given feature profile."""
    missing = [c for c in profile if c not in df.columns]
    if missing:
        raise KeyError(f"profile features not in table: {missing}")
    extra = [F.col(cluster_col).alias("cluster")] if cluster_col else []
    return top_k(cosine_to_profile(df, profile), key, k, extra)
