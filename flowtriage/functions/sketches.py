"""Approximate quantiles from mergeable sketches (T1, F11, I3 with ``approx``).

A table of sketches holds one KLL sketch per part (a file, a day) and column.
A refit merges the sketches of all parts and reads no old rows; a part that is
sketched again replaces its sketch, so a rerun counts nothing twice.  With
``K`` items kept per level the rank of a returned value is within ``RANK_ERROR``
of the one asked for, as a share of the values (twice the 99 % bound of a
sketch of that size, which merging doesn't widen).  Sketches are randomised:
two merges of the same parts may differ within that bound.

Null and NaN values are skipped.  Infinite values are counted apart and keep
their rank, as in ``exact_quantiles``.  A column without values has no quantile.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

K = 1600
RANK_ERROR = 0.005

_INF = float("inf")


def sketch(df: DataFrame, cols: list[str], part: Column | None = None, k: int = K) -> DataFrame:
    """(part, column, sketch, n, neg, pos): a sketch of the finite values per part and column, and counts of the others.

    One aggregation with partial sketches in each task: what is shuffled is tasks x parts x columns sketches.
    """
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in cols]
    rows = df.select((F.lit("all") if part is None else part.cast("string")).alias("part"), F.explode(F.array(*pairs)).alias("e"))
    rows = rows.select("part", F.col("e.column").alias("column"), F.col("e.v").alias("v")).where("v is not null and not isnan(v)")
    finite = F.abs("v") < _INF
    return rows.groupBy("part", "column").agg(
        F.kll_sketch_agg_double(F.when(finite, F.col("v")), k).alias("sketch"),
        F.count_if(finite).alias("n"),
        F.count_if(F.col("v") == -_INF).alias("neg"),
        F.count_if(F.col("v") == _INF).alias("pos"),
    )


def keep(parts: DataFrame, path: str) -> None:
    """Write the sketches of ``parts`` below ``path``; parts already there are replaced, others stay."""
    parts.write.partitionBy("part").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def kept(spark: SparkSession, path: str) -> DataFrame:
    schema = "column string, sketch binary, n long, neg long, pos long, part string"
    return spark.read.schema(schema).parquet(path)


def quantile_table(parts: DataFrame, spec: dict[str, list[float]], k: int = K) -> DataFrame:
    """(column, p, total, value) for every probability that ``spec`` names for a column with values.

    The counts of the named columns come to the driver first: a sketch is only asked for ranks that are literals.
    """
    own = parts.where(F.col("column").isin(list(spec)))
    counts = own.groupBy("column").agg(*[F.sum(c).alias(c) for c in ("n", "neg", "pos")])
    lists = []
    for r in counts.collect():
        total, found = r["n"] + r["neg"] + r["pos"], []
        for p in spec[r["column"]] if total else []:
            at = (total - 1) * float(p) - r["neg"]  # rank among the finite values
            if at < 0 or at > r["n"] - 1:
                # up to the next infinite value, or between the last finite and an infinite one
                value = F.lit(-_INF if at < 0 else _INF)
            else:
                value = F.kll_sketch_get_quantile_double("sketch", F.lit(at / max(1, r["n"] - 1)))
            found.append(F.struct(F.lit(float(p)).alias("p"), F.lit(total).cast("long").alias("total"), value.alias("value")))
        if found:
            lists.append(F.when(F.col("column") == r["column"], F.array(*found)))
    merged = own.groupBy("column").agg(F.kll_merge_agg_double("sketch", k).alias("sketch"))
    if not lists:
        return merged.limit(0).select("column", F.lit(0.0).alias("p"), F.lit(0).cast("long").alias("total"), F.lit(0.0).alias("value"))
    return merged.select("column", F.explode(F.coalesce(*lists)).alias("e")).select("column", "e.*")


def quantiles(parts: DataFrame, spec: dict[str, list[float]], k: int = K) -> dict[str, list[float | None]]:
    """``exact_quantiles``' result, from sketches: ``{column: [quantile for each p]}``, ``None`` for a column without values."""
    if not any(spec.values()):
        return {c: [] for c in spec}
    found = {(r["column"], r["p"]): r["value"] for r in quantile_table(parts, {c: sorted(set(ps)) for c, ps in spec.items() if ps}, k).collect()}
    return {c: [found.get((c, float(p))) for p in ps] for c, ps in spec.items()}
