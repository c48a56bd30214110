"""Operator 7, mixing sources to target weights by weighted fair queueing.

Each source has a weight; its target is its share of the budget, capped at
``max_epochs`` times its size, the excess reshared by weight (water filling).
The documents of a source are shuffled by a keyed hash, one pass per epoch.
A copy's virtual finish time is the source's cumulative size up to and with
it, divided by the source's target, so every source reaches time 1 at its
target.  All copies are range-sorted by that time and the longest prefix
within the total budget is taken.

Rows equal in id, source and text are one item of their joint size: they are
taken or left together.  Null text has size 0; items of size 0 take no part
and no target (``copies`` 0).  Null source sorts last.  An empty table gives an
empty result.  Extra columns are kept by ``mix``, whatever their names.

Scale: only a narrow ledger (ids, source, size, 16-byte shuffle key) is sorted.
Running sums are two-level: range partitions are summed, the sums of the
partitions are accumulated, then each partition runs on from its offset, so a
source with a third of all rows is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, materialise, row_key

#: weights by rank of the source (by code point, null last), repeating
WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
MAX_EPOCHS = 2
SEED = "mix-1"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights=WEIGHTS, share_percent: int = SHARE_PERCENT, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """(source, source_size, target) from (source, size).

    One row per source, so the windows below run over the list of sources only.
    Capped sources are a prefix in the order of cap / weight; the level is the
    first one at which the next source stays below its cap.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.row_number().over(rank) - 1) % len(weights) + 1)
    fill = Window.orderBy((F.col("cap") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(0))
    per = per.withColumn("w", w).withColumn("cap", F.col("source_size").cast("double") * max_epochs)
    per = per.withColumn("budget", F.sum("source_size").over(every).cast("double") * share_percent / 100.0)
    per = per.withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    per = per.withColumn("open_w", F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    per = per.withColumn("level", (F.col("budget") - F.col("capped")) / F.col("open_w"))
    is_open = F.col("level") * F.col("w") < F.col("cap")
    per = per.withColumn("final", F.min(F.when(is_open, F.struct("capped", "open_w", "level"))).over(every))
    target = F.when(F.col("final").isNull(), F.col("cap")).otherwise(
        F.least(F.col("final.level") * F.col("w"), F.col("cap"))
    )
    return per.select("source", "source_size", target.alias("target"))


def _running(df: DataFrame, group: list[str], order: list, value: str, out: str, name: str) -> DataFrame:
    """Running sum of ``value`` in each group by ``order``, without one task per group."""
    ranged = df.repartitionByRange(*[F.col(g) for g in group], *order).withColumn("_p", F.spark_partition_id())
    ranged = materialise(ranged, name)
    sums = ranged.groupBy(*group, "_p").agg(F.sum(value).alias("_s"))
    prior = Window.partitionBy(*(group or [F.lit(0)])).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*[F.col(g).alias(f"_{g}") for g in group], F.col("_p").alias("_q"), F.coalesce(F.sum("_s").over(prior), F.lit(0)).alias("_off"))
    own = Window.partitionBy("_p", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    ranged = ranged.withColumn("_run", F.sum(value).over(own))
    on = F.col("_p") == F.col("_q")
    for g in group:
        on &= F.col(g).eqNullSafe(F.col(f"_{g}"))
    joined = ranged.join(sums, on)
    return joined.withColumn(out, F.col("_off") + F.col("_run")).drop("_p", "_q", "_off", "_run", *[f"_{g}" for g in group])


def ledger(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source") -> DataFrame:
    """(_k1, _k2, id, source, size, n): one row per item of ``n`` equal rows with joint size ``size``."""
    rows = docs.select(
        *row_key(F.col(key), F.col(source), F.col(text)), F.col(key).alias("id"), F.col(source).alias("source"), n_words(F.col(text)).alias("unit")
    )
    items = rows.groupBy("_k1", "_k2").agg(
        F.first("id").alias("id"), F.first("source").alias("source"), F.sum("unit").alias("size"), F.count(F.lit(1)).alias("n")
    )
    return materialise(items, "mix-ledger")


def plan_mix(
    items: DataFrame, weights=WEIGHTS, share_percent: int = SHARE_PERCENT, max_epochs: int = MAX_EPOCHS, seed: str = SEED
) -> DataFrame:
    """``items`` of ``ledger`` with source_size, target and copies (0 to max_epochs)."""
    targets = materialise(source_targets(items, weights, share_percent, max_epochs), "mix-targets").withColumnRenamed("source", "_src")
    with_target = items.join(targets, F.col("source").eqNullSafe(F.col("_src"))).drop("_src")
    epochs = F.explode(F.sequence(F.lit(1), F.lit(max_epochs)))
    queue = with_target.where("size > 0").select("_k1", "_k2", "id", "source", "size", "target", epochs.alias("epoch"))
    shuffle = F.md5(F.concat_ws(":", F.lit(seed), F.col("epoch"), F.coalesce(F.col("id").cast("string"), F.lit("null"))))
    queue = queue.withColumn("dice", shuffle)
    queue = _running(queue, ["source"], [F.col(c) for c in ("epoch", "dice", "_k1", "_k2")], "size", "served", "mix-served")
    queue = queue.withColumn("finish", F.col("served") / F.col("target"))
    order = [F.col("finish"), F.col("source").asc_nulls_last(), *[F.col(c) for c in ("epoch", "dice", "_k1", "_k2")]]
    queue = _running(queue, [], order, "size", "total", "mix-total")
    budget = items.agg((F.sum("size") * F.lit(share_percent) / F.lit(100)).alias("budget"))
    taken = queue.join(F.broadcast(budget), F.col("total") <= F.col("budget")).groupBy("_k1", "_k2").agg(F.count(F.lit(1)).alias("copies"))
    return with_target.join(taken, ["_k1", "_k2"], "left").withColumn("copies", F.coalesce("copies", F.lit(0)))


def mix(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", **params) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as the mix takes it, with its columns."""
    plan = plan_mix(ledger(docs, text, key, source), **params).where("copies > 0").select("_k1", "_k2", "copies")
    # the row travels in a struct, so that no name of its columns can clash
    rows = docs.select(*row_key(F.col(key), F.col(source), F.col(text)), F.struct(*docs.columns).alias("_row"))
    out = rows.join(plan, ["_k1", "_k2"]).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return out.select("_row.*")


def mix_report(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", **params) -> DataFrame:
    """One row per row of ``docs``: id, its size, its source's size and target, and the words taken from it."""
    plan = plan_mix(ledger(docs, text, key, source), **params)
    each = plan.withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    size = (F.col("size") / F.col("n")).cast("long")
    return each.select(
        F.col("id").alias(key), size.alias("size"), "source_size", "target", (size * F.col("copies")).cast("long").alias("taken")
    )
