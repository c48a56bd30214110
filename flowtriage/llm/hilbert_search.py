"""Operator 1, approximate nearest neighbours by shifted Hilbert curves.

Every curve projects the vectors onto a few random orthonormal directions,
shifts and quantises them, and orders them by Hilbert key.  A query looks at
the vectors within some ranks of its own place in several of these orderings,
each shifted and turned differently, so that neighbours cut apart by one curve
are close on another; the windows are merged and reranked by the exact
Euclidean distance in double precision.

Windows widen in rounds, each ``GROW`` times the last, up to ``near`` of all
ranks on ``curves`` curves; a query whose nearest rows stay the same over a
round is done.  What is open then, as on vectors without clusters, looks once
more at ``share`` of all ranks on ``wide_curves`` curves: for one amount of
reading few wide windows overlap less than many narrow ones.

Equal vectors are one index entry that keeps its ``k + 1`` smallest ids: of
equally near rows the smaller ids win, so no other can be among the ``k``
nearest of any query.  Vectors that are null, empty, zero, of another length
than the most common one, or that hold null or non-finite components take no
part, neither as query nor as candidate.  Null ids take no part.  Repeated rows
of an id are one row.  Other input columns are ignored.  An empty table, or one
with a single vector, gives an empty result.

Scale: ranks come from range partitions (one count per partition is
accumulated), cut into blocks of ``BLOCK`` entries, so no block grows with a
hot key or vector.  Equal query vectors are searched once.  The queries of a
block are dealt to copies of it, one per ``CHUNK`` queries, and each copy
measures its queries by matrix products and returns ``k + 2`` rows for each.
What is shuffled is the open queries times the blocks of their windows, and
the index per curve once for each such copy.  Results of vectors that more than
one in ``HOT`` queries share are broadcast, fewer than ``HOT`` short rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import hash128, materialise

K = 10
CURVES = 8
DIMS = 4
BITS = 15
NEAR = 0.05
GROW = 4
ROUNDS = 3
WIDE_CURVES = 2
SHARE = 0.75
BLOCK = 2048
CHUNK = 1024
HOT = 1000
SEED = 11


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``cells`` (n x dims integers below 2 ** bits); dims * bits <= 63.

    From the highest bit on, the cell's orthant is read in Gray-code order, then
    the frame of the next level is turned: the usual axis swaps and reflections.
    """
    axes = [c.astype(np.int64) for c in cells.T]
    n = len(axes)
    for b in range(bits - 1, 0, -1):
        q, low = 1 << b, (1 << b) - 1
        for i in range(n):
            high = (axes[i] & q) != 0
            swap = np.where(high, 0, (axes[0] ^ axes[i]) & low)
            axes[0] = np.where(high, axes[0] ^ low, axes[0]) ^ swap
            if i:
                axes[i] = axes[i] ^ swap
    for i in range(1, n):
        axes[i] = axes[i] ^ axes[i - 1]
    turn = np.zeros_like(axes[0])
    for b in range(bits - 1, 0, -1):
        turn = np.where((axes[-1] >> b) & 1 == 1, turn ^ ((1 << b) - 1), turn)
    key = np.zeros_like(axes[0])
    for b in range(bits - 1, -1, -1):
        for a in axes:
            key = (key << 1) | (((a ^ turn) >> b) & 1)
    return key


def curve_keys(x: np.ndarray, curve: int, dims: int, bits: int, seed: int) -> np.ndarray:
    """Key of unit-scaled vectors on one curve: projections lie in [-1, 1], shifted by up to a whole side."""
    rng = np.random.default_rng([seed, curve])
    turn = np.linalg.qr(rng.normal(size=(x.shape[1], max(dims, 1))))[0]
    place = x @ turn
    place = (place / 2 + 0.5 + rng.random(turn.shape[1])) / 2
    return hilbert_keys(np.clip(place * (1 << bits), 0, (1 << bits) - 1).astype(np.int64), bits)


def _valid(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & fine & F.exists(vector, lambda x: x != 0)


def _entries(vectors: DataFrame, key: str, vector: str, k: int) -> DataFrame:
    """(node, h1, h2, vec, ids): distinct vectors with their k + 1 smallest ids."""
    # 4-byte vectors stay so until they are measured, which halves what is shuffled
    kind = "array<float>" if vectors.schema[vector].dataType.simpleString() == "array<float>" else "array<double>"
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast(kind).alias("vec"))
    rows = rows.where("id is not null").where(_valid(F.col("vec")))
    sizes = rows.groupBy(F.size("vec").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").limit(1)
    rows = rows.join(F.broadcast(sizes.select("d")), F.size("vec") == F.col("d")).drop("d")
    h1, h2 = hash128(F.transform("vec", lambda x: x + F.lit(0.0)))  # -0.0 and 0.0 are the same number
    rows = rows.select("id", "vec", h1.alias("h1"), h2.alias("h2")).dropDuplicates(["id", "h1", "h2"])
    best = Window.partitionBy("h1", "h2").orderBy("id")
    few = rows.withColumn("rn", F.row_number().over(best)).where(F.col("rn") <= k + 1)
    grouped = few.groupBy("h1", "h2").agg(F.sort_array(F.collect_list("id")).alias("ids"), F.first("vec").alias("vec"))
    return materialise(grouped.select(F.monotonically_increasing_id().alias("node"), "h1", "h2", "vec", "ids"), "curve-entries")


def _ranks(entries: DataFrame, scale: float, curves: int, dims: int, bits: int, seed: int) -> DataFrame:
    """(node, curve, rank): the place of every entry in every ordering."""

    @F.pandas_udf("array<long>")
    def keys_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            x = np.stack(batch.to_numpy()).astype(np.float64) / scale if len(batch) else np.zeros((0, 1))
            cols = [curve_keys(x, c, dims, bits, seed) for c in range(curves)] if len(batch) else []
            yield pd.Series(list(np.column_stack(cols)) if cols else [], dtype=object)

    placed = entries.select("node", F.posexplode(keys_of("vec")).alias("curve", "place"))
    ranged = materialise(placed.repartitionByRange("curve", "place", "node").withColumn("p", F.spark_partition_id()), "curve-order")
    counts = ranged.groupBy("curve", "p").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("curve").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("curve").alias("c"), F.col("p").alias("q"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("off"))
    local = F.row_number().over(Window.partitionBy("curve", "p").orderBy("place", "node")) - 1
    order = ranged.withColumn("local", local).join(offsets, (F.col("curve") == F.col("c")) & (F.col("p") == F.col("q")))
    return materialise(order.select("node", "curve", (F.col("off") + F.col("local")).alias("rank")), "curve-ranks")


def _nearest(asked: np.ndarray, at: np.ndarray, base: np.ndarray, ranks: np.ndarray, low: np.ndarray, reach: int, most: int):
    """For each query, the ``most`` nearest rows of ``base`` within ``reach`` ranks, by exact distance, then ``low``."""
    sizes = (base * base).sum(1)
    for begin in range(0, len(asked), 128):
        q = asked[begin : begin + 128]
        own = (q * q).sum(1)
        rough = own[:, None] + sizes - 2 * (q @ base.T)
        rough[np.abs(ranks - at[begin : begin + 128, None]) > reach] = np.inf
        # the matrix product is only as good as the squared lengths; what it can't tell apart is measured
        slack = 1e-10 * (own + sizes.max())
        if len(base) > most:
            limit = np.partition(rough, most - 1, axis=1)[:, most - 1] + slack
        else:
            limit = np.full(len(q), np.inf)
        for i in range(len(q)):
            near = np.flatnonzero((rough[i] <= limit[i]) & (rough[i] < np.inf))
            gap = np.sqrt(((base[near] - q[i]) ** 2).sum(1))
            by = np.lexsort((low[near], gap))[:most]
            yield begin + i, near[by], gap[by]


def _look(todo: DataFrame, order: DataFrame, index: DataFrame, total: int, reach: int, curves: int, most: int) -> DataFrame:
    """(node, cand, low, score): for each entry of ``todo`` (node, vec) the nearest in each block of its windows."""
    last = max(0, (total - 1) // BLOCK)
    # a window keeps its width at the ends of a curve
    middle = F.greatest(F.least("rank", F.lit(total - 1 - reach)), F.lit(reach))
    windows = todo.select("node").join(order.where(F.col("curve") < curves), "node").select("node", "curve", middle.alias("at"))
    first = F.floor((F.col("at") - reach) / BLOCK).cast("int")
    final = F.least(F.lit(last), F.floor((F.col("at") + reach) / BLOCK)).cast("int")
    windows = windows.withColumn("block", F.explode(F.sequence(first, final)))
    copies = windows.groupBy("curve", "block").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("copies"))
    copies = materialise(copies, "curve-copies")
    left = windows.join(copies, ["curve", "block"]).withColumn("copy", F.pmod(F.hash("node"), F.col("copies")))
    left = left.join(todo.select("node", F.col("vec").alias("asked")), "node")
    left = left.select(F.col("curve").alias("on"), F.col("block").alias("to"), F.col("copy").alias("part"), "node", "at", "asked")
    right = index.join(copies, ["curve", "block"]).withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    right = right.select("curve", "block", "copy", F.col("node").alias("cand"), "low", "rank", "vec")

    def measure(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = {"node": [], "cand": [], "low": [], "score": []}
        if len(left) and len(right):
            node, cand, low = (t.to_numpy() for t in (left["node"], right["cand"], right["low"]))
            asked, base = (np.stack(t.to_numpy()).astype(np.float64) for t in (left["asked"], right["vec"]))
            for i, near, gap in _nearest(asked, left["at"].to_numpy(), base, right["rank"].to_numpy(), low, reach, most):
                for name, part in zip(out, (np.full(len(near), node[i]), cand[near], low[near], gap)):
                    out[name].append(part)
        kinds = {name: "float64" if name == "score" else "int64" for name in out}
        return pd.DataFrame({name: np.concatenate(parts) if parts else [] for name, parts in out.items()}).astype(kinds)

    return left.groupBy("on", "to", "part").cogroup(right.groupBy("curve", "block", "copy")).applyInPandas(measure, "node long, cand long, low long, score double")


def search(
    vectors: DataFrame,
    is_query: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
    curves: int = CURVES,
    dims: int = DIMS,
    bits: int = BITS,
    near: float = NEAR,
    share: float = SHARE,
    wide_curves: int = WIDE_CURVES,
    seed: int = SEED,
) -> DataFrame:
    """(query_id, rank, <key>, score): the ``k`` nearest found for each row that ``is_query`` picks, by distance, then id."""
    entries = _entries(vectors, key, vector, k)
    total = entries.count()
    scale = entries.agg(F.max(F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))))).first()[0] or 1.0
    order = _ranks(entries, scale, curves, dims, bits, seed)
    index = order.withColumn("block", F.floor(F.col("rank") / BLOCK).cast("int"))
    index = index.join(entries.select("node", "vec", F.col("ids")[0].alias("low")), "node")

    asked = vectors.where(is_query).select(F.col(key).cast("long").alias("query_id"), F.col(vector).cast("array<double>").alias("vec"))
    asked = asked.where("query_id is not null").where(_valid(F.col("vec")))
    h1, h2 = hash128(F.transform("vec", lambda x: x + F.lit(0.0)))
    asked = materialise(asked.select("query_id", h1.alias("h1"), h2.alias("h2")).distinct(), "curve-asked")
    same = asked.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"))
    searched = materialise(entries.join(same, ["h1", "h2"]).select("node", "h1", "h2", "vec", "n"), "curve-queries")

    # itself, k others, and one to spare should another lie at distance 0
    most = k + 2
    widths = [(curves, math.ceil(near * total / 2 / GROW**r)) for r in reversed(range(ROUNDS))]
    widths = [w for w in widths if w[1] > k] + [(wide_curves, max(math.ceil(share * total / 2), k + 1))]
    place = F.row_number().over(Window.partitionBy("node").orderBy("score", "low"))
    found, todo = None, searched.select("node", "vec")
    for on, reach in widths:
        seen = _look(todo, order, index, total, reach, min(on, curves), most)
        if found is not None:
            seen = seen.unionByName(found.join(todo.select("node"), "node", "left_semi"))
        seen = seen.groupBy("node", "cand", "low").agg(F.min("score").alias("score")).withColumn("at", place).where(F.col("at") <= most)
        seen = materialise(seen.drop("at"), "curve-seen")
        if found is None:
            found = seen
            continue
        shape = lambda df, *names: df.groupBy("node").agg(*[f.alias(n) for f, n in zip((F.count(F.lit(1)), F.max("score")), names)])
        both = shape(seen, "n", "far").join(shape(found, "m", "was"), "node", "left")
        settled = both.where((F.col("n") == most) & (F.col("m") == most) & (F.col("far") == F.col("was"))).select("node")
        found = materialise(found.join(todo.select("node"), "node", "left_anti").unionByName(seen), "curve-found")
        todo = materialise(todo.join(settled, "node", "left_anti"), "curve-open")

    # one short row per searched vector, then the queries that have it
    pairs = found.join(entries.select(F.col("node").alias("cand"), "ids"), "cand").select("node", "score", F.explode("ids").alias("id"))
    pairs = pairs.withColumn("at", F.row_number().over(Window.partitionBy("node").orderBy("score", "id"))).where(F.col("at") <= k + 1)
    lists = pairs.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("score", "id"))).alias("near"))
    lists = materialise(lists.join(searched.drop("vec"), "node").drop("node"), "curve-lists")
    n_asked = asked.count()
    hot, rest = (lists.where(c).drop("n") for c in (F.col("n") * HOT > n_asked, F.col("n") * HOT <= n_asked))
    common = F.broadcast(hot.select("h1", "h2"))
    got = asked.join(F.broadcast(hot), ["h1", "h2"]).unionByName(asked.join(common, ["h1", "h2"], "left_anti").join(rest, ["h1", "h2"]))
    got = got.select("query_id", F.explode("near").alias("x")).select("query_id", "x.score", "x.id").where("id != query_id")
    got = got.groupBy("query_id", "id").agg(F.min("score").alias("score"))
    by = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "id"))
    return got.withColumn("rank", by).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(key), "score")
