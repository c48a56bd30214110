"""M2, M3 for baskets of any width: support of given itemsets, and level-wise mining on it.

``itemset_support`` counts any list of itemsets in one pass over the baskets.  Up to
``PLANES`` itemsets are counted by bit planes: a task has one row of bits per item, one bit
per basket, and ands the rows of an itemset.  More itemsets form a prefix tree, which every task
walks for each of its baskets, so only itemsets whose prefixes a basket holds are
looked at.  Tasks send one partial count per itemset met.  Itemsets are numbered and dealt into trees of at
most ``TREE`` itemsets, so a task's memory doesn't grow with their number.

``apriori`` finds all frequent itemsets level by level (Agrawal & Srikant 1994): two
itemsets with a common prefix join to a candidate, which stays if all its subsets
are frequent.  Candidates, checks and counts are tables.

Items are compared as strings.  Null items are no items, repeated ones count once,
a null basket is an empty one.  The empty itemset is in every basket; an
itemset given twice gets two rows; a null itemset has no support (null).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtriage.config import DEFAULTS
from flowtriage.operators.mining import association_rules
from flowtriage.runtime import materialise

#: Itemsets in one prefix tree.
TREE = 200_000
#: Itemsets that are counted by bit planes, cells (item, basket) of the planes made at a time, itemsets anded at a time.
PLANES = 5_000
CELLS = 1 << 24
ANDED = 256
#: Frequent items that are held as one literal to prune the baskets.
LITERAL = 1_000


def clean(items: Column) -> Column:
    """Sorted distinct items without nulls."""
    return F.array_sort(F.array_distinct(F.filter(F.coalesce(items.cast("array<string>"), F.array().cast("array<string>")), lambda x: x.isNotNull())))


class PrefixTree:
    """Itemsets (sorted tuples, numbered) as nested dictionaries: item to (numbers of the itemsets that end here, deeper items)."""

    def __init__(self, itemsets: list[tuple[int, list[str]]]):
        self.root = ([], {})
        for number, items in itemsets:
            node = self.root
            for item in items:
                node = node[1].setdefault(item, ([], {}))
            node[0].append(number)

    def walk(self, basket: list[str], counts: dict[int, int]) -> None:
        """Add 1 to every itemset that the sorted basket holds."""
        todo = [(self.root, 0)]
        while todo:
            (ends, deeper), begin = todo.pop()
            for number in ends:
                counts[number] = counts.get(number, 0) + 1
            if len(deeper) < len(basket) - begin:
                at = {x: i for i, x in enumerate(basket[begin:], begin)} if len(deeper) * 4 < len(basket) - begin else None
                if at is not None:
                    todo += [(node, at[item] + 1) for item, node in deeper.items() if item in at]
                    continue
            for i in range(begin, len(basket)):
                node = deeper.get(basket[i])
                if node is not None:
                    todo.append((node, i + 1))


class BitPlanes:
    """Itemsets (numbered) by size, as places in the sorted list of their items."""

    def __init__(self, itemsets: list[tuple[int, list[str]]]):
        self.items = pa.array(sorted({x for _, items in itemsets for x in items}), pa.string())
        place = {x: i for i, x in enumerate(self.items.to_pylist())}
        sizes: dict = {}
        for number, items in itemsets:
            sizes.setdefault(len(items), []).append((number, [place[x] for x in items]))
        self.sizes = {size: (np.array([n for n, _ in sets]), np.array([p for _, p in sets], dtype=np.int64).reshape(len(sets), size)) for size, sets in sizes.items()}
        self.numbers = np.concatenate([n for n, _ in self.sizes.values()]) if sizes else np.zeros(0, dtype=np.int64)

    def count(self, baskets: pa.ListArray) -> np.ndarray:
        """How many of the baskets hold each itemset, in the order of ``numbers``."""
        n = len(baskets)
        row = np.repeat(np.arange(n), pc.list_value_length(baskets).to_numpy(zero_copy_only=False).astype(np.int64))
        item = pc.fill_null(pc.index_in(baskets.flatten(), value_set=self.items), -1).to_numpy(zero_copy_only=False)
        held = np.zeros((len(self.items), -(-n // 64) * 64), dtype=bool)
        held[item[item >= 0], row[item >= 0]] = True
        planes = np.packbits(held, axis=1).view(np.uint64) if held.size else held
        counts = []
        for size, (_, places) in self.sizes.items():
            if not size:
                counts.append(np.full(len(places), n))
            for lo in range(0, len(places) if size else 0, ANDED):
                part = places[lo : lo + ANDED]
                both = planes[part[:, 0]]
                for j in range(1, size):
                    both &= planes[part[:, j]]
                counts.append(np.bitwise_count(both).sum(1, dtype=np.int64))
        return np.concatenate(counts) if counts else np.zeros(0, dtype=np.int64)


def _numbered(itemsets: DataFrame, items: str) -> DataFrame:
    """(number, given, items) of every itemset, numbers from 0 on without gaps; written."""
    rows = itemsets.select(F.col(items).alias("given"), clean(F.col(items)).alias("items"))
    rows = materialise(rows.withColumn("p", F.spark_partition_id()).withColumn("i", F.monotonically_increasing_id()), "itemsets-given")
    sizes = [(r["p"], r["n"], r["least"]) for r in rows.groupBy("p").agg(F.count(F.lit(1)).alias("n"), F.min("i").alias("least")).orderBy("p").collect()]
    before = np.cumsum([0, *[n for _, n, _ in sizes]])[:-1].tolist()  # one number for each part
    starts = itemsets.sparkSession.createDataFrame([(p, b - least) for (p, _, least), b in zip(sizes, before)], "p int, off long")
    return rows.join(F.broadcast(starts), "p").select((F.col("i") + F.col("off")).alias("number"), "given", "items")


def itemset_support(baskets: DataFrame, itemsets: DataFrame, basket_col: str = "items", items_col: str = "items", tree: int = TREE) -> DataFrame:
    """M2: (items, n, support) of every row of ``itemsets``, as given, over the rows of ``baskets``."""
    numbered = materialise(_numbered(itemsets, items_col), "itemsets-numbered")
    wanted = numbered.where("given is not null")
    rows = baskets.select(clean(F.col(basket_col)).alias("basket"))
    n_baskets, last = baskets.count(), wanted.agg(F.max("number")).first()[0]
    counts = None
    for begin in range(0, (last if last is not None else -1) + 1, tree):
        block = wanted.where(F.col("number").between(begin, begin + tree - 1)).select("number", "items").toPandas()
        shared = rows.sparkSession.sparkContext.broadcast([(int(n), list(i)) for n, i in zip(block["number"], block["items"])])

        def count(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            index, found = PrefixTree(shared.value), {}
            for batch in batches:
                for basket in batch["basket"]:
                    index.walk(basket.tolist(), found)
            yield pd.DataFrame({"number": list(found), "n": list(found.values())}, dtype=np.int64)

        def count_planes(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = BitPlanes(shared.value)
            n, step = np.zeros(len(index.numbers), dtype=np.int64), max(64, CELLS // max(len(index.items), 1))
            for batch in batches:
                for lo in range(0, batch.num_rows, step):
                    n += index.count(batch.column(0).slice(lo, step))
            yield pa.RecordBatch.from_arrays([pa.array(index.numbers[n > 0], pa.int64()), pa.array(n[n > 0])], ["number", "n"])

        got = rows.mapInArrow(count_planes, "number long, n long") if len(block) <= PLANES else rows.mapInPandas(count, "number long, n long")
        counts = got if counts is None else counts.unionByName(got)
    if counts is None:
        n = F.lit(None).cast("long")
        out = numbered
    else:
        out = numbered.join(counts.groupBy("number").agg(F.sum("n").alias("n")), "number", "left")
        n = F.when(F.col("given").isNotNull(), F.coalesce("n", F.lit(0).cast("long")))
    share = F.try_divide(n, F.lit(float(n_baskets)))
    return out.select(F.col("given").alias(items_col), n.alias("n"), share.alias("support"))


def _candidates(level: DataFrame, size: int) -> DataFrame:
    """(items) of ``size`` items, all of whose subsets of one item less are in ``level``."""
    head = F.slice("items", 1, size - 2)
    left = level.select(head.alias("head"), F.element_at("items", -1).alias("a"))
    right = level.select(head.alias("head"), F.element_at("items", -1).alias("b"))
    made = left.join(right, "head").where("a < b").select(F.concat("head", F.array("a", "b")).alias("items"))
    if size == 2:
        return made
    # the two subsets without one of the last two items are the ones that were joined
    subsets = made.select("items", F.explode(F.expr(f"transform(sequence(0, {size - 3}), d -> filter(items, (x, i) -> i != d))")).alias("subset"))
    whole = subsets.join(level.select(F.col("items").alias("subset")), "subset").groupBy("items").agg(F.count(F.lit(1)).alias("n"))
    return whole.where(F.col("n") == size - 2).select("items")


def apriori(baskets: DataFrame, items_col: str = "items", min_support: float = DEFAULTS.min_support, max_size: int | None = None) -> DataFrame:
    """M3 + M4: (items, size, n, support) of all itemsets with support ≥ ``min_support``, of at most ``max_size`` items if given."""
    rows = materialise(baskets.select(F.monotonically_increasing_id().alias("row"), clean(F.col(items_col)).alias("items")), "baskets")
    total = rows.count()
    single = rows.select(F.explode("items").alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    single = single.where(F.try_divide(F.col("n"), F.lit(float(total))) >= F.lit(min_support))
    level = materialise(single.select(F.array("item").alias("items"), "n", (F.col("n") / F.lit(float(total))).alias("support")), "itemsets-1")
    found, size = level, 1
    # itemsets need frequent items only, so rare ones leave the baskets
    often = level.select(F.element_at("items", 1).alias("item"))
    few = [r["item"] for r in often.limit(LITERAL + 1).collect()]
    if len(few) <= LITERAL:
        kept = rows.select(F.array_intersect("items", F.lit(sorted(few)).cast("array<string>")).alias("items"))
    else:
        kept = rows.select("row", F.explode("items").alias("item")).join(often, "item").groupBy("row").agg(F.collect_list("item").alias("items"))
    rows = materialise(kept.where(F.size("items") > 1).select("items"), "baskets-pruned")
    while level.limit(2).count() > 1 and (max_size is None or size < max_size):
        size += 1
        counted = itemset_support(rows, materialise(_candidates(level.select("items"), size), f"candidates-{size}"))
        counted = counted.withColumn("support", F.col("n") / F.lit(float(total))).where(F.col("support") >= F.lit(min_support))
        level = materialise(counted.select("items", "n", "support"), f"itemsets-{size}")
        found = found.unionByName(level)
    return found.select("items", F.size("items").alias("size"), "n", "support")


def mine_baskets(baskets: DataFrame, items_col: str = "items", min_support: float = DEFAULTS.min_support, min_confidence: float = DEFAULTS.min_confidence, max_size: int | None = None):
    """(itemsets, rules) of ``array<string>`` baskets: ``apriori``, then M5 as for the fixed columns."""
    found = materialise(apriori(baskets, items_col, min_support, max_size), "itemsets")
    return found, association_rules(found, min_confidence)
