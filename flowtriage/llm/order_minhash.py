"""Operator 6, near-duplicate texts by Order MinHash.

Texts are sequences of words ``[^\\x20\\x09-\\x0D]+``; their k-mers are runs of
five words, the n-th occurrence of a k-mer being an element of its own (a text
of one to four words is one k-mer).  A sketch keeps the three labelled k-mers
with the smallest hash, in the order of the text; texts that agree in one of
``SKETCHES`` sketches are candidates.  A pair is verified by alignment: ``m`` is
the longest common subsequence of the labelled k-mers within the band in which
any alignment of interest lies, its similarity ``m / (n1 + n2 - m)``; it is a
near-duplicate from 0.8 on.  In texts of the same order this is the Jaccard
similarity of five-word shingles, and less where passages are moved.  A class
is a connected component of such pairs.

Candidates are not paired with each other.  A bucket's hub, the text with the
most bucket mates, is aligned with the bucket's others; that joins copies of one
text.  Texts of buckets that still hold several components are then decided
exactly: two texts are only aligned if they are of different components and
share one of their rarest k-mers, as any two of the required similarity must
(prefix filter).  So every candidate pair is decided or already joined by others.

Texts equal in their words are one node, sketched and compared once.  Null
texts and texts without words are in no class but their own.  Ids that are null
give no class name: a class is named by its smallest id, null if it has none.
Rows equal in id and text are one document.  Extra columns stay in
``drop_near_copies``; an empty table gives an empty result.

Scale: the signature table holds a row of 8-byte sketches per text, written to
the shared folder; buckets are grouped by partial minima, so a hot bucket moves
one row per task; only texts in a candidate pair are joined for alignment.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe_trie import slices
from .common import SPACE, components, materialise, row_key

K_WORDS = 5
KEEP = 3
SKETCHES = 14
SIMILARITY = 0.8
#: Low bits of a hash that hold a k-mer's place in its slice of texts; a slice, or a text of 2^31 bytes, has fewer k-mers.
PLACE_BITS = 32
#: Keys with more than one part in HOT of all rows are joined apart from the others.
HOT = 1000
#: Pairs of such a hub that share one copy of its text.
PAIRS_PER_COPY = 256

_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)
_BASE = _U(0xD6E8FEB86659FD93)
_BYTES = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _ODD
    x = (x ^ (x >> _U(29))) * _BASE
    return x ^ (x >> _U(32))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        while len(out) < n:
            out = np.concatenate([out, out * _U(pow(base, len(out), 1 << 64))])
    return out[:n]


class Kmers:
    """Labelled k-mers of texts as 64-bit hashes, for a slice of texts at once."""

    def __init__(self):
        self.up = self.down = np.zeros(0, dtype=np.uint64)

    def words(self, texts: list[str]):
        """(hash of every word, text of every word)."""
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        flat = np.frombuffer(b" ".join(raw) + b" ", dtype=np.uint8)
        if len(self.up) < len(flat):
            n = 1 << int(len(flat)).bit_length()
            self.up = _powers(int(_BASE), n)
            self.down = _powers(pow(int(_BASE), -1, 1 << 64), n)
        gap = (flat == 32) | ((flat >= 9) & (flat <= 13))
        edge = np.flatnonzero(np.diff(np.concatenate([[True], gap, [True]]).astype(np.int8)))
        begin, end = edge[0::2], edge[1::2]
        total = np.concatenate([[_U(0)], np.cumsum(_BYTES[flat] * self.up[: len(flat)], dtype=np.uint64)])
        hashes = _mix((total[end] - total[begin]) * self.down[begin] + (end - begin).astype(np.uint64) * _ODD)
        starts = np.cumsum([0, *[len(r) + 1 for r in raw]])
        return hashes, np.searchsorted(starts, begin, side="right") - 1

    def __call__(self, texts: list[str]):
        """(labelled k-mer hashes, text of each, words per text, two hashes of the word sequence per text)."""
        word, owner = self.words(texts)
        n_words = np.bincount(owner, minlength=len(texts)).astype(np.int64)
        first = np.cumsum(n_words) - n_words
        place = np.arange(len(word)) - first[owner]
        # a text's last words start shorter runs, which count only where the whole text is that short
        run = np.zeros(len(word), dtype=np.uint64)
        for k in range(K_WORDS):
            at = np.minimum(np.arange(len(word)) + k, max(0, len(word) - 1))
            run = run * _BASE + np.where(place + k < n_words[owner], word[at], _U(0))
        good = (place + K_WORDS <= n_words[owner]) | (place == 0)
        run, of = _mix(run[good]), owner[good]
        by = np.argsort(run ^ _mix(of.astype(np.uint64)), kind="stable")
        same = np.zeros(len(run), dtype=bool)
        same[1:] = (run[by][1:] == run[by][:-1]) & (of[by][1:] == of[by][:-1])
        if same.any():
            start = np.maximum.accumulate(np.where(same, 0, np.arange(len(run))))
            label = np.empty(len(run), dtype=np.uint64)
            label[by] = (np.arange(len(run)) - start).astype(np.uint64)
            run = np.where(label > 0, _mix(run + label * _ODD), run)
        names = np.zeros((2, len(texts)), dtype=np.uint64)
        for j, seed in enumerate((_ODD, _BASE)):
            np.add.at(names[j], owner, _mix(word + seed) * _mix(place.astype(np.uint64) * _U(2) + seed))
        return run, of, n_words, names


def sketches(run: np.ndarray, of: np.ndarray, n_texts: int, n: int = SKETCHES, keep: int = KEEP) -> np.ndarray:
    """n_texts x n: hash of the ``keep`` smallest labelled k-mers of each text in their order; texts without k-mers get 0."""
    out = np.zeros((n_texts, n), dtype=np.uint64)
    if not len(run):
        return out
    cuts = np.flatnonzero(np.diff(of, prepend=-1))
    rows = of[cuts]
    worst = _U(0xFFFFFFFFFFFFFFFF)
    bits = PLACE_BITS
    spot = np.arange(len(run), dtype=np.uint64)
    # each hash carries its k-mer's place in the low bits, so a minimum tells where it is
    for s in range(n):
        value = (run ^ _U(0x1234567 + s * 0x9E3779B9)) * (_ODD + _U(2 * s))
        value ^= value >> _U(31)
        value *= _BASE
        value >>= _U(bits)
        value <<= _U(bits)
        value |= spot
        places = np.full((keep, len(cuts)), len(run), dtype=np.int64)
        for j in range(keep):
            low = np.minimum.reduceat(value, cuts)
            real = np.flatnonzero(low != worst)
            at = (low[real] & _U((1 << bits) - 1)).astype(np.int64)
            places[j, real] = at
            value[at] = worst
        places.sort(axis=0)
        key = np.full(len(cuts), s + 1, dtype=np.uint64)
        padded = np.append(run, _U(0))
        for j in range(keep):
            key = _mix(key * _ODD + padded[places[j]])
        out[rows, s] = key
    return out


def signatures(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, _k1, _k2, h1, h2, n_words, keys) per row: the text's own key, its word sequence's key, its sketches."""

    @F.pandas_udf("h1 long, h2 long, n_words long, keys array<long>")
    def sign(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        kmers = Kmers()
        for batch in batches:
            for texts in slices(batch):
                run, of, n_words, names = kmers(texts)
                keys = sketches(run, of, len(texts)).view(np.int64)
                own = names.view(np.int64)
                yield pd.DataFrame({"h1": own[0], "h2": own[1], "n_words": n_words, "keys": list(keys)})

    rows = docs.select(F.col(key).alias("id"), *row_key(F.col(key), F.col(text)), sign(F.col(text)).alias("s"))
    return materialise(rows.select("id", "_k1", "_k2", "s.*"), "omh-signatures")


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Banded alignment of two sequences of labelled k-mers; exact from 0.6 on, else a lower bound."""
    n = len(a) + len(b)
    if not len(a) or not len(b):
        return 0.0
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    # similarity 0.6 means at most n / 4 k-mers outside the alignment, so no partner is farther off than that
    near = np.abs(i - j) <= n // 4 + 1
    i, j = i[near], j[near]
    line = i[np.argsort(j)]
    if (np.diff(line) > 0).all():
        m = len(line)
    else:
        tails: list[int] = []
        for x in line.tolist():
            at = bisect_left(tails, x)
            tails[at : at + 1] = [x]
        m = len(tails)
    return m / (n - m)


def _named(rows: DataFrame, names: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``rows`` joined to ``names`` (one row per key, ``n`` rows of ``rows`` having it, dropped).

    The keys of more than one part in ``HOT`` of all rows, fewer than ``HOT`` by that, are broadcast, so no task of the
    shuffled join meets a hot one.
    """
    total = names.agg(F.sum("n")).first()[0] or 0
    is_hot = F.col("n") * HOT > total
    hot, rest = F.broadcast(names.where(is_hot).drop("n")), names.where(~is_hot).drop("n")
    others = rows.join(hot.select(*keys), keys, "left_anti").join(rest, keys, how)
    return rows.join(hot, keys).unionByName(others.select(*rows.columns, *[c for c in rest.columns if c not in keys]))


def _align(pairs: DataFrame, texts: DataFrame, name: str) -> DataFrame:
    """(node, hub, far) for pairs (node, hub): far is 1 - similarity.

    The pairs of a hot hub are dealt to copies of its text, one per ``PAIRS_PER_COPY`` pairs; fewer than ``HOT`` hubs are hot.
    """
    sizes = pairs.groupBy("hub").agg(F.count(F.lit(1)).alias("n"))
    hot = materialise(sizes.where(F.col("n") * HOT > pairs.count()).select("hub", F.ceil(F.col("n") / PAIRS_PER_COPY).cast("int").alias("salts")), "omh-hot-hubs")
    salted = lambda df: df.join(F.broadcast(hot), "hub", "left").withColumn("salts", F.coalesce("salts", F.lit(1)))
    few = salted(pairs).withColumn("salt", F.pmod(F.hash("node"), F.col("salts"))).drop("salts")
    hubs = salted(sizes.select("hub")).select("hub", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    hubs = hubs.join(texts.select(F.col("node").alias("hub"), F.col("text").alias("hub_text")), "hub")
    got = few.join(texts, "node").join(hubs, ["hub", "salt"])

    def measure(batches):
        kmers, hub, b = Kmers(), None, None
        for batch in batches:
            far = []
            for h, ht, t in zip(batch["hub"], batch["hub_text"], batch["text"]):
                if h != hub:
                    hub, b = h, kmers([ht])[0]
                far.append(1 - similarity(kmers([t])[0], b))
            yield pd.DataFrame({"node": batch["node"], "hub": batch["hub"], "far": np.array(far, dtype=np.float64)})

    return materialise(got.select("node", "hub", "text", "hub_text").mapInPandas(measure, "node long, hub long, far double"), name)


def _prefix_pairs(nodes: DataFrame, texts: DataFrame, comps: DataFrame, similar: float) -> DataFrame:
    """(node, hub): the pairs of different components among ``nodes`` that can be as similar as ``similar``.

    Two sets of sizes n1 and n2 with at least ``o = similar / (1 + similar) * (n1 + n2)`` common elements share one of
    their first n1 - o + 1 and n2 - o + 1 elements in any order.  The order is by frequency among ``nodes``, rare first,
    so k-mers that an edit made fill the places of texts that were edited too much, and those meet nobody.
    """

    def explode(batches):
        kmers = Kmers()
        for batch in batches:
            for node, text in zip(batch["node"], batch["text"]):
                run = kmers([text])[0].view(np.int64)
                yield pd.DataFrame({"node": node, "n": len(run), "k": run})

    rows = texts.join(nodes, "node").mapInPandas(explode, "node long, n int, k long")
    rows = materialise(rows, "omh-kmers")
    often = rows.groupBy("k").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    known = rows.join(often, "k")
    # a text's k-mers that no other text has come first
    place = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("c"), F.desc("k")))
    known = known.withColumn("r", F.col("n") - place + 1)
    share = similar / (1 + similar)
    least = lambda total: F.ceil(F.lit(share) * total - 1e-9)
    # a partner has at least ``similar`` times the size
    known = known.where(F.col("r") <= F.col("n") - least(F.col("n") * (1 + similar)) + 1).select("k", "node", "n", "r")
    known = materialise(known.join(comps, "node").select("k", "node", "n", "r", "comp"), "omh-prefixes")
    sizes = known.groupBy("k", "comp").agg(F.count(F.lit(1)).alias("c"))
    most = sizes.groupBy("k").agg(F.max_by("comp", F.struct("c", "comp")).alias("most"), F.count(F.lit(1)).alias("comps")).where("comps > 1")
    few = known.join(most, "k").where("comp != most").select("k", *[F.col(c).alias(f"x_{c}") for c in ("node", "n", "r", "comp")])
    o = least(F.col("n") + F.col("x_n"))
    meet = (F.col("comp") != F.col("x_comp")) & (F.col("r") <= F.col("n") - o + 1) & (F.col("x_r") <= F.col("x_n") - o + 1)
    return few.join(known, "k").where(meet).select(F.greatest("node", "x_node").alias("node"), F.least("node", "x_node").alias("hub")).distinct()


def _candidates(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes that share a bucket, numbered so that the most central ones (with the most bucket mates) come first, and
    their buckets (b, own, node)."""
    keyed = nodes.select("raw", F.posexplode("keys").alias("own", "b"))
    mates = keyed.groupBy("b").agg(F.count(F.lit(1)).alias("mates")).where("mates > 1")
    shared = materialise(keyed.join(mates, "b"), "omh-buckets")
    order = shared.groupBy("raw").agg(F.sum("mates").alias("mates"))
    order = order.repartitionByRange(F.desc("mates"), F.col("raw")).sortWithinPartitions(F.desc("mates"), "raw")
    order = materialise(order.select("raw", F.monotonically_increasing_id().alias("node")), "omh-order")
    numbered = materialise(nodes.join(order, "raw"), "omh-candidates")
    return numbered, shared.join(order, "raw").select("b", "own", "node")


def near_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", similar: float = SIMILARITY) -> DataFrame:
    """(id, _k1, _k2, class_id, is_kept) per row of ``docs``; is_kept marks one document of each class."""
    signed = signatures(docs, key, text)
    first = F.min(F.struct(F.col("id").isNull().alias("no"), "id", "_k1", "_k2")).alias("f")
    nodes = signed.where("n_words > 0").groupBy("h1", "h2").agg(first, F.first("keys").alias("keys"), F.count(F.lit(1)).alias("n"))
    nodes = nodes.select(F.monotonically_increasing_id().alias("raw"), "h1", "h2", "keys", "n", "f.id", "f._k1", "f._k2")
    nodes = materialise(nodes, "omh-nodes")
    found, level = _candidates(nodes)
    near = F.col("far") <= 1 - similar + 1e-12
    links, comps = None, found.select("node", F.col("node").alias("comp"))
    level = materialise(level, "omh-level")
    hubs = level.join(level.groupBy("b").agg(F.min("node").alias("hub")), "b").where("node > hub")
    pairs = materialise(hubs.select("node", "hub").distinct(), "omh-pairs")
    if pairs.limit(1).count():
        rows = docs.select(*row_key(F.col(key), F.col(text)), F.col(text).alias("text"))
        texts = rows.join(found.select("node", "_k1", "_k2"), ["_k1", "_k2"]).dropDuplicates(["_k1", "_k2"]).select("node", "text")
        texts = materialise(texts, "omh-texts")
        linked = lambda df: df.where(near).select(F.col("node").alias("a"), F.col("hub").alias("b"))
        links = _align(pairs, texts, "omh-aligned")
        comps = materialise(components(linked(links), found.select("node")), "omh-components")
        # buckets that still hold several components
        open_ = level.join(comps, "node").groupBy("b").agg(F.min("comp").alias("c"), F.max("comp").alias("d")).where("c < d").select("b")
        left = materialise(level.join(open_, "b", "left_semi").select("node").distinct(), "omh-open")
        check = _prefix_pairs(left, texts, comps, similar).join(links.select("node", "hub"), ["node", "hub"], "left_anti")
        links = links.unionByName(_align(materialise(check, "omh-pairs"), texts, "omh-aligned"))
        comps = components(linked(links), found.select("node"))
    named = materialise(found.drop("keys").join(comps, "node"), "omh-named")
    best = named.groupBy("comp").agg(F.min(F.struct(F.col("id").isNull().alias("no"), "id", "_k1", "_k2")).alias("f"), F.count(F.lit(1)).alias("n"))
    named = _named(named, materialise(best, "omh-best"), ["comp"]).select("raw", F.col("f.id").alias("class_id"), F.col("f._k1").alias("c1"), F.col("f._k2").alias("c2"))
    own = nodes.select("raw", "h1", "h2", "n", F.col("id").alias("own_id"), F.col("_k1").alias("o1"), F.col("_k2").alias("o2")).join(named, "raw", "left")
    alone = F.col("c1").isNull()
    own = own.select(
        "h1", "h2", "n", F.when(alone, F.col("own_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("c1", "o1").alias("c1"), F.coalesce("c2", "o2").alias("c2")
    )
    out = _named(signed.drop("keys"), materialise(own, "omh-classes"), ["h1", "h2"], "left")
    lone = F.col("n_words") == 0
    return out.select(
        "id", "_k1", "_k2",
        F.when(lone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        (lone | ((F.col("_k1") == F.col("c1")) & (F.col("_k2") == F.col("c2")))).alias("is_kept"),
    )


def drop_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", **params) -> DataFrame:
    """``docs`` with one document of each class: that with the smallest id."""
    kept = near_classes(docs, key, text, **params).where("is_kept").select("_k1", "_k2").distinct()
    worded = F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(SPACE)) != ""
    # the row travels in a struct, so that no name of its columns can clash
    rows = docs.where(worded).select(*row_key(F.col(key), F.col(text)), F.struct(*docs.columns).alias("_row"))
    one = rows.join(kept, ["_k1", "_k2"]).dropDuplicates(["_k1", "_k2"]).select("_row.*")
    return one.unionByName(docs.where(~worded))
