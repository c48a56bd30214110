r"""Operator 12, Merkle manifest of a dataset by slot pivots.

A row's leaf is H (lower-case hex SHA-256) of its fields, each ``-`` if null,
else its UTF-8 byte count, ``:`` and its value.  The leaves of a source, in
ascending order of id (null first; rows of one id by leaf), form a tree: while
several nodes remain, runs of ``fanout`` consecutive ones become the H of their
concatenated digests, also a last run of one.  What remains is the source's
subroot; subroots, ordered by source (null first, by UTF-8 bytes), form the tree
whose last node is the root.

Every level is one conditional aggregate per slot: a parent's row holds its
children in ``fanout`` columns, is hashed by concatenating them, and gives a
child's siblings by leaving its own column out.  Proofs go down the same rows,
so no leaf meets more than its ``fanout - 1`` siblings a level.

``verify`` folds a leaf (as it is, or computed from a changed row) with the
original siblings and compares with the root.

Equal rows are separate, neighbouring leaves.  Null sources are a source of
their own.  A source with one row has no siblings there; an empty table gives an
empty manifest.  Texts of any length are hashed whole.  Other columns are
ignored, so no name can clash.

Scale: the texts are read once and never shuffled.  Positions come from range
partitions (``dense_rank``), so a hot source is cut like any other; levels are
written tables that shrink by ``fanout``, their number grows with the logarithm
of the largest source.  Levels and the root are all the driver learns.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtriage.runtime import dense_rank

from .common import materialise

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _field(value: Column) -> Column:
    said = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(said).cast("string"), F.lit(":"), said), F.lit("-"))


def leaf_digest(fields: Iterable[Column]) -> Column:
    return F.sha2(F.concat(*[_field(f) for f in fields]), 256)


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, nothing else."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def _pivot(nodes: DataFrame, fanout: int, carried: list[str], name: str) -> DataFrame:
    """(g, at, n, slots, h): one row per parent, children's ``carried`` columns by slot; ``n`` is the number of nodes of the
    level in the tree.  The one node of a tree that is done keeps its digest."""
    slot = F.col("pos") % fanout
    child = F.struct(*carried)
    spread = [F.max(F.when(slot == j, child)).alias(f"c{j}") for j in range(fanout)]
    rows = nodes.groupBy("g", F.floor(F.col("pos") / fanout).alias("at")).agg(F.max("n").alias("n"), *spread)
    digests = F.concat(*[F.coalesce(F.col(f"c{j}.h"), F.lit("")) for j in range(fanout)])
    own = F.when(F.col("n") == 1, F.col("c0.h")).otherwise(F.sha2(digests, 256))
    return materialise(rows.select("g", "at", "n", F.array(*[f"c{j}" for j in range(fanout)]).alias("slots"), own.alias("h")), name)


def levels(leaves: DataFrame, fanout: int = FANOUT, name: str = "merkle") -> list[DataFrame]:
    """Level tables from the leaves up, from (g, pos, n, h, ...); a tree is in all levels up to that of its last node."""
    extra = [c for c in leaves.columns if c not in ("g", "pos", "n", "h")]
    out = [_pivot(leaves, fanout, ["h", *extra], name)]
    while True:
        left = F.ceil(F.col("n") / fanout)
        nodes = out[-1].where(left > 1).select("g", F.col("at").alias("pos"), left.alias("n"), "h")
        if not nodes.limit(1).count():
            return out
        out.append(_pivot(nodes, fanout, ["h"], name))


def tops(tables: list[DataFrame], fanout: int = FANOUT) -> DataFrame:
    """(g, h): the last node of every tree."""
    out = None
    for t in tables:
        done = t.where(F.ceil(F.col("n") / fanout) == 1).select("g", "h")
        out = done if out is None else out.unionByName(done)
    return out


def _children(rows: DataFrame, path: Column, others: list[str]) -> DataFrame:
    """A row per child with its siblings put before ``path``."""
    rows = rows.select("g", "at", "n", "slots", path.alias("path"), *others)
    one = rows.select("g", "at", "n", "slots", "path", *others, F.posexplode("slots").alias("slot", "child")).where("child is not null")
    digests = F.transform("slots", lambda c: c["h"])  # array_join leaves the empty slots out
    left = F.array_join(F.slice(digests, F.lit(1), F.col("slot")), "")
    right = F.array_join(F.slice(digests, F.col("slot") + 2, F.size("slots")), "")
    longer = F.concat(F.array(F.struct(left.alias("left"), right.alias("right"))), F.col("path"))
    return one.withColumn("path", F.when(F.col("n") == 1, F.col("path")).otherwise(longer)).drop("slots")


def paths(tables: list[DataFrame], ends: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """The leaves (g, at, slot, child, path, ...) with ``path``, the siblings (left, right) level by level up to the root;
    ``ends`` (g, path, ...) has what follows the tree's own levels and further columns of the tree."""
    others = [c for c in ends.columns if c not in ("g", "path")]
    below = None
    for t in reversed(tables):
        done = F.ceil(F.col("n") / fanout) == 1
        known = t.where(done).join(ends, "g").select(*t.columns, "path", *others)
        if below is not None:
            upper = below.select("g", (F.col("at") * fanout + F.col("slot")).alias("at"), "path", *others)
            known = known.unionByName(t.where(~done).join(upper, ["g", "at"]).select(*t.columns, "path", *others))
        below = _children(known, F.col("path"), others)
    return below


def proof_of(path: Column) -> Column:
    """H of all siblings, from the leaf's up, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda x: F.concat(x["left"], x["right"])), ""), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and the siblings lead to."""
    return F.aggregate(path, leaf, lambda acc, x: F.sha2(F.concat(x["left"], acc, x["right"]), 256))


def manifest(docs: DataFrame, key: str = "doc_id", source: str = "source", fields: tuple = FIELDS, altered: dict | None = None, fanout: int = FANOUT) -> DataFrame:
    """(<key>, leaf, subroot, root, path, changed): a row per document; ``changed`` is the leaf of the row with the columns
    ``altered`` (name to Column) in place of its own, null where that is the same."""
    altered = altered or {}
    leaf = leaf_digest(F.col(f) for f in fields)
    other = leaf_digest(altered.get(f, F.col(f)) for f in fields)
    differs = F.lit(False)
    for f, c in altered.items():
        differs = differs | ~c.eqNullSafe(F.col(f))
    rows = docs.select(
        F.col(key).alias("id"), F.coalesce(F.concat(F.lit("1"), F.col(source).cast("string")), F.lit("0")).alias("g"),
        leaf.alias("h"), F.when(differs, other).alias("changed"),
    )
    # the texts stay behind here; the place in the written table tells equal rows apart
    rows = materialise(rows, "merkle-leaves").withColumn("v", F.struct("id", "h", F.monotonically_increasing_id().alias("i")))
    sizes = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    leaves = dense_rank(rows, ["g"], "v", "pos", "merkle-order").join(sizes, "g").select("g", "pos", "n", "h", "id", "changed")
    trees = levels(leaves, fanout)
    subroots = materialise(tops(trees, fanout), "merkle-subroots")
    n_sources = subroots.count()
    ranked = dense_rank(subroots, [], "g", "pos", "merkle-sources")
    upper = levels(ranked.select(F.lit("").alias("g"), "pos", F.lit(n_sources).cast("long").alias("n"), "h", F.col("g").alias("tree")), fanout, "merkle-top")
    root = tops(upper, fanout).first()
    nothing = F.expr("cast(array() as array<struct<left:string,right:string>>)")
    start = docs.sparkSession.range(1).select(F.lit("").alias("g"), nothing.alias("path"))
    ends = paths(upper, start, fanout).select(F.col("child.tree").alias("g"), "path", F.col("child.h").alias("subroot"))
    found = paths(trees, materialise(ends, "merkle-ends"), fanout)
    return found.select(
        F.col("child.id").alias(key), F.col("child.h").alias("leaf"), "subroot", F.lit(root["h"] if root else None).cast("string").alias("root"),
        "path", F.col("child.changed").alias("changed"),
    )


def verify(found: DataFrame) -> DataFrame:
    """``manifest``'s rows with proof_sha256, folded_root (of the changed leaf where there is one) and verified."""
    folded = fold(F.coalesce("changed", "leaf"), F.col("path"))
    rows = found.withColumn("proof_sha256", proof_of(F.col("path"))).withColumn("folded_root", folded)
    return rows.withColumn("verified", F.col("folded_root") == F.col("root")).drop("path", "changed")


def tampering(text: str = "text", key: str = "doc_id", every: int = 5) -> Column:
    """The text, its A-Z lower-cased in rows whose id's crc32 ``every`` divides."""
    hit = F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % every == 0, F.lit(False))
    return F.when(hit, lower_ascii(F.col(text))).otherwise(F.col(text))
