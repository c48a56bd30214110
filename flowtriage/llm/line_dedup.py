"""Operator 10, line deduplication: explode normalised lines, hash, count the
documents of each hash, drop lines over the threshold, reassemble by position.

Rows of one id are one document, rows without an id another one.  Null text has one empty line, as empty text has; it stays
null when returned.  Lines whose key is shorter than ``min_chars`` are never
counted or dropped.  Identical rows get the same result.  Null ids, an empty table and extra columns are fine; with
``report``, input columns named ``n_lines`` or ``n_dropped`` are replaced.

Scale: only 16-byte hashes and positions are exploded.  Counting combines map
side (a line that is in every document reaches its reducer once per task).
Hashes that are in enough rows are written to the shared folder, so their join is a
broadcast exactly when their measured size allows it; otherwise AQE splits the
hot key of the line side.  Documents are told apart for the lines of these hashes
only, which are written as row key, position and hash.  The text moves once, in the join by row key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, free_names, hash128, materialise, row_key

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def line_key(line: Column) -> Column:
    """The line stripped of white space at both ends, A-Z lower-cased (ASCII only)."""
    bare = F.btrim(line, F.lit(SPACE))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, _UPPER, _UPPER.lower()))


def _hashed(line: Column, min_chars: int) -> Column:
    def of(key):
        return F.when(F.char_length(key) >= min_chars, F.struct(*[c.alias(n) for c, n in zip(hash128(key), ("h1", "h2"))]))

    # one-element transform binds the key once instead of computing it for each use
    return F.element_at(F.transform(F.array(line_key(line)), of), 1)


def _lines(text: str, min_chars: int) -> Column:
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: _hashed(x, min_chars))


def line_hits(docs: DataFrame, text: str, key: str, min_docs: int, min_chars: int) -> DataFrame:
    """(_k1, _k2, id, pos, h1, h2) of every line whose key is in at least ``min_docs`` rows."""
    own = docs.select(F.explode(F.array_distinct(_lines(text, min_chars))).alias("k")).where("k is not null")
    rows = own.groupBy("k.h1", "k.h2").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_docs)
    often = materialise(rows.select("h1", "h2"), "often-lines")
    lines = docs.select(*row_key(F.col(key), F.col(text)), F.col(key).alias("id"), F.posexplode(_lines(text, min_chars)).alias("pos", "k"))
    return lines.where("k is not null").select("_k1", "_k2", "id", "pos", "k.h1", "k.h2").join(often, ["h1", "h2"])


def frequent_lines(hits: DataFrame, min_docs: int) -> DataFrame:
    """(h1, h2) of every line key that is in at least ``min_docs`` distinct documents."""
    return hits.select("h1", "h2", "id").distinct().groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_docs).select("h1", "h2")


def dedup_lines(
    docs: DataFrame, text: str = "text", key: str = "doc_id", min_docs: int = 10, min_chars: int = 1, report: bool = True
) -> DataFrame:
    """``docs`` with the frequent lines taken out of ``text``, with ``report`` plus n_lines and n_dropped (long)."""
    if report:
        docs = free_names(docs, "n_lines", "n_dropped")
    keys = row_key(F.col(key), F.col(text))
    lines = materialise(line_hits(docs, text, key, min_docs, min_chars), "line-hits")
    frequent = materialise(frequent_lines(lines, min_docs), "frequent-lines")
    hits = lines.join(frequent, ["h1", "h2"]).groupBy("_k1", "_k2").agg(F.collect_set("pos").alias("_pos"))
    # the other columns travel in a struct, so that no name of theirs can clash
    rest = F.struct(*[c for c in docs.columns if c != text]).alias("_row")
    lines = docs.select(*keys, rest, F.col(text).isNull().alias("_null"), F.split(F.coalesce(text, F.lit("")), "\n", -1).alias("_lines"))
    joined = lines.join(hits, ["_k1", "_k2"], "left")
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_pos"))
    whole = F.when(~F.col("_null"), F.array_join("_lines", "\n"))
    kept = F.when(F.col("_pos").isNull(), whole).otherwise(F.array_join(F.transform(stay, lambda i: F.get("_lines", i)), "\n"))
    out = [kept.alias(text) if c == text else F.col("_row")[c].alias(c) for c in docs.columns]
    if report:
        out += [F.size("_lines").cast("long").alias("n_lines"), F.coalesce(F.size("_pos"), F.lit(0)).cast("long").alias("n_dropped")]
    return joined.select(*out)
