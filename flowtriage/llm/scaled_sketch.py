"""Operator 13, document fingerprints by threshold-scaled sketches.

A text's shingles are its runs of five words ``[^\\x20\\x09-\\x0D]+`` (one run
where it has one to four words).  Its sketch keeps every shingle hash below a
fixed fraction of the hash range, and its smallest hash if none is below, so
that short texts have one too.  The union of two sketches, cut in the same way,
is the sketch of both texts together (``merge``), whatever their sizes, and the
share of common hashes estimates resemblance and, for very unequal texts,
containment.

A fingerprint is the sorted sketch as text, ``DIGITS`` hexadecimal digits a
hash.  Null and empty texts, and texts without words, have the empty one; two
empty ones are alike (1), an empty and another are not (0).  Equal texts have
equal fingerprints, and so have texts that differ in white space alone.

``beside_next`` compares each text with an edited copy and with the next
document by id (null ids first, rows of one id by hash, then by their place;
after the last comes the first).  Rows are documents, equal or not; extra
columns are ignored; an empty table gives an empty result.

Scale: sketching is one pass without a shuffle.  ``beside_next`` moves each text
once, range-partitioned by id; a task streams its part holding one slice of
texts and its successor.  Only the first and last text of each part are written
to be paired with the neighbouring parts'.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bpe_trie import slices
from .common import free_names, materialise
from .order_minhash import Kmers

K_WORDS = 5
#: The share of all shingles that is kept.
FRACTION = 1 / 8
#: Hashes have 48 bits.
DIGITS = 12
_U = np.uint64
_FACTOR = _U(0x9E3779B97F4A7C15)
_SECOND = _U(0xBF58476D1CE4E5B9)


def _scatter(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _SECOND
    x = (x ^ (x >> _U(27))) * _FACTOR
    return x ^ (x >> _U(31))


class Sketcher:
    """Sketches of texts, a slice at once: sorted distinct hashes as arrays of unsigned 64-bit integers."""

    def __init__(self, fraction: float = FRACTION):
        self.limit = _U(int(fraction * (1 << (4 * DIGITS))))
        self.words = Kmers().words

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        word, owner = self.words(texts)
        n_words = np.bincount(owner, minlength=len(texts))
        place = np.arange(len(word)) - (np.cumsum(n_words) - n_words)[owner]
        size = n_words[owner]
        run = np.zeros(len(word), dtype=np.uint64)
        for k in range(K_WORDS):
            at = np.minimum(np.arange(len(word)) + k, max(0, len(word) - 1))
            run = _scatter(run + _FACTOR) + np.where(place + k < size, word[at], _U(0))
        whole = (place + K_WORDS <= size) | (place == 0)
        hashes, of = _scatter(run[whole]) >> _U(64 - 4 * DIGITS), owner[whole]
        keep = hashes < self.limit
        if len(hashes):
            # the smallest one stays in any case
            cuts = np.flatnonzero(np.diff(of, prepend=-1))
            least = np.zeros(len(texts), dtype=np.uint64)
            least[of[cuts]] = np.minimum.reduceat(hashes, cuts)
            keep |= hashes == least[of]
        hashes, of = hashes[keep], of[keep]
        order = np.lexsort((hashes, of))
        hashes, of = hashes[order], of[order]
        new = np.ones(len(hashes), dtype=bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
        hashes, of = hashes[new], of[new]
        return np.split(hashes, np.searchsorted(of, np.arange(1, len(texts)))) if texts else []


def written(sketch: np.ndarray) -> str:
    return "".join([f"{x:0{DIGITS}x}" for x in sketch.tolist()])


def _both(a: np.ndarray, b: np.ndarray) -> int:
    return len(np.intersect1d(a, b, assume_unique=True))


def likeness(a: np.ndarray, b: np.ndarray) -> tuple[float, float]:
    """(resemblance, share of ``a`` that is in ``b``)."""
    if not len(a) or not len(b):
        same = float(len(a) == len(b))
        return same, same
    n = _both(a, b)
    return n / (len(a) + len(b) - n), n / len(a)


# --- on fingerprints in tables, with native functions ---------------------------------------


def hashes(fingerprint: Column) -> Column:
    """The hashes of a fingerprint as an array of strings."""
    return F.regexp_extract_all(F.coalesce(fingerprint, F.lit("")), F.lit(f"[0-9a-f]{{{DIGITS}}}"), F.lit(0))


def merge(a: Column, b: Column, fraction: float = FRACTION) -> Column:
    """The fingerprint of two texts' shingles together."""
    limit = f"{int(fraction * (1 << (4 * DIGITS))):0{DIGITS}x}"
    union = F.array_sort(F.array_union(hashes(a), hashes(b)))
    return F.array_join(F.filter(union, lambda x, i: (x < limit) | (i == 0)), "")


def resemblance(a: Column, b: Column) -> Column:
    x, y = hashes(a), hashes(b)
    n = F.size(F.array_intersect(x, y))
    total = F.size(x) + F.size(y) - n
    return F.when(total == 0, F.lit(1.0)).otherwise(n / total)


def containment(a: Column, b: Column) -> Column:
    """The estimated share of ``a``'s shingles that ``b`` has."""
    x, y = hashes(a), hashes(b)
    n = F.size(F.array_intersect(x, y))
    return F.when(F.size(x) == 0, (F.size(y) == 0).cast("double")).otherwise(n / F.size(x))


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fingerprint", fraction: float = FRACTION) -> DataFrame:
    """``docs`` with ``out``."""

    @F.pandas_udf("string")
    def sketch(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = Sketcher(fraction)
        for batch in batches:
            for texts in slices(batch):
                yield pd.Series([written(s) for s in of(texts)], dtype=object)

    return free_names(docs, out).withColumn(out, sketch(F.col(text)))


# --- each document beside an edited copy and the next one -----------------------------------


def edited(text: str, following: str) -> str:
    """The text, its last quarter replaced by as much of the beginning of the one that follows."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


#: The two sketches are written as what they share and what each has alone, six bytes a hash.
_MEASURED = "n_chars long, edited_sha256 binary, shared binary, gone binary, came binary, near_edited double, near_next double, kept_in_edited double, kept_in_next double"


def packed(sketch: np.ndarray) -> bytes:
    return sketch.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - DIGITS // 2 :].tobytes()


def _unpacked(*parts: str) -> Column:
    """The fingerprint of the hashes in several packed columns."""
    return F.array_join(F.array_sort(F.concat(*[hashes(F.lower(F.hex(p))) for p in parts])), "")


def measure(sketch: Sketcher, texts: list[str], following: list[str]) -> pd.DataFrame:
    """The columns of ``_MEASURED`` for texts and those that follow them."""
    changed = [edited(a, b) for a, b in zip(texts, following)]
    own = sketch(texts)
    # mostly the next one's own sketch
    again = [i for i in range(len(texts)) if i + 1 == len(texts) or following[i] is not texts[i + 1]]
    extra = dict(zip(again, sketch([following[i] for i in again])))
    after = [extra[i] if i in extra else own[i + 1] for i in range(len(texts))]
    other = sketch(changed)
    to_edited = [likeness(a, b) for a, b in zip(own, other)]
    to_next = [likeness(a, b) for a, b in zip(own, after)]
    return pd.DataFrame(
        {
            "n_chars": [len(t) for t in texts],
            "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).digest() for t in changed],
            "shared": [packed(np.intersect1d(a, b, assume_unique=True)) for a, b in zip(own, other)],
            "gone": [packed(np.setdiff1d(a, b, assume_unique=True)) for a, b in zip(own, other)],
            "came": [packed(np.setdiff1d(b, a, assume_unique=True)) for a, b in zip(own, other)],
            "near_edited": [x[0] for x in to_edited],
            "near_next": [x[0] for x in to_next],
            "kept_in_edited": [x[1] for x in to_edited],
            "kept_in_next": [x[1] for x in to_next],
        }
    )


def _followed(rows: Iterable[tuple]) -> Iterator[tuple[list[tuple], tuple]]:
    """Slices of (id, text) with the row after each slice; the last row follows nobody's slice and stays out."""
    held, size = [], 0
    for row in rows:
        if held and size > 500_000:
            yield held, row
            held, size = [], 0
        held.append(row)
        size += len(row[1])
    if len(held) > 1:
        yield held[:-1], held[-1]


def beside_next(docs: DataFrame, key: str = "doc_id", text: str = "text", fraction: float = FRACTION) -> DataFrame:
    """(<key>, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, kept_in_edited, kept_in_next)."""
    rows = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    # the place in the input spreads equal rows over several parts
    rows = rows.withColumn("h", F.xxhash64("t")).withColumn("i", F.monotonically_increasing_id())
    parts = rows.repartitionByRange("id", "h", "i").sortWithinPartitions("id", "h", "i")
    # ids travel as text, since pandas has no whole numbers beside nulls
    parts = parts.select(F.spark_partition_id().alias("p"), F.col("id").cast("string").alias("id"), "t")

    def pair(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sketch = Sketcher(fraction)
        edge = {"p": None, "first": None, "last": None}

        def rows_of():
            for batch in batches:
                for p, i, t in zip(batch["p"].tolist(), batch["id"], batch["t"]):
                    if edge["p"] is None:
                        edge.update(p=p, first=t)
                    edge["last"] = (i, t)
                    yield i, t

        for held, after in _followed(rows_of()):
            texts = [t for _, t in held]
            got = measure(sketch, texts, [*texts[1:], after[1]])
            got.insert(0, "id", pd.Series([i for i, _ in held], dtype=object))
            blank = pd.Series([None] * len(got), dtype=object)
            yield got.assign(p=-1, head=blank, tail=blank)
        if edge["p"] is not None:
            i, t = edge["last"]
            got = measure(sketch, [""], [""])  # only its shape
            got.insert(0, "id", pd.Series([i], dtype=object))
            yield got.assign(p=edge["p"], head=edge["first"], tail=t)

    shape = f"id string, {_MEASURED}, p int, head string, tail string"
    done = materialise(parts.mapInPandas(pair, shape), "sketch-pairs")
    # a row per part that has rows: its last text goes before the first one of the next part
    ends = done.where("p >= 0").select("p", "id", "head", "tail")
    order = Window.orderBy("p")
    firsts = ends.select("p", F.lead("p").over(order).alias("to"), F.first("p").over(order).alias("one"))  # numbers of parts only
    turn = firsts.select("p", F.coalesce("to", "one").alias("to"))
    seams = ends.select("p", "id", "tail").join(turn, "p").join(ends.select(F.col("p").alias("to"), "head"), "to")

    def close(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sketch = Sketcher(fraction)
        for batch in batches:
            for i, t, after in zip(batch["id"], batch["tail"], batch["head"]):
                got = measure(sketch, [t], [after])
                got.insert(0, "id", pd.Series([i], dtype=object))
                yield got

    closed = seams.select("id", "tail", "head").mapInPandas(close, f"id string, {_MEASURED}")
    kept = done.where("p < 0").select(closed.columns).unionByName(closed)
    return kept.select(
        F.col("id").cast("long").alias(key), "n_chars", F.lower(F.hex("edited_sha256")).alias("edited_sha256"), _unpacked("shared", "gone").alias("fingerprint"),
        _unpacked("shared", "came").alias("edited_fingerprint"), "near_edited", "near_next", "kept_in_edited", "kept_in_next",
    )
