"""Operator 5, language identification: multinomial naive Bayes over hashed
character n-grams.

Training counts the n-grams of every training text (partial counts per task
and language, summed in Spark).  The smoothed log-probability matrix, buckets
times languages, is bounded by ``dims`` and the number of languages and is
broadcast; scoring gathers its rows for the n-grams of a batch and sums them
per text.

The prediction uses the text alone.  Null texts and texts without a letter get
``und`` with score 0; ties go to the language that sorts first; the score is
the posterior of the prediction.  Training rows with null text or null language
take no part; without any training row every prediction is ``und``.  Repeated
rows count repeatedly.  Result columns replace clashing input columns.

Scale: two passes over the texts, no shuffle but of the partial counts, at most
dims x languages rows per task.  Texts are worked off in slices of
``SLICE_CHARS`` characters; memory doesn't depend on a text's length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_names

ORDERS = (1, 2, 3)
DIMS = 1 << 16
ALPHA = 0.5
SLICE_CHARS = 400_000
UNKNOWN = "und"


def held_out(key: Column) -> Column:
    """Rows that no model may learn from: crc32 of the key as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def runs(texts, limit: int = SLICE_CHARS):
    """(first row, last row + 1, lower-case texts joined by line feeds) in slices; a long text is cut into overlapping parts."""
    at, rows, size = 0, [], 0
    for i, t in enumerate(texts):
        t = "" if t is None else t.lower()
        if rows and size + len(t) > limit:
            yield at, rows
            at, rows, size = i, [], 0
        if len(t) > limit:
            step = limit
            for k in range(0, len(t), step):
                yield i, [t[max(0, k - max(ORDERS) + 1) : k + step]] if k else [t[:step]]
            at, rows, size = i + 1, [], 0
            continue
        rows.append(t)
        size += len(t)
    if rows:
        yield at, rows


def grams(rows: list[str], orders=ORDERS, dims: int = DIMS):
    """For each order: (bucket of the n-gram at each position, row of each position), n-grams across rows left out."""
    codes = np.frombuffer("\n".join(rows).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    lengths = np.fromiter(map(len, rows), np.int64, len(rows))
    owner = np.repeat(np.arange(len(rows)), lengths + 1)[: len(codes)]
    ends = np.cumsum(lengths + 1) - 1
    left = np.repeat(ends, lengths + 1)[: len(codes)] - np.arange(len(codes))  # characters up to the row's end
    key = np.zeros(len(codes), dtype=np.uint32)
    for n in range(1, max(orders) + 1):
        if len(codes) < n:
            return
        key = key[: len(codes) - n + 1] * np.uint32(0x9E3779B1) + codes[n - 1 :] + np.uint32(n)
        if n in orders:
            good = left[: len(key)] >= n
            mixed = key ^ (key >> np.uint32(15))
            mixed = mixed * np.uint32(0x85EBCA6B)
            yield n, ((mixed >> np.uint32(16)) % np.uint32(dims))[good], owner[: len(key)][good]


def _counts_of(texts, dims: int) -> np.ndarray:
    total = np.zeros(dims, dtype=np.int64)
    for _, rows in runs(texts):
        for _, bucket, _ in grams(rows, dims=dims):
            total += np.bincount(bucket, minlength=dims)
    return total


def train(docs: DataFrame, text: str = "text", lang: str = "lang", key: str | None = "doc_id", dims: int = DIMS, alpha: float = ALPHA):
    """(languages, float32 matrix of log priors + one row per bucket) from all rows that aren't held out."""
    rows = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull())
    if key is not None:
        rows = rows.where(~held_out(F.col(key)))
    rows = rows.select(F.col(lang).alias("lang"), F.col(text).alias("text"))

    def partial(batches):
        counts: dict[str, np.ndarray] = {}
        n_rows: dict[str, int] = {}
        for batch in batches:
            for name, part in batch.groupby("lang"):
                got = _counts_of(part["text"], dims)
                counts[name] = counts[name] + got if name in counts else got
                n_rows[name] = n_rows.get(name, 0) + len(part)
        for name, c in counts.items():
            at = np.flatnonzero(c)
            yield pd.DataFrame({"lang": name, "bucket": np.append(at, -1), "n": np.append(c[at], n_rows[name])})

    parts = rows.mapInPandas(partial, "lang string, bucket long, n long")
    sums = parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(sums["lang"].unique())
    prior = np.zeros(len(langs))
    table = np.zeros((dims, len(langs)))
    for j, name in enumerate(langs):
        own = sums[sums["lang"] == name]
        is_prior = own["bucket"].to_numpy() < 0
        prior[j] = own["n"].to_numpy()[is_prior].sum()
        table[own["bucket"].to_numpy()[~is_prior], j] = own["n"].to_numpy()[~is_prior]
    if langs:
        prior = np.log(prior / prior.sum())
        table = np.log((table + alpha) / (table.sum(0) + alpha * dims))
    return langs, prior, table.astype(np.float32)


def predict(docs: DataFrame, model, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score."""
    langs, prior, _ = model
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names, first, table = shared.value
        for batch in batches:
            texts = list(batch)
            sums = np.tile(np.asarray(first, dtype=np.float64), (len(texts), 1))
            for at, rows in runs(texts):
                for _, bucket, owner in grams(rows, dims=len(table)):
                    if len(owner):
                        cuts = np.flatnonzero(np.diff(owner, prepend=-1))
                        sums[at + owner[cuts]] += np.add.reduceat(table[bucket], cuts, axis=0, dtype=np.float64)
            yield decide(texts, names, sums)

    got = label(F.col(text))
    docs = free_names(docs, "lang_pred", "score", "_got")
    return docs.withColumn("_got", got).select(*docs.columns, "_got.lang_pred", "_got.score")


def decide(texts, names, sums) -> pd.DataFrame:
    lettered = np.array([t is not None and any(map(str.isalpha, t)) for t in texts], dtype=bool)
    if not names or not len(texts):
        return pd.DataFrame({"lang_pred": [UNKNOWN] * len(texts), "score": np.zeros(len(texts))})
    best = sums.argmax(1)
    score = 1 / np.exp(sums - sums.max(1, keepdims=True)).sum(1)
    name = np.array(names, dtype=object)[best]
    return pd.DataFrame({"lang_pred": np.where(lettered, name, UNKNOWN), "score": np.where(lettered, score, 0.0)})
