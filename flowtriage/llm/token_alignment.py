r"""Operator 11, alignment of two tokenizers with a fast path for equal tokens.

A is a byte-level BPE of the tokenizers library, B a sentencepiece model, which
puts a space in front.  Both encode space + text, their special tokens' strings
being plain text.  Byte offsets at which a token of both ends cut the two
sequences into groups; a link is a pair of an A and a B occurrence in one group.
The count of an id pair is the number of documents that hold it linked.

Identity map: for every A id the B id of the same bytes, computed once from the
vocabularies.  A group of one token each always has such a pair, so its count
depends on the A id alone: those counts are vectors of the vocabulary's length,
summed per task.  Only the pairs of irregular groups (that aren't in the map)
are shuffled, after a partial count per task.

Texts that are null or empty, or whose joined tokens of A or B differ from
space + text (a sign that B normalises, U+2581 in the text), have no tokens:
zeros and ''.  Each row is a document, equal or not; null ids are fine; input
columns named as the results are replaced; an empty table gives an empty result.

Parts between a space and the next one that follows no white space are encoded
on their own: no token of either vocabulary reaches over such a border (checked
for B's pieces when the model is loaded), so the result is that of the whole
text.  Each task encodes a part once and keeps ``CACHE_PARTS`` of them.

Scale: texts are encoded once; what is written per document is its distinct
pairs.  Pair counts come back to the documents through a join that is a
broadcast only up to ``max_broadcast`` pairs (checked), beyond that a shuffled
one; vectors have the vocabulary's length.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe_trie import load_vocab, slices
from .common import free_names, materialise

CACHE_PARTS = 400_000
#: Parts that the A library encodes as one string.
JOINED = 4000
MAX_BROADCAST = 1_000_000
#: A space that isn't a border: at the start or behind white space.
ODD = re.compile("^ |[\\s᠎] ")
BORDER = re.compile("(?<=[^\\s᠎]) ")
RESULTS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


class Vocabularies:
    """Both tokenizers from the contents of their files."""

    def __init__(self, a_json: str, a_tokens: list[bytes], b_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.a.no_padding()
        self.a.no_truncation()
        self.b = SentencePieceProcessor(model_proto=b_model)
        self.a_bytes = a_tokens
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.splits = not any(re.search("[^▁]▁", p) for p in pieces)
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.size_a = np.array([len(t) for t in self.a_bytes])
        self.size_b = np.array([len(t) for t in self.b_bytes])
        self.n_b = len(self.b_bytes)
        # plain pieces last, so that they win over byte pieces
        known = {t: i for i, t in sorted(enumerate(self.b_bytes), key=lambda x: not self.b.is_byte(x[0])) if self.b.is_byte(i)}
        known |= {t: i for i, t in enumerate(self.b_bytes) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))}
        #: A id to the B id of the same bytes, -1 where there is none.
        self.same = np.array([known.get(t, -1) for t in self.a_bytes])
        # every id as text with what may follow it: within its side of a group, at the side's end
        ids = [(x, range(n)) for n, ends in ((len(self.a_bytes), ",|"), (self.n_b, ",;")) for x in ends]
        self.said = np.array([f"{i}{x}" for x, numbers in ids for i in numbers], dtype=object)

    def encode_a(self, parts: list[str]) -> list[int]:
        """Ids of all parts, each with a space in front, one after the other; a part that ends in white space is on its own."""
        runs, at = [], 0
        for i, p in enumerate(parts):
            if p[-1:].isspace() or not p or i + 1 == len(parts) or i + 1 - at == JOINED:
                if p and not p[-1:].isspace():
                    runs.append(" " + " ".join(parts[at : i + 1]))
                else:
                    runs += [" " + " ".join(parts[at:i])] if i > at else []
                    runs.append(" " + p)
                at = i + 1
        return list(chain.from_iterable(e.ids for e in self.a.encode_batch_fast(runs, add_special_tokens=False)))


def parts_of(text: str) -> list[str]:
    """The text's independent parts without the space in front of each."""
    parts = BORDER.split(text) if ODD.search(text) else text.split(" ")
    if len(parts) > 1 and not parts[-1]:
        parts.pop()
        parts[-1] += " "  # a last space stays with what it follows
    return parts


class Aligner:
    """Groups, links and pairs of texts; caches those of parts."""

    def __init__(self, vocabularies: Vocabularies):
        self.v = vocabularies
        self.place: dict[str, int] = {}
        self.names: list[str] = []
        self.facts = np.zeros((1024, 5), dtype=np.int64)  # n_a, n_b, n_groups, n_links, 1 if bytes differ
        self.codes = np.zeros(4096, dtype=np.int64)
        self.begin = np.zeros(1025, dtype=np.int64)
        self.hits = np.zeros(1024, dtype=np.int64)

    def _forget(self) -> None:
        """Keep the quarter of the cache that was met most often."""
        n = len(self.place)
        stay = np.sort(np.argsort(-self.hits[:n], kind="stable")[: CACHE_PARTS // 4])
        parts = list(self.place)
        self.place = {parts[i]: k for k, i in enumerate(stay.tolist())}
        self.names = [self.names[i] for i in stay.tolist()]
        many = self.begin[stay + 1] - self.begin[stay]
        ends = np.cumsum(many)
        self.codes = self.codes[np.repeat(self.begin[stay] - ends + many, many) + np.arange(many.sum())]
        self.facts, self.hits = self.facts[stay], self.hits[stay] // 2
        self.begin = np.append(0, ends)
        self._room(1, 1)

    def _room(self, parts: int, codes: int) -> None:
        more = max(parts - len(self.facts), 0)
        if more:
            more = max(more, len(self.facts))
            self.facts = np.concatenate([self.facts, np.zeros((more, 5), dtype=np.int64)])
            self.begin = np.concatenate([self.begin, np.zeros(more, dtype=np.int64)])
            self.hits = np.concatenate([self.hits, np.zeros(more, dtype=np.int64)])
        if len(self.codes) < codes:
            self.codes = np.concatenate([self.codes, np.zeros(max(codes - len(self.codes), len(self.codes)), dtype=np.int64)])

    def learn(self, parts: set[str]) -> None:
        new = parts.difference(self.place)
        if len(self.place) + len(new) > CACHE_PARTS:
            self._forget()
            new = parts.difference(self.place)
        new = list(new)
        if not new:
            return
        v, n = self.v, len(new)
        raw = [(" " + p).encode("utf-8", "surrogatepass") for p in new]
        ends = np.cumsum([len(r) for r in raw])
        a = np.array(v.encode_a(new), dtype=np.int64)
        found = v.b.encode(new, num_threads=1)
        get = v.b_bytes.__getitem__
        sizes = np.fromiter(map(len, found), np.int64, n)
        b = np.fromiter(chain.from_iterable(found), np.int64, sizes.sum())
        b_of = np.repeat(np.arange(n), sizes)
        differ = np.bincount(b_of, weights=v.size_b[b], minlength=n) != np.diff(ends, prepend=0)
        if differ.any() or b"".join(map(get, b.tolist())) != b"".join(raw):
            differ = np.fromiter((b"".join(map(get, ids)) != r for ids, r in zip(found, raw)), bool, n)
        a_end = np.cumsum(v.size_a[a])
        if a_end[-1] != ends[-1]:
            raise ValueError("the byte-level vocabulary doesn't give the text's bytes")
        a_of = np.searchsorted(ends, a_end)  # part of each token
        a, a_of = a[~differ[a_of]], a_of[~differ[a_of]]
        b, sizes = b[~differ[b_of]], sizes * ~differ
        a_end, b_end = np.cumsum(v.size_a[a]), np.cumsum(v.size_b[b])
        cuts = np.intersect1d(a_end, b_end, assume_unique=True)
        a_group, b_group = np.searchsorted(cuts, a_end), np.searchsorted(cuts, b_end)
        p, q = np.bincount(a_group, minlength=len(cuts)), np.bincount(b_group, minlength=len(cuts))
        a_last = np.cumsum(p)
        g_of = a_of[a_last - 1] if len(cuts) else np.zeros(0, dtype=np.int64)
        # every A token of a group with every B token of it
        times = q[a_group]
        left = np.repeat(a, times)
        first = np.cumsum(times) - times
        right = b[np.repeat((np.cumsum(q) - q)[a_group], times) + np.arange(len(left)) - np.repeat(first, times)]
        per = np.bincount(np.repeat(a_of, times), minlength=n)
        at, have = len(self.place), int(self.begin[len(self.place)])
        self._room(at + n + 1, have + len(left))
        self.codes[have : have + len(left)] = left * v.n_b + right
        self.begin[at + 1 : at + n + 1] = have + np.cumsum(per)
        self.facts[at : at + n] = np.column_stack(
            [np.bincount(a_of, minlength=n), sizes, np.bincount(g_of, minlength=n), per, differ]
        )
        # the contract's notation: the tokens of a group's sides one after the other, each with the sign that follows it
        where = np.empty(len(a) + len(b), dtype=np.int64)
        a_at = np.arange(len(a)) + (np.cumsum(q) - q)[a_group]
        b_at = np.arange(len(b)) + a_last[b_group]
        n_a = len(v.a_bytes)
        where[a_at] = a + n_a * (np.arange(len(a)) == a_last[a_group] - 1)
        where[b_at] = 2 * n_a + b + v.n_b * (np.arange(len(b)) == np.cumsum(q)[b_group] - 1)
        said = v.said[where].tolist()
        ends = np.cumsum(np.bincount(a_of, minlength=n) + sizes).tolist()
        self.names += ["".join(said[i:j]) for i, j in zip([0, *ends], ends)]
        self.place.update(zip(new, range(at, at + n)))

    def __call__(self, texts: list[str]) -> pd.DataFrame:
        parts = [(parts_of(t) if self.v.splits else [t]) if t else [] for t in texts]
        self.learn({p for ps in parts for p in ps})
        get = self.place.__getitem__
        flat = np.fromiter(map(get, chain.from_iterable(parts)), np.int64)
        self.hits[: len(self.place)] += np.bincount(flat, minlength=len(self.place))
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        owner = np.repeat(np.arange(len(texts)), sizes)
        sums = np.zeros((len(texts), 5), dtype=np.int64)
        for c in range(5):
            sums[:, c] = np.bincount(owner, weights=self.facts[flat, c], minlength=len(texts))
        empty = (sums[:, 4] > 0) | (sizes == 0)
        sums[empty] = 0
        found, ends = flat.tolist(), np.cumsum(sizes).tolist()
        flat, owner = flat[~empty[owner]], owner[~empty[owner]]
        many = self.begin[flat + 1] - self.begin[flat]
        first = np.cumsum(many) - many
        codes = self.codes[np.repeat(self.begin[flat] - first, many) + np.arange(many.sum())]
        span = len(self.v.a_bytes) * self.v.n_b
        keys, times = np.unique(np.repeat(owner, many) * span + codes, return_counts=True)
        of, code = keys // span, keys % span
        a = code // self.v.n_b
        same = self.v.same[a] == code % self.v.n_b
        said = self.names.__getitem__
        digests = ["" if none else hashlib.sha256("".join(map(said, found[i:j]))[:-1].encode()).hexdigest() for none, i, j in zip(empty, [0, *ends], ends)]
        cut = lambda values, chosen: np.split(values[chosen], np.searchsorted(of[chosen], np.arange(1, len(texts))))
        made = {"n_a": sums[:, 0], "n_b": sums[:, 1], "n_groups": sums[:, 2], "n_links": sums[:, 3], "groups_sha256": digests}
        made |= {"same": cut(a, same), "same_n": cut(times, same), "odd": cut(code, ~same), "odd_n": cut(times, ~same)}
        return pd.DataFrame(made)


def _shared(spark, a_path: str, b_path: str):
    """The contents of both files, broadcast (their sizes are fixed): executors need no files."""
    with open(a_path, encoding="utf-8") as f:
        a_json = f.read()
    with open(b_path, "rb") as f:
        b_model = f.read()
    return spark.sparkContext.broadcast((a_json, load_vocab(a_path)["tokens"], b_model))


@lru_cache(maxsize=1)
def _loaded(shared) -> Vocabularies:
    return Vocabularies(*shared.value)


def coded(docs: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with row (a number), n_a, n_b, n_groups, n_links, groups_sha256 and the distinct pairs: ``same``
    (A ids of the identity map) and ``odd`` (A id * size of B + B id), each with its number of links; written."""
    shared = _shared(docs.sparkSession, a_path, b_path)
    many = len(shared.value[1]) * Vocabularies(*shared.value).n_b
    kind = "int" if many < 1 << 31 else "long"
    shape = f"n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, same array<int>, same_n array<int>, odd array<{kind}>, odd_n array<int>"

    @F.pandas_udf(shape)
    def align(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        aligner = Aligner(_loaded(shared))
        for batch in batches:
            for texts in slices(batch, 500_000):
                yield aligner(texts)

    docs = free_names(docs, "row", "_got", "same", "same_n", "odd", "odd_n", *RESULTS)
    rows = docs.withColumn("_got", align(F.col(text))).drop(text)
    return materialise(rows.select(F.monotonically_increasing_id().alias("row"), *rows.drop("_got").columns, "_got.*"), "aligned")


def same_counts(rows: DataFrame, n_a: int) -> DataFrame:
    """(a, n): documents that hold each pair of the identity map, from vectors of the vocabulary's length per task."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(n_a, dtype=np.int64)
        for batch in batches:
            for ids in np.array_split(np.arange(len(batch)), max(1, len(batch) // 500)):
                own = [x for x in batch["same"].iloc[ids] if len(x)]
                if own:
                    total += np.bincount(np.concatenate(own), minlength=n_a)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"a": at, "n": total[at]})

    return rows.select("same").mapInPandas(count, "a long, n long").groupBy("a").agg(F.sum("n").alias("n"))


def odd_counts(rows: DataFrame) -> DataFrame:
    """(code, n): documents that hold each other pair."""
    return rows.select(F.explode("odd").alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("n"))


def align(docs: DataFrame, a_path: str, b_path: str, text: str = "text", max_broadcast: int = MAX_BROADCAST) -> tuple[DataFrame, DataFrame]:
    """(``docs`` without ``text`` and with ``RESULTS``, the alignment table (a, b, n, best) of all pairs)."""
    spark = docs.sparkSession
    rows = coded(docs, a_path, b_path, text)
    v = Vocabularies(*_shared(spark, a_path, b_path).value)
    n_a, n_b = len(v.a_bytes), v.n_b
    same = same_counts(rows, n_a).toPandas()  # at most the vocabulary's length
    vector = np.zeros(n_a, dtype=np.int64)
    vector[same["a"]] = same["n"]
    odd = odd_counts(rows).withColumn("a", F.floor(F.col("code") / n_b).cast("long"))
    odd = materialise(odd, "alignment-pairs")
    most = odd.groupBy("a").agg(F.max("n").alias("most")).toPandas()  # at most the vocabulary's length
    best = vector.copy()
    best[most["a"]] = np.maximum(best[most["a"]], most["most"])
    highest = spark.createDataFrame(pd.DataFrame({"a": np.flatnonzero(best), "most": best[best > 0]}), "a long, most long")
    pairs = odd.join(F.broadcast(highest), "a").select("code", "n", "a", (F.col("n") == F.col("most")).alias("best"))
    vectors = spark.sparkContext.broadcast((vector, vector == best))

    @F.pandas_udf("n_best long, count_sum long")
    def of_same(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        n, top = vectors.value
        for ids, times in batches:
            got = [(int(t[top[i]].sum()), int((t * n[i]).sum())) for i, t in zip(ids, times)]
            yield pd.DataFrame(got, columns=["n_best", "count_sum"])

    few = odd.count() <= max_broadcast
    links = rows.select("row", F.explode(F.arrays_zip("odd", "odd_n")).alias("x")).select("row", F.col("x.odd").alias("code"), F.col("x.odd_n").alias("times"))
    links = links.join(F.broadcast(pairs) if few else pairs, "code").groupBy("row")
    links = links.agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("odd_best"), F.sum(F.col("times") * F.col("n")).alias("odd_sum"))
    fast = rows.drop("odd", "odd_n").withColumn("_same", of_same("same", "same_n"))
    rest = [c for c in rows.columns if c not in ("row", "same", "same_n", "odd", "odd_n", *RESULTS)]
    total = lambda x, y: (F.col(f"_same.{x}") + F.coalesce(y, F.lit(0))).cast("long").alias(x)
    made = {"n_best": total("n_best", "odd_best"), "count_sum": total("count_sum", "odd_sum")}
    out = fast.join(links, "row", "left").select(*rest, *[made.get(c, F.col(c)) for c in RESULTS])
    twins = spark.createDataFrame(pd.DataFrame({"a": same["a"], "b": v.same[same["a"]], "n": same["n"], "best": (vector == best)[same["a"]]}), "a long, b long, n long, best boolean")
    table = pairs.select("a", (F.col("code") % n_b).cast("long").alias("b"), "n", "best").unionByName(twins)
    return out, table
