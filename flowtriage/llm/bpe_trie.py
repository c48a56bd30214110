"""Operator 9, byte-level BPE by a prefix-sharing trie.

The distinct words of a batch, in byte order, are the trie's leaves in
depth-first order: the traversal keeps one state per depth of the current path
and goes back to the common prefix with the next word, so the encoding of a
shared prefix is computed once.  The state of a prefix is the last token of its
encoding.  A prefix ends in token t exactly if the pair (last token of what
precedes t, t) is stable, i.e. encoding both together gives the same two
tokens; the word's ids are read by following the states back.

Encoding equals the vocabulary's own merge order, with added tokens cut out of
the text first; decoding joins the bytes of the ids.  Null text encodes as
empty (no ids).  Rows are independent: null ids, repeated rows, extra columns
and empty tables need no care; result columns replace clashing input columns.

Scale: no shuffle.  The vocabulary (its size is fixed) is broadcast once, so
executors need no file.  Each task caches encodings of space-separated pieces
up to ``CACHE_PIECES`` entries and then starts anew; batches are worked off in
slices of ``SLICE_CHARS`` characters.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_names

#: Fixed value: the pre-tokenizer's pattern, its white space being Unicode's White_Space.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
CACHE_PIECES = 200_000
SLICE_CHARS = 1_000_000
SPACES = re.compile(r" \s|\s ")


def byte_symbols() -> dict[str, int]:
    """The printable symbol of every byte: Latin-1's visible characters stand for themselves, the rest follow from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def load_vocab(path: str) -> dict:
    """The parts of a tokenizers JSON file that encoding needs, as plain lists (to be broadcast)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    symbols = byte_symbols()
    vocab = spec["model"]["vocab"]
    tokens: list[bytes] = [b""] * (1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]))
    for word, i in vocab.items():
        tokens[i] = bytes(symbols[c] for c in word)
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    for word, i in added.items():
        tokens[i] = word.encode()
    merges = []
    for m in spec["model"]["merges"]:
        left, right = m.split(" ") if isinstance(m, str) else m
        merges.append((vocab[left], vocab[right], vocab[left + right]))
    return {"tokens": tokens, "merges": merges, "added": added}


class TrieEncoder:
    """Encodes sets of words; see the module's text."""

    def __init__(self, vocab: dict):
        self.tokens = vocab["tokens"]
        self.added = vocab["added"]
        self.rank: dict[tuple[int, int], int] = {}
        self.made = [(-1, -1, -1)] * len(self.tokens)  # (rank, left, right); -1: a single byte
        for r, (left, right, whole) in enumerate(vocab["merges"]):
            if self.rank.setdefault((left, right), r) == r and self.made[whole][0] < 0:
                self.made[whole] = (r, left, right)
        added = set(self.added.values())
        self.id_of = {t: i for i, t in enumerate(self.tokens) if t and i not in added and (len(t) == 1 or self.made[i][0] >= 0)}
        self.size = [len(t) for t in self.tokens]
        self.longest = [1] * 256
        for t in self.id_of:
            self.longest[t[-1]] = max(self.longest[t[-1]], len(t))
        self.stable = lru_cache(maxsize=120_000)(self._stable)
        self.whole = lru_cache(maxsize=50_000)(self._whole)

    def _whole(self, token: int) -> bool:
        """Whether the token's bytes encode to the token alone."""
        _, left, right = self.made[token]
        return left < 0 or (self.whole(left) and self.whole(right) and self._stable(left, right, self.made[token][0]))

    def _stable(self, a: int, b: int, before: int = 1 << 30) -> bool:
        """Whether no merge across the border of a and b comes first (``before``: only merges of lower rank count).

        Going back in time from (a, b), the token formed last is undone; a merge
        of the two tokens at the border would have fired if it precedes the
        merges that used them up.  Of equal ranks, the one further left goes first.
        """
        made, rank = self.made, self.rank
        end_a = end_b = before
        while True:
            r = rank.get((a, b))
            if r is not None and r < end_a and (r <= end_b if end_b < before else r < end_b):
                return False
            ra, rb = made[a][0], made[b][0]
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                end_a, a = ra, made[a][2]
            else:
                end_b, b = rb, made[b][1]

    def encode_words(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of each word as little-endian unsigned 32-bit integers."""
        out = {}
        get, longest, stable, size = self.id_of.get, self.longest, self.stable, self.size
        path: list[int] = [-1]  # state by depth
        prior = b""
        for word in sorted(words):
            n, same = min(len(word), len(prior)), 0
            while same < n and word[same] == prior[same]:
                same += 1
            del path[same + 1 :]
            for end in range(same + 1, len(word) + 1):
                # exactly one token can end here, so the likely ones are tried first: the last token
                # grown by a byte, the byte alone, two bytes
                long = end - 1
                t = path[long]
                if t >= 0:
                    grown = long - size[t]
                    t = get(word[grown:end])
                    if t is not None and (stable(path[grown], t) if grown else self.whole(t)):
                        path.append(t)
                        continue
                    t = get(word[long:end])
                    if stable(path[long], t):
                        path.append(t)
                        continue
                    t = get(word[long - 1 : end])
                    if t is not None and long > 1 and stable(path[long - 1], t):
                        path.append(t)
                        continue
                for start in range(max(0, end - longest[word[long]]), end):
                    t = get(word[start:end])
                    if t is not None and (stable(path[start], t) if start else self.whole(t)):
                        path.append(t)
                        break
                else:
                    raise ValueError(f"no token ends {word[:end]!r}")
            prior = word
            ids, at = [], len(word)
            while at:
                t = path[at]
                ids.append(t)
                at -= size[t]
            ids.reverse()
            out[word] = array("I", ids).tobytes()
        return out


class TextEncoder:
    """Texts to ids; caches the encodings of pieces between spaces."""

    def __init__(self, vocab: dict):
        self.trie = TrieEncoder(vocab)
        self.find = regex.compile(PATTERN).findall
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.trie.added, key=len, reverse=True))) + ")") if self.trie.added else None
        self.cache: dict[str, bytes] = {}

    def _pieces(self, text: str) -> list[str]:
        """Parts that can be encoded on their own; a space goes with what follows it, as in the pattern."""
        if SPACES.search(text):
            return self.find(text)  # runs of white space: the pattern decides
        first, *rest = text.split(" ")
        return ([first] if first else []) + [" " + x for x in rest]

    def _learn(self, pieces: set[str]) -> None:
        new = pieces.difference(self.cache)
        if len(self.cache) + len(new) > CACHE_PIECES:
            self.cache.clear()
            new = pieces
        # a space and letters are one match of the pattern
        plain = {p: p.encode() for p in new if p[1:].isalpha() and p[0] == " "}
        mixed = {p: [w.encode() for w in self.find(p)] for p in new if p not in plain}
        ids = self.trie.encode_words({w for ws in mixed.values() for w in ws}.union(plain.values()))
        for p, w in plain.items():
            self.cache[p] = ids[w]
        for p, ws in mixed.items():
            self.cache[p] = b"".join([ids[w] for w in ws])

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [self.cut.split(t) if self.cut and "<" in t else [t] for t in texts]
        special = {w: array("I", [i]).tobytes() for w, i in self.trie.added.items()}
        parts = [[special.get(x) or self._pieces(x) for x in xs if x] for xs in cut]
        self._learn({p for xs in parts for x in xs if isinstance(x, list) for p in x})
        get = self.cache.__getitem__
        return [b"".join([x if isinstance(x, bytes) else b"".join(map(get, x)) for x in xs]) for xs in parts]


def slices(texts, limit: int = SLICE_CHARS):
    """Runs of texts of at most ``limit`` characters, or one longer text."""
    run, size = [], 0
    for t in texts:
        t = t or ""
        if run and size + len(t) > limit:
            yield run
            run, size = [], 0
        run.append(t)
        size += len(t)
    if run:
        yield run


def _texts(tokens: list[bytes], ids) -> list[str]:
    get = tokens.__getitem__
    return [b"".join(map(get, array("I", x or b""))).decode("utf-8", "replace") for x in ids]


def encode(docs: DataFrame, vocab_path: str, text: str = "text", out: str = "ids", decoded: str | None = None) -> DataFrame:
    """``docs`` with ``out``: the ids of ``text`` as a binary of little-endian unsigned 32-bit integers.

    With ``decoded``, that column holds the text which ``decode`` makes of these
    ids, from the same pass.
    """
    spark: SparkSession = docs.sparkSession
    vocab = spark.sparkContext.broadcast(load_vocab(vocab_path))
    wide = decoded is not None

    @F.pandas_udf("ids binary, decoded string")
    def coded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = TextEncoder(vocab.value)
        for batch in batches:
            for run in slices(batch):
                ids = encoder.encode(run)
                yield pd.DataFrame({"ids": ids, "decoded": _texts(encoder.trie.tokens, ids) if wide else None}, dtype=object)

    made = [out] + ([decoded] if wide else [])
    docs = free_names(docs, *made, "_coded")
    got = docs.withColumn("_coded", coded(F.col(text)))
    return got.select(*docs.columns, *[F.col(f"_coded.{a}").alias(b) for a, b in zip(("ids", "decoded"), made)])


def decode(df: DataFrame, vocab_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with ``out``: the text of ``ids``, added tokens as their strings; broken UTF-8 becomes U+FFFD, null ids ''."""
    spark: SparkSession = df.sparkSession
    tokens = spark.sparkContext.broadcast(load_vocab(vocab_path)["tokens"])

    @F.pandas_udf("string")
    def text_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(_texts(tokens.value, batch), dtype=object)

    return free_names(df, out).withColumn(out, text_of(F.col(ids)))
