"""Operator 8, toxicity by a subsequence string-kernel SVM with Nystroem landmarks.

The kernel of two words is the gap-weighted subsequence kernel of order 3: the
inner product over all letter triples u of phi_u(s) phi_u(t), where phi_u(s)
sums ``DECAY ** span`` over the places of u in s, gaps allowed; it is divided
by the words' norms.  Insults with letters put in between, changed endings or
stray signs therefore stay close to their plain form.

Letters of all scripts and digits are symbols of their own: accents are folded
(NFKD), triples of a to z have fixed places in the vector below, all others
are hashed by code point into its further places.

Pieces of a text are the letters and digits of its words, words over ``LONGEST``
letters in overlapping parts; windows over runs of tokens of at most three
letters; and a single letter joined with the word beside it, whatever signs and
blanks stand between.

Training (driver, bounded): at most ``max_rows`` labelled texts of each class,
chosen by the smallest hash of their id among rows with a text that aren't held out, are
split into distinct pieces by the executors.  Landmarks are pieces of them; pieces become vectors
``k(w, landmarks) K^-1/2``, and a linear SVM with squared hinge loss is fitted
on the witness word of each toxic text against words of clean texts: ``n_clean`` drawn
ones and, after each round, the ``n_hard`` that scored highest.  A witness of several
texts weighs ``toxic_weight`` times their number, ``most_alike`` at most, over the number of toxic texts.
Witnesses and hard clean words are chosen anew in each of ``rounds`` rounds.  A logistic curve over the
best word of a text gives the score, fitted on texts that the SVM didn't see.

Since the kernel is an inner product over triples, the fitted function of a
word is one dot product of its triples with a fixed vector, which is broadcast
(``SYMBOLS ** 3`` numbers).  Every piece of every text is scored, one array pass
over the letters of a slice of texts naming each by a 64-bit hash, distinct ones once;
scores of ``CACHE_PIECES`` pieces are kept per task.
Phrases of longer words are not seen together.

Null and empty texts score as a text whose best word is neutral.  Without
labels of both classes every score is 0.  Null labels take no part; of several
labels of one id the largest counts.  Repeated rows are scored alike; result
columns replace clashing input columns; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe_trie import slices
from .common import free_names
from .langid import held_out

#: Triples have SYMBOLS ** 3 places: one for each triple of the first 26, which are a to z; the others share the rest.
SYMBOLS = 36
DECAY = 0.6
LONGEST = 14
SHORT = 3
CACHE_PIECES = 1_000_000
THRESHOLD = 0.3
MAX_ROWS = 1500
N_LANDMARKS = 400
#: Words whose triples are looked up at once when landmarks are compared.
SLICE = 16
NEUTRAL = -1.0

MARKS = re.compile("[\u0300-\u036f]+")
_ALL = np.arange(SYMBOLS**3)
#: Places of triples with a symbol that isn't a to z.
SHARED = _ALL[(_ALL // SYMBOLS**2 >= 26) | (_ALL // SYMBOLS % SYMBOLS >= 26) | (_ALL % SYMBOLS >= 26)]


def folded(text: str) -> str:
    """Lower case without accents."""
    low = text.lower()
    return low if low.isascii() else MARKS.sub("", unicodedata.normalize("NFKD", low)).lower()


@cache
def _kinds() -> np.ndarray:
    """For every code point: 1 a letter or digit, 2 white space, 0 another sign."""
    return np.fromiter((1 if c.isalnum() else 2 if c.isspace() else 0 for c in map(chr, range(0x110000))), np.int8, 0x110000)


def _cut(begin: np.ndarray, end: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of three letters or more, those over LONGEST in overlapping parts."""
    n, half = end - begin, LONGEST // 2
    times = np.where(n < 3, 0, np.where(n <= LONGEST, 1, -((half - n) // half)))
    first = np.repeat(begin, times)
    first += half * (np.arange(len(first)) - np.repeat(np.cumsum(times) - times, times))
    return first, np.minimum(first + LONGEST, np.repeat(end, times)), np.repeat(owner, times)


def spans(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(letters and digits of all texts one after the other; begin, end and text of every piece in them)."""
    low = [folded(t) for t in texts]
    flat = np.frombuffer("\n".join(low).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    starts = np.cumsum([0, *[len(t) + 1 for t in low]])[:-1]
    kind = _kinds()[flat]
    letter = kind == 1
    upto = np.concatenate([[0], np.cumsum(letter)])

    def ranges(inside):
        edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
        begin, end = edge[0::2], edge[1::2]
        return upto[begin], upto[end], np.searchsorted(starts, begin, side="right") - 1

    found = [_cut(*ranges(kind != 2))]
    begin, end, owner = ranges(letter)
    size = end - begin
    # windows of two tokens, three and so on from each short token, as long as short ones of the same text follow
    small = np.flatnonzero(size <= SHORT)
    last = small
    while len(small):
        last = last + 1
        on = last < len(size)
        small, last = small[on], last[on]
        on = (size[last] <= SHORT) & (owner[last] == owner[small]) & (end[last] - begin[small] <= LONGEST)
        small, last = small[on], last[on]
        some = end[last] - begin[small] > 2
        found.append((begin[small][some], end[last][some], owner[small][some]))
    beside = ((size[:-1] == 1) & (size[1:] > SHORT)) | ((size[:-1] > SHORT) & (size[1:] == 1))
    at = np.flatnonzero(beside & (owner[:-1] == owner[1:]))
    found.append(_cut(begin[at], end[at + 1], owner[at]))
    return flat[letter].astype(np.int64), *[np.concatenate(x) for x in zip(*found)]


def pieces(text: str) -> list[str]:
    """The distinct pieces of a text."""
    letters, begin, end, _ = spans([text])
    said = letters.astype(np.uint32).tobytes().decode("utf-32-le", "surrogatepass")
    return sorted({said[i:j] for i, j in zip(begin.tolist(), end.tolist())})


def _packed(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(letters of all words, begin and end of each)."""
    letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    end = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
    return letters, np.concatenate([[0], end[:-1]]).astype(np.int64), end


def _groups(letters: np.ndarray, begin: np.ndarray, end: np.ndarray, room: int):
    """Yields (which pieces, their symbols) for pieces of one length, about ``room`` triples at once."""
    size = end - begin
    for n in np.unique(size).tolist():
        at = np.flatnonzero(size == n)
        for part in np.array_split(at, max(1, len(at) * len(_TRIPLES[n]) // room)):
            if len(part):
                c = letters[begin[part][:, None] + np.arange(n)]
                yield part, np.where((c >= 97) & (c <= 122), c - 97, 26 + c)


def _places(c: np.ndarray, trip: np.ndarray) -> np.ndarray:
    """Place of every triple of every word; ``c`` has a row of symbols for each word."""
    a, b, d = c[:, trip[:, 0]], c[:, trip[:, 1]], c[:, trip[:, 2]]
    ids = (a * SYMBOLS + b) * SYMBOLS + d
    other = (a >= 26) | (b >= 26) | (d >= 26)
    if other.any():
        h = ((a[other] << 42) ^ (b[other] << 21) ^ d[other]).astype(np.uint64)
        for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
        ids[other] = SHARED[((h ^ (h >> np.uint64(33))) % np.uint64(len(SHARED))).astype(np.int64)]
    return ids


_TRIPLES = {n: np.array(list(combinations(range(n), 3))) for n in range(3, LONGEST + 1)}


def features(words: list[str]):
    """Yields (places in ``words``, triples, values) by word length; values are divided by the word's norm."""
    if words:
        for part, c in _groups(*_packed(words), 200_000):
            trip = _TRIPLES[c.shape[1]]
            ids = _places(c, trip)
            values = np.broadcast_to(DECAY ** (trip[:, 2] - trip[:, 0] + 1.0), ids.shape)
            order = np.argsort(ids, axis=1, kind="stable")
            ids = np.take_along_axis(ids, order, 1)
            values = np.take_along_axis(values, order, 1)
            # values of one triple are summed where it ends, so that equal triples count as one
            run = np.cumsum(values, axis=1)
            last = np.ones(ids.shape, dtype=bool)
            last[:, :-1] = ids[:, 1:] != ids[:, :-1]
            upto = np.where(last, run, 0.0)
            prior = np.zeros_like(upto)
            prior[:, 1:] = np.maximum.accumulate(upto, axis=1)[:, :-1]
            own = np.where(last, run - prior, 0.0)
            yield part, ids, own / np.sqrt((own**2).sum(1, keepdims=True))


def dense(words: list[str]) -> np.ndarray:
    out = np.zeros((len(words), SYMBOLS**3), dtype=np.float32)
    for part, ids, values in features(words):
        np.add.at(out, (part[:, None], ids), values)
    return out


def landmark_matrix(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(triples of the words, row of every triple, a row of features for each of them and one of zeros for all others)."""
    parts = list(features(words))
    used = np.unique(np.concatenate([ids.ravel() for _, ids, _ in parts]))
    row = np.full(SYMBOLS**3, len(used), dtype=np.int32)
    row[used] = np.arange(len(used))
    matrix = np.zeros((len(used) + 1, len(words)), dtype=np.float32)
    for part, ids, values in parts:
        np.add.at(matrix, (row[ids], part[:, None]), values)
    return used, row, matrix


def against(words: list[str], matrix: np.ndarray, row: np.ndarray | None = None) -> np.ndarray:
    """Kernel of every word with the landmarks whose features are the columns of ``matrix``, by triple or by ``row`` of the triple."""
    out = np.zeros((len(words), matrix.shape[1]), dtype=np.float32)
    for part, ids, values in features(words):
        for k in range(0, len(part), SLICE):
            at = ids[k : k + SLICE] if row is None else row[ids[k : k + SLICE]]
            out[part[k : k + SLICE]] = np.einsum("wt,wtm->wm", values[k : k + SLICE].astype(np.float32), matrix[at], optimize=True)
    return out


def span_scores(letters: np.ndarray, begin: np.ndarray, end: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """``weights`` times the normed features of every piece.

    The product needs no equal triples put together.  The norm is the kernel of a
    piece with itself: L M L' sums, for each pair of places, over all pairs of
    equal letters before them, weighted by distance.
    """
    out = np.zeros(len(begin))
    for part, c in _groups(letters, begin, end, 100_000):
        n = c.shape[1]
        trip = _TRIPLES[n]
        value = weights[_places(c, trip)] @ (DECAY ** (trip[:, 2] - trip[:, 0] + 1.0))
        steps = np.subtract.outer(np.arange(n), np.arange(n))
        low = np.where(steps > 0, DECAY ** np.abs(steps).astype(float), 0.0)
        same = (c[:, :, None] == c[:, None, :]).astype(float)
        two = same * (low @ same @ low.T)
        norm = DECAY**2 * (same * (low @ two @ low.T)).sum((1, 2))
        out[part] = value / np.sqrt(norm)
    return out


def scores(words: list[str], weights: np.ndarray) -> np.ndarray:
    out = np.zeros(len(words))
    for k in range(0, len(words), 20_000):
        out[k : k + 20_000] = span_scores(*_packed(words[k : k + 20_000]), weights)
    return out


_U = np.uint64
_FACTOR, _SEED = _U(0x9E3779B97F4A7C15), 0xBF58476D1CE4E5B9


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _FACTOR
    return x ^ (x >> _U(29))


class TextScorer:
    """Best score of the pieces of a text."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias
        self.known, self.values = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.float32)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def _names(self, letters: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A 64-bit hash of every piece, from differences of one running polynomial."""
        while len(self.up) <= len(letters):
            for name, base in (("up", _SEED), ("down", pow(_SEED, -1, 1 << 64))):
                have = getattr(self, name)
                setattr(self, name, np.concatenate([have, have * _U(pow(base, len(have), 1 << 64))]))
        run = np.concatenate([[_U(0)], np.cumsum(_mixed(letters.astype(np.uint64) + _U(7)) * self.up[: len(letters)], dtype=np.uint64)])
        return _mixed((run[end] - run[begin]) * self.down[begin] + (end - begin).astype(np.uint64) * _FACTOR)

    def _learn(self, letters, begin, end, names, first) -> None:
        if len(self.known) + len(names) > CACHE_PIECES:
            self.known, self.values = self.known[:0], self.values[:0]
        at = np.searchsorted(self.known, names)
        new = np.ones(len(names), dtype=bool)
        if len(self.known):
            new = self.known[np.minimum(at, len(self.known) - 1)] != names
        own = first[new]
        got = span_scores(letters, begin[own], end[own], self.weights) + self.bias
        self.known = np.insert(self.known, at[new], names[new])
        self.values = np.insert(self.values, at[new], got)

    def best(self, texts: list[str]) -> np.ndarray:
        letters, begin, end, owner = spans(texts)
        best = np.full(len(texts), -np.inf)
        if len(begin):
            names, first, inverse = np.unique(self._names(letters, begin, end), return_index=True, return_inverse=True)
            self._learn(letters, begin, end, names, first)
            np.maximum.at(best, owner, self.values[np.searchsorted(self.known, names)][inverse])
        return np.where(np.isinf(best), NEUTRAL, best)


def _svm(x: np.ndarray, y: np.ndarray, c: np.ndarray, steps: int = 12):
    """Linear SVM, squared hinge loss with weight ``c`` per row, by Newton steps on the rows inside the margin."""
    m = x.shape[1] + 1
    w = np.zeros(m)
    active = None
    for _ in range(steps):
        inside = y * (x @ w[:-1].astype(x.dtype) + w[-1]) < 1
        if active is not None and (inside == active).all():
            break
        active = inside
        left, right = np.eye(m), np.zeros(m)
        left[-1, -1] = 1e-3
        for at in np.array_split(np.flatnonzero(inside), 1 + int(inside.sum()) // 500):
            rows = np.hstack([x[at], np.ones((len(at), 1))]).astype(np.float64)
            left += (rows * c[at, None]).T @ rows
            right += (rows * c[at, None]).T @ y[at]
        w = np.linalg.solve(left, right)
    return w[:-1], w[-1]


def _bags(found: Iterable[list[str]]) -> tuple[list[str], list[np.ndarray]]:
    """(sorted distinct pieces, for each text the places of its pieces in that list); texts are taken one by one."""
    first: dict[str, int] = {}
    bags = [np.fromiter([first.setdefault(p, len(first)) for p in ps], np.int32) for ps in found]
    words = sorted(first)
    place = np.empty(len(words), dtype=np.int32)
    place[[first[w] for w in words]] = np.arange(len(words))
    return words, [np.sort(place[b]) for b in bags]


def _first_rates(words: list[str], bags: list[np.ndarray], toxic: list[int], clean: list[int]) -> np.ndarray:
    """For each word how well it, or a run of four letters in it, tells toxic from clean texts."""
    letters, begin, end = _packed(words)
    run = np.zeros(len(letters), dtype=np.uint64)
    for k in range(4):
        run[: len(run) - k] = _mixed(run[: len(run) - k] + letters[k:].astype(np.uint64) + _FACTOR)
    owner = np.repeat(np.arange(len(words)), end - begin)
    run = run[np.arange(len(letters)) + 4 <= end[owner]]
    size = np.maximum(end - begin - 3, 0) + 1
    first = np.cumsum(size) - size
    # a word's runs, then the word itself
    names = np.empty(size.sum(), dtype=np.uint64)
    itself = np.zeros(len(names), dtype=bool)
    itself[first + size - 1] = True
    names[~itself] = run
    names[itself] = _mixed(np.arange(len(words), dtype=np.uint64) + _U(1 << 60))
    flat = np.unique(names, return_inverse=True)[1].astype(np.int32)
    begin = np.append(first, len(flat))
    df = np.zeros((2, int(flat.max(initial=-1)) + 1))
    for label, rows in enumerate((clean, toxic)):
        for i in rows:
            sizes = size[bags[i]]
            at = np.repeat(begin[bags[i]] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            df[label][np.unique(flat[at])] += 1
    odds = np.log((df[1] + 0.05) / len(toxic)) - np.log((df[0] + 1.0) / len(clean))
    rate = np.where(df[1] > 1, odds, -1.0) * np.sqrt(df[1])
    return np.maximum.reduceat(rate[flat], begin[:-1])


def _best(values: np.ndarray, bag: np.ndarray) -> int:
    """The word of the bag with the largest value, the last one of equals."""
    own = values[bag]
    return int(bag[len(own) - 1 - np.argmax(own[::-1])])


def fit(texts: list[str], labels: list[int], **params):
    """``fit_pieces`` on the pieces of texts."""
    return fit_pieces([pieces(t) for t in texts], labels, **params)


def fit_pieces(
    found: Iterable[list[str]],
    labels: list[int],
    n_landmarks: int = N_LANDMARKS,
    rounds: int = 4,
    n_clean: int = 6000,
    n_hard: int = 3000,
    toxic_weight: float = 1000.0,
    most_alike: int = 20,
    seed: int = 7,
):
    """(weights over triples, bias, logistic slope, logistic offset) from the pieces of labelled texts, or None without both classes."""
    labels = np.asarray(labels)
    rng = np.random.default_rng(seed)
    words, bags = _bags(found)
    rows = [i for i in range(len(bags)) if len(bags[i])]
    fold = np.arange(len(bags)) % 4 == 3
    both = lambda rs: ([i for i in rs if labels[i]], [i for i in rs if not labels[i]])
    toxic, clean = both([i for i in rows if not fold[i]])
    if not toxic or not clean:
        fold[:] = False
        toxic, clean = both(rows)
        if not toxic or not clean:
            return None
    rate = _first_rates(words, bags, toxic, clean)
    witness = {i: _best(rate, bags[i]) for i in toxic}
    counts = np.bincount(np.concatenate([bags[i] for i in clean]), minlength=len(words))
    clean_words = np.flatnonzero(counts)
    strong = [w for w, _ in Counter(witness.values()).most_common(n_landmarks // 2)]
    common = clean_words[np.argsort(-counts[clean_words], kind="stable")][: n_landmarks // 4].tolist()
    rest = clean_words[rng.permutation(len(clean_words))[: n_landmarks - len(strong) - len(common)]].tolist()
    landmarks = sorted({*strong, *common, *rest})
    used, row, matrix = landmark_matrix([words[w] for w in landmarks])
    vals, vecs = np.linalg.eigh((matrix.T @ matrix).astype(np.float64))
    good = vals > 1e-6 * vals.max()
    root = (vecs[:, good] / np.sqrt(vals[good])).astype(np.float32)
    negatives = set(clean_words[rng.permutation(len(clean_words))[:n_clean]].tolist()) | set(common)
    weights, bias = None, 0.0
    for _ in range(rounds):
        pos = Counter(witness.values())
        neg = sorted(negatives - set(pos))
        z = against([words[w] for w in (*pos, *neg)], matrix, row) @ root
        y = np.array([1.0] * len(pos) + [-1.0] * len(neg))
        c = np.array([toxic_weight * min(n, most_alike) / len(toxic) for n in pos.values()] + [1.0] * len(neg))
        v, bias = _svm(z, y, c)
        del z
        weights = np.zeros(SYMBOLS**3)
        weights[used] = (matrix @ (root @ v))[:-1]
        value = scores(words, weights) + bias
        hard = clean_words[np.argsort(-value[clean_words], kind="stable")][:n_hard].tolist()
        negatives = set(neg) | set(hard)
        # a text whose best word is no better than clean texts' words is a doubtful witness and leaves the next round
        limit = np.quantile([value[bags[i]].max() for i in clean], 0.999)
        chosen = {i: _best(value, bags[i]) for i in toxic}
        kept = {i: w for i, w in chosen.items() if value[w] > min(limit, 0.0)}
        witness = kept or chosen
    value = scores(words, weights) + bias
    check = np.flatnonzero(fold) if fold.any() and len(set(labels[fold].tolist())) == 2 else np.arange(len(bags))
    best = np.array([value[bags[i]].max() if len(bags[i]) else NEUTRAL for i in check])
    slope, offset = _logistic(best, labels[check])
    return weights, float(bias), slope, offset


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Platt's curve with his smoothed targets and a weak prior, by Newton steps with halving."""
    n1, n0 = y.sum(), len(y) - y.sum()
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(2)

    def loss(w):
        z = a @ w
        return (np.logaddexp(0, z) - t * z).sum() + 1e-3 * (w @ w)

    for _ in range(60):
        p = 1 / (1 + np.exp(-(a @ w)))
        grad = a.T @ (p - t) + 2e-3 * w
        hess = (a * (p * (1 - p))[:, None]).T @ a + 2e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", max_rows: int = MAX_ROWS, **params):
    """The model from at most ``max_rows`` labelled texts of each class; the choice moves only ids until it is made."""
    narrow = (
        labels.select(F.col(key).alias("_id"), F.col(label).alias("_y"))
        .where("_id is not null and _y is not null")
        .where(~held_out(F.col("_id")))
        .groupBy("_id")
        .agg(F.max(F.col("_y").cast("int")).alias("_y"))
    )
    # labels of documents that aren't here, or have no text, take no places in the sample
    narrow = narrow.join(docs.where(F.col(text).isNotNull()).select(F.col(key).alias("_id")), "_id", "left_semi")
    sample = None
    for y in (0, 1):
        part = narrow.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(max_rows)
        sample = part if sample is None else sample.unionByName(part)
    ids = sample.toPandas()  # at most 2 * max_rows ids
    spark = docs.sparkSession
    chosen = spark.createDataFrame(ids.astype({"_y": "int32"}), "_id long, _y int") if len(ids) else sample
    rows = docs.join(F.broadcast(chosen), F.col(key) == F.col("_id")).where(F.col(text).isNotNull())
    rows = rows.groupBy("_id").agg(F.first("_y").alias("y"), F.max(text).alias("t"))

    # one string for each text, since a million small ones would fill the driver
    @F.pandas_udf("string")
    def split(texts: pd.Series) -> pd.Series:
        return pd.Series(["\n".join(pieces(t)) for t in texts], dtype=object)

    got = rows.select("_id", "y", split("t").alias("found")).toPandas().sort_values("_id")
    return fit_pieces((x.split("\n") if x else [] for x in got["found"]), got["y"].tolist(), **params) if len(got) else None


def score(docs: DataFrame, model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 if the score reaches the threshold)."""
    docs = free_names(docs, "score", "predicted")
    if model is None:
        got = F.lit(0.0)
    else:
        shared = docs.sparkSession.sparkContext.broadcast(model)

        @F.pandas_udf("double")
        def toxic(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            weights, bias, slope, offset = shared.value
            scorer = TextScorer(weights, bias)
            for batch in batches:
                for run in slices(batch, 500_000):
                    best = scorer.best(run)
                    yield pd.Series(1 / (1 + np.exp(-np.clip(slope * best + offset, -60, 60))))

        got = toxic(F.col(text))
    scored = docs.withColumn("score", got)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def reject_toxic(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", **params) -> DataFrame:
    """``docs`` without the rows that a model fitted on them and ``labels`` predicts to be toxic."""
    model = train(docs, labels, key, text, **params)
    rows = docs.select(F.struct(*docs.columns).alias("_row"))
    return score(rows, model, f"_row.{text}").where("predicted = 0").select("_row.*")
