"""Language identification, toxicity, BPE: held-out accuracy, the tokenizer library, awkward tables."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowtriage.llm import bpe_trie, langid, queries, toxicity
from flowtriage.llm.queries import vocab_path
from tests.llm.helpers import SCHEMA, awkward, docs, with_clashes

SF = "/root/testdata/sf0.01"


def held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


# --- 9 --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocab_path())


def test_bpe_query_equals_library(spark, library):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = {r.doc_id: r for r in queries.op9_trie_bpe(spark, sf).collect()}
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_odd_texts_equal_library(library):
    rng = random.Random(3)
    texts = ["<|endoftext|>a <|endoftext|><|endoftext|>", "a  b   c\n \n d\t\te  x", "", "a" * 3000, "\x1c \x1d a\x85b᠎c", "I'll don't 'sx ½²", " ", "x\n\n\n  y ", "-=" * 400]
    texts += ["".join(rng.choice("aeiouthsr d'1.,\n ") for _ in range(rng.randint(1, 40))) for _ in range(2000)]
    texts += ["".join(chr(rng.choice([rng.randint(32, 126), rng.randint(0, 0x2FFF), rng.choice([10, 32, 9, 0x1F600])])) for _ in range(rng.randint(1, 30))) for _ in range(2000)]
    got = bpe_trie.TextEncoder(bpe_trie.load_vocab(vocab_path())).encode(texts)
    for t, g, want in zip(texts, got, library.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(g, "<u4").tolist() == want.ids, t


def test_bpe_small_cache_gives_the_same(monkeypatch):
    vocab = bpe_trie.load_vocab(vocab_path())
    texts = [f"word{i} shared pieces {i * i}" for i in range(300)]
    want = bpe_trie.TextEncoder(vocab).encode(texts)
    monkeypatch.setattr(bpe_trie, "CACHE_PIECES", 10)
    small = bpe_trie.TextEncoder(vocab)
    assert [x for i in range(0, 300, 7) for x in small.encode(texts[i : i + 7])] == want


def test_bpe_round_trip_awkward(spark):
    base = with_clashes(awkward(spark))
    got = bpe_trie.decode(bpe_trie.encode(base, vocab_path()), vocab_path()).collect()
    assert len(got) == base.count()
    assert all(r.decoded == (r.text or "") for r in got)
    assert bpe_trie.encode(spark.createDataFrame([], SCHEMA), vocab_path()).count() == 0


# --- 5 --------------------------------------------------------------------------


def test_langid_equals_plain_naive_bayes(spark):
    rows = [(i, t, l) for i, (t, l) in enumerate([("the cat and the hat", "en"), ("der hund und die katze", "de"), ("le chat et la souris", "fr"), ("and then the end", "en")] * 6)]
    base = docs(spark, rows)
    langs, prior, table = langid.train(base)
    learned = [(t, l) for i, t, l in rows if not held(i)]
    assert langs == sorted({l for _, l in learned})
    assert np.exp(prior).tolist() == pytest.approx([sum(l == x for _, l in learned) / len(learned) for x in langs])
    for j, name in enumerate(langs):
        n = np.zeros(langid.DIMS)
        for t, l in learned:
            if l == name:
                for _, b, _ in langid.grams([t]):
                    np.add.at(n, b, 1)
        assert table[:, j] == pytest.approx(np.log((n + 0.5) / (n.sum() + 0.5 * langid.DIMS)), rel=1e-5)
    got = langid.predict(docs(spark, [(1, "the dog and the end"), (2, "die maus und der hut"), (3, "123 !"), (4, None)]), (langs, prior, table)).orderBy("doc_id").collect()
    assert [r.lang_pred for r in got] == ["en", "de", "und", "und"] and got[2].score == got[3].score == 0 and got[0].score > 0.9


def test_langid_slices_do_not_change_sums(spark, monkeypatch):
    texts = ["abc def ", "x" * 999 + "yz", "", "long text " * 300, "tail"]
    def total():
        out = np.zeros((len(texts), langid.DIMS))
        for at, rows in langid.runs(texts, limit=limit):
            for _, bucket, owner in langid.grams(rows):
                np.add.at(out, (at + owner, bucket), 1)
        return out
    limit = 10**9
    whole = total()
    limit = 500
    cut = total()
    # a cut repeats the last two characters: n-grams that lie inside the overlap count once more
    assert np.abs(whole.sum(1) - cut.sum(1)).max() <= 3 * 7 and (whole[[0, 2, 4]] == cut[[0, 2, 4]]).all()


def test_langid_held_out_accuracy(spark):
    want = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = [r for r in queries.op5_naive_bayes(spark, SF).collect()]
    assert len(got) == len(want) and all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 for r in got)
    out = [r for r in got if r.held_out]
    assert sum(r.lang_pred == want[r.doc_id] for r in out) / len(out) > 0.97


def test_langid_awkward(spark):
    base = with_clashes(awkward(spark))
    model = langid.train(base)
    got = langid.predict(base, model).collect()
    assert len(got) == base.count() and {r.lang_pred for r in got if r.text is None or not r.text.strip()} == {"und"}
    none = langid.train(spark.createDataFrame([], SCHEMA))
    assert none[0] == [] and {r.lang_pred for r in langid.predict(base, none).collect()} == {"und"}
    assert langid.predict(spark.createDataFrame([], SCHEMA), model).count() == 0


# --- 8 --------------------------------------------------------------------------


def brute_kernel(s, t, n=3):
    """Gap-weighted subsequence kernel from its definition."""
    from itertools import combinations

    def phi(x):
        out = {}
        for at in combinations(range(len(x)), n):
            u = "".join(x[i] for i in at)
            out[u] = out.get(u, 0) + toxicity.DECAY ** (at[-1] - at[0] + 1)
        return out

    a, b = phi(s), phi(t)
    return sum(v * b.get(u, 0) for u, v in a.items()) / np.sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values()))


def test_kernel_equals_definition():
    words = ["idiot", "idxiot", "banana", "statistics", "abc", "aaaaaa", "mississippi"]
    got = toxicity.dense(words) @ toxicity.dense(words).T
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            assert got[i, j] == pytest.approx(brute_kernel(a, b), abs=1e-5)
    w = np.random.default_rng(0).normal(size=toxicity.SYMBOLS**3)
    assert toxicity.scores(words, w) == pytest.approx(toxicity.dense(words) @ w, abs=1e-4)
    assert toxicity.against(words, toxicity.dense(words).T.copy()) == pytest.approx(got, abs=1e-4)


def test_kernel_tells_letters_of_other_scripts_apart():
    words = ["кретин", "дети", "идиот", "историю", "ηλιθιος", "12345", "67890", "混蛋东西吧", "你好朋友们"]
    got = toxicity.dense(words) @ toxicity.dense(words).T
    want = [[brute_kernel(a, b) for b in words] for a in words]
    assert got == pytest.approx(np.array(want), abs=0.06)  # triples that share a place by hash
    assert toxicity.folded("Crétin Ёж") == "cretin еж"


def test_toxicity_in_another_script():
    rng = random.Random(5)
    syll = "ба де фи го лу ма не пи ро су та ве".split()
    word = lambda: "".join(rng.choice(syll) for _ in range(rng.randint(1, 4)))
    texts, labels = [], []
    for i in range(600):
        ws = [word() for _ in range(40)]
        if i % 3 == 0:
            ws[rng.randrange(40)] = rng.choice(["кроттель", "звикле", "кроттели"])
        texts.append(" ".join(ws))
        labels.append(int(i % 3 == 0))
    weights, bias, slope, offset = toxicity.fit(texts, labels)
    p = lambda ts: 1 / (1 + np.exp(-(slope * np.array(toxicity.TextScorer(weights, bias).best(ts)) + offset)))
    assert (p(["баде фи кроттель", "КРОТТЕЛЬ!", "к.р.о.т.т.е.л.ь", "крот-тель", "суне звикле"]) >= 0.3).all()
    assert (p(["баде фи голу мане", "сута веро", "баде " * 500]) < 0.3).all()


@pytest.fixture(scope="module")
def insults():
    rng = random.Random(5)
    syll = "ba de fi go lu ma ne pi ro su ta ve".split()
    word = lambda: "".join(rng.choice(syll) for _ in range(rng.randint(1, 4)))
    texts, labels = [], []
    for i in range(600):
        ws = [word() for _ in range(40)]
        if i % 3 == 0:
            ws[rng.randrange(40)] = rng.choice(["krottel", "zwickle", "krottels"])
        texts.append(" ".join(ws))
        labels.append(int(i % 3 == 0))
    return texts, labels


def test_toxicity_finds_gapped_and_inserted_insults(insults):
    weights, bias, slope, offset = toxicity.fit(*insults)
    scorer = toxicity.TextScorer(weights, bias)
    p = lambda ts: 1 / (1 + np.exp(-(slope * np.array(scorer.best(ts)) + offset)))
    clean = "bade fi golu mane"
    assert (p([f"{clean} krottel", "you k.r.o.t.t.e.l", "KROTTEL!", "k r o t t e l", "krot-tel", f"a {'bade ' * 3000} zwickle"]) >= 0.3).all()
    assert (p([clean, "", "suta vero", "bade " * 5000]) < 0.3).all()


def test_toxicity_finds_insults_gapped_by_blanks(insults):
    weights, bias, slope, offset = toxicity.fit(*insults)
    p = lambda ts: 1 / (1 + np.exp(-(slope * np.array(toxicity.TextScorer(weights, bias).best(ts)) + offset)))
    gapped = ["k  r  o  t  t  e  l", "k - r - o - t - t - e - l", "k. r. o. t. t. e. l", "kro tt el", "krotte l", "k rottel", "bade fi kro tte l"]
    assert (p(gapped) >= 0.3).all()
    assert (p(["bade fi golu mane", "fi ba de go", "suta ve ro pi"]) < 0.3).all()


def test_toxicity_query_on_held_out_rows(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = queries.op8_string_kernel(spark, SF).collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) and r.held_out == held(r.doc_id) for r in got)
    out = [r for r in got if r.held_out and r.doc_id in labels]
    hit = [r.predicted for r in out if labels[r.doc_id]]
    false = [r.predicted for r in out if not labels[r.doc_id]]
    # about 40 toxic texts to learn from here; the README has the figures for more
    assert sum(hit) / len(hit) >= 0.5 and sum(false) / len(false) < 0.1


def test_toxicity_learns_from_labels_of_given_documents(spark, insults):
    texts, toxic = insults
    rows = [(20 * i, t) for i, t in enumerate(texts)] + [(20 * i + 1, None) for i in range(600)]
    labels = spark.createDataFrame([(i, 0, toxic[i // 20] if i % 20 == 0 else i % 2) for i in range(12000)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs(spark, rows), labels, max_rows=100)
    got = {r.doc_id: r.predicted for r in toxicity.score(docs(spark, [(1, "bade krottel"), (2, "bade golu mane")]), model).collect()}
    assert got == {1: 1, 2: 0}


def test_toxicity_awkward(spark):
    base = with_clashes(awkward(spark))
    labels = spark.createDataFrame([(i, 0, t) for i, t in [(1, 1), (1, 0), (2, 0), (4, 1), (5, None), (None, 1), (6, 0), (77, 1)]], "doc_id long, quality int, toxic int")
    assert toxicity.score(base, toxicity.train(base, labels)).count() == base.count()
    none = toxicity.score(base, toxicity.train(base, labels.limit(0))).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.0, 0)}
    assert toxicity.reject_toxic(base, labels.limit(0)).columns == base.columns
    empty = spark.createDataFrame([], SCHEMA)
    assert toxicity.reject_toxic(empty, labels).count() == 0
