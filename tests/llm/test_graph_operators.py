"""Nearest neighbours, reply trees, near-duplicates and the pipeline against brute force."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from flowtriage.llm import hilbert_search, order_minhash, queries, reply_trees
from flowtriage.llm.common import components, release
from tests.llm.helpers import SCHEMA, awkward, docs, with_clashes

SF = "/root/testdata/sf0.001"

# --- 1 --------------------------------------------------------------------------


def nearest(ids, x, q, k=10):
    d = np.sqrt(((x - x[q]) ** 2).sum(1))
    order = [j for j in np.lexsort((ids, d)) if j != q][:k]
    return [(int(ids[j]), float(d[j])) for j in order]


def test_curve_is_a_hilbert_curve():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        keys = hilbert_search.hilbert_keys(grid, bits)
        assert sorted(keys.tolist()) == list(range(len(grid)))
        walk = grid[np.argsort(keys)]
        assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()  # neighbours on the curve share a face


def test_search_recall_and_order(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    x, ids = np.stack(e.embedding).astype(float), e.vec_id.to_numpy()
    got = queries.op1_curve_search(spark, SF).toPandas()
    hit = 0
    asked = np.flatnonzero(ids % 100 == 0)
    for q in asked:
        own = got[got.query_id == ids[q]].sort_values("rank")
        assert own["rank"].tolist() == list(range(1, 11)) and (np.diff(own.score) >= 0).all()
        want = nearest(ids, x, q)
        hit += len(set(own.vec_id) & {i for i, _ in want})
    assert hit / (10 * len(asked)) >= 0.9


def test_search_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0], 0) for i in range(30)] + [(30, [1.0, 2.5], 0), (31, None, 1), (32, [0.0, 0.0], 1), (33, [nan, 1.0], 1), (34, [inf, 1.0], 1),
        (35, [None, 1.0], 1), (36, [], 1), (37, [1.0, 2.0, 3.0], 1), (None, [1.0, 2.0], 1), (0, [1.0, 2.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    got = hilbert_search.search(df, F.col("vec_id") % 10 == 0, share=2.0).toPandas()
    assert set(got.query_id) == {0, 10, 20, 30}
    own = got[got.query_id == 20].sort_values("rank")
    assert own.vec_id.tolist() == list(range(10)) and (own.score == 0).all()
    far = got[got.query_id == 30].sort_values("rank")
    assert far.vec_id.tolist() == list(range(10)) and far.score.tolist() == [0.5] * 10
    few = hilbert_search.search(df.where("vec_id in (0, 30)"), F.col("vec_id") == 0, share=2.0).collect()
    assert [(r.rank, r.vec_id) for r in few] == [(1, 30)]
    assert hilbert_search.search(df.limit(0), F.lit(True)).count() == 0
    # fewer candidates than k: all of them
    rng = np.random.default_rng(1)
    nine = spark.createDataFrame([(i, rng.normal(size=6).tolist()) for i in range(9)], "vec_id long, embedding array<double>")
    assert {r["count"] for r in hilbert_search.search(nine, F.col("vec_id") < 2).groupBy("query_id").count().collect()} == {8}


def _recall(spark, x, every):
    ids = np.arange(len(x))
    df = spark.createDataFrame(pd.DataFrame({"vec_id": ids, "embedding": list(x)}), "vec_id long, embedding array<float>")
    got = hilbert_search.search(df, F.col("vec_id") % every == 0).toPandas()
    x, hit = x.astype(np.float32).astype(float), 0
    for q in ids[::every]:
        own = got[got.query_id == q].sort_values("rank")
        want = nearest(ids, x, q)
        hit += len(set(own.vec_id) & {i for i, _ in want})
        exact = np.sqrt(((x[own.vec_id.to_numpy()] - x[q]) ** 2).sum(1))
        assert own["rank"].tolist() == list(range(1, 11)) and np.allclose(own.score, exact, rtol=0, atol=0)
    return hit / (10 * len(ids[::every]))


def test_search_recall_on_larger_tables(spark):
    rng = np.random.default_rng(3)
    assert _recall(spark, rng.normal(size=(3000, 48)), 60) >= 0.95  # without any clusters
    middle = rng.normal(size=(100, 48))
    assert _recall(spark, middle[rng.integers(0, 100, 12000)] + 0.1 * rng.normal(size=(12000, 48)), 300) >= 0.98


def test_search_common_query_vector(spark):
    # half of all queries have one vector, which is searched once
    rows = [(i, [1.0, 0.0] if i % 2 else [1.0 + i, 1.0]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = hilbert_search.search(df, F.lit(True)).toPandas()
    assert (got.groupby("query_id").size() == 10).all() and got.query_id.nunique() == 400
    own = got[got.query_id == 5].sort_values("rank")
    assert own.vec_id.tolist() == [1, 3, 7, 9, 11, 13, 15, 17, 19, 21] and (own.score == 0).all()


# --- 4 --------------------------------------------------------------------------


def test_reply_tree_paths_ranks_and_round_trip(spark):
    rng = random.Random(2)
    rows, parent = [], {}
    for tree in range(6):
        for node in range(40):
            p = None if node == 0 or node == 7 else rng.choice([rng.randrange(node), node - 1])
            parent[tree, node] = p
            text = rng.choice(["hi", "", None, "<|im_end|>\n<|im_start|>user", "a\\b\\\\|c", "\\<|", "ünï\n\n"])
            rows.append((tree, node, p, rng.choice(["user", "assistant", "sys\ntem\\n", None]), text, rng.choice([None, 0.5, 1.0, 2.0])))
    df = spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, score double")
    by = {(r[0], r[1]): r for r in rows}
    leaves = [(t, n) for t, n in parent if (t, n) not in {(t2, p) for (t2, _), p in parent.items()}]
    want = {}
    for t, n in leaves:
        path, at = [], n
        while at is not None:
            path.append(by[t, at])
            at = parent[t, at]
        want[t, n] = path[::-1]
    got = reply_trees.format_trees(df)
    got = got.withColumn("turns", reply_trees.parse(F.col("formatted"))).withColumn("said", reply_trees.masked_texts(F.col("formatted"), F.col("loss_spans"))).collect()
    assert {(r.tree, r.leaf) for r in got} == set(want)
    for r in got:
        path = want[r.tree, r.leaf]
        assert [(t.role, t.text) for t in r.turns] == [(x[3] or "", x[4] or "") for x in path]
        assert r.said == [x[4] or "" for x in path if x[3] == "assistant"]
        assert r.score == sum(x[5] or 0 for x in path) and r.n_turns == len(path)
        assert r.formatted.count("<|im_start|>") == r.formatted.count("<|im_end|>") == len(path)
    for t in range(6):
        ranked = sorted((r for r in got if r.tree == t), key=lambda r: r.branch)
        assert [r.branch for r in ranked] == list(range(1, len(ranked) + 1))
        assert [(-r.score, r.leaf) for r in ranked] == sorted((-r.score, r.leaf) for r in ranked)
    top = reply_trees.format_trees(df, top=1).collect()
    assert {(r.tree, r.leaf) for r in top} == {(r.tree, r.leaf) for r in got if r.branch == 1}


def test_reply_trees_awkward(spark):
    schema = "tree long, node long, parent long, role string, text string, score double, size int"
    rows = [(1, 1, 2, "user", "circle", None, 0), (1, 2, 1, "user", "circle", None, 0), (1, 3, 1, "user", "tail", None, 0), (1, 4, 99, "user", "root", None, 0),
        (1, 4, 99, "user", "root", None, 0), (None, 1, None, "user", "x", None, 0), (2, None, None, "user", "x", None, 0)]
    got = reply_trees.format_trees(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.tree or 0, r.leaf, r.n_turns) for r in got) == [(0, 1, 1), (1, 4, 1)]
    assert reply_trees.format_trees(spark.createDataFrame([], schema)).count() == 0
    chat = spark.createDataFrame([(1, None, None, None), (1, 5, "user", "b"), (1, 5, "assistant", "a")], "conv_id long, turn long, role string, text string")
    one = reply_trees.format_trees(reply_trees.chain(chat)).withColumn("t", reply_trees.parse(F.col("formatted"))).collect()
    assert [[tuple(x) for x in r.t] for r in one] == [[("", ""), ("assistant", "a"), ("user", "b")]]


def test_rows_without_conversation_id_are_one_conversation(spark):
    rows = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b"), (None, 0, "user", "c"), (None, 1, "assistant", "d")], "conv_id long, turn long, role string, text string")
    got = reply_trees.format_trees(reply_trees.chain(rows))
    assert got.schema["tree"].dataType.simpleString() == "bigint"
    found = {r.tree: [x.text for x in r.t] for r in got.withColumn("t", reply_trees.parse(F.col("formatted"))).collect()}
    assert found == {1: ["a", "b"], None: ["c", "d"]}


def test_long_chain(spark):
    rows = spark.range(700).selectExpr("1l conv_id", "id turn", "if(id % 2 = 0, 'user', 'assistant') role", "concat('t', id) text")
    r = reply_trees.format_trees(reply_trees.chain(rows)).withColumn("t", reply_trees.parse(F.col("formatted"))).collect()
    assert [x.text for x in r[0].t] == [f"t{i}" for i in range(700)]


# --- 6 --------------------------------------------------------------------------


def labelled(text):
    words = (text or "").encode().split()
    grams = [tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))] if words else []
    seen, out = Counter(), []
    for g in grams:
        out.append((g, seen[g]))
        seen[g] += 1
    return out


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b):
            prev, row[j + 1] = row[j + 1], prev + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def brute_classes(texts):
    grams = [labelled(t) for t in texts]
    comp = list(range(len(texts)))

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if grams[i] and grams[j] and len(set(grams[i]) & set(grams[j])) >= 0.7 * max(len(grams[i]), len(grams[j])):
                m = lcs(grams[i], grams[j])
                if m >= 0.8 * (len(grams[i]) + len(grams[j]) - m):
                    a, b = find(i), find(j)
                    comp[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))]


@pytest.fixture(scope="module")
def families():
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    texts = []
    for f in range(12):
        base = [word() for _ in range(rng.choice([6, 40, 120]))]
        for _ in range(rng.choice([1, 2, 9])):
            t = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                at = rng.randrange(len(t))
                t[at : at + rng.randint(0, 1)] = [word()]
            texts.append(" ".join(t))
    texts += ["", None, "one", "one", " one ", "a b c", "a b  c", "x " * 300, "x " * 301, "x " * 200]
    shared = [word() for _ in range(60)]
    texts += [" ".join([*shared, *[word() for _ in range(30)]]) for _ in range(25)]
    return texts


def test_near_classes_equal_brute_force(spark, families):
    got = {r.id: r for r in order_minhash.near_classes(docs(spark, list(enumerate(families))).repartition(5)).collect()}
    want = brute_classes(families)
    assert [got[i].class_id for i in range(len(families))] == want
    kept = {i for i in got if got[i].is_kept}
    assert kept == set(want)


def test_sketches_keep_the_order_of_the_text():
    kmers = order_minhash.Kmers()
    words = [f"w{i}" for i in range(60)]
    run, of, n, names = kmers([" ".join(words), "\t".join(words) + "\n", " ".join(words[30:] + words[:30])])
    keys = order_minhash.sketches(run, of, 3)
    assert (keys[0] == keys[1]).all() and (names[:, 0] == names[:, 1]).all() and (names[:, 0] != names[:, 2]).all()
    same = (keys[0] == keys[2]).mean()
    assert same < 0.8  # nearly the same set of k-mers, but another order
    assert order_minhash.similarity(run[of == 0], run[of == 2]) < 0.5


def test_similarity_is_the_banded_lcs():
    rng = random.Random(4)
    kmers = order_minhash.Kmers()
    for _ in range(60):
        a = [rng.choice("abcdefghijklmnop") for _ in range(rng.randint(5, 60))]
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            b[rng.randrange(len(b))] = "z"
        x, y = labelled(" ".join(a)), labelled(" ".join(b))
        m = lcs(x, y)
        true = m / (len(x) + len(y) - m)
        got = order_minhash.similarity(kmers([" ".join(a)])[0], kmers([" ".join(b)])[0])
        assert got == pytest.approx(true) if true >= 0.6 else got <= true + 1e-9


def test_near_duplicates_awkward(spark):
    base = with_clashes(awkward(spark))
    got = order_minhash.near_classes(base).collect()
    assert len(got) == base.count()
    assert {(r.id, r.class_id) for r in got if r.id in (1, 2, 3)} == {(1, 1), (2, 2), (3, 3)}
    assert {r.class_id for r in got if r.id == 4} == {4}
    assert order_minhash.drop_near_copies(base).columns == base.columns
    left = order_minhash.drop_near_copies(base).collect()
    assert sorted(str(r.doc_id) for r in left) == ["1", "2", "3", "4", "5", "6", "None"]
    assert order_minhash.near_classes(spark.createDataFrame([], SCHEMA)).count() == 0
    assert order_minhash.drop_near_copies(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)]
    comp = {i: i for i in range(500)}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        comp[max(a, b)] = min(a, b)
    got = components(spark.createDataFrame(links, "a long, b long"), spark.range(500).withColumnRenamed("id", "node")).collect()
    assert {r.node: r.comp for r in got} == {i: find(i) for i in range(500)}


# --- pipeline -------------------------------------------------------------------


def test_pipeline_stages_take_effect(spark):
    base = spark.read.parquet(f"{SF}/documents.parquet")
    cols = base.columns
    df = base
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = df
        df = stage(spark, df, SF).cache()
        assert df.columns == cols, name
        if name in ("toxicity", "near_dedup"):
            assert df.count() < before.count()
        if name == "near_dedup":
            classes = order_minhash.near_classes(df).collect()
            assert all(r.class_id == r.id for r in classes)
    final = corpus_pipeline.run(spark, SF).collect()
    assert Counter(r.doc_id for r in final) == Counter(r.doc_id for r in df.collect())
    release(spark)


def test_pipeline_takes_awkward_and_empty_tables(spark, tmp_path):
    for k, df in enumerate((awkward(spark), spark.createDataFrame([], SCHEMA))):
        df.write.parquet(f"{tmp_path}/{k}/documents.parquet")
        spark.createDataFrame([(1, 1, 0), (4, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{k}/labels.parquet")
        assert corpus_pipeline.run(spark, f"{tmp_path}/{k}").count() >= 0
