"""Token alignment, Merkle manifest, scaled sketches: the libraries on whole texts, a recursive tree in Python, sets of shingles."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from flowtriage.llm import merkle_manifest, queries, scaled_sketch, token_alignment
from flowtriage.llm.queries import piece_model_path, vocab_path
from tests.llm.helpers import SCHEMA, awkward, docs, with_clashes

SF = "/root/testdata/sf0.001"

# --- 11 -------------------------------------------------------------------------


def brute_links(texts):
    """Groups and links of each text from the libraries' encodings of the whole text."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(vocab_path())
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=piece_model_path())
    symbols = {}
    extra = 0
    for x in range(256):
        own = 33 <= x <= 126 or 161 <= x <= 172 or 174 <= x <= 255
        symbols[chr(x if own else 256 + extra)] = x
        extra += not own
    out = []
    for t in texts:
        if not t:
            out.append([])
            continue
        ids_a, ids_b = a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)
        raw_a = [bytes(symbols[c] for c in a.id_to_token(i)) for i in ids_a]
        raw_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not b"".join(raw_a) == b"".join(raw_b) == (" " + t).encode():
            out.append([])
            continue
        groups, i, j, left, right, at_a, at_b = [], 0, 0, [], [], 0, 0
        while i < len(ids_a) or j < len(ids_b):
            if at_a <= at_b and i < len(ids_a):
                left.append(ids_a[i])
                at_a += len(raw_a[i])
                i += 1
            else:
                right.append(ids_b[j])
                at_b += len(raw_b[j])
                j += 1
            if at_a == at_b:
                groups.append((left, right))
                left, right = [], []
        out.append(groups)
    return out


def brute_alignment(texts):
    groups = brute_links(texts)
    links = [[(x, y) for left, right in g for x in left for y in right] for g in groups]
    n = Counter(p for ls in links for p in set(ls))
    best = Counter()
    for (x, _), c in n.items():
        best[x] = max(best[x], c)
    out = []
    for g, ls in zip(groups, links):
        said = ";".join(",".join(map(str, left)) + "|" + ",".join(map(str, right)) for left, right in g)
        out.append((
            sum(len(x[0]) for x in g), sum(len(x[1]) for x in g), len(g), len(ls), sum(n[p] == best[p[0]] for p in ls),
            sum(n[p] for p in ls), hashlib.sha256(said.encode()).hexdigest() if g else "",
        ))
    return out, n, best


ODD_TEXTS = ["a  b   c\n \n d\t\te  x", " lead", "trail ", "trail  ", "  ", " ", "\n", "x\n", "x \ny", "<|endoftext|> <s> </s> <unk>", "a▁b", "\x00 a", "é É ½ 日本語 😀",
             "don't I'll 'tis", "\x1c \x1d a\x85b᠎ c", "ﬁ ﬂ", "a  b  c", "1234567 89 0.5", "x" * 500, "-=" * 200, "　x 　y"]


def odd_texts():
    rng = random.Random(3)
    out = ODD_TEXTS + ["".join(rng.choice("aeiouthsr d'1.,\n  ") for _ in range(rng.randint(1, 60))) for _ in range(300)]
    return out + ["".join(chr(rng.choice([rng.randint(32, 126), rng.randint(0, 0x2FFF), 10, 32, 32, 9, 0x1F600])) for _ in range(rng.randint(1, 40))) for _ in range(300)]


@pytest.mark.parametrize("max_broadcast", [10**6, 0])
def test_alignment_equals_whole_text_libraries(spark, max_broadcast):
    texts = odd_texts() + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    got, table = token_alignment.align(docs(spark, list(enumerate(texts))).select("doc_id", "text").repartition(5), vocab_path(), piece_model_path(), max_broadcast=max_broadcast)
    want, n, best = brute_alignment(texts)
    rows = {r.doc_id: tuple(r[c] for c in token_alignment.RESULTS) for r in got.collect()}
    bad = [(texts[i], rows[i], w) for i, w in enumerate(want) if rows[i] != w]
    assert not bad, bad[:3]
    if not max_broadcast:
        assert {(r.a, r.b): (r.n, r.best) for r in table.collect()} == {p: (c, c == best[p[0]]) for p, c in n.items()}


def test_alignment_small_cache_gives_the_same(monkeypatch):
    import json

    vocabularies = token_alignment.Vocabularies(open(vocab_path()).read(), token_alignment.load_vocab(vocab_path())["tokens"], open(piece_model_path(), "rb").read())
    assert vocabularies.splits and json.loads(open(vocab_path()).read())
    texts = odd_texts()
    want = token_alignment.Aligner(vocabularies)(texts)
    monkeypatch.setattr(token_alignment, "CACHE_PARTS", 20)
    small = token_alignment.Aligner(vocabularies)
    again = [small(texts[i : i + 9]) for i in range(0, len(texts), 9)]
    for c in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256"):
        assert [x for g in again for x in g[c].tolist()] == want[c].tolist()
    for c in ("same", "same_n", "odd", "odd_n"):
        assert [x.tolist() for g in again for x in g[c]] == [x.tolist() for x in want[c]]


def test_alignment_awkward(spark):
    base = with_clashes(awkward(spark)).withColumn("n_links", F.lit("x"))
    got = token_alignment.align(base, vocab_path(), piece_model_path())[0]
    rows = got.collect()
    assert len(rows) == base.count() and "size" in got.columns
    assert {(r.n_a, r.n_links, r.count_sum, r.groups_sha256) for r in rows if r.doc_id in (1, 2)} == {(0, 0, 0, "")}
    twice = [r for r in rows if r.doc_id == 4]
    assert len(twice) == 2 and twice[0] == twice[1] and twice[0].count_sum == 3 * twice[0].n_links  # in three documents
    empty, table = token_alignment.align(spark.createDataFrame([], SCHEMA), vocab_path(), piece_model_path())
    assert empty.count() == 0 and table.count() == 0


# --- 12 -------------------------------------------------------------------------


def H(x):
    return hashlib.sha256(x.encode()).hexdigest()


def brute_manifest(rows, fanout=16):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def lower(t):
        return None if t is None else re.sub("[A-Z]", lambda m: m[0].lower(), t)

    def tree(nodes):
        """(last node, siblings left and right of each first node by level)."""
        paths = [[] for _ in nodes]
        at = list(range(len(nodes)))
        while len(nodes) > 1:
            for i in range(len(paths)):
                run = at[i] - at[i] % fanout
                paths[i].append(("".join(nodes[run : at[i]]), "".join(nodes[at[i] + 1 : run + fanout])))
            nodes = [H("".join(nodes[i : i + fanout])) for i in range(0, len(nodes), fanout)]
            at = [i // fanout for i in at]
        return nodes[0], paths

    by = {}
    for i, text, lang, source, n in rows:
        leaf = H(field(i) + field(source) + field(lang) + field(n) + field(text))
        other = H(field(i) + field(source) + field(lang) + field(n) + field(lower(text))) if i is not None and zlib.crc32(str(i).encode()) % 5 == 0 else leaf
        by.setdefault(source, []).append((i is not None, i or 0, leaf, other, i))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(by[s])]) for s in order}
    root, top = tree([trees[s][0] for s in order])
    out = []
    for s, crown in zip(order, top):
        for x, path in zip(sorted(by[s]), trees[s][1]):
            acc = x[3]
            for left, right in path + crown:
                acc = H(left + acc + right)
            out.append((x[4], x[2], trees[s][0], root, H("".join(left + right for left, right in path + crown)), acc, acc == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("fanout", [16, 2])
def test_manifest_equals_python_tree(spark, fanout):
    rows = [(i, None if i % 11 == 0 else f"Text {i} É", "en", None if i % 7 == 0 else f"s{i % 3 if i < 150 else i % 40}", i) for i in range(300)]
    rows += [(5, "again", None, "s2", None), (5, "again", None, "s2", None), (None, "NO id", "en", "s2", 3), (77, "Lone", "en", "ä lone", 4)]
    df = spark.createDataFrame([(i, t, l, s, n) for i, t, l, s, n in rows], SCHEMA)
    got = merkle_manifest.verify(merkle_manifest.manifest(df, altered={"text": merkle_manifest.tampering()}, fanout=fanout))
    want = brute_manifest(rows, fanout)
    assert sorted([tuple(r) for r in got.collect()], key=repr) == want
    assert not all(x[-1] for x in want) and any(x[-1] for x in want)


def test_manifest_awkward(spark):
    base = with_clashes(awkward(spark)).withColumn("pos", F.lit(1)).withColumn("g", F.lit("x")).withColumn("leaf", F.lit(2))
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in base.collect()]
    got = merkle_manifest.verify(merkle_manifest.manifest(base))
    assert sorted([tuple(r)[:5] for r in got.collect()], key=repr) == sorted([x[:5] for x in brute_manifest(rows)], key=repr)
    assert got.where("verified").count() == len(rows)
    one = merkle_manifest.verify(merkle_manifest.manifest(docs(spark, [(3, "only")]))).first()
    assert one.leaf == one.subroot == one.root == one.folded_root and one.proof_sha256 == H("")
    assert merkle_manifest.verify(merkle_manifest.manifest(spark.createDataFrame([], SCHEMA))).count() == 0


# --- 13 -------------------------------------------------------------------------


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if 0 < len(words) < 5:
        return {" ".join(words)}
    return {" ".join(words[i : i + 5]) for i in range(len(words) - 4)}


def sketch_of(text, fraction):
    """A sketch from the hash of every single shingle."""
    of = scaled_sketch.Sketcher(1.0)
    hashes = sorted({int(of([s])[0][0]) for s in shingles(text)})
    limit = int(fraction * (1 << 48))
    return [h for i, h in enumerate(hashes) if h < limit or i == 0]


def test_sketch_keeps_all_hashes_below_the_fraction():
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abcdefg") * rng.randint(1, 3) for _ in range(n)) for n in (0, 1, 3, 4, 5, 6, 9, 40, 400)] + ["", " \n", "a\tb\x0bc  d\ne", "ü ü ü ü ü ü ü"]
    for fraction in (1 / 8, 1 / 2, 1.0):
        got = scaled_sketch.Sketcher(fraction)(texts)
        assert [s.tolist() for s in got] == [sketch_of(t, fraction) for t in texts]
    assert [len(s) for s in scaled_sketch.Sketcher(1 / 8)(texts)[:4]] == [0, 1, 1, 1]


def brute_beside(rows, sketch):
    order = [(i, t or "") for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))]
    out = []
    for (i, t), (_, after) in zip(order, order[1:] + order[:1]):
        n = len(t) // 4
        changed = t[: len(t) - n] + after[:n]
        a, b, c = ("".join(f"{x:012x}" for x in sketch([u])[0].tolist()) for u in (t, changed, after))

        def alike(x, y):
            p, q = ({z[k : k + 12] for k in range(0, len(z), 12)} for z in (x, y))
            return len(p & q) / len(p | q) if p | q else 1.0

        out.append((i, len(t), hashlib.sha256(changed.encode()).hexdigest(), a, b, alike(a, b), alike(a, c)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("parts", [1, 7])
def test_beside_next_brute_force(spark, parts):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()] + [(10**17 + 1, "x y"), (-5, None), (-4, ""), (None, "no id at all")]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = scaled_sketch.beside_next(docs(spark, rows).repartition(3))
        assert sorted([tuple(r)[:7] for r in got.collect()], key=repr) == brute_beside(rows, scaled_sketch.Sketcher())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_likeness_estimates_resemblance_and_containment(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").collect()]
    got = {r.doc_id: r for r in queries.op13_scaled_sketch(spark, "/root/testdata/sf0.01").collect()}
    errors, inside = [], []
    for (i, t), (_, after) in zip(rows, rows[1:] + rows[:1]):
        a, b, c = shingles(t), shingles(scaled_sketch.edited(t, after)), shingles(after)
        if len(a) >= 100:
            errors.append(abs(got[i].near_edited - len(a & b) / len(a | b)))
            inside.append(abs(got[i].kept_in_edited - len(a & b) / len(a)))
            assert abs(got[i].near_next - len(a & c) / len(a | c)) < 0.35
    assert sum(errors) / len(errors) < 0.06 and sum(inside) / len(inside) < 0.06 and len(errors) > 500


def test_fingerprints_merge(spark):
    texts = [(1, "one two three four five six seven " * 3 + "end"), (2, " ".join(f"w{i}" for i in range(400))), (3, "a b"), (4, "")]
    marked = scaled_sketch.fingerprints(docs(spark, texts)).select("doc_id", "fingerprint")
    pairs = marked.alias("x").join(marked.withColumnsRenamed({"doc_id": "other", "fingerprint": "theirs"}), F.lit(True))
    rows = pairs.select("doc_id", "other", scaled_sketch.merge(F.col("fingerprint"), F.col("theirs")).alias("m"), scaled_sketch.resemblance(F.col("fingerprint"), F.col("theirs")).alias("r"),
                        scaled_sketch.containment(F.col("fingerprint"), F.col("theirs")).alias("c")).collect()
    text = dict(texts)
    of = scaled_sketch.Sketcher(1.0)
    for r in rows:
        both = sorted({int(of([s])[0][0]) for s in shingles(text[r.doc_id]) | shingles(text[r.other])})
        assert r.m == "".join(f"{h:012x}" for i, h in enumerate(both) if h < (1 << 45) or i == 0)
        assert (r.r, r.c) == ((1.0, 1.0) if r.doc_id == r.other else (0.0, 0.0))


def test_sketch_awkward(spark):
    base = with_clashes(awkward(spark)).withColumn("fingerprint", F.lit(1))
    got = scaled_sketch.beside_next(base).collect()
    assert len(got) == base.count() and {r.n_chars for r in got if r.doc_id in (1, 2)} == {0}
    assert len({r.fingerprint for r in got if r.doc_id == 4}) == 1
    one = scaled_sketch.beside_next(docs(spark, [(3, "abcdefgh x y z w")])).first()
    assert one.near_next == 1.0 and one.n_chars == 16
    assert scaled_sketch.beside_next(spark.createDataFrame([], SCHEMA)).count() == 0
    made = scaled_sketch.fingerprints(base)
    assert made.columns == base.columns and made.where("doc_id = 1").first().fingerprint == ""
    assert scaled_sketch.fingerprints(spark.createDataFrame([], SCHEMA)).count() == 0
