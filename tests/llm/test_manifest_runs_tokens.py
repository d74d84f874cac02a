"""Hash trees, periodic stretches and byte-pair encoding against plain versions."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tslines.llm import bpe, merkle, runs
from llm.support import CLASH, DOCS, clashing, store, words


def sha(s):
    return hashlib.sha256(s if isinstance(s, bytes) else s.encode()).hexdigest()


def written(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def levels(nodes):
    """All levels of a tree, digests only."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i:i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def climbed(tree, at, value):
    """Siblings, left to right, and what the root becomes with `value` at a leaf."""
    proof = ""
    for level in tree[:-1]:
        run = level[at // 3 * 3:at // 3 * 3 + 3]
        proof += "".join(run[:at % 3] + run[at % 3 + 1:])
        value = sha("".join(run[:at % 3] + [value] + run[at % 3 + 1:]))
        at //= 3
    return proof, value


def plain_manifest(rows):
    groups = {}
    for doc, text, lang, source, n in rows:
        hit = doc is not None and zlib.crc32(str(doc).encode()) % 2 == 0
        leaf, cut = (sha("".join(written(v) for v in (doc, source, lang, n, t)))
                     for t in (text, text.replace("\n", "") if hit and text else text))
        groups.setdefault(source, []).append((doc, leaf, cut))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[s] = levels([r[1] for r in groups[s]])
    top = levels([trees[s][-1][0] for s in order])
    out = []
    for i, s in enumerate(order):
        for at, (doc, leaf, cut) in enumerate(groups[s]):
            low, value = climbed(trees[s], at, cut)
            high, value = climbed(top, i, value)
            out.append((doc, leaf, trees[s][-1][0], top[-1][0], sha(low + high), value, value == top[-1][0]))
    return sorted(out, key=repr)


def manifest(df):
    cols = "doc_id leaf subroot root proof_sha256 folded_root verified".split()
    out = merkle.verify(df, merkle.tampered())
    assert out.columns == cols
    return sorted((tuple(r) for r in out.collect()), key=repr)


def test_manifest_of_odd_rows(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, i, i, i]), rng.choice([None, "", "a\nb\n", words(rng, 30).replace(" w1", "\n"), "ü\n"]),
             rng.choice([None, "", "en"]), rng.choice([None, "", "s", "s", "s", "ü", "Z", "=", "-"]),
             rng.choice([None, -3, 5])) for i in range(120)]
    rows += rows[:9] + [(7, "x\n" * 40_000, "en", "alone", 1)] + [(None, "same\n", "en", "s", 1)] * 5
    df = spark.createDataFrame(clashing(rows), DOCS + CLASH).repartition(5)
    got = manifest(df)
    assert got == plain_manifest(rows) and {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("sources", [["s"], ["s"] * 3, ["s"] * 4, list("abcdefghij"), ["a", "b", "b", "b", "b"]])
def test_small_manifests(spark, sources):
    rows = [(i, f"t\n{i}", "en", s, i) for i, s in enumerate(sources)]
    assert manifest(spark.createDataFrame(rows, DOCS)) == plain_manifest(rows)


def test_no_manifest(spark):
    assert manifest(spark.createDataFrame([], DOCS)) == []


def plain_runs(x, least=24, times=3):
    """{(start, length): period} by looking at all distances."""
    out = {}
    for p in range(1, len(x) // times + 1):
        k = 0
        while k + p < len(x):
            e = k
            while e + p < len(x) and x[e] == x[e + p]:
                e += 1
            if e - k + p >= max(least, times * p):
                out.setdefault((k, e - k + p), p)
            k = max(e, k + 1)
    return out


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=90), st.integers(1, 30), st.integers(2, 60), st.integers(0, 89),
       st.sampled_from([(24, 3), (6, 3), (10, 2), (1, 4)]))
def test_runs_of_few_words(x, period, length, at, how):
    x = x[:at] + (x[at:at + period] * length)[:length] + x[at:]
    assert runs.maximal_runs(np.array(x, np.int64), *how) == plain_runs(x, *how)


def test_many_left_words(monkeypatch):
    # the same long word run after many different words, with one list of all places and without
    x = [w for i in range(60) for w in [100 + i, *[1, 2, 1] * (10 + i % 3)]]
    want = plain_runs(x)
    assert runs.maximal_runs(np.array(x)) == want and len(want) == 60
    monkeypatch.setattr(runs, "MANY", 1)
    assert runs.maximal_runs(np.array(x)) == want
    x = [5] * 20_000
    assert runs.maximal_runs(np.array(x)) == {(0, 20_000): 1}


def plain_summary(doc, text):
    x = (text or "").encode().split()
    n, h = len(x), zlib.crc32(str(doc).encode())
    if doc is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        x = x[:a] + [x[a + (i - a) % p] for i in range(a, n)]
    found = sorted((s, size, p) for (s, size), p in plain_runs(x).items())
    found.sort(key=lambda r: (r[0], r[2]))
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
    drop = {i for s, size, p in found for i in range(s + p, s + size)}
    left = b" ".join(w for i, w in enumerate(x) if i not in drop)
    return (doc, len(found), *best, found and 1000 * best[1] // best[2] or None,
            sha("".join("%d,%d,%d\n" % r for r in found)), sha(left))


def test_runs_of_documents(spark, tmp_path):
    rng = random.Random(2)
    texts = [None, "", " \n\t", "ü " * 50, words(rng, 40), "x\x1cy\x85z " * 30,
             words(rng, 300, 3), "a b c\n" * 40 + "tail", "  " + words(rng, 24, 1) + "  ", "  b" * 30]
    rows = [(i, rng.choice(texts) if i % 3 else words(rng, rng.randrange(400), rng.choice([2, 9, 500])), "en", "s", 1)
            for i in range(160)] + [(None, "b " * 30, "en", "s", 1), (3, "b " * 30, None, None, None)]
    df = store(spark, tmp_path, clashing(rows), DOCS + CLASH)
    for group in (runs.GROUP, 100):
        out = runs.summary(runs.find_runs(
            df.select("doc_id", runs.with_period(df["text"], df["doc_id"]).alias("text")), group))
        assert out.columns == "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()
        want = sorted((plain_summary(r[0], r[1]) for r in rows), key=repr)
        assert sorted((tuple(r) for r in out.collect()), key=repr) == want
    assert runs.find_runs(df.limit(0)).count() == 0


def test_planted_documents_have_runs(spark, sf):
    out = {r["doc_id"]: r for r in runs.op12_maximal_pairs(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(out) == len(docs)
    for r in docs:
        if len(r["text"].split()) < 1500:
            assert tuple(out[r["doc_id"]]) == plain_summary(r["doc_id"], r["text"])


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_path())


@pytest.fixture(scope="module")
def encoder():
    with open(bpe.default_path(), "rb") as f:
        return bpe.Encoder(bpe.vocabulary(f.read()))


CHARS = st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("aab  \n\t'stlé")),
                max_size=60)
PARTS = st.one_of(CHARS, st.sampled_from(["<|endoftext|>", "<|endoftext", "'s", "'ll ", "   ", " \n ", "ababab", "aaaaaaa",
                                          "１２", "\x00", "\x85", "　", "​", "the the", " THE"]))


@settings(max_examples=400, deadline=None)
@given(st.lists(PARTS, max_size=8).map("".join))
def test_ids_are_the_librarys(library, encoder, text):
    ids = encoder.encode([text])[0]
    want = library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ids, "<u4").tolist() == want
    assert encoder.decode(ids) == library.decode(want, skip_special_tokens=False) == text


def test_long_pieces_and_forgetting(library):
    rng = random.Random(3)
    with open(bpe.default_path(), "rb") as f:
        coder = bpe.Encoder(bpe.vocabulary(f.read()), pieces=50)
    for text in ("".join(rng.choice("ab") for _ in range(50_000)), "a" * 30_000, "=" * 10_000 + " " * 9_999,
                 words(rng, 2000), "é" * 5000, "".join(rng.choice("thein") for _ in range(20_000))):
        assert np.frombuffer(coder.encode([text, None])[0], "<u4").tolist() == library.encode(
            text, add_special_tokens=False).ids
        assert len(coder.known) < 2100


def test_documents_are_encoded(spark, tmp_path, library):
    rng = random.Random(4)
    rows = [(i, words(rng, rng.randrange(50)) + "<|endoftext|> ü\n", "en", "s", 1) for i in range(40)]
    rows += [(None, "x y", None, None, None), (1, None, "en", "s", 1), (1, "", "en", "s", 1), (2, words(rng, 300_000), "en", "s", 1)]
    df = store(spark, tmp_path, clashing(rows), DOCS + CLASH)
    out = bpe.encode(df, decoded=True).collect()
    got = sorted((repr(r["doc_id"]), r["n_tokens"], sha(bytes(r["ids"])), r["decoded"]) for r in out)
    want = []
    for doc, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((repr(doc), len(ids), sha(np.array(ids, "<u4").tobytes()), text or ""))
    assert got == sorted(want)
    assert bpe.encode(df.limit(0)).count() == 0


def test_unknown_vocabularies_are_refused():
    import json
    with open(bpe.default_path()) as f:
        spec = json.load(f)
    for part, key, value in (("model", "byte_fallback", True), ("pre_tokenizer", "add_prefix_space", True)):
        with pytest.raises(ValueError):
            bpe.Vocabulary(json.dumps({**spec, part: {**spec[part], key: value}}).encode())
    turned = {**spec["model"], "merges": spec["model"]["merges"][::-1]}
    with pytest.raises(ValueError):
        bpe.Vocabulary(json.dumps({**spec, "model": turned}).encode())
