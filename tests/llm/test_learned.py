"""Language mixtures, toxicity and nearest neighbours."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tslines.llm import language, neighbours, toxicity
from tslines.llm.catalog import QUERIES
from llm.support import CLASH, DOCS, clashing, words

SETS = {"x": "lorem ipsum dolor amet sit".split(), "y": "kvazi prokto zemlja grad voda".split()}


def text(rng, lang, n):
    return " ".join(rng.choice(SETS[lang]) for _ in range(n))


def corpus(n=60):
    rng = random.Random(3)
    return [(i, text(rng, "xy"[i % 2], rng.randrange(3, 60)), "xy"[i % 2], "s", 1) for i in range(n)]


def test_mixture_and_empty_texts(spark):
    rng = random.Random(4)
    odd = [(1001, None, None, None, None), (1002, "", "x", "s", 0), (1003, "12 + 3!", "y", "s", 0),
           (1004, text(rng, "x", 200) + " " + text(rng, "y", 100), None, "s", 0), (None, "lorem", "x", "s", 0)]
    df = spark.createDataFrame(clashing(corpus() + odd + odd[:1]), DOCS + CLASH)
    model = language.learn(language.learnable(df))
    rows = df.select("doc_id", "text", language.identify(spark, model, df["text"]).alias("f")).collect()
    found = {r["doc_id"]: r["f"] for r in rows}
    assert all(found[i]["lang_pred"] == ("xy"[i % 2]) for i in range(60))
    assert all(found[i]["lang_pred"] == "und" and found[i]["score"] == 0 for i in (1001, 1002, 1003))
    assert found[1004]["lang_pred"] == "x" and 0.55 < found[1004]["score"] < 0.8
    assert "y" in found[1004]["mixture"] and found[None]["lang_pred"] == "x"
    kept = language.keep_identified(spark, df)
    assert kept.columns == df.columns
    assert kept.count() == 62
    empty = df.limit(0)
    assert language.keep_identified(spark, empty).count() == 0
    assert language.learn(empty).infer("lorem") == []


def test_mixtures_of_three_languages_are_kept(spark, monkeypatch):
    monkeypatch.setitem(SETS, "z", "huomenta talossa kissoja pöydän".split())
    rng = random.Random(12)
    rows = [(i, text(rng, "xyz"[i % 3], 60), "xyz"[i % 3], "s", 1) for i in range(90)]
    mixed = " ".join(text(rng, lang, n) for lang, n in (("x", 80), ("y", 70), ("z", 50)))
    df = spark.createDataFrame(rows + [(500, mixed, None, "s", 1), (501, "12 + 3!", None, "s", 1)], DOCS)
    model = language.learn(language.learnable(df))
    assert len(model.infer(mixed)) == 3 and model.infer(mixed)[0][1] < 0.5
    kept = {r["doc_id"] for r in language.keep_identified(spark, df).collect()}
    assert 500 in kept and 501 not in kept and len(kept) == 91


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
def test_slices_change_nothing(monkeypatch, size):
    rng = random.Random(1)
    for long in (text(rng, "x", 600), "", "1 2", "a", "ab", "..ab..", "a  b" * 9 + "  ", "  \u00e9t\u00e9 1x", " " * 50 + "a"):
        monkeypatch.setattr(language, "SLICE", 1 << 20)
        whole = language.trigrams(long)
        monkeypatch.setattr(language, "SLICE", size)
        again = language.trigrams(long)
        assert (whole is None) == (again is None)
        assert whole is None or [x.tolist() for x in whole] == [x.tolist() for x in again]


def test_mixtures_reach_the_greatest_likelihood():
    """Expectation-maximisation of two languages against all shares on a grid."""
    rng = np.random.default_rng(3)
    for _ in range(20):
        p, n = rng.dirichlet(np.ones(30), 2).T, rng.integers(0, 20, 30)
        got = language._mixture(p, n, 2000)
        grid = np.linspace(0, 1, 2001)
        best = max(n @ np.log(p @ np.array([a, 1 - a]) + 1e-300) for a in grid)
        assert abs(got.sum() - 1) < 1e-9 and n @ np.log(p @ got) > best - 0.01


def test_held_out_accuracy(spark):
    import duckdb
    true = dict(duckdb.sql("SELECT doc_id, lang FROM '/root/testdata/sf0.01/documents.parquet'").fetchall())
    rows = [r for r in QUERIES["op7_language_mixture"](spark, "/root/testdata/sf0.01").collect() if r["held_out"]]
    assert np.mean([true[r["doc_id"]] == r["lang_pred"] for r in rows]) > 0.97


def test_toxicity_is_learnt_from_positives_and_unlabelled(spark):
    rng = random.Random(6)
    docs, labels = [], []
    for i in range(1500):
        bad = i % 8 == 0
        body = words(rng, rng.randrange(5, 80))
        docs.append((i, body + (" vileone viletwo vilethree" if bad else "")))
        if i % 3 == 0:
            labels.append((i, int(bad)))
    docs += [(5001, None), (5002, ""), (5003, "1 2 3"), (5004, "vileone vilefour viletwo"), (None, "vileone"), (0, docs[0][1])]
    labels += [(7, None), (None, 1), (9999, 1)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    lab = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    model = toxicity.learn(df, lab, F.col("doc_id") % 5 != 1)
    got = {r[0]: r[2] for r in df.select("doc_id", "text", toxicity.score(spark, model, df["text"])).collect()}
    toxic = [got[i] for i in range(1500) if i % 8 == 0 and i % 5 == 1]
    clean = [got[i] for i in range(1500) if i % 8 and i % 5 == 1]
    assert np.mean(np.array(toxic) >= 0.7) > 0.9 and np.mean(np.array(clean) >= 0.7) < 0.03
    assert got[5001] == got[5002] == got[5003] < 0.7 and got[5004] > 0.7
    nothing = toxicity.learn(df, lab.limit(0), F.col("doc_id") >= 0)
    assert nothing.score("vileone") < 1e-9


def test_the_unlabelled_sample_keeps_its_size():
    assert toxicity.UNLABELLED >= 18_000 and toxicity.POSITIVES >= 6_000


def test_rare_words_count_in_samples_of_any_size():
    rng = random.Random(5)
    rare = toxicity.features("vilerare")
    for n in (900, 1200):
        clean = [toxicity.features(words(rng, 30)) for _ in range(n)]
        bad = [toxicity.features(words(rng, 30) + " vileone" + (" vilerare" if i < 15 else "")) for i in range(90)]
        model = toxicity.fit(bad, clean + bad[:30], 0.1)
        assert model.weight[rare].max() > 0


def test_a_repeated_id_is_sampled_once(spark):
    rows = [(i, f"text {'a' * (i + 3)}") for i in range(20)] + [(3, "text other"), (4, None)] + [(3, "text aaaaaa")] * 50
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = toxicity._sample(df, df, 100, "s")
    assert len(got) == 20
    again = toxicity._sample(df.repartition(3), df, 100, "s")
    assert all((a == b).all() for a, b in zip(got, again))


def test_the_risk_on_clean_documents_is_bounded():
    zp, zu = np.full(10, 8.0), np.full(10, -8.0)
    gp, gu = toxicity._slopes(zp, zu, 0.5)
    assert (gu == 0).all() and (gp < 0).all()


def brute(rows, k):
    rows = [(i, np.array(v, float)) for i, v in rows]
    out = {}
    for q, a in rows:
        if q % 50 == 0:
            best = sorted((-(a @ b) / np.linalg.norm(a) / np.linalg.norm(b), i) for i, b in rows if i != q)
            out[q] = [i for _, i in best[:k]]
    return out


def test_neighbours_with_copies_and_bad_vectors(spark):
    rng = np.random.default_rng(8)
    base = [rng.normal(size=6).tolist() for _ in range(60)]
    good = [(i, base[i % 60] if i < 200 else base[0]) for i in range(300)]
    bad = [(1000, None), (1050, [0.0] * 6), (1001, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (1100, [float("nan")] * 6),
           (1002, [float("inf")] + [1.0] * 5), (1003, []), (1004, [1.0, 2.0]), (None, base[0])]
    df = spark.createDataFrame(good + bad + good[:5], "vec_id bigint, embedding array<double>")
    rows = neighbours.search(df, df["vec_id"] % 50 == 0).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got == brute(good, 5)
    few = spark.createDataFrame(good[:3], "vec_id bigint, embedding array<double>")
    assert neighbours.search(few, few["vec_id"] % 50 == 0).count() == 2
    assert neighbours.search(df.limit(0), df["vec_id"] % 50 == 0).count() == 0


def test_more_ties_than_are_ranked_go_to_the_smallest_ids(spark):
    # multiples of two vectors by powers of two: equal cosines, not equal vectors
    good = [(i, [2.0 ** (i % 97 - 48) * c for c in ((3.0, 4.0) if i % 2 else (4.0, 3.0))]) for i in range(1, 90)]
    df = spark.createDataFrame([*reversed(good)], "vec_id bigint, embedding array<double>")
    got = {}
    for r in neighbours.search(df, df["vec_id"] % 50 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got == {50: [2, 4, 6, 8, 10]}


def test_routing_with_the_parts_of_production(spark, monkeypatch):
    assert neighbours.learn(np.random.default_rng(1).normal(size=(4095, 8)), 4095).parts == 1
    routers, learn = [], neighbours.learn
    monkeypatch.setattr(neighbours, "learn", lambda *a: routers.append(learn(*a)) or routers[-1])
    rng = np.random.default_rng(10)
    centres = rng.normal(size=(16, 8))
    rows = [(i, (centres[i % 16] + 0.2 * rng.normal(size=8)).tolist()) for i in range(4200)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {}
    for r in neighbours.search(df, df["vec_id"] % 50 == 0).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert routers[0].parts == 2 and len(routers[0].layers) == 4
    x, ids = neighbours._unit(np.array([v for _, v in rows])), np.arange(0, 4200, 50)
    near = neighbours._nearest(x[ids], x, 5, ids)
    assert np.mean([len(got[q] & set(n.tolist())) / 5 for q, n in zip(ids.tolist(), near)]) > 0.9


def test_parts_are_balanced_and_recall_is_high(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "PER_PART", 256)
    monkeypatch.setattr(neighbours, "BLOCK", 100)
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(20, 16))
    rows = [(i, (centres[i % 20] + 0.6 * rng.normal(size=16)).tolist()) for i in range(2500)]
    part = neighbours.partition(neighbours._unit(np.array([v for _, v in rows])), 8, rng)
    counts = np.bincount(part)
    assert len(counts) == 8 and counts.max() - counts.min() <= 8
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {}
    for r in neighbours.search(df, df["vec_id"] % 50 == 0).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    want = brute(rows, 5)
    assert np.mean([len(got[q] & set(want[q])) / 5 for q in want]) > 0.9
