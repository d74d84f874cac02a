"""Mixing, training order and the pipeline."""

import random

import numpy as np
import tiktoken

import corpus_pipeline
from tslines import session
from tslines.llm import mixing, order, simhash
from llm.support import CLASH, DOCS, clashing, store, words


def corpus(n=900):
    rng = random.Random(21)
    names = ["s0"] * 4 + ["s1", "s2", "b", "é", None]
    return [(i, words(rng, rng.randrange(1, 60)), "en", rng.choice(names), 1) for i in range(n)]


def plain_targets(sizes):
    """Water filling by repeated sharing of the excess."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, rest, free = dict.fromkeys(names, 0.0), float(sum(sizes.values())), set(names)
    while rest > 1e-9 and free:
        total = sum(weight[s] for s in free)
        for s in free:
            target[s] += rest * weight[s] / total
        rest = 0.0
        for s in list(free):
            if target[s] >= 3 * sizes[s]:
                rest += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
                free.discard(s)
    return target


def test_targets_and_taken_words(spark, tmp_path):
    odd = [(5000, None, "en", "s0", 0), (5001, "", "en", "void", 0), (5002, " \t", "en", "s1", 0), (None, "a b", "en", "s2", 1)]
    rows = clashing(corpus() + odd + corpus()[:7] + corpus()[:7])
    df = store(spark, tmp_path, rows, DOCS + CLASH)
    got = mixing.copies(df, fan=8).collect()
    assert len(got) == len(rows)
    sizes, taken = {}, {}
    source = {r[0]: r[3] for r in rows}
    for r in got:
        s = source[r["doc_id"]]
        sizes[s] = sizes.get(s, 0) + r["size"]
        taken[s] = taken.get(s, 0) + r["size"] * r["copies"]
        assert 0 <= r["copies"] <= 3
    want = plain_targets(sizes)
    for r in got:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and abs(r["target"] - want[s]) < 1e-6 * max(1, want[s])
    assert all(abs(taken[s] - want[s]) <= 60 for s in sizes)
    again = mixing.copies(store(spark, tmp_path, rows[::-1], DOCS + CLASH, parts=5), fan=8).collect()
    key = lambda r: (str(r["doc_id"]), r["size"], r["copies"])
    assert sorted(map(key, got)) == sorted(map(key, again))
    mixed = mixing.mix(df, fan=8)
    assert mixed.columns == df.columns and mixed.count() == sum(r["copies"] for r in got)


def test_expectation_is_kept(spark, tmp_path):
    rows = [(i, "a b c", "en", "s", 1) for i in range(400)] + [(1000 + i, "a b c", "en", "t", 1) for i in range(100)]
    got = mixing.copies(store(spark, tmp_path, rows)).collect()
    for low, high in ((0, 400), (1000, 1100)):
        some = [r for r in got if low <= r["doc_id"] < high]
        mean = some[0]["target"] / some[0]["source_size"]
        assert {r["copies"] for r in some} <= {int(mean), int(mean) + 1}
        assert abs(sum(r["copies"] for r in some) - mean * len(some)) <= 1


def test_nothing_to_mix(spark, tmp_path):
    assert mixing.copies(store(spark, tmp_path, [])).count() == 0
    got = mixing.copies(store(spark, tmp_path, [(1, None, None, None, None)])).collect()
    assert [(r["size"], r["target"], r["copies"]) for r in got] == [(0, 0.0, 0)]


def test_slots_are_a_keyed_permutation():
    for n in (1, 2, 3, 5, 64, 1000, 4097):
        assert sorted(order.permute(np.arange(n), n).tolist()) == list(range(n))
    assert (order.permute(np.arange(1000), 1000) != order.permute(np.arange(1000), 1000, key=1)).mean() > 0.9


def test_shards_hold_every_token_at_its_slot(spark, tmp_path):
    rng = random.Random(22)
    rows = corpus(80) + [(200, None, None, None, None), (201, "", "en", "s", 1), (None, "x y", "en", "s", 1),
                         (3, "  two\n\n runs  ", "en", "s", 1), (202, words(rng, 9000, 10 ** 6), "en", "s", 1)]
    df = store(spark, tmp_path, clashing(rows), DOCS + CLASH)
    session.checkpoint_dir(spark)
    folder, length, per = f"{tmp_path}/shards", 16, 50
    n = order.write_shards(df, folder, length=length, per_shard=per)
    listed = sorted(order.read_shards(spark, folder, length, per).collect(), key=lambda r: r["slot"])
    assert [r["slot"] for r in listed] == list(range(n))
    for first, stop in ((0, 1), (49, 51), (60, n), (per, 2 * per), (n, None), (7, 7), (123, None)):
        again = order.read_shards(spark, folder, length, per, first, stop).collect()
        assert sorted(again, key=lambda r: r["slot"]) == listed[first:stop]
    coder = order._encoder(order.VOCABULARY)
    assert isinstance(coder, tiktoken.Encoding)
    import glob
    stride, tokens = order.record(length).itemsize + 2, {}
    for r in listed:
        [name] = glob.glob(f"{folder}/shard={r['shard']}/part-*")
        with open(name, "rb") as f:
            f.seek((r["slot"] % per) * stride)
            row = np.frombuffer(f.read(stride - 2), order.record(length))[0]
            assert f.read(2) == b"\0\0"
        assert row["part"] == r["part"] and row["n"] == r["n_tokens"]
        assert (None if row["doc"] == order.NO_ID else row["doc"]) == r["doc_id"]
        tokens.setdefault((r["doc_id"], r["part"]), []).append(row["ids"][:row["n"]].tolist())
    for d, t, *_ in rows:
        if d == 3:
            continue  # two rows have this id
        ids = coder.encode_ordinary(t or "") + [order.END]
        for k in range(0, len(ids), length):
            assert tokens[d, k // length] == [ids[k:k + length]]
    assert order.materialise(df.where("doc_id < 0")).count() == 0


def test_pieces_do_not_change_tokens(monkeypatch):
    rng = random.Random(23)
    text = "".join(rng.choice(["a", " ", "the", "\n", "\t", "  ", "é", "9", "!", " of", "'s"]) for _ in range(3000))
    whole = order.tokens(text)
    monkeypatch.setattr(order, "PIECE", 40)
    assert order.tokens(text) == whole


def test_pipeline_stages(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        if name != "shards":
            assert out.columns == docs.columns, name
        path = f"{tmp_path}/{name}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        counts.append(docs.count())
    assert counts[0] >= counts[1] > counts[2] > counts[3] and counts[5] > 0
    whole = corpus_pipeline.run(spark, sf)
    assert sorted(map(tuple, whole.collect()), key=str) == sorted(map(tuple, docs.collect()), key=str)


def test_maps_may_be_among_the_columns(spark, tmp_path):
    from pyspark.sql import functions as F
    rows = [(i, "a b c " * (i % 4), "en", "st"[i % 2], 1) for i in range(30)] * 2
    df = store(spark, tmp_path, rows).withColumn("extra", F.create_map(F.lit("k"), F.col("doc_id")))
    df.write.parquet(f"{tmp_path}/maps")
    df = spark.read.parquet(f"{tmp_path}/maps")
    assert mixing.copies(df).count() == 60 and mixing.mix(df).columns == df.columns
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns and sorted(r["extra"]["k"] - r["doc_id"] for r in kept.collect()) == [0] * kept.count()


def test_order_does_not_depend_on_folders(spark, tmp_path):
    rows = corpus(120)
    key, found = "spark.sql.autoBroadcastJoinThreshold", []
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        for run in range(2):
            path = f"{tmp_path}/{run}"
            spark.createDataFrame(rows, DOCS).coalesce(4).write.parquet(path)
            mixing.mix(spark.read.parquet(path)).write.parquet(f"{path}-mixed")
            out = order.materialise(spark.read.parquet(f"{path}-mixed"), length=16, per_shard=50)
            found.append(sorted(map(tuple, out.collect())))
    finally:
        spark.conf.set(key, before)
    assert found[0] == found[1] and len(found[0]) > 100
