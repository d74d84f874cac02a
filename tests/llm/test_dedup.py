"""SimHash components and repeated windows against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash

from tslines.llm import simhash, substring
from llm.support import CLASH, DOCS, clashing, store, words


def plain_print(text):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    counts = [sum(xxhash.xxh64_intdigest(s, 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles)) if shingles else 0


def plain_components(rows):
    prints = [plain_print(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, f"{p:016x}", least.get(find(i))) for i, ((d, _), p) in enumerate(zip(rows, prints))),
                  key=str)


@pytest.fixture(scope="module")
def near():
    rng = random.Random(5)
    rows = [(None, "a b c"), (990, None), (991, ""), (992, "  \n"), (993, "One two"), (994, "one TWO"), (993, "One two")]
    for i in range(12):
        base = words(rng, rng.choice([4, 30, 200]))
        for j in range(rng.randrange(1, 6)):
            w = base.split()
            if j > 1:
                w[rng.randrange(len(w))] = "changed"
            rows.append((i * 10 + j, " ".join(w)))
    return rows


def test_components_match_brute_force(spark, near):
    df = spark.createDataFrame(near, "doc_id bigint, text string")
    got = simhash.near_duplicates(df).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_components(near)


def test_divided_units_link_the_same(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 5).astype(np.uint64)
    keys = set(base.tolist())
    for b in base.tolist():
        for _ in range(60):
            keys.add(b ^ (1 << int(rng.integers(64))) ^ (1 << int(rng.integers(64))))
    df = spark.createDataFrame([(int(np.uint64(k).view(np.int64)),) for k in keys], "fp bigint")

    def groups(unit):
        rows = simhash.components(simhash.links(df, unit=unit)).collect()
        return sorted(map(tuple, rows))
    assert groups(10) == groups(50_000)


def test_one_of_each_group_stays(spark, near):
    rows = [(d, t, "en", "s", 1) for d, t in near]
    df = spark.createDataFrame(clashing(rows), DOCS + CLASH)
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns
    expected = {c for d, _, c in plain_components(near)}
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted(expected, key=str)
    assert simhash.keep_first(df.limit(0)).count() == 0


def plain_repeats(rows, span):
    first, out = {}, []
    for d, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        w = (t or "").encode().split()
        for i in range(len(w) - span + 1):
            first.setdefault(tuple(w[i:i + span]), d)
    for d, t in rows:
        w = (t or "").encode().split()
        gone = set()
        for i in range(len(w) - span + 1):
            if d is not None and first[tuple(w[i:i + span])] < d:
                gone.update(range(i, i + span))
        rest = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("span, broadcast, bucket", [
    (50, True, substring.BUCKET), (8, False, substring.BUCKET), (50, True, 3000), (8, True, 1)])
def test_repeats_match_brute_force(spark, monkeypatch, span, broadcast, bucket):
    rng = random.Random(span)
    shared = [words(rng, 3 * span) for _ in range(4)]
    rows = [(None, shared[0]), (900, None), (901, ""), (902, " \t "), (903, shared[1]), (903, shared[1]),
            (903, shared[2]), (5, "again " * 700), (6, "again " * 300)]
    for i in range(40):
        parts = [words(rng, rng.randrange(60))]
        if i % 2:
            parts.insert(rng.randrange(2), rng.choice(shared))
        if i % 5 == 0:
            parts.append(shared[3].replace(" ", " \n", 20))
        rows.append((100 + i, "\n".join(parts)))
    rows += [(700 + i, shared[0] + " " + shared[1]) for i in range(30)]
    if not broadcast:
        monkeypatch.setattr(substring, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(substring, "LONGEST", 16)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    got = substring.without_repeats(df, span=span, texts=False, bucket=bucket).collect()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(substring.common.BATCH_ROWS))
    assert sorted((tuple(r) for r in got), key=str) == plain_repeats(rows, span)


def test_no_rows(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert substring.without_repeats(df).count() == 0
    assert simhash.near_duplicates(df).count() == 0


def test_long_texts_are_cut_without_losing_windows(monkeypatch):
    text = words(random.Random(1), 3000)
    cells = np.zeros(1 << substring.CELL_BITS, np.uint64)

    def windows():
        found = []
        for _, packed, first, n in substring.super_kmers(text, cells):
            w = packed.split()
            found += [(first + i, tuple(w[i:i + 50])) for i in range(n)]
        return sorted(found)
    whole = windows()
    monkeypatch.setattr(substring.common, "BLOCK", 700)
    assert windows() == whole and len(whole) == 2951


def thue_morse(bits):
    word = "a"
    for _ in range(bits):
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("bucket", [substring.BUCKET, 1])
def test_words_with_patterns_are_told_apart(spark, bucket):
    same = " ".join(f"w{i}" for i in range(49))
    rows = []
    for bits in (5, 6, 7, 10, 16):
        rows += [(len(rows) + i, f"{same} {w}") for i, w in enumerate(thue_morse(bits))]
    rows.append((100, rows[3][1] + " more"))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = substring.without_repeats(df, texts=False, bucket=bucket).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_repeats(rows, 50)
    assert {r["doc_id"]: r["n_removed"] for r in got if r["n_removed"]} == {100: 50}


def test_equal_hashes_are_not_equal_words(monkeypatch):
    import pandas as pd
    rng, span = random.Random(4), 6
    shared = [words(rng, 20) for _ in range(3)]
    rows = [(i, " ".join([words(rng, 9), rng.choice(shared), words(rng, 5)])) for i in range(30)]
    # all words of one length have one hash
    monkeypatch.setattr(substring, "_BYTES", tuple(np.full(256, 7 + k, np.uint64) for k in (0, 1)))
    cells = np.zeros(1 << substring.CELL_BITS, np.uint64)
    packed = [(0, p, d, 0, first, n) for d, t in rows for _, p, first, n in substring.super_kmers(t, cells, span)]
    marks = substring._decide(pd.DataFrame(packed, columns=["mini", "packed", "doc_id", "tag", "first", "n"]), span)
    gone = {}
    for r in marks.itertuples():
        gone.setdefault(r.doc_id, set()).update(range(r.start, r.end))
    want = {d: removed for d, _, removed, _ in plain_repeats(rows, span)}
    assert {d: len(gone.get(d, ())) for d, _ in rows} == want and sum(want.values()) > 300
