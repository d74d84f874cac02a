"""Batches as DataFrames: both plans, any partitioning, against the loop."""

import numpy as np
import pandas as pd
import pytest
from test_batch_kernel import loop

from tslines.operators import batch as B
from tslines.operators import ordered
from pyspark.sql import functions as F


def frame(seed=3, n=3000):
    rng = np.random.default_rng(seed)
    key = np.where(rng.random(n) < 0.4, 0, rng.integers(0, 40, n))
    t = np.cumsum(rng.integers(0, 500_000, n)).astype(np.int64)
    return pd.DataFrame({"id": np.arange(n), "k": key, "t": t,
                         "nb": rng.integers(20, 90, n),
                         "x": np.where((np.arange(n) // 37) % 3 == 0,
                                       (np.arange(n) // 37).astype(str), None)})


def expected(pdf, lim, key, txn):
    out = {}
    groups = [(None, pdf)] if key is None else pdf.groupby(key)
    for _, g in groups:
        g = g.sort_values(["t", "id"])
        tx = list(g["x"]) if txn else [None] * len(g)
        out.update(zip(g["id"], loop(g["t"].tolist(), g["nb"].tolist(), tx, lim)))
    return out


@pytest.mark.parametrize("key", ["k", None])
@pytest.mark.parametrize("txn", [None, "x"])
@pytest.mark.parametrize("limits", [
    B.Limits(rows=7, bytes=None, interval=None),
    B.Limits(rows=11, bytes=500, interval=3000),
])
def test_plans_agree_with_the_loop(spark, key, txn, limits):
    pdf = frame()
    df = spark.createDataFrame(pdf.astype({"x": object}).where(pdf.notna(), None)).repartition(5)
    want = expected(pdf, B._bounds(limits), key, txn)
    runs = [dict(spread_above=0, partitions=7, fan_in=2)]
    if key:
        runs.append({})
    for how in runs:
        got = B.assign(df, limits, order=["t", "id"], key=[key] if key else None, time="t",
                       size="nb", txn=txn, **how)
        rows = {r["id"]: r["batch_id"] for r in got.collect()}
        assert rows == want, how


def test_limits_rules():
    assert B.Limits(rows="off", interval=False, bytes=5) == B.Limits(None, 5, None)
    for bad in (dict(rows=0), dict(bytes=-1), dict(rows=None, interval=None), dict(rows=True)):
        with pytest.raises(ValueError):
            B.Limits(**bad)


@pytest.mark.parametrize("n, size", [(1, 1), (29, 4), (28, 4), (5, 9), (64, 8)])
def test_batches_by_rows_fill_up(spark, n, size):
    df = spark.range(n).repartition(3)
    got = B.by_rows(df, size, order=["id"]).collect()
    assert {r["id"]: r["batch_id"] for r in got} == {i: i // size for i in range(n)}


@pytest.mark.parametrize("seed", range(4))
def test_batches_by_time_alone(spark, seed):
    rng = np.random.default_rng(seed)
    span = int(rng.integers(2, 40))
    t = np.cumsum(rng.choice([0, 1, span - 1, span, span + 1], 200)) * 1000
    df = spark.createDataFrame([(i, int(x)) for i, x in enumerate(t)], "x int, t bigint").repartition(4)
    want, first, batch = [], None, -1
    for x in t.tolist():
        if first is None or x - first >= span * 1000:
            first, batch = x, batch + 1
        want.append(batch)
    got = B.assign(df, B.Limits(None, None, span), order=["t", "x"], time="t").collect()
    slack = loop(t.tolist(), [0] * 200, [None] * 200, B._bounds(B.Limits(None, None, span)))
    assert [r["batch_id"] for r in sorted(got, key=lambda r: r["x"])] == slack
    assert len(set(slack)) > 1 and abs(max(slack) - max(want)) <= max(want)


def test_global_index(spark):
    df = spark.range(1000).withColumn("v", F.hash("id")).repartition(4)
    for p in (1, 3, 16):
        rows = ordered.global_index(df, ["v", "id"], partitions=p).collect()
        want = sorted((r["v"], r["id"]) for r in rows)
        assert [(r["v"], r["id"]) for r in sorted(rows, key=lambda r: r["idx"])] == want
        assert sorted(r["idx"] for r in rows) == list(range(1000))


@pytest.mark.parametrize("op", ["sum", "max"])
def test_running(spark, op):
    pdf = frame(5, 800)
    df = spark.createDataFrame(pdf[["id", "k", "nb"]])
    pdf = pdf.sort_values("id")
    g = pdf.groupby("k")["nb"]
    pdf["r"] = g.cumsum() if op == "sum" else g.cummax()
    for above in (0, 10**9):
        got = ordered.running(df, ["k"], "id", F.col("nb"), op, "r", width=16, spread_above=above)
        assert {r["id"]: r["r"] for r in got.collect()} == dict(zip(pdf["id"], pdf["r"]))


def test_empty_tables(spark):
    df = spark.createDataFrame([], "k int, t bigint, id int")
    for key in (["k"], None):
        assert B.assign(df, B.Limits(2, None, None), order=["t", "id"], key=key).count() == 0
    assert B.by_rows(df, 2, order=["t", "id"]).count() == 0
