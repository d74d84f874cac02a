"""Bursts, sessions, slots, symbols and landing against small loops, with a dominant key."""

import bisect
import datetime as dt
import heapq

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tslines.operators import bursts, land, store, symbols

S = 1_000_000


def events(seed=1, n=1500, step=3 * S):
    rng = np.random.default_rng(seed)
    t = np.cumsum(rng.integers(0, step, n))
    return pd.DataFrame({"k": np.where(rng.random(n) < .4, 0, rng.integers(0, 12, n)),
                         "t": t - t % S})  # whole seconds: many ties


def loop_counts(pdf, window):
    out = {}
    for k, g in pdf.groupby("k"):
        ts = sorted(g["t"])
        for t in set(ts):
            out[k, t] = (ts.count(t), sum(t - window <= x <= t for x in ts))
    return out


def loop_alerts(counts, threshold, quiet):
    out, last = set(), {}
    for (k, t), (n, recent) in sorted(counts.items()):
        if recent >= threshold and (k not in last or t - last[k] > quiet):
            last[k] = t
            out.add((k, t, n, recent))
    return out


def test_counts_and_alerts(spark):
    pdf = events()
    df = spark.createDataFrame(pdf).repartition(6)
    want = loop_counts(pdf, 5 * S)
    for slices in (1, 3):
        got = bursts.counts(df, ["k"], "t", 5 * S, slices).collect()
        assert {(r["k"], r["t"]): (r["n_events"], r["n_recent"]) for r in got} == want
    alerts = loop_alerts(want, 3, 60 * S)
    assert alerts
    for plan in ({}, dict(spread_above=0, partitions=6, fan_in=2)):
        got = bursts.alerts(df, ["k"], "t", 5 * S, 3, 60 * S, **plan).collect()
        assert {(r["k"], r["t"], r["n_events"], r["n_recent"]) for r in got} == alerts


@pytest.mark.parametrize("seed", range(5))
def test_alerts_on_random_lines(spark, seed):
    """Dense and idle stretches, with steps that often hit the window's or the pause's end exactly."""
    rng = np.random.default_rng(seed)
    window, threshold, quiet = int(rng.integers(3, 9)), int(rng.integers(2, 5)), int(rng.integers(10, 30))
    steps = rng.choice([0, 1, window - 1, window, window + 1, quiet, quiet + 1], 400,
                       p=[.2, .3, .15, .15, .1, .05, .05])
    pdf = pd.DataFrame({"k": rng.integers(0, 3, 400), "t": np.cumsum(steps)})
    want = loop_alerts(loop_counts(pdf, window), threshold, quiet)
    df = spark.createDataFrame(pdf)
    for plan in ({}, dict(spread_above=0, partitions=4)):
        got = bursts.alerts(df, ["k"], "t", window, threshold, quiet, **plan).collect()
        assert {(r["k"], r["t"], r["n_events"], r["n_recent"]) for r in got} == want


def test_both_plans_keep_null_keys_and_positions(spark):
    rng = np.random.default_rng(31)
    rows = [(i, None if rng.random() < .3 else int(rng.integers(3)),
             None if rng.random() < .2 else int(rng.integers(200)), int(rng.integers(200)),
             None if rng.random() < .2 else int(rng.integers(200, 260))) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, k int, t bigint, v bigint, e bigint").repartition(5)
    timed = df.filter("t is not null")
    pick = lambda out: sorted(map(str, out.collect()))
    for make in (
            lambda above: land.lateness(df, ["k"], "v", "t", width=16, spread_above=above),
            lambda above: bursts.sessions(timed, ["k"], "t", 2, slice_us=16, spread_above=above),
            lambda above: bursts.concurrency(df, ["k"], "t", "e", 16, spread_above=above),
            lambda above: bursts.slots(df, ["k"], "t", "e", "id", slice_us=16, spread_above=above,
                                       **({} if above else dict(partitions=4)))):
        assert pick(make(0)) == pick(make(10**9))
    assert land.lateness(df, ["k"], "v", "t", width=16, spread_above=0).count() == 300
    assert bursts.slots(df, ["k"], "t", "e", "id", spread_above=0, partitions=4).count() == 300


def loop_sessions(pdf, gap):
    out = set()
    for k, g in pdf.groupby("k"):
        ts = sorted(g["t"])
        start, prev, n = ts[0], ts[0], 0
        for t in ts:
            if t - prev > gap:
                out.add((k, start, prev + gap, n))
                start, n = t, 0
            prev, n = t, n + 1
        out.add((k, start, prev + gap, n))
    return out


def test_sessions_and_concurrency(spark):
    pdf = events(2)
    df = spark.createDataFrame(pdf)
    want = loop_sessions(pdf, 6 * S)
    for above in (0, 10**9):
        got = bursts.sessions(df, ["k"], "t", 6 * S, slice_us=20 * S, spread_above=above)
        assert {(r["k"], r["start_us"], r["end_us"], r["n_events"]) for r in got.collect()} == want
    edges = {}
    for _, a, b, _ in want:
        edges[a] = edges.get(a, 0) + 1
        edges[b] = edges.get(b, 0) - 1
    level, expect = 0, {}
    for t in sorted(edges):
        level += edges[t]
        expect[t] = level
    for above in (0, 10**9):
        rows = bursts.concurrency(got.withColumn("g", F.lit(1)), ["g"], "start_us", "end_us",
                                  50 * S, spread_above=above)
        assert {r["at_us"]: r["n_open"] for r in rows.collect()} == expect


def loop_slots(rows):
    out, open_, free, fresh = {}, [], [], 0
    for start, end, i in sorted(rows):
        while open_ and open_[0][0] <= start:
            heapq.heappush(free, heapq.heappop(open_)[1])
        if free:
            slot = heapq.heappop(free)
        else:
            slot, fresh = fresh, fresh + 1
        heapq.heappush(open_, (end, slot))
        out[i] = slot
    return out


@pytest.mark.parametrize("length", [4, 60])
def test_slots(spark, length):
    rng = np.random.default_rng(length)
    n = 600
    start = np.cumsum(rng.integers(0, 4, n))
    pdf = pd.DataFrame({"id": np.arange(n), "g": 1, "s": start,
                        "e": start + rng.integers(1, length, n)})
    want = loop_slots(list(zip(pdf["s"], pdf["e"], pdf["id"])))
    # equal starts are ordered by end, then id, as in the loop
    df = spark.createDataFrame(pdf).repartition(5)
    # whole keys, busy periods, and periods over several partitions
    for plan in ({}, dict(spread_above=500), dict(spread_above=0, partitions=7),
                 dict(spread_above=0, partitions=7, rounds=1)):
        got = bursts.slots(df, ["g"], "s", "e", "e", "id", slice_us=16, **plan).collect()
        assert {r["id"]: r["slot"] for r in got} == want, plan


def test_symbols_with_a_dominant_value(spark):
    rng = np.random.default_rng(4)
    words = [None if r < .1 else "hot" if r < .4 else "unseen" if r < .6 else f"w{rng.integers(300)}"
             for r in rng.random(3000)]
    df = spark.createDataFrame(list(enumerate(words)), "id int, w string").repartition(6)
    table = symbols.dictionary(df.filter("w <> 'unseen'"), "w", partitions=5)
    codes = {w: i for i, w in enumerate(sorted({w for w in words if w} - {"unseen"}))}
    assert {r["symbol"]: r["code"] for r in table.collect()} == codes
    for limit in (1_000_000, 0):
        coded = symbols.encode(df, "w", table, broadcast_rows=limit)
        assert {r["id"]: r["code"] for r in coded.collect()} == {
            i: codes.get(w) for i, w in enumerate(words)}
        back = symbols.decode(coded.drop("w"), "code", table, "w", broadcast_rows=limit)
        assert {r["id"]: r["w"] for r in back.collect()} == {
            i: w if w in codes else None for i, w in enumerate(words)}


@pytest.mark.parametrize("n, bits", [(1, 8), (127, 8), (128, 16), (32_767, 16), (32_768, 32)])
def test_code_width(spark, n, bits):
    assert spark.range(1).select(symbols.code_width(F.lit(n))).first()[0] == bits


@pytest.mark.parametrize("keep", ["last", "first"])
def test_dedup_by_arrival(spark, keep):
    """Unknown instants stay; a known arrival is later than an unknown one; ties are determined."""
    rng = np.random.default_rng(6)
    rows = [(str(rng.integers(4)), None if rng.random() < .2 else int(rng.integers(5)),
             None if rng.random() < .3 else int(rng.integers(1000)), i) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, at bigint, arrival int, v int")
    got = [tuple(r) for r in land.dedup(df, ["k"], "at", "arrival", keep).collect()]
    best = {}
    for r in rows:
        if r[1] is not None:
            best.setdefault(r[:2], []).append(r)
    order = max if keep == "last" else min
    known = sorted(r for r in got if r[1] is not None)
    assert sorted(r[:2] for r in known) == sorted(best)
    for r in known:
        rank = lambda x: (x[2] is not None, x[2] or 0)
        assert rank(r) == rank(order(best[r[:2]], key=rank)) and r in best[r[:2]]
    assert sorted((r for r in got if r[1] is None), key=str) == sorted((r for r in rows if r[1] is None), key=str)
    again = land.dedup(df.repartition(7), ["k"], "at", "arrival", keep).collect()
    assert sorted(map(str, again)) == sorted(map(str, (land.dedup(df, ["k"], "at", "arrival", keep).collect())))


def test_conform_keeps_only_what_comes_back(spark):
    rows = [(0.1, 2**53 + 1, 1.25, "2020-05-01 00:00:00"), (0.5, 2**53, 1.5, "2020-05-01 00:00:01"),
            (float("nan"), None, None, None)]
    df = spark.createDataFrame(rows, "a double, b bigint, c double, d string").withColumn("d", F.col("d").cast("timestamp"))
    to = T.StructType.fromDDL("a float, b double, c decimal(5,1), d date")
    bad = sorted(r["column"] for r in land.conform_rejects(df, to).collect())
    assert bad == ["a", "b", "c", "d"] and land.conform(df, to).count() == 1


def test_second_load_adds_and_keeps_columns(spark, tmp_path):
    root = f"{tmp_path}/landed"
    base = "tbl string, at timestamp, x int"
    when = dt.datetime(2024, 5, 1, 12)
    assert store.land(spark.createDataFrame([("a", when, 1)], base), root).count() == 0
    more = spark.createDataFrame([("a", when, 2.0, "new"), ("b", None, 2.5, "lost")],
                                 "tbl string, at timestamp, x double, y string")
    assert [r["value"] for r in store.land(more, root).collect()] == ["2.5"]
    back = store.landed(spark, root)
    assert dict(back.dtypes)["x"] == "int"
    assert sorted(map(tuple, back.select("x", "y").collect())) == [(1, None), (2, "new")]


def test_sort_is_global(spark):
    df = spark.range(500).withColumn("at", F.hash("id").cast("bigint")).repartition(4)
    got = [r["at"] for r in land.sort(df, "at", "id", partitions=5).collect()]
    assert got == sorted(got)


def test_evolve_refuses_new_decimals(spark):
    a = spark.createDataFrame([(1,)], "x int")
    with pytest.raises(ValueError):
        land.append(a, a.withColumn("d", F.expr("1.5")))
    b = spark.createDataFrame([("2", 3.0)], "x string, y double")
    rows = sorted(map(tuple, land.append(a, b).collect()))
    assert rows == [(1, None), (2, 3.0)] and land.append(a, b).dtypes == [("x", "int"), ("y", "double")]


@pytest.mark.parametrize("kind,keeps,loses", [
    ("decimal(10,2)", ["1.23", "1.230", "-0.50", "1e2", "125e-2", "0.000", "12345678.9", "1.234e1", None],
     ["1.23456", "1e-3", "123456789012", "x", "1.234e-1", ""]),
    ("double", ["1.5", "0.1", "Infinity", "-inf", "NaN", "0", "-0.0", "1e308", "123456789012345", "100000000000000000000"],
     ["1e400", "1e-400", "x", "0.12345678901234567890123", "12345678901234567891"]),
    ("timestamp", ["2024-05-01 12:00:00", "2024-05-01 12:00:00.123456", "2024-05-01 12:00:00.123456000"],
     ["2024-05-01 12:00:00.123456789", "2024-05-01 12:00:00.0000001", "x"]),
    ("date", ["2024-05-01", "2024-05-01 00:00:00"], ["2024-05-01 12:00:00", "2024-05-01T00:00:01"]),
    ("int", ["1", " 7 ", "-5"], ["1.5", "3000000000", "x"]), ("boolean", ["true", "f"], ["x", "2"])])
def test_texts_that_would_change_are_rejects(spark, kind, keeps, loses):
    df = spark.createDataFrame([(v,) for v in keeps + loses], "x string")
    to = T.StructType([T.StructField("x", T.StructType.fromDDL(f"x {kind}")[0].dataType)])
    assert sorted(r["value"] for r in land.conform_rejects(df, to).collect()) == sorted(loses)
    assert land.conform(df, to).count() == len(keeps)


def test_conversions_are_made_once_for_a_row(spark):
    """No filter below the conversions repeats them, and cells that cannot be cast are not asked."""
    df = spark.range(3000).select(F.concat(F.col("id").cast("string"), F.lit(".5")).alias("a"),
                                  F.concat(F.lit("0."), F.col("id").cast("string")).alias("b"))
    to = T.StructType.fromDDL("a decimal(12,1), b double")
    for out in (land.conform(df, to), land.conform_rejects(df, to)):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("try_cast(a#") == 1 and plan.count("try_cast(b#") == 1
    assert land.conform(df, to).count() == 3000 and land.conform_rejects(df, to).count() == 0


@pytest.mark.parametrize("kind,keeps,loses", [
    ("double", ["+Infinity", "nan", "0e5", "0000000000000000000000.5", "1.50000000000000000000000", "5e-1"],
     ["1e-999", "-1e999", "0.1000000000000000055511151231257827", "e5", ".", "1.2.3"]),
    ("decimal(10,1)", ["0.00e-9", "1E1", "+7.10", "00012.50", "15e-1"], ["1.25E0", "-0.05", "7e-2", "1e", "e"]),
    ("bigint", ["+5", "-0", "007"], ["1e3", "5.", "0x1", "9223372036854775808", "NaN", ""])])
def test_odd_texts_that_would_change_are_rejects(spark, kind, keeps, loses):
    test_texts_that_would_change_are_rejects(spark, kind, keeps, loses)


def test_dense_windows_are_running_sums(spark):
    """What a window holds does not have to be added up anew for every instant."""
    df = spark.range(30_000).select((F.col("id") % 3).alias("k"), (F.col("id") * 7919 % 10_000_019 - 5_000_000).alias("t"))
    df = df.unionByName(df.filter("t % 5 = 0"))
    out = bursts.counts(df, ["k"], "t", 1_000_000, slice_windows=2)
    assert "RangeFrame, -" not in out._jdf.queryExecution().analyzed().toString()
    times = {}
    for k, t in map(tuple, df.collect()):
        times.setdefault(k, []).append(t)
    for v in times.values():
        v.sort()
    got = sorted(map(tuple, out.collect()))
    assert got == sorted((k, t, bisect.bisect_right(v, t) - bisect.bisect_left(v, t),
                          bisect.bisect_right(v, t) - bisect.bisect_left(v, t - 1_000_000))
                         for k, v in times.items() for t in set(v))
