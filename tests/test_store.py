"""Commits of landed rows: replay, conflicts, late rows, stored duplicates."""

import datetime as dt
import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tslines.catalog import landing
from tslines.operators import store

SCHEMA = "tbl string, at timestamp, id bigint, v double"
START = dt.datetime(2024, 5, 1)


def some(rng, n, first=0, days=3):
    return [(rng.choice("ab"), START + dt.timedelta(seconds=rng.randrange(86400 * days)), first + i, float(i))
            for i in range(n)]


def plain(df, *more):
    return sorted(map(tuple, df.select("tbl", "at", "id", "v", *more).collect()), key=repr)


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def check_files(spark, root):
    """Files of a day are apart, and rows inside are in order."""
    by = {}
    for r in store.files(spark, root).collect():
        by.setdefault((r["tbl"], r["day"]), []).append((r["first_us"], r["last_us"], r["n_rows"]))
    for spans in by.values():
        spans.sort()
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    rows = store.landed(spark, root).select("at", F.col("_metadata.file_path").alias("f"),
                                            F.col("_metadata.row_index").alias("i")).collect()
    last = {}
    for r in sorted(rows, key=lambda r: (r["f"], r["i"])):
        assert last.get(r["f"], r["at"]) <= r["at"]
        last[r["f"]] = r["at"]
    assert sum(n for s in by.values() for *_, n in s) == len(rows)


def test_loads_in_any_order(spark, tmp_path):
    rng, root = random.Random(1), f"{tmp_path}/r"
    rows = some(rng, 400)
    for i in range(5):
        store.land(frame(spark, rows[i::5]), root, commit=f"c{i}")
        check_files(spark, root)
    assert plain(store.landed(spark, root)) == sorted(rows, key=repr)
    assert plain(store.landed(spark, root, version=1)) == sorted(rows[0::5] + rows[1::5], key=repr)
    for i in (3, 0):
        store.land(frame(spark, rows[i::5]), root, commit=f"c{i}")
    assert len(store.history(spark, root)) == 5 and store.landed(spark, root).count() == 400
    one = store.landed(spark, root, where="tbl = 'a' AND day = date'2024-05-02'")
    assert plain(one) == sorted((r for r in rows if r[0] == "a" and r[1].day == 2), key=repr)


def test_last_arrival_stays(spark, tmp_path):
    rng, root = random.Random(2), f"{tmp_path}/r"
    rows = some(rng, 200)
    land = lambda rs, **how: store.land(frame(spark, rs), root, keys=["tbl", "id"], **how)
    land(rows)
    before = plain(store.files(spark, root).select(F.col("tbl"), F.lit(None).alias("at"), F.col("path").alias("id"),
                                                   F.col("n_rows").alias("v")))
    land(rows[::7] + rows[::7])
    after = plain(store.files(spark, root).select(F.col("tbl"), F.lit(None).alias("at"), F.col("path").alias("id"),
                                                  F.col("n_rows").alias("v")))
    assert before == after
    changed = [(*r[:3], r[3] + 0.5) for r in rows[::9] if r[1].day == 1]
    land(changed + rows[1::9] + some(rng, 30, 1000))
    new = {r[2]: r for r in rows} | {r[2]: r for r in changed}
    got = plain(store.landed(spark, root).where("id < 1000"))
    assert got == sorted(new.values(), key=repr) and store.landed(spark, root).count() == 230
    check_files(spark, root)
    # of rows of one frame the last arrival stays
    twice = spark.createDataFrame([("a", START, 5000, 1.0, 2), ("a", START, 5000, 2.0, 1)], SCHEMA + ", n int")
    store.land(twice, root, keys=["tbl", "id"], arrival="n")
    assert [r["v"] for r in store.landed(spark, root).where("id = 5000").collect()] == [1.0]
    # rows without an instant are never the same
    none = [("a", None, 1, 1.0), ("a", None, 1, 1.0), ("a", None, None, None)]
    land(none)
    land(none)
    assert store.landed(spark, root).where("at > '2025-01-01'").count() == 6
    # NULL is a key like any other
    land([("a", START, None, 1.0)])
    land([("a", START, None, 3.0), ("a", START, None, 3.0)])
    assert [r["v"] for r in store.landed(spark, root).where(f"id IS NULL AND at = '{START}'").collect()] == [3.0]


def test_one_instant_in_several_files(spark, tmp_path):
    root = f"{tmp_path}/r"
    same = [("a", START, i, float(i)) for i in range(3000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        store.land(frame(spark, same), root, keys=["id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert store.files(spark, root).count() > 1
    store.land(frame(spark, [(*r[:3], r[3] + 1) for r in same[::100]] + [("a", START, 9999, 0.0)]), root, keys=["id"])
    want = [(*r[:3], r[3] + (r[2] % 100 == 0)) for r in same] + [("a", START, 9999, 0.0)]
    assert plain(store.landed(spark, root)) == sorted(want, key=repr)
    check_files(spark, root)


def test_killed_writes_and_conflicts(spark, tmp_path, monkeypatch):
    rng, root = random.Random(3), f"{tmp_path}/r"
    rows = some(rng, 90)

    def die(*_):
        raise KeyboardInterrupt

    store.land(frame(spark, rows[:30]), root)
    with monkeypatch.context() as m:
        m.setattr(store, "_claim", die)
        with pytest.raises(KeyboardInterrupt):
            store.land(frame(spark, rows[30:60]), root, commit="x")
    assert plain(store.landed(spark, root)) == sorted(rows[:30], key=repr)
    # another writer takes the number, first with the same days, then with others
    real, other = store._claim, [rows[30:60], [("z", START, 1, 1.0)]]

    def late(*how):
        if other:
            theirs = other.pop(0)
            with pytest.MonkeyPatch.context() as m:
                m.setattr(store, "_claim", real)
                store.land(frame(spark, theirs), root, commit="x" if len(theirs) > 1 else "z")
        return real(*how)

    monkeypatch.setattr(store, "_claim", late)
    store.land(frame(spark, rows[60:]), root, commit="y")
    monkeypatch.setattr(store, "_claim", real)
    assert [c.name for c in store.history(spark, root)][1:] == ["x", "z", "y"]
    assert plain(store.landed(spark, root)) == sorted([*rows, ("z", START, 1, 1.0)], key=repr)
    check_files(spark, root)
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: store.land(frame(spark, some(rng, 10, 100 * i)), root, commit=i), range(4)))
    assert sorted(c.version for c in store.history(spark, root)) == list(range(8))
    assert store.landed(spark, root).count() == 131


def test_names_as_the_session_compares_them(spark, tmp_path):
    root = f"{tmp_path}/r"
    store.land(spark.createDataFrame([("a", START, 1, 1.0)], SCHEMA), root)
    store.land(spark.createDataFrame([("a", START, 2, 2.0, "e")], "TBL string, At timestamp, ID bigint, V double, Neu string"),
               root, keys=["Id"])
    store.land(spark.createDataFrame([("a", START, 3, "x")], "tbl string, at timestamp, id int, neu string"), root)
    back = store.landed(spark, root)
    assert back.columns == ["tbl", "at", "id", "v", "day", "Neu"]
    assert sorted((r["id"], r["Neu"]) for r in back.collect()) == [(1, None), (2, "e"), (3, "x")]
    with pytest.raises(ValueError, match="twice"):
        store.land(spark.createDataFrame([("a", START, 1, 1, 2)], "tbl string, at timestamp, id int, x int, X int"), root)
    with pytest.raises(ValueError, match="must exist"):
        store.land(spark.createDataFrame([("a", START)], "tbl string, at timestamp").withColumn(
            "d", F.lit(1).cast("decimal(5,1)")), root)
    with pytest.raises(ValueError, match="no column"):
        store.land(spark.createDataFrame([("a", 1)], "tbl string, id int"), root)
    with pytest.raises(ValueError, match="nothing"):
        store.landed(spark, f"{tmp_path}/none")
    assert len(store.history(spark, root)) == 3


def test_rejects_stay_with_their_commit(spark, tmp_path):
    root = f"{tmp_path}/r"
    store.land(spark.createDataFrame([("a", START, 1, 1.0)], SCHEMA), root)
    bad = spark.createDataFrame([("a", START, "x", 1.0), ("a", START, "7", 1.0)], "tbl string, at timestamp, id string, v double")
    assert [r["value"] for r in store.land(bad, root, commit="b").collect()] == ["x"]
    assert [r["value"] for r in store.land(bad, root, commit="b").collect()] == ["x"]
    assert sorted(r["id"] for r in store.landed(spark, root).collect()) == [1, 7]
    empty = spark.createDataFrame([], SCHEMA)
    assert store.land(empty, root).count() == 0 and store.landed(spark, root).count() == 2
    store.land(empty, f"{tmp_path}/new")
    assert store.landed(spark, f"{tmp_path}/new").count() == 0


def _busy_days(spark, folder, each):
    """Two days of events, `each` rows at every one of 2,000 instants a day."""
    ts = F.timestamp_micros(F.lit(1_714_521_600_000_000) + F.col("id") % 4000 * 43_000_000)
    spark.range(4000 * each).select(
        F.col("id").alias("event_id"), ts.cast("timestamp_ntz").alias("ts"), (F.col("id") % 7).alias("user_id"),
        F.lit("click").alias("event_type"), F.lit(0.5).alias("value"), F.lit("{}").alias("props"),
    ).write.parquet(f"{folder}/events.parquet")
    return folder


def test_late_rows_whose_sum_is_beyond_64_bits(spark, tmp_path):
    folder = _busy_days(spark, f"{tmp_path}/events", 6)
    got = {r["day"]: r for r in landing.land_late(spark, folder).collect()}
    want = {}
    for r in spark.read.parquet(f"{folder}/events.parquet").select("ts").collect():
        us = (r["ts"] - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
        n, total = want.get(str(r["ts"].date()), (0, 0))
        want[str(r["ts"].date())] = (n + 1, total + us)
    assert {d: (r["n_rows"], int(r["sum_us"])) for d, r in got.items()} == want
    assert max(total for _, total in want.values()) > 1 << 63
    assert all(r["apart"] and r["sorted"] for r in got.values())
