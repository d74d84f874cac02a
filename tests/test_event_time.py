"""Streams whose rows come in any order, against the batch operators."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tslines import session
from tslines.operators import bursts
from tslines.streaming import event_time

START = dt.datetime(2024, 5, 1)


def drain(spark, df, name):
    query = (df.writeStream.format("memory").queryName(name).outputMode("append")
             .option("checkpointLocation", session.scratch(spark, name)).trigger(availableNow=True).start())
    query.awaitTermination()
    left = sum(s["numRowsTotal"] for s in query.lastProgress["stateOperators"])
    return spark.table(name), left


def arrivals(spark, rows, schema, files=5):
    """A stream of files in the order given."""
    root = session.scratch(spark, "arrivals")
    size = -(-len(rows) // files)
    for i in range(0, len(rows), size):
        spark.createDataFrame(rows[i:i + size], schema).coalesce(1).write.mode("append").parquet(root)
    return root, spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(root)


def test_alerts_of_shuffled_arrivals(spark):
    rng = random.Random(1)
    rows = []
    for k in range(4):
        t = 0
        for _ in range(150):
            t += rng.choice([0, 1, 1, 2, 40]) * 1_000_000
            rows.append((k, START + dt.timedelta(microseconds=t)))
    rows.sort(key=lambda r: r[1] + dt.timedelta(seconds=rng.randrange(60)))
    rows.append((9, START + dt.timedelta(days=9)))
    root, stream = arrivals(spark, rows, "k int, at timestamp")
    how = (5_000_000, 4, 20_000_000)
    got, left = drain(spark, event_time.alerts(stream, ["k"], "at", "60 seconds", *how), "shuffled_alerts")
    plain = spark.read.schema("k int, at timestamp").parquet(root).select("k", F.unix_micros("at").alias("at_us"))
    want = bursts.alerts(plain, ["k"], "at_us", *how)
    rows = sorted(map(tuple, want.collect()))
    assert len(rows) > 10 and sorted(map(tuple, got.select(*want.columns).collect())) == rows
    # only the row that moved the watermark still waits
    assert left <= 3


def test_slots_of_shuffled_arrivals(spark):
    rng = random.Random(2)
    rows = []
    for i in range(300):
        at = START + dt.timedelta(seconds=rng.randrange(3000))
        rows.append((i % 3, i, at, at + dt.timedelta(seconds=rng.choice([0, 5, 60, 400]))))
    rows.sort(key=lambda r: r[2] + dt.timedelta(seconds=rng.randrange(120)))
    last = START + dt.timedelta(days=9)
    rows.append((9, 1000, last, last))
    schema = "k int, id int, start timestamp, stop timestamp"
    root, stream = arrivals(spark, rows, schema)
    got, left = drain(spark, event_time.slots(stream, ["k"], "start", "stop", "id", delay="2 minutes"), "shuffled_slots")
    plain = spark.read.schema(schema).parquet(root).where("k < 9").select(
        "k", "id", F.unix_micros("start").alias("start_us"), F.unix_micros("stop").alias("end_us"))
    want = sorted(map(tuple, bursts.slots(plain, ["k"], "start_us", "end_us", "id").collect()))
    assert sorted(map(tuple, got.where("k < 9").collect())) == want and max(r[-1] for r in want) > 3
    assert left <= 3


def test_sessions_without_ends_keep_their_slots(spark):
    at = [START + dt.timedelta(minutes=i) for i in range(4)]
    rows = [(1, 0, at[0], None), (1, 1, at[1], at[2]), (1, 2, None, at[2]), (1, 3, at[3], at[3]),
            (9, 9, START + dt.timedelta(days=9), None)]
    _, stream = arrivals(spark, rows, "k int, id int, start timestamp, stop timestamp", 2)
    got, _ = drain(spark, event_time.slots(stream, ["k"], "start", "stop", "id", delay="1 minute"), "endless_slots")
    assert sorted((r["id"], r["end_us"] is None, r["slot"]) for r in got.where("k = 1").collect()) == [
        (0, True, 0), (1, False, 1), (3, False, 1)]
