"""Streams over several micro-batches, replay, and commit rules."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tslines import session
from tslines.operators import batch, bursts
from tslines.operators.batch import Limits
from tslines.sources import payloads, tables
from tslines.streaming import flows

SCHEMA = "id bigint, k bigint, t bigint, nb bigint"


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    """Six files in time order, so that a stream reads them as six micro-batches."""
    root = str(tmp_path_factory.mktemp("parts"))
    rng = np.random.default_rng(9)
    t = np.cumsum(rng.integers(1, 900_000, 600))
    rows = [(i, 0 if rng.random() < .4 else int(rng.integers(9)), int(x), int(rng.integers(5, 60)))
            for i, x in enumerate(t)]
    for i in range(6):
        part = spark.createDataFrame(rows[i * 100:(i + 1) * 100], SCHEMA)
        part.coalesce(1).write.mode("append").parquet(root)
    return root


def drain(spark, df, name):
    root = session.scratch(spark, name)
    q = (df.writeStream.format("parquet").option("path", f"{root}/out")
         .option("checkpointLocation", f"{root}/log").trigger(availableNow=True).start())
    q.awaitTermination()
    assert q.lastProgress is None or q.exception() is None
    return spark.read.schema(df.schema).parquet(f"{root}/out")


def stream(spark, root):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(root)


def test_stream_batches_equal_batch(spark, parts):
    limits = Limits(6, 150, 4000)
    how = dict(key=["k"], order=["t", "id"], time="t", size="nb")
    got = drain(spark, flows.assign(stream(spark, parts), limits, **how), "a")
    want = batch.assign(spark.read.parquet(parts), limits, **how)
    pick = lambda df: {(r["id"], r["batch_id"]) for r in df.collect()}
    assert pick(got) == pick(want)


def test_stream_alerts_equal_batch(spark, parts):
    how = ("t", 5_000_000, 3, 20_000_000)
    got = drain(spark, flows.alerts(stream(spark, parts), ["k"], *how), "b")
    want = bursts.alerts(spark.read.parquet(parts), ["k"], *how)
    rows = sorted(map(tuple, want.collect()))
    assert rows and sorted(map(tuple, got.collect())) == rows


def as_lines(df):
    cut = batch.assign(df.select("id", "k", "nb"), Limits(10, None, None), key=["k"], order=["id"])
    return cut.withColumn("line", F.concat(F.lit("t id="), F.col("id").cast("string"), F.lit("i")))


def test_flow_commits_every_micro_batch_once(spark, parts):
    root = session.scratch(spark, "flow")
    for _ in range(2):  # the second run finds nothing new
        flows.run(stream(spark, parts), as_lines, f"{root}/out", f"{root}/log", key=("k",),
                  order=["id"]).awaitTermination()
    out = payloads.read(spark, f"{root}/out")
    assert out.select("commit").distinct().count() == 6
    assert out.agg(F.sum("n_rows")).first()[0] == 600
    text = b"".join(bytes(r["payload"]) for r in out.collect()).decode().splitlines()
    assert sorted(text) == sorted(f"t id={i}i" for i in range(600))
    # a complete commit is not written again
    again = payloads.payloads(as_lines(spark.read.parquet(parts).filter("id < 100")), "k",
                              order=["id"])
    payloads.write(again, f"{root}/out", 0)
    assert payloads.read(spark, f"{root}/out").agg(F.sum("n_rows")).first()[0] == 600


def test_commits_are_all_or_nothing(spark):
    root = session.scratch(spark, "commits")
    good = spark.range(10).select("id", F.lit(1).alias("n_rows"))
    failing = spark.range(10).select("id", F.when(F.col("id") < 9, 1).otherwise(
        F.raise_error("no more")).cast("int").alias("n_rows"))
    with pytest.raises(Exception, match="no more"):
        payloads.write(failing, root, 0)
    assert not session.exists(spark, f"{root}/commit=0")
    payloads.write(good, root, 0)
    with pytest.raises(Exception, match="no more"):
        payloads.write(failing, root, 1)
    payloads.write(failing, root, 0)  # complete already, so it is skipped
    payloads.write(good.limit(3), root, 1)
    rows = payloads.read(spark, root).groupBy("commit").count().collect()
    assert {r["commit"]: r["count"] for r in rows} == {0: 10, 1: 3}


def test_payload_order_and_limit(spark):
    df = spark.range(0, 5000, 1, 7).withColumns({
        "batch_id": F.call_function("div", F.col("id"), F.lit(900)),
        "line": F.concat(F.lit("x"), F.col("id").cast("string"))})
    rows = {r["batch_id"]: r for r in payloads.payloads(df, order=["id"]).collect()}
    assert len(rows) == 6
    for b, r in rows.items():
        ids = range(b * 900, min(5000, (b + 1) * 900))
        assert bytes(r["payload"]).decode() == "".join(f"x{i}\n" for i in ids)
        assert (r["n_rows"], r["n_bytes"]) == (len(ids), len(r["payload"]))
    with pytest.raises(Exception, match="exceeds the limit"):
        payloads.payloads(df, order=["id"], limit=100).collect()


def test_text_files_keep_lines_with_line_ends_apart(spark):
    path = session.scratch(spark, "text")
    df = spark.createDataFrame([("t x=1i",), ('t x="a\\\nb"',)], "line string")
    [left] = payloads.fan_out(df, [lambda rows: payloads.write_text(rows, path)])
    assert [r["line"] for r in left.collect()] == ['t x="a\\\nb"']
    assert [r["line"] for r in payloads.text_files(spark, path).collect()] == ["t x=1i"]


def test_synthetic_load_is_deterministic(spark):
    for kind in ("mixed", "pairs", "escapes", "unicode", "integers", "trades"):
        a = tables.synthetic(spark, 500, kind, seed=3, null_share=.2, partitions=2)
        b = tables.synthetic(spark, 500, kind, seed=3, null_share=.2, partitions=7)
        c = tables.synthetic(spark, 500, kind, seed=4, null_share=.2)
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
        assert sorted(map(str, a.collect())) != sorted(map(str, c.collect()))
        nulls = a.select(F.count_if(F.col(a.columns[1]).isNull())).first()[0]
        assert 50 < nulls < 160


def test_generator_feeds_a_stream(spark):
    rate = spark.readStream.format("rate").option("rowsPerSecond", 5).load()
    df = tables.fill(rate.select(F.col("value").alias("id")), "trades")
    assert df.isStreaming and df.columns == ["id", "symbol", "side", "price", "qty"]


def test_build_agrees_with_separate_steps(spark):
    df = spark.range(0, 3000, 1, 5).select(
        "id", (F.col("id") % 3).alias("k"),
        F.concat(F.lit("x"), F.col("id").cast("string")).alias("line"),
        (F.length(F.col("id").cast("string")) + 2).cast("bigint").alias("n_bytes"))
    rows = [sorted((r["k"], r["batch_id"], r["n_rows"], bytes(r["payload"])) for r in payloads.build(
        df, Limits(40, 150, None), key=["k"], order=["id"], size="n_bytes", **plan).collect())
        for plan in ({}, dict(spread_above=0, partitions=6))]
    assert rows[0] == rows[1] and sum(r[2] for r in rows[0]) == 3000
