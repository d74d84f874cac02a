"""Queries over sources, sinks and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tslines import session
from tslines.catalog import batches, groups
from tslines.functions import times
from tslines.operators import batch, decode
from tslines.operators.batch import Limits
from tslines.operators.encode import encode
from tslines.plans import roles
from tslines.sources import messages, payload_files, payloads, tables
from tslines.streaming import event_time, flows

DAY_MS = 86_400_000
PLAIN = """
SELECT event_id, user_id, event_type, value, props, epoch_us(ts) AS at_us FROM events"""


def _lines(ev: DataFrame, version: int = 1) -> DataFrame:
    """Event lines with batches per table, ready for payloads."""
    plan = roles.resolve(ev, table="events", symbols=["event_type"], at="ts", version=version)
    lines = encode(ev, plan, "event_id", "user_id")
    return batch.assign(lines, Limits(50, 4000, None), key=["user_id"], order=["event_id"],
                        size="n_bytes")


def _plain(rows: DataFrame, version: int = 1) -> DataFrame:
    value = decode.field("value").cast("double") if version == 1 else decode.field(
        "value", "number")
    at = times.nanos_to_micros(F.col("at")) if version == 1 else F.col("at")
    return rows.filter("ok").select(
        decode.field("event_id").cast("bigint").alias("event_id"),
        decode.field("user_id").cast("bigint").alias("user_id"),
        decode.symbol("event_type").alias("event_type"), value.alias("value"),
        decode.field("props").alias("props"), at.alias("at_us"))


def parquet_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Nanoseconds as BIGINT, values, NaN and null survive a Parquet round trip."""
    path = session.scratch(session.configure(spark), "parquet")
    ev = tables.table(spark, sf, "events").select(
        "event_id", "event_type", (times.micros(F.col("ts")) * 1000).alias("ns"),
        F.when(F.col("value") < 10, F.lit(float("nan"))).when(
            F.col("value") < 90, F.col("value")).alias("value"))
    ev.write.parquet(path)
    back = tables.parquet(spark, path)
    return back.select("event_id", "event_type", "ns", "value")


PARQUET_ROUNDTRIP = """
SELECT event_id, event_type, epoch_us(ts) * 1000 AS ns,
  CASE WHEN value < 10 THEN 'NaN'::DOUBLE WHEN value < 90 THEN value END AS value
FROM events"""


def payload_frames(spark: SparkSession, sf: str) -> DataFrame:
    """Lines joined into payloads per batch, cut apart again and decoded."""
    lines = _lines(tables.table(spark, sf, "events"))
    joined = payloads.payloads(lines, "user_id", order=["event_id"])
    text = joined.select(F.decode("payload", "utf-8").alias("payload"))
    return _plain(decode.text_lines(decode.split_text(text)))


PAYLOAD_FRAMES = PLAIN


def payload_frames_binary(spark: SparkSession, sf: str) -> DataFrame:
    lines = _lines(tables.table(spark, sf, "events"), version=2)
    joined = payloads.payloads(lines, "user_id", order=["event_id"])
    return _plain(decode.binary_lines(decode.split_binary(joined)), version=2)


PAYLOAD_FRAMES_BINARY = PLAIN


def message_files(spark: SparkSession, sf: str) -> DataFrame:
    """Binary payloads as message files, cut by many tasks and decoded."""
    lines = _lines(tables.table(spark, sf, "events"), version=2)
    path = session.scratch(spark, "messages")
    messages.write(payloads.payloads(lines, "user_id", order=["event_id"]), path)
    return _plain(decode.binary_lines(messages.read(spark, path)), version=2)


MESSAGE_FILES = PLAIN


def payload_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and bytes of each payload agree with the batch it came from."""
    lines = _lines(tables.table(spark, sf, "events"))
    joined = payloads.payloads(lines, "user_id", order=["event_id"])
    return joined.select("user_id", "batch_id", "n_rows",
                         (F.octet_length("payload") == F.col("n_bytes")).alias("whole"),
                         F.endswith(F.col("payload"), F.lit(b"\n")).alias("complete"))


_LEDGER_ROWS = """
e AS (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn,
  strlen('events,event_type=' || event_type || ' event_id=' || event_id || 'i,user_id=' || user_id
  || 'i,value=' || CAST(value AS VARCHAR) || ',props="' || replace(props, '"', '..') || '" '
  || epoch_us(ts) * 1000) + 1 AS nb FROM events),
s AS (SELECT user_id, event_id, rn, CAST(0 AS BIGINT) AS batch_id, 1 AS rows,
    CAST(nb AS BIGINT) AS size FROM e WHERE rn = 1
  UNION ALL
  SELECT e.user_id, e.event_id, e.rn,
    batch_id + CASE WHEN rows >= 50 OR size >= 4000 THEN 1 ELSE 0 END,
    CASE WHEN rows >= 50 OR size >= 4000 THEN 1 ELSE rows + 1 END,
    CAST(CASE WHEN rows >= 50 OR size >= 4000 THEN 0 ELSE size END + e.nb AS BIGINT)
  FROM s JOIN e ON e.user_id = s.user_id AND e.rn = s.rn + 1)"""
PAYLOAD_LEDGER = f"""
WITH RECURSIVE {_LEDGER_ROWS}
SELECT user_id, batch_id, count(*) AS n_rows, true AS whole, true AS complete
FROM s GROUP BY user_id, batch_id"""


def payload_build(spark: SparkSession, sf: str) -> DataFrame:
    """Batches cut and joined in one go; sizes and line counts of each payload."""
    ev = tables.table(spark, sf, "events")
    plan = roles.resolve(ev, table="events", symbols=["event_type"], at="ts", version=1)
    lines = encode(ev, plan, "event_id", "user_id")
    joined = payloads.build(lines, Limits(50, 4000, None), key=["user_id"], order=["event_id"],
                            size="n_bytes")
    return joined.select("user_id", "batch_id", "n_rows", "n_bytes", F.size(
        F.split(F.decode("payload", "utf-8"), "\n")).alias("n_ends"))


PAYLOAD_BUILD = f"""
WITH RECURSIVE {_LEDGER_ROWS}
SELECT s.user_id, batch_id, count(*) AS n_rows, CAST(sum(nb) AS BIGINT) AS n_bytes,
  CAST(count(*) + 1 AS INTEGER) AS n_ends
FROM s JOIN e ON s.user_id = e.user_id AND s.rn = e.rn GROUP BY s.user_id, batch_id"""


def fan_out(spark: SparkSession, sf: str) -> DataFrame:
    """The same lines to a payload table and to text files."""
    root = session.scratch(session.configure(spark), "fan")
    lines = _lines(tables.table(spark, sf, "events"))
    payloads.fan_out(lines, [
        lambda df: payloads.write(
            payloads.payloads(df, "user_id", order=["event_id"]), f"{root}/payloads", 0),
        lambda df: payloads.write_text(df, f"{root}/text")])
    sent = payloads.read(spark, f"{root}/payloads").agg(
        F.lit("payloads").alias("sink"), F.sum("n_rows").alias("n_rows"),
        F.sum("n_bytes").alias("n_bytes"))
    text = payloads.text_files(spark, f"{root}/text").agg(
        F.lit("text").alias("sink"), F.count("*").alias("n_rows"),
        F.sum(F.octet_length("line") + 1).cast("bigint").alias("n_bytes"))
    return sent.unionByName(text)


FAN_OUT = f"""
WITH RECURSIVE {_LEDGER_ROWS}, t AS (SELECT count(*) AS n, CAST(sum(nb) AS BIGINT) AS b FROM e)
SELECT 'payloads' AS sink, n AS n_rows, b AS n_bytes FROM t UNION ALL SELECT 'text', n, b FROM t"""


def sink_replay(spark: SparkSession, sf: str) -> DataFrame:
    """A commit that is written twice counts once."""
    path = session.scratch(session.configure(spark), "replay")
    lines = _lines(tables.table(spark, sf, "events"))
    joined = payloads.payloads(lines, "user_id", order=["event_id"])
    for commit in (0, 1, 1):
        part = joined.filter(F.col("user_id") < 50 if commit == 0 else F.col("user_id") >= 50)
        payloads.write(part, path, commit)
    return payloads.read(spark, path).groupBy(F.col("commit").cast("int").alias("commit")).agg(
        F.sum("n_rows").alias("n_rows"), F.count_distinct("user_id").alias("n_users"))


SINK_REPLAY = """
SELECT CASE WHEN user_id < 50 THEN 0 ELSE 1 END AS "commit", count(*) AS n_rows,
  count(DISTINCT user_id) AS n_users FROM events GROUP BY 1"""


def _finish(query) -> None:
    query.awaitTermination()


def stream_equals_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Rows streamed into payloads and decoded are the rows of the table."""
    root = session.scratch(session.configure(spark), "stream")
    _finish(flows.run(tables.stream(spark, sf, "events"), _lines, f"{root}/out", f"{root}/log",
                      key=("user_id",), order=["event_id"]))
    back = payloads.read(spark, f"{root}/out").select(
        F.decode("payload", "utf-8").alias("payload"))
    return _plain(decode.text_lines(decode.split_text(back)))


STREAM_EQUALS_BATCH = PLAIN


def _stream_table(df: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    """Run a stream to its end into a table and read that."""
    root = session.scratch(spark, name)
    _finish(df.writeStream.format("parquet").option("path", f"{root}/out")
            .option("checkpointLocation", f"{root}/log").trigger(availableNow=True).start())
    return spark.read.schema(df.schema).parquet(f"{root}/out")


def stream_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Batches cut by a stateful stream."""
    ev = tables.stream(session.configure(spark), sf, "events").select(
        "event_id", "user_id", times.micros(F.col("ts")).alias("t"),
        (F.length("props") + 40).cast("bigint").alias("nb"))
    cut = flows.assign(ev, Limits(5, 240, DAY_MS), key=["user_id"], order=["t", "event_id"],
                       time="t", size="nb")
    return _stream_table(cut, spark, "cut").select("event_id", "user_id", "batch_id")


def stream_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """Burst alerts raised by a stateful stream."""
    ev = tables.stream(session.configure(spark), sf, "events").select(
        "user_id", times.micros(F.col("ts")).alias("t"))
    day = DAY_MS * 1000
    return _stream_table(flows.alerts(ev, ["user_id"], "t", day, 4, 2 * day), spark, "alerts")


def _late(rows: DataFrame, at: str, last: DataFrame) -> DataFrame:
    """A stream of four files whose rows come up to 30 days late, then one row that ends it."""
    spark = rows.sparkSession
    kept, root = session.scratch(spark, "kept"), session.scratch(spark, "late")
    month = 30 * DAY_MS * 1000
    rows.withColumn("arrive", F.unix_micros(at) + F.pmod(F.xxhash64(*rows.columns), F.lit(month))).write.parquet(kept)
    kept = spark.read.parquet(kept)
    cuts = [0, *kept.approxQuantile("arrive", [0.25, 0.5, 0.75], 0.01), 1e19]
    for low, high in zip(cuts[:-1], cuts[1:]):
        some = kept.filter((F.col("arrive") >= low) & (F.col("arrive") < high))
        some.drop("arrive").coalesce(1).write.mode("append").parquet(root)
    last.coalesce(1).write.mode("append").parquet(root)
    return spark.readStream.schema(last.schema).option("maxFilesPerTrigger", 1).parquet(root)


def stream_alerts_late(spark: SparkSession, sf: str) -> DataFrame:
    """Burst alerts of events that arrive in no order of time."""
    ev = tables.table(spark, sf, "events").select("user_id", F.col("ts").cast("timestamp").alias("at"))
    last = ev.limit(1).select(F.lit(-1).cast("bigint").alias("user_id"), F.expr("timestamp'2200-01-01'").alias("at"))
    day = DAY_MS * 1000
    found = event_time.alerts(_late(ev, "at", last), ["user_id"], "at", "40 days", day, 4, 2 * day)
    return _stream_table(found, spark, "late_alerts").withColumnRenamed("at_us", "t")


def stream_slots(spark: SparkSession, sf: str) -> DataFrame:
    """Lowest free slots of sessions that arrive in no order of time."""
    daily = groups.daily_sessions(spark, sf).select(
        "day", "user_id", F.timestamp_micros("start_us").alias("start"), F.timestamp_micros("end_us").alias("stop"))
    none = F.expr("timestamp'2200-01-01'")
    last = daily.limit(1).select(F.lit(-1).cast("bigint").alias("day"), F.lit(-1).cast("bigint").alias("user_id"),
                                 none.alias("start"), none.alias("stop"))
    found = event_time.slots(_late(daily, "start", last), ["day"], "start", "stop", "user_id", delay="40 days")
    return _stream_table(found, spark, "late_slots").filter("day >= 0").select("day", "user_id", "start_us", "slot")


def payload_files_written(spark: SparkSession, sf: str) -> DataFrame:
    """One file for each payload: its name, bytes and lines."""
    root = session.scratch(session.configure(spark), "payload_files")
    lines = _lines(tables.table(spark, sf, "events"))
    joined = payloads.payloads(lines, "user_id", order=["event_id"])
    payloads.fan_out(joined, [lambda df: payload_files.write(df, root, 1, "user_id")] * 2)
    return payload_files.read(spark, root).select(
        "name", "n_bytes", F.regexp_count(F.decode("payload", "utf-8"), F.lit("\n")).cast("bigint").alias("n_rows"))


PAYLOAD_FILES_WRITTEN = f"""
WITH RECURSIVE {_LEDGER_ROWS}
SELECT '=' || user_id || '-=' || batch_id AS name, max(size) AS n_bytes, count(*) AS n_rows
FROM s GROUP BY user_id, batch_id"""


def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every event arrives twice, over several micro-batches; without an instant both stay."""
    root = session.scratch(session.configure(spark), "arrivals")
    ev = tables.table(spark, sf, "events").select("event_id", F.when(
        F.col("event_type") != "error", F.col("ts").cast("timestamp")).alias("at"))
    for copy in range(2):
        ev.repartitionByRange(3, "at").write.mode("append").parquet(root)
    twice = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 2).parquet(root)
    kept = flows.dedup(twice, ["event_id"], "at", delay="100000 days").select("event_id")
    return _stream_table(kept, spark, "dedup")


STREAM_DEDUP = """
SELECT event_id FROM events UNION ALL SELECT event_id FROM events WHERE event_type = 'error'"""


def text_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Lines written as text files, read back as a stream and decoded."""
    root = session.scratch(session.configure(spark), "text")
    payloads.write_text(_lines(tables.table(spark, sf, "events")), f"{root}/in")
    back = decode.text_lines(payloads.text_files(spark, f"{root}/in", stream=True))
    return _plain(_stream_table(back, spark, "decoded"))


TEXT_STREAM = PLAIN


def synthetic_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A generated trade for every event; cells depend on (event, seed) only."""
    ids = tables.table(spark, sf, "events").select(F.col("event_id").alias("id"))
    return tables.fill(ids, "trades", seed=7, null_share=0.1)


def synthetic_profile(spark: SparkSession, sf: str) -> DataFrame:
    """The generated cells stay in their ranges."""
    rows = synthetic_rows(spark, sf)
    return rows.agg(
        F.count("*").alias("n_rows"), F.count_distinct("id").alias("n_ids"),
        F.count_if(~F.col("side").isin("buy", "sell")).alias("bad_side"),
        F.count_if((F.col("price") < 0) | (F.col("price") >= 10_000)).alias("bad_price"),
        (F.count("qty") < F.count("*")).alias("has_nulls"))


SYNTHETIC_PROFILE = """
SELECT count(*) AS n_rows, count(DISTINCT event_id) AS n_ids, CAST(0 AS BIGINT) AS bad_side,
  CAST(0 AS BIGINT) AS bad_price, true AS has_nulls FROM events"""


QUERIES = {f.__name__: f for f in (
    parquet_roundtrip, payload_frames, payload_frames_binary, payload_ledger, payload_build, fan_out, sink_replay,
    payload_files_written, message_files, stream_equals_batch, stream_batches, stream_alerts, stream_alerts_late,
    stream_slots, stream_dedup, text_stream, synthetic_rows,
    synthetic_profile)}
ORACLES = {name: globals()[name.upper()] for name in QUERIES if name.upper() in globals()}


def _shared_oracles() -> dict[str, str]:
    """Streams whose batch form already has an oracle."""
    return {"stream_batches": batches.BATCH_COMBINED, "stream_alerts": groups.BURST_ALERTS,
            "stream_alerts_late": groups.BURST_ALERTS, "stream_slots": groups.SLOT_ASSIGN}


ORACLES |= _shared_oracles()
