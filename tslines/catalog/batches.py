"""Queries over batching."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tslines.functions import times
from tslines.operators import batch
from tslines.operators.batch import Limits
from tslines.operators.encode import encode
from tslines.plans import roles
from tslines.sources.tables import table

DAY_MS = 86_400_000


def _events(spark, sf):
    """Events with their clock and the size of their line."""
    ev = table(spark, sf, "events")
    return ev.select("event_id", "user_id", "event_type", times.micros(F.col("ts")).alias("t"),
                     (F.length("props") + 40).cast("bigint").alias("nb"))


_EVENTS = ("SELECT event_id, user_id AS k, epoch_us(ts) AS t, length(props) + 40 AS nb, "
           "CAST(NULL AS VARCHAR) AS x, "
           "row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events")


def _sequential(rows: str, key: str, limits: Limits, tail: str) -> str:
    """The batch rules as a recursive query: one step per row of a key."""
    closes = [c for c in (
        limits.rows and f"rows >= {limits.rows}", limits.bytes and f"size >= {limits.bytes}",
        limits.interval and f"t - last >= {limits.interval * 1000}") if c]
    hit = f"(x IS NULL AND ({' OR '.join(closes)}))"
    return f"""
WITH RECURSIVE r AS ({rows}),
s AS (
  SELECT *, {hit} AS hit FROM (
    SELECT k, rn, {key}, t, x, CAST(0 AS BIGINT) AS batch_id, 1 AS rows, CAST(nb AS BIGINT) AS size,
      t AS last FROM r WHERE rn = 1)
  UNION ALL
  SELECT *, {hit} AS hit FROM (
    SELECT r.k, r.rn, r.{key}, r.t, r.x,
      batch_id + CASE WHEN hit OR s.x IS DISTINCT FROM r.x THEN 1 ELSE 0 END AS batch_id,
      CASE WHEN hit OR s.x IS DISTINCT FROM r.x THEN 1 ELSE rows + 1 END AS rows,
      CAST(CASE WHEN hit OR s.x IS DISTINCT FROM r.x THEN 0 ELSE size END + r.nb AS BIGINT) AS size,
      CASE WHEN s.x IS DISTINCT FROM r.x AND r.x IS NOT NULL THEN r.t
        WHEN hit OR s.x IS DISTINCT FROM r.x THEN s.t ELSE last END AS last
    FROM s JOIN r ON r.k = s.k AND r.rn = s.rn + 1))
{tail}"""


def _per_user(spark, sf, limits):
    return batch.assign(_events(spark, sf), limits, key=["user_id"], order=["t", "event_id"],
                        time="t", size="nb").select("event_id", "user_id", "batch_id")


_PER_USER = "SELECT event_id, k AS user_id, batch_id FROM s"
ROWS, BYTES = Limits(7, None, None), Limits(None, 300, None)
INTERVAL, COMBINED = Limits(None, None, DAY_MS), Limits(5, 240, DAY_MS)


def batch_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _per_user(spark, sf, ROWS)


BATCH_ROWS = """
SELECT event_id, user_id, CAST(floor((row_number() OVER (
  PARTITION BY user_id ORDER BY ts, event_id) - 1) / 7) AS BIGINT) AS batch_id FROM events"""


def batch_rows_global(spark: SparkSession, sf: str) -> DataFrame:
    ev = _events(spark, sf).select("event_id", "t")
    return batch.by_rows(ev, 600, order=["t", "event_id"]).select("event_id", "batch_id")


BATCH_ROWS_GLOBAL = """
SELECT event_id, CAST(floor((row_number() OVER (ORDER BY ts, event_id) - 1) / 600) AS BIGINT)
  AS batch_id FROM events"""


def batch_bytes(spark: SparkSession, sf: str) -> DataFrame:
    return _per_user(spark, sf, BYTES)


BATCH_BYTES = _sequential(_EVENTS, "event_id", BYTES, _PER_USER)


def batch_interval(spark: SparkSession, sf: str) -> DataFrame:
    return _per_user(spark, sf, INTERVAL)


BATCH_INTERVAL = _sequential(_EVENTS, "event_id", INTERVAL, _PER_USER)


def batch_combined(spark: SparkSession, sf: str) -> DataFrame:
    return _per_user(spark, sf, COMBINED)


BATCH_COMBINED = _sequential(_EVENTS, "event_id", COMBINED, _PER_USER)


def batch_spread(spark: SparkSession, sf: str) -> DataFrame:
    """The spread plan on few large keys: every key counts as large."""
    ev = _events(spark, sf)
    return batch.assign(ev, COMBINED, key=["event_type"], order=["t", "event_id"], time="t",
                        size="nb", spread_above=0).select("event_id", "event_type", "batch_id")


BATCH_SPREAD = _sequential(
    _EVENTS.replace("user_id", "event_type"), "event_id", COMBINED,
    "SELECT event_id, k AS event_type, batch_id FROM s")


def _turns(spark, sf):
    talk = table(spark, sf, "conversations")
    return talk.select(
        "conv_id", "turn", (F.col("conv_id") * 100 + F.col("turn")).alias("pos"), "role",
        F.octet_length("text").cast("bigint").alias("nb"),
        F.when(F.col("conv_id") % 2 == 0, F.col("conv_id")).cast("string").alias("txn"))


_TURNS = ("SELECT conv_id * 100 + turn AS pos, 0 AS k, 0 AS t, strlen(text) AS nb, "
          "{} AS x, row_number() OVER (ORDER BY conv_id, turn) AS rn FROM conversations")


def batch_whole_table(spark: SparkSession, sf: str) -> DataFrame:
    """No key: the whole table is one sequence, spread over all tasks."""
    return batch.assign(_turns(spark, sf), Limits(20, 4000, None), order=["conv_id", "turn"],
                        size="nb").select("pos", "batch_id")


BATCH_WHOLE_TABLE = _sequential(_TURNS.format("CAST(NULL AS VARCHAR)"), "pos",
                                Limits(20, 4000, None), "SELECT pos, batch_id FROM s")


def txn_cut(spark: SparkSession, sf: str) -> DataFrame:
    """Every second conversation is a transaction among rows that are not."""
    return batch.assign(_turns(spark, sf), Limits(2, None, None), order=["conv_id", "turn"],
                        txn="txn").select("pos", "batch_id")


TXN_CUT = _sequential(
    _TURNS.format("CASE WHEN conv_id % 2 = 0 THEN CAST(conv_id AS VARCHAR) END"), "pos",
    Limits(2, None, None), "SELECT pos, batch_id FROM s")


def batch_ledger(spark: SparkSession, sf: str) -> DataFrame:
    cut = batch.assign(_events(spark, sf), ROWS, key=["user_id"], order=["t", "event_id"])
    return batch.ledger(cut, "user_id", size="nb", at="t", table="event_type")


BATCH_LEDGER = """
SELECT user_id, batch_id, count(*) AS n_rows, CAST(sum(nb) AS BIGINT) AS n_bytes,
  min(t) AS first_at, max(t) AS last_at, min(event_type) = max(event_type) AS one_table
FROM (SELECT *, length(props) + 40 AS nb, epoch_us(ts) AS t, CAST(floor((row_number() OVER (
  PARTITION BY user_id ORDER BY ts, event_id) - 1) / 7) AS BIGINT) AS batch_id FROM events)
GROUP BY user_id, batch_id"""


def batch_max(spark: SparkSession, sf: str) -> DataFrame:
    cut = batch.assign(_events(spark, sf), ROWS, key=["user_id"], order=["t", "event_id"])
    return batch.check_max(cut, "user_id", size="nb", limit=342).select(
        "user_id", "batch_id", "n_bytes")


BATCH_MAX = """
SELECT user_id, batch_id, CAST(sum(nb) AS BIGINT) AS n_bytes
FROM (SELECT *, length(props) + 40 AS nb, CAST(floor((row_number() OVER (
  PARTITION BY user_id ORDER BY ts, event_id) - 1) / 7) AS BIGINT) AS batch_id FROM events)
GROUP BY user_id, batch_id HAVING sum(nb) > 342"""


def txn_single_table(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations as transactions, routed by role: those that mix tables are refused."""
    talk = table(spark, sf, "conversations").select(
        F.col("conv_id").alias("batch_id"), "turn", "role", "text")
    plan = roles.resolve(talk, table_col="role", at=roles.SERVER_TIME, version=1)
    lines = encode(talk, plan, "batch_id")
    return batch.transactional(lines).select("batch_id", "n_rows")


TXN_SINGLE_TABLE = """
SELECT conv_id AS batch_id, count(*) AS n_rows FROM conversations
GROUP BY conv_id HAVING count(DISTINCT role) > 1"""


QUERIES = {f.__name__: f for f in (
    batch_rows, batch_rows_global, batch_bytes, batch_interval, batch_combined, batch_spread,
    batch_whole_table, txn_cut, batch_ledger, batch_max, txn_single_table)}
ORACLES = {name: globals()[name.upper()] for name in QUERIES}
