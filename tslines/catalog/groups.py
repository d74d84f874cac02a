"""Queries over symbol dictionaries, bursts and sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tslines.functions import times
from tslines.operators import bursts, symbols
from tslines.sources.tables import table

DAY_US = 86_400_000_000
GAP_US = 1_800_000_000


def _sources(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.nullif("source", F.lit("src0")).alias("source"))


def symbol_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    return symbols.dictionary(table(spark, sf, "part"), "p_name")


SYMBOL_DICTIONARY = """
SELECT p_name AS symbol, count(*) AS n_rows, row_number() OVER (ORDER BY p_name) - 1 AS code
FROM part GROUP BY p_name"""


def symbol_encode(spark: SparkSession, sf: str) -> DataFrame:
    df = _sources(spark, sf)
    return symbols.encode(df, "source", symbols.dictionary(df, "source"))


SYMBOL_ENCODE = """
WITH d AS (SELECT doc_id, nullif(source, 'src0') AS source FROM documents)
SELECT doc_id, source, CASE WHEN source IS NOT NULL
  THEN dense_rank() OVER (ORDER BY source NULLS LAST) - 1 END AS code FROM d"""


def symbol_encode_large(spark: SparkSession, sf: str) -> DataFrame:
    """The plan for dictionaries that are too large to broadcast."""
    df = table(spark, sf, "orders").select("o_orderkey", "o_custkey",
                                           F.concat("o_orderpriority", F.lit("/"),
                                                    F.col("o_custkey") % 3).alias("s"))
    df = df.withColumn("s", F.when(F.col("o_custkey") % 2 == 0, F.col("s")).otherwise(
        F.concat(F.lit("c"), "o_custkey"))).drop("o_custkey")
    return symbols.encode(df, "s", symbols.dictionary(df, "s"), broadcast_rows=0)


SYMBOL_ENCODE_LARGE = """
WITH o AS (SELECT o_orderkey, CASE WHEN o_custkey % 2 = 0 THEN o_orderpriority || '/'
  || (o_custkey % 3) ELSE 'c' || o_custkey END AS s FROM orders)
SELECT o_orderkey, s, dense_rank() OVER (ORDER BY s) - 1 AS code FROM o"""


def symbol_decode(spark: SparkSession, sf: str) -> DataFrame:
    df = _sources(spark, sf)
    words = symbols.dictionary(df, "source")
    coded = symbols.encode(df, "source", words).drop("source")
    return symbols.decode(coded, "code", words, "source").drop("code")


SYMBOL_DECODE = "SELECT doc_id, nullif(source, 'src0') AS source FROM documents"


def symbol_width(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "orders").select(
        "o_orderpriority", "o_orderstatus", F.concat(F.lit("c"), "o_custkey").alias("customer"),
        F.concat(F.lit("o"), "o_orderkey").alias("ord"))
    return symbols.profile(df, ["o_orderpriority", "o_orderstatus", "customer", "ord"])


SYMBOL_WIDTH = """
WITH n AS (SELECT 'o_orderpriority' AS "column", count(DISTINCT o_orderpriority) AS n_symbols
    FROM orders UNION ALL SELECT 'o_orderstatus', count(DISTINCT o_orderstatus) FROM orders
  UNION ALL SELECT 'customer', count(DISTINCT o_custkey) FROM orders
  UNION ALL SELECT 'ord', count(DISTINCT o_orderkey) FROM orders)
SELECT *, CASE WHEN n_symbols <= 127 THEN 8 WHEN n_symbols <= 32767 THEN 16 ELSE 32 END
  AS code_bits FROM n"""


def _events(spark, sf):
    return table(spark, sf, "events").select(
        "user_id", "event_type", times.micros(F.col("ts")).alias("t"))


def burst_counts(spark: SparkSession, sf: str) -> DataFrame:
    return bursts.counts(_events(spark, sf), ["user_id"], "t", DAY_US)


BURST_COUNTS = f"""
WITH i AS (SELECT user_id, epoch_us(ts) AS t, count(*) AS n_events FROM events GROUP BY 1, 2)
SELECT user_id, t, n_events, CAST(sum(n_events) OVER (PARTITION BY user_id ORDER BY t
  RANGE BETWEEN {DAY_US} PRECEDING AND CURRENT ROW) AS BIGINT) AS n_recent FROM i"""


def _alerts_sql(key: str, window: int, threshold: int, quiet: int) -> str:
    return f"""
WITH RECURSIVE i AS (SELECT {key}, epoch_us(ts) AS t, count(*) AS n_events FROM events
  GROUP BY 1, 2),
c AS (SELECT *, CAST(sum(n_events) OVER (PARTITION BY {key} ORDER BY t
  RANGE BETWEEN {window} PRECEDING AND CURRENT ROW) AS BIGINT) AS n_recent FROM i),
b AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY t) AS rn FROM c
  WHERE n_recent >= {threshold}),
a AS (SELECT {key}, rn, t, n_events, n_recent, t AS last, true AS alert FROM b WHERE rn = 1
  UNION ALL
  SELECT b.{key}, b.rn, b.t, b.n_events, b.n_recent,
    CASE WHEN b.t - a.last > {quiet} THEN b.t ELSE a.last END, b.t - a.last > {quiet}
  FROM a JOIN b ON a.{key} = b.{key} AND b.rn = a.rn + 1)
SELECT {key}, t, n_events, n_recent FROM a WHERE alert"""


def burst_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return bursts.alerts(_events(spark, sf), ["user_id"], "t", DAY_US, 4, 2 * DAY_US)


BURST_ALERTS = _alerts_sql("user_id", DAY_US, 4, 2 * DAY_US)


def burst_alerts_spread(spark: SparkSession, sf: str) -> DataFrame:
    """The plan for keys that are too large for one task."""
    return bursts.alerts(_events(spark, sf), ["event_type"], "t", DAY_US // 24, 5, DAY_US // 2,
                         spread_above=0)


BURST_ALERTS_SPREAD = _alerts_sql("event_type", DAY_US // 24, 5, DAY_US // 2)

_SESSIONS = f"""
e AS (SELECT user_id, epoch_us(ts) AS t FROM events),
g AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY user_id ORDER BY t) <= {GAP_US}
  THEN 0 ELSE 1 END AS s FROM e),
n AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY t) AS sid FROM g),
x AS (SELECT user_id, min(t) AS start_us, max(t) + {GAP_US} AS end_us, count(*) AS n_events
  FROM n GROUP BY user_id, sid)"""


def _sessions(spark, sf):
    return bursts.sessions(_events(spark, sf), ["user_id"], "t", GAP_US)


def event_sessions(spark: SparkSession, sf: str) -> DataFrame:
    return _sessions(spark, sf)


EVENT_SESSIONS = f"WITH {_SESSIONS} SELECT user_id, start_us, end_us, n_events FROM x"


def event_sessions_spread(spark: SparkSession, sf: str) -> DataFrame:
    """The plan for keys that are too large for one task."""
    ev = _events(spark, sf).withColumn("user_id", F.nullif("user_id", F.lit(7)))
    return bursts.sessions(ev, ["user_id"], "t", GAP_US, spread_above=0)


EVENT_SESSIONS_SPREAD = EVENT_SESSIONS.replace(
    "SELECT user_id, epoch_us(ts)", "SELECT nullif(user_id, 7) AS user_id, epoch_us(ts)")


def daily_sessions(spark, sf):
    return _sessions(spark, sf).withColumn(
        "day", F.call_function("div", F.col("start_us"), F.lit(DAY_US)))


def session_concurrency(spark: SparkSession, sf: str) -> DataFrame:
    return bursts.concurrency(daily_sessions(spark, sf), ["day"], "start_us", "end_us")


SESSION_CONCURRENCY = f"""
WITH {_SESSIONS},
d AS (SELECT start_us // {DAY_US} AS day, start_us AS at_us, 1 AS d FROM x
  UNION ALL SELECT start_us // {DAY_US}, end_us, -1 FROM x),
m AS (SELECT day, at_us, sum(d) AS d FROM d GROUP BY 1, 2)
SELECT day, at_us, CAST(sum(d) OVER (PARTITION BY day ORDER BY at_us) AS BIGINT) AS n_open FROM m"""


def session_concurrency_spread(spark: SparkSession, sf: str) -> DataFrame:
    """The plan for groups that are too large for one task."""
    some = F.when(F.col("day") % 3 != 0, F.col("day"))
    return bursts.concurrency(daily_sessions(spark, sf).withColumn("day", some), ["day"], "start_us",
                              "end_us", spread_above=0)


SESSION_CONCURRENCY_SPREAD = SESSION_CONCURRENCY.replace(
    f"start_us // {DAY_US}", f"CASE WHEN start_us // {DAY_US} % 3 <> 0 THEN start_us // {DAY_US} END")


def slot_assign(spark: SparkSession, sf: str) -> DataFrame:
    return bursts.slots(daily_sessions(spark, sf), ["day"], "start_us", "end_us", "user_id").select(
        "day", "user_id", "start_us", "slot")


def slot_assign_spread(spark: SparkSession, sf: str) -> DataFrame:
    """The plan for busy periods that are too large for one task."""
    return bursts.slots(daily_sessions(spark, sf), ["day"], "start_us", "end_us", "user_id",
                        spread_above=0).select("day", "user_id", "start_us", "slot")


SLOT_ASSIGN = f"""
WITH RECURSIVE {_SESSIONS},
y AS (SELECT start_us // {DAY_US} AS day, user_id, start_us, end_us FROM x),
z AS (SELECT *, row_number() OVER (PARTITION BY day ORDER BY start_us, user_id) AS rn FROM y),
w AS (
  SELECT day, rn, user_id, start_us, CAST(0 AS BIGINT) AS slot, [end_us] AS busy FROM z
  WHERE rn = 1
  UNION ALL
  SELECT day, rn, user_id, start_us, CAST(s - 1 AS BIGINT),
    CASE WHEN s > len(busy) THEN list_append(busy, end_us)
      ELSE list_transform(busy, lambda b, i: CASE WHEN i = s THEN end_us ELSE b END) END
  FROM (SELECT z.day, z.rn, z.user_id, z.start_us, z.end_us, w.busy,
      coalesce(nullif(list_position(list_transform(w.busy, lambda b: b <= z.start_us), true), 0),
        len(w.busy) + 1) AS s
    FROM w JOIN z ON z.day = w.day AND z.rn = w.rn + 1))
SELECT day, user_id, start_us, slot FROM w"""
SLOT_ASSIGN_SPREAD = SLOT_ASSIGN


QUERIES = {f.__name__: f for f in (
    symbol_dictionary, symbol_encode, symbol_encode_large, symbol_decode, symbol_width,
    burst_counts, burst_alerts, burst_alerts_spread, event_sessions, event_sessions_spread,
    session_concurrency, session_concurrency_spread,
    slot_assign, slot_assign_spread)}
ORACLES = {name: globals()[name.upper()] for name in QUERIES}
