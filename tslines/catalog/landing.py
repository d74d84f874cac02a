"""Queries over landing effects."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tslines import session
from tslines.functions import times
from tslines.operators import land, store
from tslines.operators.ordered import global_index
from tslines.plans import roles
from tslines.sources.tables import table


def _events(spark, sf):
    return table(spark, sf, "events").withColumn("at_us", times.micros(F.col("ts")))


def land_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Clicks are sent twice, errors carry no instant, and some arrivals are unknown."""
    ev = _events(spark, sf).select(
        "event_id", "user_id", "value",
        F.when(F.col("event_type") != "error", F.col("at_us")).alias("at_us"),
        F.when(F.col("user_id") != 7, 1).alias("arrival"), "event_type")
    again = ev.filter(F.col("event_type").isin("click", "error")).withColumns(
        {"arrival": F.lit(2), "value": F.col("value") + 1})
    both = ev.unionByName(again).drop("event_type")
    return land.dedup(both, ["event_id", "user_id"], "at_us", "arrival")


LAND_DEDUP = """
WITH e AS (SELECT event_id, user_id, value, CASE WHEN event_type <> 'error' THEN epoch_us(ts) END
    AS at_us, CASE WHEN user_id <> 7 THEN 1 END AS arrival, event_type FROM events),
b AS (SELECT * FROM e UNION ALL SELECT event_id, user_id, value + 1, at_us, 2, event_type FROM e
  WHERE event_type IN ('click', 'error')),
n AS (SELECT *, row_number() OVER (PARTITION BY event_id, user_id, at_us ORDER BY arrival DESC NULLS LAST)
  AS rn FROM b)
SELECT event_id, user_id, value, at_us, arrival FROM n WHERE at_us IS NULL OR rn = 1"""


def land_lateness(spark: SparkSession, sf: str) -> DataFrame:
    """Rows arrive out of order, some users later than others."""
    ev = _events(spark, sf).select("event_id", "event_type", "at_us", (
        F.col("event_id") + F.col("user_id") * 3).alias("arrival"))
    return land.lateness(ev, ["event_type"], "at_us", "arrival")


LAND_LATENESS = """
WITH e AS (SELECT event_id, event_type, epoch_us(ts) AS at_us, event_id + user_id * 3 AS arrival
  FROM events)
SELECT event_id, event_type, at_us, arrival, greatest(coalesce(max(at_us) OVER (
  PARTITION BY event_type ORDER BY arrival RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
  - at_us, 0), 0) AS late_us FROM e"""


def land_lateness_spread(spark: SparkSession, sf: str) -> DataFrame:
    """The plan for keys that are too large for one task."""
    ev = _events(spark, sf).select(
        "event_id", F.nullif("event_type", F.lit("error")).alias("event_type"), "at_us",
        F.when(F.col("user_id") != 7, F.col("event_id") + F.col("user_id") * 3).alias("arrival"))
    return land.lateness(ev, ["event_type"], "at_us", "arrival", width=512, spread_above=0)


# rows without an arrival come first and are peers of each other
LAND_LATENESS_SPREAD = """
WITH e AS (SELECT event_id, nullif(event_type, 'error') AS event_type, epoch_us(ts) AS at_us,
  CASE WHEN user_id <> 7 THEN event_id + user_id * 3 END AS arrival FROM events),
p AS (SELECT event_type, arrival, max(at_us) AS top FROM e GROUP BY 1, 2),
n AS (SELECT *, CASE WHEN arrival IS NULL THEN top ELSE max(top) OVER (PARTITION BY event_type
  ORDER BY arrival NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS newest FROM p)
SELECT e.event_id, e.event_type, e.at_us, e.arrival,
  greatest(coalesce(n.newest - e.at_us, 0), 0) AS late_us
FROM e JOIN n ON e.event_type IS NOT DISTINCT FROM n.event_type
  AND e.arrival IS NOT DISTINCT FROM n.arrival"""


def land_time_order(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "orders").select(
        "o_orderkey", times.micros(F.col("o_orderdate")).alias("at_us"))
    return global_index(ev, ["at_us", "o_orderkey"], "position")


LAND_TIME_ORDER = """
SELECT o_orderkey, epoch_us(o_orderdate) AS at_us,
  row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS position FROM orders"""


def _routed(spark, sf, one=False):
    """Events for a table of their type, or all for one."""
    return table(spark, sf, "events").select(
        F.lit("events").alias("tbl") if one else F.col("event_type").alias("tbl"), F.col("ts").cast("timestamp").alias("at"), "event_id",
        "user_id", "value")


def _root(spark, name="landed"):
    return session.scratch(session.configure(spark), name)


def land_day_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Events landed per table and day, in files of one table and day each."""
    root = _root(spark)
    store.land(_routed(spark, sf), root)
    us = times.micros(F.col("at"))
    return store.landed(spark, root).groupBy("tbl", F.col("day").cast("string").alias("day")).agg(
        F.count("*").alias("n_rows"), F.min(us).alias("first_us"), F.max(us).alias("last_us"))


LAND_DAY_COUNTS = """
SELECT event_type AS tbl, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n_rows,
  min(epoch_us(ts)) AS first_us, max(epoch_us(ts)) AS last_us FROM events GROUP BY 1, 2"""



def land_twice(spark: SparkSession, sf: str) -> DataFrame:
    """A second load brings a new column and a wider type; lost values are rejects."""
    root = _root(spark)
    ev = _routed(spark, sf).withColumn("user_id", F.col("user_id").cast("int"))
    store.land(ev.filter("event_id % 2 = 0").drop("value"), root)
    later = ev.filter("event_id % 2 = 1").withColumn("user_id", F.when(
        F.col("user_id") == 7, F.lit(1.5)).otherwise(F.col("user_id").cast("double")))
    bad = store.land(later, root).select(
        F.lit("reject").alias("what"), F.lit(None).cast("bigint").alias("event_id"),
        F.lit(None).cast("int").alias("user_id"), F.col("value").cast("double").alias("value"))
    return store.landed(spark, root).select(
        F.lit("row").alias("what"), "event_id", "user_id", "value").unionByName(bad)


LAND_TWICE = """
SELECT CASE WHEN event_id % 2 = 1 AND user_id = 7 THEN 'reject' ELSE 'row' END AS what,
  CASE WHEN event_id % 2 = 0 OR user_id <> 7 THEN event_id END AS event_id,
  CASE WHEN event_id % 2 = 0 OR user_id <> 7 THEN CAST(user_id AS INTEGER) END AS user_id,
  CASE WHEN event_id % 2 = 1 AND user_id = 7 THEN 1.5 WHEN event_id % 2 = 1 THEN value END AS value
FROM events"""



def land_rerun(spark: SparkSession, sf: str) -> DataFrame:
    """A commit that is sent again adds nothing; rows of a write that died are not seen."""
    root, ev = _root(spark), _routed(spark, sf, one=True)
    store.land(ev.filter("event_id % 3 = 0"), root, commit="first")
    store.land(ev.filter("event_id % 3 = 0"), root, commit="first")
    lost = ev.filter("event_id % 3 = 2").withColumns({"day": F.to_date("at"), "_slot": F.lit(0)})
    store.write_rows(lost, root, "tbl", "at")
    store.land(ev.filter("event_id % 3 = 1"), root, commit="second")
    store.land(ev.filter("event_id % 3 = 0"), root, commit="first")
    log = F.lit(",".join(c.name for c in store.history(spark, root)))
    return store.landed(spark, root).select("tbl", "event_id", times.micros(F.col("at")).alias("at_us"),
                                            "value", log.alias("commits"))


LAND_RERUN = """
SELECT 'events' AS tbl, event_id, epoch_us(ts) AS at_us, value, 'first,second' AS commits
FROM events WHERE event_id % 3 < 2"""


def land_writers(spark: SparkSession, sf: str) -> DataFrame:
    """Writers at the same time, on the same tables and days: each commit lands once."""
    root, ev = _root(spark), _routed(spark, sf, one=True)
    with ThreadPoolExecutor(3) as pool:
        work = [pool.submit(store.land, ev.filter(f"event_id % 3 = {i}"), root, commit=f"c{i}") for i in range(3)]
        for w in work:
            w.result()
    log = store.history(spark, root)
    names = F.lit(",".join(sorted(c.name for c in log)) + f" {[c.version for c in log]}")
    return store.landed(spark, root).select("tbl", "event_id", "user_id", "value", names.alias("commits"))


LAND_WRITERS = """
SELECT 'events' AS tbl, event_id, user_id, value, 'c0,c1,c2 [0, 1, 2]' AS commits FROM events"""


def land_case_variants(spark: SparkSession, sf: str) -> DataFrame:
    """Later rows spell columns in another way, and find the columns that are there."""
    root, ev = _root(spark), _routed(spark, sf)
    store.land(ev.filter("user_id % 2 = 0"), root)
    store.land(ev.filter("user_id % 2 = 1").toDF("TBL", "At", "EVENT_ID", "User_Id", "VALUE").withColumn(
        "Extra", F.col("VALUE") * 2), root, table="Tbl", at="AT")
    back = store.landed(spark, root)
    return back.select("tbl", "event_id", "user_id", "value", "extra",
                       F.lit(",".join(back.columns)).alias("columns")).withColumnRenamed("Extra", "extra")


LAND_CASE_VARIANTS = """
SELECT event_type AS tbl, event_id, user_id, value, CASE WHEN user_id % 2 = 1 THEN value * 2 END AS extra,
  'tbl,at,event_id,user_id,value,day,Extra' AS columns FROM events"""


def land_resent(spark: SparkSession, sf: str) -> DataFrame:
    """A slice is sent again as it was, then with other values for clicks; files elsewhere stay."""
    root, ev = _root(spark), _routed(spark, sf)
    keys = ["event_id", "user_id"]
    store.land(ev, root, commit="all", keys=keys)
    store.land(ev.filter("event_id % 5 < 2"), root, commit="again", keys=keys)
    changed = F.when(F.col("tbl") == "click", F.col("value") + 1).otherwise(F.col("value"))
    store.land(ev.filter("event_id % 5 = 0").withColumn("value", changed), root, commit="changed", keys=keys)
    same = store.touched(spark, root, 1).count() == 0
    other = store.touched(spark, root, 2).filter("tbl <> 'click'").count() == 0
    return store.landed(spark, root).select("tbl", "event_id", "user_id", "value", F.lit(same).alias("same"),
                                            F.lit(other).alias("others_stay"))


LAND_RESENT = """
SELECT event_type AS tbl, event_id, user_id,
  CASE WHEN event_id % 5 = 0 AND event_type = 'click' THEN value + 1 ELSE value END AS value,
  true AS same, true AS others_stay FROM events"""


def land_late(spark: SparkSession, sf: str) -> DataFrame:
    """Rows come in four loads in no order of time; files stay in time order and apart.

    The sum is exact. It is a BIGINT, as in the SQL, unless a day's sum is beyond 64
    bits, for which the SQL has no result; then the column is a decimal.
    """
    root, ev = _root(spark), _routed(spark, sf, one=True)
    for i in (2, 0, 3, 1):
        store.land(ev.filter(f"(event_id * 7919) % 4 = {i}"), root)
    live = store.files(spark, root)
    # as `store` has it, rows of one instant may fill several files
    day = Window.partitionBy("tbl", "day").orderBy("first_us", "last_us")
    apart = live.withColumn("ok", F.coalesce(F.lead("first_us").over(day) >= F.col("last_us"), F.lit(True)))
    apart = apart.groupBy("tbl", "day").agg(F.bool_and("ok").alias("apart"), F.sum("n_rows").alias("n_rows"))
    # in each file a row is not earlier than the one before it
    us, place = times.micros(F.col("at")), F.col("_metadata")
    rows = store.landed(spark, root).select("tbl", "day", us.alias("us"), place["file_path"].alias("file"),
                                            place["row_index"].alias("i"))
    inside = rows.withColumn("ok", F.coalesce(F.col("us") >= F.lag("us").over(
        Window.partitionBy("file").orderBy("i")), F.lit(True)))
    inside = inside.groupBy("tbl", "day").agg(F.bool_and("ok").alias("sorted"), F.sum(
        F.col("us").cast("decimal(20,0)")).alias("sum_us"))
    inside = session.checkpoint(inside)  # a row per table and day
    most = inside.agg(F.max(F.abs("sum_us"))).first()[0]
    if most is None or most < 1 << 63:
        inside = inside.withColumn("sum_us", F.col("sum_us").cast("bigint"))
    return apart.join(inside, ["tbl", "day"]).withColumn("day", F.col("day").cast("string"))


LAND_LATE = """
SELECT 'events' AS tbl, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, true AS apart, count(*) AS n_rows,
  true AS sorted, CAST(sum(epoch_us(ts)) AS BIGINT) AS sum_us FROM events GROUP BY 1, 2"""


def _texts(spark, sf):
    price = F.col("l_extendedprice").cast("decimal(12,2)").cast("string")
    stamp = F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")
    odd = F.col("l_linenumber") % 3
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", price.alias("price"),
        F.when(odd == 0, F.concat(price, F.lit("e400"))).when(odd == 1, F.concat(price, F.lit("e-2"))).otherwise(
            F.concat(price, F.lit("00000000000000000001"))).alias("weight"),
        F.concat(stamp, F.when(odd == 0, ".123456789").when(odd == 1, ".123456000").otherwise("")).alias("seen"),
        F.concat(F.col("l_quantity").cast("int").cast("string"), F.when(odd == 0, ".5").otherwise("")).alias("n"))


_TEXT_TARGET = T.StructType([T.StructField(n, t) for n, t in (
    ("l_orderkey", T.LongType()), ("l_linenumber", T.IntegerType()), ("l_partkey", T.LongType()),
    ("price", T.DecimalType(12, 1)), ("weight", T.DoubleType()), ("seen", T.TimestampType()),
    ("n", T.IntegerType()))])


def conform_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Texts to decimals, doubles, instants and integers: what would change is a reject."""
    bad = land.conform_rejects(_texts(spark, sf), _TEXT_TARGET, "l_orderkey", "l_linenumber", "l_partkey")
    kept = land.conform(_texts(spark, sf), _TEXT_TARGET).select(
        "l_orderkey", "l_linenumber", "l_partkey", F.lit("kept").alias("column"), F.concat_ws(
            "|", F.col("price").cast("string"), F.round(F.col("weight") * 10000).cast("bigint").cast("string"),
            times.micros(F.col("seen")).cast("string"), F.col("n").cast("string")).alias("value"))
    return bad.unionByName(kept)


CONFORM_TEXTS = """
WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, l_linenumber % 3 AS odd, l_shipdate,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS price,
    CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS q FROM lineitem),
w AS (SELECT *, price || CASE odd WHEN 0 THEN 'e400' WHEN 1 THEN 'e-2' ELSE '00000000000000000001' END AS weight,
    strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') || CASE odd WHEN 0 THEN '.123456789' WHEN 1 THEN '.123456000' ELSE '' END
      AS seen, q || CASE WHEN odd = 0 THEN '.5' ELSE '' END AS n FROM t)
SELECT l_orderkey, l_linenumber, l_partkey, 'price' AS "column", price AS value FROM w WHERE price NOT LIKE '%0'
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'weight', weight FROM w WHERE odd <> 1
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'seen', seen FROM w WHERE odd = 0
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'n', n FROM w WHERE odd = 0
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'kept', left(price, length(price) - 1) || '|'
  || CAST(CAST(price AS DECIMAL(12,2)) * 100 AS BIGINT) || '|'
  || (epoch_us(date_trunc('second', l_shipdate)) + 123456) || '|' || q
FROM w WHERE odd = 1 AND price LIKE '%0'"""

_TARGET = T.StructType([
    T.StructField("l_orderkey", T.LongType()), T.StructField("l_linenumber", T.LongType()),
    T.StructField("l_quantity", T.LongType()), T.StructField("price", T.DecimalType(8, 3)),
    T.StructField("tax", T.DecimalType(6, 1)), T.StructField("l_shipdate", T.StringType())])


def _lines(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_linenumber"), "l_quantity",
        F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
        F.col("l_tax").cast("decimal(6,2)").alias("tax"),
        F.col("l_orderkey").cast("string").alias("l_shipdate"))


def conform_types(spark: SparkSession, sf: str) -> DataFrame:
    """Doubles to integers, decimals to more and fewer places, for rows that keep their values."""
    out = land.conform(_lines(spark, sf), _TARGET)
    return out.withColumns({"price": F.col("price").cast("string"),
                            "tax": F.col("tax").cast("string")})


CONFORM_TYPES = """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
  CAST(l_quantity AS BIGINT) AS l_quantity, CAST(CAST(l_extendedprice AS DECIMAL(8,3)) AS VARCHAR)
  AS price, CAST(CAST(l_tax AS DECIMAL(6,1)) AS VARCHAR) AS tax,
  CAST(l_orderkey AS VARCHAR) AS l_shipdate
FROM lineitem WHERE CAST(l_extendedprice AS DECIMAL(12,2)) < 100000 AND
  CAST(CAST(l_tax AS DECIMAL(6,2)) * 100 AS INTEGER) % 10 = 0 AND l_quantity = floor(l_quantity)"""


def conform_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return land.conform_rejects(_lines(spark, sf), _TARGET, "l_orderkey", "l_linenumber")


CONFORM_REJECTS = """
SELECT l_orderkey, l_linenumber, 'price' AS "column",
  CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS value
FROM lineitem WHERE CAST(l_extendedprice AS DECIMAL(12,2)) >= 100000
UNION ALL SELECT l_orderkey, l_linenumber, 'tax', CAST(CAST(l_tax AS DECIMAL(6,2)) AS VARCHAR)
FROM lineitem WHERE CAST(CAST(l_tax AS DECIMAL(6,2)) * 100 AS INTEGER) % 10 <> 0"""


def add_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Customers exist; suppliers arrive with another column and another integer type."""
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
        F.col("c_nationkey").cast("bigint").alias("nation"))
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance"))
    return land.append(customers, suppliers)


ADD_COLUMNS = """
SELECT c_custkey AS "key", c_name AS name, CAST(c_nationkey AS BIGINT) AS nation,
  CAST(NULL AS DOUBLE) AS balance FROM customer
UNION ALL SELECT s_suppkey, s_name, CAST(s_nationkey AS BIGINT), s_acctbal FROM supplier"""


def table_catalogue(spark: SparkSession, sf: str) -> DataFrame:
    """The tables and columns that routed events create."""
    ev = table(spark, sf, "events").select(
        "event_type", F.when(F.col("event_type") == "click", F.col("value")).alias("clicked"),
        "user_id", "props", "ts")
    plan = roles.resolve(ev, table_col="event_type", symbols=["props"], at="ts")
    return land.catalogue(land.long_rows(ev, plan))


TABLE_CATALOGUE = """
WITH c AS (
  SELECT event_type AS tbl, 0 AS rp, 'symbol' AS role, 'props' AS name, 'SYMBOL' AS kind,
    epoch_us(ts) AS t FROM events
  UNION ALL SELECT event_type, 1, 'field', 'clicked', 'DOUBLE', epoch_us(ts) FROM events
    WHERE event_type = 'click'
  UNION ALL SELECT event_type, 1, 'field', 'user_id', 'LONG', epoch_us(ts) FROM events
  UNION ALL SELECT event_type, 2, 'at', 'timestamp', 'TIMESTAMP', epoch_us(ts) FROM events),
g AS (SELECT tbl, rp, role, name, kind, min(t) AS first_us, count(*) AS n_cells FROM c
  GROUP BY ALL)
SELECT tbl, role, name, kind, first_us, n_cells,
  CAST(row_number() OVER (PARTITION BY tbl ORDER BY rp, first_us, name) AS INTEGER) AS position
FROM g"""


def arrival_stamp(spark: SparkSession, sf: str) -> DataFrame:
    """Rows without an instant get one at landing, the others keep theirs."""
    ev = table(spark, sf, "events").withColumn(
        "at", F.when(F.col("event_type") != "error", F.col("ts").cast("timestamp")))
    out = land.stamp(ev, "at")
    return out.select("event_id", F.col("at").isNotNull().alias("has_at"), F.when(
        F.col("event_type") != "error", times.micros(F.col("at"))).alias("own_us"))


ARRIVAL_STAMP = """
SELECT event_id, true AS has_at, CASE WHEN event_type <> 'error' THEN epoch_us(ts) END AS own_us
FROM events"""


def route_stats(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events")
    plan = roles.resolve(ev, table_col=3, at="ts")
    rows = roles.map_types(ev, plan)
    return rows.groupBy("tbl").agg(
        F.count("*").alias("n_rows"), F.min("at_us").alias("first_us"),
        F.max("at_us").alias("last_us"), F.max("user_id").alias("max_user"))


ROUTE_STATS = """
SELECT event_type AS tbl, count(*) AS n_rows, min(epoch_us(ts)) AS first_us,
  max(epoch_us(ts)) AS last_us, max(user_id) AS max_user FROM events GROUP BY 1"""


QUERIES = {f.__name__: f for f in (
    land_dedup, land_lateness, land_lateness_spread, land_time_order, land_day_counts, land_twice, land_rerun,
    land_writers, land_case_variants, land_resent, land_late, conform_types, conform_texts, conform_rejects,
    add_columns, table_catalogue, arrival_stamp, route_stats)}
ORACLES = {name: globals()[name.upper()] for name in QUERIES}
