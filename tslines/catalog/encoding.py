"""Queries over roles, encoders and decoders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tslines.functions import numbers, times
from tslines.operators import decode
from tslines.operators.encode import encode, payload_size
from tslines.plans import roles
from tslines.sources.tables import from_events, table

# Oracle pieces: escaping as DuckDB SQL.
BARE = r"regexp_replace({}, '([ ,=\n\r\\])', '\\\1', 'g')"
QUOTED = r"""'"' || regexp_replace({}, '(["\\\n\r])', '\\\1', 'g') || '"'"""


def encode_v1_orders(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "orders")
    plan = roles.resolve(df, table="orders", symbols=["o_orderstatus", "o_orderpriority"],
                         at="o_orderdate", version=1)
    return encode(df, plan, "o_orderkey")


ORDERS_LINE = f"""'orders,o_orderstatus=' || {BARE.format('o_orderstatus')}
  || ',o_orderpriority=' || {BARE.format('o_orderpriority')}
  || ' o_orderkey=' || o_orderkey || 'i,o_custkey=' || o_custkey || 'i,o_totalprice='
  || CAST(o_totalprice AS VARCHAR) || ' ' || CAST(epoch_us(o_orderdate) * 1000 AS VARCHAR)"""

ENCODE_V1_ORDERS = f"""
SELECT o_orderkey, 'orders' AS tbl, line, CAST(strlen(line) + 1 AS BIGINT) AS n_bytes
FROM (SELECT o_orderkey, {ORDERS_LINE} AS line FROM orders)"""


def _events_with_nulls(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", "event_type", "props", "ts",
        F.expr("nullif(user_id, 7)").alias("user_id"),
        F.when(F.col("value") <= 50, F.col("value")).alias("value"))


def encode_v1_events_nulls(spark: SparkSession, sf: str) -> DataFrame:
    df = _events_with_nulls(spark, sf)
    plan = roles.resolve(df, table="events", symbols=["event_type"], at=-3, version=1)
    return encode(df, plan, "event_id")


ENCODE_V1_EVENTS_NULLS = f"""
SELECT event_id, 'events' AS tbl, line, CAST(strlen(line) + 1 AS BIGINT) AS n_bytes FROM (
  SELECT event_id, 'events,event_type=' || {BARE.format('event_type')}
    || ' event_id=' || event_id || 'i,props=' || {QUOTED.format('props')}
    || CASE WHEN user_id <> 7 THEN ',user_id=' || user_id || 'i' ELSE '' END
    || CASE WHEN value <= 50 THEN ',value=' || CAST(value AS VARCHAR) ELSE '' END
    || ' ' || CAST(epoch_us(ts) * 1000 AS VARCHAR) AS line FROM events)"""


def encode_v1_documents(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "documents")
    plan = roles.resolve(df, table="docs", symbols=["lang", "source"], at=roles.SERVER_TIME,
                         version=1)
    return encode(df, plan, "doc_id")


ENCODE_V1_DOCUMENTS = f"""
SELECT doc_id, 'docs' AS tbl, line, CAST(strlen(line) + 1 AS BIGINT) AS n_bytes FROM (
  SELECT doc_id, 'docs,lang=' || {BARE.format('lang')} || ',source=' || {BARE.format('source')}
    || ' doc_id=' || doc_id || 'i,text=' || {QUOTED.format('text')}
    || ',n_chars=' || n_chars || 'i' AS line FROM documents)"""


#: `=`, the type tag and the eight bytes of a double, lowest first, as hexadecimal text.
DOUBLE_HEX = """('3D10' || list_aggregate(list_transform([15,13,11,9,7,5,3,1],
    lambda i: substr(hex(CAST(CAST({0} AS DOUBLE) AS BIT)::BLOB), i, 2)), 'string_agg', ''))"""


def encode_v2_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    """Binary doubles: every byte of each line."""
    df = table(spark, sf, "lineitem")
    plan = roles.resolve(df, table="lineitem", symbols=["l_returnflag", "l_linestatus"],
                         at="l_shipdate", version=2)
    lines = encode(df, plan, "l_orderkey", "l_linenumber", "l_partkey")
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", "n_bytes",
                        F.hex("line").alias("line_hex"))


ENCODE_V2_LINEITEM = """
SELECT l_orderkey, l_linenumber, l_partkey,
  CAST(strlen('lineitem,l_returnflag=' || l_returnflag || ',l_linestatus=' || l_linestatus
    || ' l_orderkey=' || l_orderkey || 'i,l_partkey=' || l_partkey || 'i,l_suppkey=' || l_suppkey
    || 'i,l_linenumber=' || l_linenumber || 'i,l_quantity===,l_extendedprice===,l_discount==='
    || ',l_tax=== ' || epoch_us(l_shipdate) || 't') + 4 * 8 + 1 AS BIGINT) AS n_bytes,
  hex('lineitem,l_returnflag=' || l_returnflag || ',l_linestatus=' || l_linestatus || ' l_orderkey='
    || l_orderkey || 'i,l_partkey=' || l_partkey || 'i,l_suppkey=' || l_suppkey || 'i,l_linenumber='
    || l_linenumber || 'i,l_quantity=') || {quantity} || hex(',l_extendedprice=') || {price}
    || hex(',l_discount=') || {discount} || hex(',l_tax=') || {tax}
    || hex(' ' || epoch_us(l_shipdate) || 't') AS line_hex
FROM lineitem""".format(**{n: DOUBLE_HEX.format(c) for n, c in (
    ("quantity", "l_quantity"), ("price", "l_extendedprice"), ("discount", "l_discount"),
    ("tax", "l_tax"))})


def encode_v3_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with decimals of 4, 8 and 16 bytes, as hexadecimal text."""
    df = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.col("l_tax").cast("decimal(7,2)").alias("a"),
        F.col("l_extendedprice").cast("decimal(14,4)").alias("b"),
        (-F.col("l_extendedprice")).cast("decimal(38,6)").alias("c"))
    plan = roles.resolve(df, table="l", at=roles.SERVER_TIME, version=3)
    lines = encode(df, plan, "l_orderkey", "l_linenumber")
    return lines.select("l_orderkey", "l_linenumber", F.lower(F.hex("line")).alias("line_hex"))


ENCODE_V3_LINEITEM = """
SELECT l_orderkey, l_linenumber,
  lower(hex('l l_orderkey=' || l_orderkey || 'i,l_linenumber=' || l_linenumber || 'i,a=')) || '3d170204'
  || printf('%08x', CAST(CAST(l_tax AS DECIMAL(7,2)) * 100 AS BIGINT))
  || lower(hex(',b=')) || '3d170408'
  || printf('%016x', CAST(CAST(l_extendedprice AS DECIMAL(14,4)) * 10000 AS BIGINT))
  || lower(hex(',c=')) || '3d170610' || 'ffffffffffffffff' || printf('%016x',
    CAST(18446744073709551616 - CAST(CAST(l_extendedprice AS DECIMAL(38,6)) * 1000000 AS HUGEINT)
    AS UBIGINT)) AS line_hex
FROM lineitem"""


def payload_size_by_table(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "events").select("event_type", "user_id", "value", "ts")
    plan = roles.resolve(df, table_col="event_type", at="ts", version=1)
    return payload_size(encode(df, plan))


PAYLOAD_SIZE_BY_TABLE = """
SELECT event_type AS tbl, count(*) AS n_rows,
  CAST(sum(strlen(event_type || ' user_id=' || user_id || 'i,value=' || CAST(value AS VARCHAR)
    || ' ' || CAST(epoch_us(ts) * 1000 AS VARCHAR)) + 1) AS BIGINT) AS n_bytes
FROM events GROUP BY event_type"""


def symbol_auto_true_list(spark: SparkSession, sf: str) -> DataFrame:
    df = roles.mark(table(spark, sf, "customer"), "c_mktsegment", symbol=True)
    out = None
    for name, choice in (("auto", "auto"), ("all", True), ("none", False), ("list", [1])):
        plan = roles.resolve(df, table="c", symbols=choice, at=roles.Instant(1000), version=1)
        lines = encode(df, plan, "c_custkey").withColumn("mode", F.lit(name))
        out = lines if out is None else out.unionByName(lines)
    return out.select("mode", "c_custkey", "line")


_KEY, _REST = "' c_custkey=' || c_custkey || 'i'", (
    "',c_nationkey=' || c_nationkey || 'i,c_acctbal=' || CAST(c_acctbal AS VARCHAR)")
_NAME_S, _SEG_S = "',c_name=' || c_name", "',c_mktsegment=' || c_mktsegment"
_NAME_F, _SEG_F = """',c_name="' || c_name || '"'""", """',c_mktsegment="' || c_mktsegment || '"'"""
SYMBOL_AUTO_TRUE_LIST = f"""
SELECT 'auto' AS mode, c_custkey,
  'c' || {_SEG_S} || {_KEY} || {_NAME_F} || {_REST} || ' 1000' AS line FROM customer
UNION ALL SELECT 'all', c_custkey,
  'c' || {_NAME_S} || {_SEG_S} || {_KEY} || {_REST} || ' 1000' FROM customer
UNION ALL SELECT 'none', c_custkey,
  'c' || {_KEY} || {_NAME_F} || {_REST} || {_SEG_F} || ' 1000' FROM customer
UNION ALL SELECT 'list', c_custkey,
  'c' || {_NAME_S} || {_KEY} || {_REST} || {_SEG_F} || ' 1000' FROM customer"""


def widen_types(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "part").select(
        "p_partkey", F.col("p_size").cast("tinyint").alias("tiny"),
        F.col("p_size").cast("smallint").alias("small"), "p_size",
        F.col("p_retailprice").cast("float").alias("single"),
        F.expr("nullif(p_size, 11)").alias("gap"))
    plan = roles.resolve(df, table="part", at=roles.SERVER_TIME)
    return roles.map_types(df, plan)


WIDEN_TYPES = """
SELECT 'part' AS tbl, p_partkey, CAST(p_size AS BIGINT) AS tiny, CAST(p_size AS BIGINT) AS small,
  CAST(p_size AS BIGINT) AS p_size, CAST(CAST(p_retailprice AS FLOAT) AS DOUBLE) AS single,
  CAST(nullif(p_size, 11) AS BIGINT) AS gap, CAST(NULL AS BIGINT) AS at_us FROM part"""


def u64_guard(spark: SparkSession, sf: str) -> DataFrame:
    wide = "concat(cast(cast(round(l_extendedprice * 100) as bigint) as string), '000000000000')"
    df = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.expr(f"cast({wide} as decimal(20,0))").alias("u64"))
    df = roles.mark(df, "u64", unsigned=True)
    plan = roles.resolve(df, table="t", at=roles.SERVER_TIME)
    return roles.map_types(df, plan).select(
        "l_orderkey", "l_linenumber", F.col("u64").alias("as_bigint"))


U64_GUARD = """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, TRY_CAST(
  CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR) || '000000000000' AS BIGINT)
  AS as_bigint FROM lineitem"""


def at_normalise(spark: SparkSession, sf: str) -> DataFrame:
    """Timestamps with and without zone and nanosecond integers reach the same instants."""
    df = table(spark, sf, "events").withColumn(
        "at", F.when(F.col("event_type") != "error", F.col("ts")))
    us = times.micros(F.col("at"))
    df = df.select("event_id", "at", F.col("at").cast("timestamp").alias("zoned"),
                   (us * 1000 + 999).alias("ns"), us.alias("us"))
    df = roles.mark(df, "ns", unit="ns")
    cells = {c: roles.resolve(df, table="t", at=c) for c in ("at", "zoned", "ns")}
    return df.select(
        "event_id",
        *[p.at_micros().alias(f"{c}_us") for c, p in cells.items()],
        times.micros(F.timestamp_micros("us")).alias("back_us"),
        times.nanos_to_micros(-F.col("ns")).alias("before_epoch_us"),
        F.coalesce(F.col("at") >= "1970-01-01", F.lit(True)).alias("in_range"))


AT_NORMALISE = """
SELECT event_id, us AS at_us, us AS zoned_us, us AS ns_us, us AS back_us,
  -us - 1 AS before_epoch_us, true AS in_range
FROM (SELECT event_id, CASE WHEN event_type <> 'error' THEN epoch_us(ts) END AS us FROM events)"""


def decimal_parts(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").cast("decimal(18,2)").alias("p"),
        (-F.col("l_extendedprice")).cast("decimal(30,6)").alias("w"))
    return d.select(
        "l_orderkey", "l_linenumber", F.lit(2).alias("scale"),
        numbers.unscaled(F.col("p"), 18, 2).cast("bigint").alias("unscaled"),
        numbers.unscaled(F.col("w"), 30, 6).cast("string").alias("wide_unscaled"))


DECIMAL_PARTS = """
SELECT l_orderkey, l_linenumber, 2 AS scale,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS unscaled,
  CAST(CAST(CAST(-l_extendedprice AS DECIMAL(30,6)) * 1000000 AS HUGEINT) AS VARCHAR)
    AS wide_unscaled
FROM lineitem"""


def array_shape(spark: SparkSession, sf: str) -> DataFrame:
    """Rank, sizes and row-major values read back from the array payload."""
    df = table(spark, sf, "embeddings").select(
        "vec_id", F.array(F.slice("embedding", 1, 32), F.slice("embedding", 33, 32)).alias("m"))
    plan = roles.resolve(df, table="e", at=roles.SERVER_TIME, version=2)
    rows = decode.binary_lines(encode(df, plan, "vec_id"), "vec_id")
    m = decode.field("m", "numbers")
    return rows.select(
        "vec_id", F.size(decode.field("m", "dims")).alias("rank"),
        F.get(decode.field("m", "dims"), F.lit(0)).alias("n_rows"),
        F.get(decode.field("m", "dims"), F.lit(1)).alias("n_cols"),
        F.posexplode(m).alias("cell", "value"))


ARRAY_SHAPE = """
SELECT vec_id, 2 AS rank, 2 AS n_rows, 32 AS n_cols, CAST(unnest(range(64)) AS INTEGER) AS cell,
  CAST(unnest(embedding) AS DOUBLE) AS value
FROM embeddings"""


def drop_null_columns(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "events").select(
        "event_id", "user_id", F.lit(None).alias("none"),
        F.when(F.col("value") < -1e18, F.col("value")).alias("never"), "value")
    plan = roles.drop_empty(df, roles.resolve(df, table="e", at=roles.SERVER_TIME, version=1))
    kept = F.lit(",".join(c.name for c in plan.cells))
    return encode(df, plan, "event_id").select("event_id", "line", kept.alias("columns"))


DROP_NULL_COLUMNS = """
SELECT event_id, 'e event_id=' || event_id || 'i,user_id=' || user_id || 'i,value='
  || CAST(value AS VARCHAR) AS line, 'event_id,user_id,value' AS columns FROM events"""


def pivot_long_rows(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events")
    none_s, none_d = F.lit(None).cast("string"), F.lit(None).cast("double")
    long = ev.select("event_id", F.explode(F.array(
        F.struct(F.lit("kind").alias("name"), F.nullif(F.col("event_type"), F.lit("error")).alias(
            "s"), none_d.alias("d")),
        F.struct(F.lit("value").alias("name"), none_s.alias("s"),
                 F.when(F.col("value") < 30, F.col("value")).alias("d")),
    )).alias("c")).select("event_id", "c.*")
    return from_events(long, "event_id", "name", {"text": "s", "number": "d"},
                       {"kind": "text", "value": "number"})


PIVOT_LONG_ROWS = """
SELECT * FROM (SELECT event_id, nullif(event_type, 'error') AS kind,
  CASE WHEN value < 30 THEN value END AS value FROM events)
WHERE kind IS NOT NULL OR value IS NOT NULL"""


def pivot_all_types(spark: SparkSession, sf: str) -> DataFrame:
    """Rows given as cells of nine types, some of them absent, become typed columns."""
    ev = table(spark, sf, "events")
    us = times.micros(F.col("ts"))
    cells = {
        "flag": F.col("value") > 50, "count": F.col("user_id"), "level": F.col("value"),
        "kind": F.nullif("event_type", F.lit("error")), "text": F.col("props"), "seen": F.col("ts").cast("timestamp"),
        "nanos": us * 1000 + 1, "pair": F.array("value", F.col("value") * 2),
        "price": F.col("value").cast("decimal(12,2)")}
    types = {n: ev.select(c.alias(n)).schema[n].dataType for n, c in cells.items()}
    rows = [F.struct(F.lit(n).alias("name"), *[(c if n == m else F.lit(None).cast(types[m])).alias(f"as_{m}")
                                               for m in cells]) for n, c in cells.items()]
    # every fifth event has no cell at all, users above 50 have no level
    long = ev.select("event_id", F.explode(F.array(*rows)).alias("c"), "user_id").select("event_id", "user_id", "c.*")
    long = long.filter("event_id % 5 <> 0 AND NOT (name = 'level' AND user_id > 50)").drop("user_id")
    wide = from_events(long, "event_id", "name", {n: f"as_{n}" for n in cells}, {n: n for n in cells})
    return wide.select("event_id", "flag", "count", "level", "kind", "text", times.micros(F.col("seen")).alias("seen_us"),
                       "nanos", F.get("pair", F.lit(1)).alias("second"), F.col("price").cast("string").alias("price"))


PIVOT_ALL_TYPES = """
SELECT event_id, value > 50 AS flag, user_id AS "count", CASE WHEN user_id <= 50 THEN value END AS level,
  nullif(event_type, 'error') AS kind, props AS text, epoch_us(ts) AS seen_us, epoch_us(ts) * 1000 + 1 AS nanos,
  value * 2 AS second, CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) AS price
FROM events WHERE event_id % 5 <> 0"""


def roundtrip_v1(spark: SparkSession, sf: str) -> DataFrame:
    rows = decode.text_lines(encode_v1_orders(spark, sf))
    return rows.filter("ok").select(
        "tbl", decode.field("o_orderkey").cast("bigint").alias("o_orderkey"),
        decode.field("o_custkey").cast("bigint").alias("o_custkey"),
        decode.symbol("o_orderstatus").alias("o_orderstatus"),
        decode.symbol("o_orderpriority").alias("o_orderpriority"),
        decode.field("o_totalprice").cast("double").alias("o_totalprice"),
        times.nanos_to_micros(F.col("at")).alias("at_us"))


ROUNDTRIP_V1 = """
SELECT 'orders' AS tbl, o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_totalprice,
  epoch_us(o_orderdate) AS at_us FROM orders"""


def roundtrip_v1_documents(spark: SparkSession, sf: str) -> DataFrame:
    rows = decode.text_lines(encode_v1_documents(spark, sf))
    return rows.filter("ok").select(
        decode.field("doc_id").cast("bigint").alias("doc_id"), decode.symbol("lang").alias("lang"),
        decode.field("text").alias("text"), "at")


ROUNDTRIP_V1_DOCUMENTS = "SELECT doc_id, lang, text, CAST(NULL AS BIGINT) AS at FROM documents"


def roundtrip_v2(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "lineitem")
    plan = roles.resolve(df, table="li", symbols=["l_returnflag"], at="l_shipdate", version=2)
    rows = decode.binary_lines(encode(df, plan)).filter("ok")
    return rows.select(
        decode.field("l_orderkey").cast("bigint").alias("l_orderkey"),
        decode.symbol("l_returnflag").alias("l_returnflag"),
        decode.field("l_linestatus").alias("l_linestatus"),
        *[decode.field(c, "number").alias(c)
          for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")],
        F.col("at").alias("at_us"), "at_unit")


ROUNDTRIP_V2 = """
SELECT l_orderkey, l_returnflag, l_linestatus, l_quantity, l_extendedprice, l_discount, l_tax,
  epoch_us(l_shipdate) AS at_us, 'us' AS at_unit FROM lineitem"""


def roundtrip_v3(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_tax").cast("decimal(7,2)").alias("a"),
        F.col("l_extendedprice").cast("decimal(14,4)").alias("b"),
        (-F.col("l_extendedprice")).cast("decimal(38,6)").alias("c"),
        F.concat(F.col("l_partkey").cast("string"),
                 F.lpad(F.col("l_suppkey").cast("string"), 30, "0"), F.lit("."),
                 F.lpad(F.col("l_linenumber").cast("string"), 12, "0")).alias("d"))
    df = roles.mark(df, "d", decimal_text=True)
    plan = roles.resolve(df, table="li", at=roles.SERVER_TIME, version=3)
    rows = decode.binary_lines(encode(df, plan)).filter("ok")
    return rows.select(decode.field("l_orderkey").cast("bigint").alias("l_orderkey"),
                       *[decode.field(c).alias(c) for c in "abcd"])


ROUNDTRIP_V3 = """
SELECT l_orderkey, CAST(CAST(l_tax AS DECIMAL(7,2)) AS VARCHAR) AS a,
  CAST(CAST(l_extendedprice AS DECIMAL(14,4)) AS VARCHAR) AS b,
  CAST(CAST(-l_extendedprice AS DECIMAL(38,6)) AS VARCHAR) AS c,
  coalesce(nullif(ltrim(l_partkey || lpad(CAST(l_suppkey AS VARCHAR), 30, '0'), '0'), ''), '0')
    || '.'
    || lpad(CAST(l_linenumber AS VARCHAR), 12, '0') AS d
FROM lineitem"""


def decode_wide(spark: SparkSession, sf: str) -> DataFrame:
    """Lines back to a typed table."""
    ev = _events_with_nulls(spark, sf).withColumn("hot", F.col("event_type") == "click")
    plan = roles.resolve(ev, table="events", symbols=["event_type"], at="ts", version=2)
    return decode.wide(decode.binary_lines(encode(ev, plan)), {
        "event_id": "bigint", "event_type": "string", "props": "string", "user_id": "bigint",
        "value": "double", "hot": "boolean"})


DECODE_WIDE = """
SELECT 'events' AS tbl, event_id, event_type, props, nullif(user_id, 7) AS user_id,
  CASE WHEN value <= 50 THEN value END AS value, event_type = 'click' AS hot, epoch_us(ts) AS at_us
FROM events"""


def decode_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Lines torn apart are told from whole ones: page text, cut at its line ends."""
    pages = table(spark, sf, "pages").select("page_id", F.concat(
        F.lit("page n="), F.length("html").cast("string"), F.lit('i,html="'), F.col("html"),
        F.lit('"')).alias("whole"))
    lines = pages.select("page_id", F.posexplode(F.split("whole", "\n")).alias("part", "line"))
    return decode.text_lines(lines, "page_id", "part").select("page_id", "part", "ok")


DECODE_REJECTS = r"""
WITH w AS (SELECT page_id, string_split('page n=' || length(html) || 'i,html="' || html || '"', chr(10))
  AS parts FROM pages)
SELECT page_id, CAST(unnest(range(len(parts))) AS INTEGER) AS part, regexp_full_match(unnest(parts),
  '([^ ,=\\]|\\.)+ n=[0-9]+i,html="([^"\\]|\\.)*"') AS ok FROM w"""


def decode_bad_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Whole numbers and instants beyond 64 bits make a line a reject, in both forms."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("string")
    x, at = F.concat(cents, F.lit("000000000000")), F.concat(F.lit("-"), cents, F.lit("99999999999"))
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.concat(
        F.lit("t x="), F.when(F.col("l_linenumber") % 2 == 0, x).otherwise(cents), F.lit("i "),
        F.when(F.col("l_linenumber") % 3 == 0, at).otherwise(cents)).alias("line"))
    key = ("l_orderkey", "l_linenumber", "l_partkey")
    text = decode.text_lines(rows, *key)
    raw = decode.binary_lines(rows.select(*key, F.col("line").cast("binary").alias("line")), *key)
    out = None
    for form, got in (("text", text), ("binary", raw)):
        got = got.select(*key, F.lit(form).alias("form"), "ok", decode.field("x").alias("x"), "at")
        out = got if out is None else out.unionByName(got)
    return out


DECODE_BAD_NUMBERS = """
WITH n AS (SELECT l_orderkey, l_linenumber, l_partkey,
    CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR) AS cents FROM lineitem),
t AS (SELECT *, CASE WHEN l_linenumber % 2 = 0 THEN cents || '000000000000' ELSE cents END AS x,
    CASE WHEN l_linenumber % 3 = 0 THEN '-' || cents || '99999999999' ELSE cents END AS stamp FROM n),
k AS (SELECT *, TRY_CAST(x AS BIGINT) IS NOT NULL AND TRY_CAST(stamp AS BIGINT) IS NOT NULL AS ok FROM t)
SELECT l_orderkey, l_linenumber, l_partkey, form, ok, CASE WHEN ok THEN x END AS x,
  CASE WHEN ok THEN TRY_CAST(stamp AS BIGINT) END AS "at"
FROM k, (VALUES ('text'), ('binary')) f(form)"""


QUERIES = {f.__name__: f for f in (
    encode_v1_orders, encode_v1_events_nulls, encode_v1_documents, encode_v2_lineitem,
    encode_v3_lineitem, payload_size_by_table, symbol_auto_true_list, widen_types, u64_guard,
    at_normalise, decimal_parts, array_shape, drop_null_columns, pivot_long_rows, pivot_all_types, roundtrip_v1,
    roundtrip_v1_documents, roundtrip_v2, roundtrip_v3, decode_wide, decode_rejects,
    decode_bad_numbers)}
ORACLES = {name: globals()[name.upper()] for name in QUERIES}
