"""Queries over names, validation and column reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tslines.functions import names
from tslines.operators import validate
from tslines.operators.encode import encode
from tslines.plans import roles
from tslines.sources.tables import table


def name_check(spark: SparkSession, sf: str) -> DataFrame:
    """Page addresses, hosts and part names as table and column names."""
    host = F.regexp_extract("url", "^[a-z]+://([^/]*)", 1)
    pages = table(spark, sf, "pages").select(F.explode(F.array(
        "url", host, F.concat(host, F.lit(".")), F.regexp_replace(host, "[.]", ".."))).alias("name"))
    parts = table(spark, sf, "part").select(F.explode(F.array(
        "p_name", F.concat("p_name", F.lit("-"), "p_brand"), F.lpad("p_type", 128, "x"))).alias(
        "name"))
    both = pages.unionByName(parts)
    return both.select("name", names.name_error(F.col("name"), "table").alias("table_error"),
                       names.name_error(F.col("name"), "column").alias("column_error"))


_BAD = r"""[?,''"\\/:)(+*%~\r\n\x00-\x0f\x7f\x{FEFF}]"""
_BAD_COLUMN = r"""[?,''"\\/:)(+*%~.\r\n\x00-\x0f\x7f\x{FEFF}-]"""
NAME_CHECK = rf"""
WITH p AS (SELECT url, regexp_extract(url, '^[a-z]+://([^/]*)', 1) AS host FROM pages),
n AS (SELECT url AS name FROM p UNION ALL SELECT host FROM p UNION ALL SELECT host || '.' FROM p
  UNION ALL SELECT replace(host, '.', '..') FROM p
  UNION ALL SELECT p_name FROM part UNION ALL SELECT p_name || '-' || p_brand FROM part
  UNION ALL SELECT lpad(p_type, 128, 'x') FROM part)
SELECT name,
  CASE WHEN name = '' THEN 'empty name' WHEN strlen(name) > 127 THEN 'name too long'
    WHEN regexp_matches(name, '{_BAD}') THEN 'forbidden character'
    WHEN name LIKE '.%' OR name LIKE '%.' OR name LIKE '%..%' THEN 'misplaced dot' END
    AS table_error,
  CASE WHEN name = '' THEN 'empty name' WHEN strlen(name) > 127 THEN 'name too long'
    WHEN regexp_matches(name, '{_BAD_COLUMN}') THEN 'forbidden character' END AS column_error
FROM n"""


def bool_strict_rejects(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderpriority") != "5-LOW",
                             F.col("o_orderpriority") < "3").alias("urgent"))
    plan = roles.resolve(df, table="orders", at=roles.SERVER_TIME)
    return validate.rejects(df, plan, "o_orderkey")


BOOL_STRICT_REJECTS = """
SELECT o_orderkey, 2 AS pos, 'null_boolean' AS rule, 'urgent' AS "column",
  CAST(NULL AS VARCHAR) AS value, 'a boolean must not be null' AS message
FROM orders WHERE o_orderpriority = '5-LOW'"""


def _faulty(spark, sf):
    """Line items where some rows break one or more rules."""
    li = table(spark, sf, "lineitem")
    big = "cast(round(l_extendedprice * 100) as decimal(10,0)) * 1000000000000BD"
    df = li.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.when(F.col("l_quantity") == 1, "bad/name").when(F.col("l_quantity") != 2, F.lit("ok")
                                                         ).alias("route"),
        F.expr(f"cast({big} as decimal(20,0))").alias("big"),
        F.when(F.col("l_tax") != 0.08, F.col("l_returnflag") == "A").alias("flag"),
        F.when(F.col("l_quantity") == 3, F.array(F.array("l_tax", "l_tax"), F.array("l_tax")))
        .otherwise(F.array(F.array("l_tax"), F.array("l_discount"))).alias("m"),
        F.when(F.col("l_quantity") == 4, F.timestamp_seconds(F.lit(-1)))
        .otherwise(F.col("l_shipdate").cast("timestamp")).alias("at"))
    df = roles.mark(df, "big", unsigned=True)
    keys = {"l_orderkey", "l_linenumber", "l_partkey"}
    plan = roles.resolve(df, table_col="route", at="at", version=3).without(keys)
    return df, plan


_FAULTS = """
WITH f AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_tax,
    CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR) || '000000000000' AS big
  FROM lineitem),
r AS (
  SELECT l_orderkey, l_linenumber, l_partkey, 0 AS pos, 'table_name' AS rule,
    'route' AS "column", CASE WHEN l_quantity = 1 THEN 'bad/name' END AS value,
    CASE WHEN l_quantity = 1 THEN 'forbidden character' ELSE 'null name' END AS message
  FROM f WHERE l_quantity IN (1, 2)
  UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 1, 'int_overflow', 'big', big,
    'the value does not fit a signed 64-bit integer'
  FROM f WHERE TRY_CAST(big AS BIGINT) IS NULL
  UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 2, 'null_boolean', 'flag', NULL,
    'a boolean must not be null' FROM f WHERE l_tax = 0.08
  UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 3, 'ragged_array', 'm', NULL,
    'all rows of an array must have one size and no nulls' FROM f WHERE l_quantity = 3
  UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 4, 'negative_at', 'at',
    '1969-12-31 23:59:59', 'the instant lies before 1970' FROM f WHERE l_quantity = 4)"""
_SHOWN = """CASE WHEN rule <> 'ragged_array' THEN value END AS value"""


def rejects(spark: SparkSession, sf: str) -> DataFrame:
    df, plan = _faulty(spark, sf)
    out = validate.rejects(df, plan, "l_orderkey", "l_linenumber", "l_partkey")
    return out.withColumn("value", F.expr("case when rule <> 'ragged_array' then value end"))


REJECTS = f"""{_FAULTS}
SELECT l_orderkey, l_linenumber, l_partkey, pos, rule, "column", {_SHOWN}, message FROM r"""


def clean_rows(spark: SparkSession, sf: str) -> DataFrame:
    df, plan = _faulty(spark, sf)
    return validate.clean(df, plan).select("l_orderkey", "l_linenumber", "l_partkey", "route")


CLEAN_ROWS = """
SELECT l_orderkey, l_linenumber, l_partkey, 'ok' AS route FROM lineitem
WHERE l_quantity > 4 AND l_tax <> 0.08 AND TRY_CAST(
  CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR) || '000000000000' AS BIGINT)
  IS NOT NULL"""


def lines_and_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Lenient encoding: each row becomes a line or is a reject, never both or neither."""
    df, plan = _faulty(spark, sf)
    keys = ("l_orderkey", "l_linenumber", "l_partkey")
    lines = encode(df, plan, *keys, strict=False).filter("line is not null and tbl is not null")
    bad = validate.rejects(df, plan, *keys).select(*keys).distinct()
    return lines.select(*keys, F.lit("line").alias("what")).unionByName(
        bad.withColumn("what", F.lit("reject")))


LINES_AND_REJECTS = f"""
WITH ok AS ({CLEAN_ROWS}), f AS (SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
  WHERE NOT coalesce(l_quantity > 4 AND l_tax <> 0.08 AND TRY_CAST(
    CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR) || '000000000000' AS BIGINT)
    IS NOT NULL, false))
SELECT l_orderkey, l_linenumber, l_partkey, 'line' AS what FROM ok
UNION ALL SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, 'reject' FROM f"""


def first_error(spark: SparkSession, sf: str) -> DataFrame:
    df, plan = _faulty(spark, sf)
    out = validate.first_error(df, plan, "l_orderkey", "l_linenumber", "l_partkey")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "pos", "rule", "column", "message")


FIRST_ERROR = f"""{_FAULTS}
SELECT l_orderkey, l_linenumber, l_partkey, pos, rule, "column", message FROM r
ORDER BY l_orderkey, l_linenumber, l_partkey, pos LIMIT 1"""


def strict_load(spark: SparkSession, sf: str) -> DataFrame:
    """A clean table passes the strict check as a whole and is then encoded."""
    df = table(spark, sf, "customer")
    plan = roles.resolve(df, table="customer", symbols=True, at=roles.SERVER_TIME, version=1)
    return encode(validate.strict(df, plan, "c_custkey"), plan).select("line")


STRICT_LOAD = """
SELECT 'customer,c_name=' || c_name || ',c_mktsegment=' || c_mktsegment || ' c_custkey='
  || c_custkey || 'i,c_nationkey=' || c_nationkey || 'i,c_acctbal=' || CAST(c_acctbal AS VARCHAR)
  AS line FROM customer"""


def strict_refused(spark: SparkSession, sf: str) -> DataFrame:
    """A strict load of each table in turn: one bad row refuses all of its table's rows."""
    ev = table(spark, sf, "events").withColumn("hot", F.when(
        (F.col("event_type") != "error") | (F.col("user_id") % 3 != 0), F.col("value") > 50))
    kept = None
    for (kind,) in sorted(map(tuple, ev.select("event_type").distinct().collect())):
        rows = ev.filter(F.col("event_type") == kind)
        plan = roles.resolve(rows, table=kind, at="ts", version=1)
        try:
            part = validate.strict(rows, plan, "event_id").select("event_id", F.lit(None).cast("string").alias("error"))
        except validate.RejectedRows as refused:
            part = rows.agg(F.lit(None).cast("bigint").alias("event_id"), F.lit(str(refused)).alias("error"))
        part = part.withColumn("tbl", F.lit(kind))
        kept = part if kept is None else kept.unionByName(part)
    return kept


STRICT_REFUSED = """
SELECT event_type AS tbl, event_id, CAST(NULL AS VARCHAR) AS error FROM events WHERE event_type <> 'error'
UNION ALL SELECT 'error', CAST(NULL AS BIGINT), 'row [' || min(event_id) || '], column ''hot'': a boolean must not be null (value None)'
FROM events WHERE event_type = 'error' AND user_id % 3 = 0"""


def sniff_types(spark: SparkSession, sf: str) -> DataFrame:
    """Kinds of loosely typed text columns by their first value."""
    ev = table(spark, sf, "events").select(
        "event_id", F.get_json_object("props", "$.k").alias("k"), "event_type",
        F.nullif(F.col("value").cast("string"), F.lit("6.55")).alias("value"),
        F.when(F.col("event_type") == "error", "true").otherwise(
            F.get_json_object("props", "$.k")).alias("mixed"),
        F.lit(None).cast("string").alias("none"))
    return validate.sniff(ev, ["k", "event_type", "value", "mixed", "none"], "event_id")


_KIND = """CASE WHEN v IS NULL THEN NULL WHEN v IN ('true', 'false') THEN 'boolean'
  WHEN regexp_full_match(v, '[+-]?[0-9]+') THEN 'integer'
  WHEN regexp_full_match(v, '[+-]?([0-9]+\\.[0-9]*|\\.[0-9]+|[0-9]+)([eE][+-]?[0-9]+)?')
  THEN 'float' ELSE 'string' END""".replace("\\\\", "\\")
SNIFF_TYPES = f"""
WITH c AS (
  SELECT event_id, 'k' AS "column", json_extract_string(props, '$.k') AS v FROM events
  UNION ALL SELECT event_id, 'event_type', event_type FROM events
  UNION ALL SELECT event_id, 'value', nullif(CAST(value AS VARCHAR), '6.55') FROM events
  UNION ALL SELECT event_id, 'mixed', CASE WHEN event_type = 'error' THEN 'true'
    ELSE json_extract_string(props, '$.k') END FROM events
  UNION ALL SELECT event_id, 'none', NULL FROM events),
k AS (SELECT event_id, "column", {_KIND} AS kind FROM c),
f AS (SELECT "column", arg_min(kind, event_id) FILTER (kind IS NOT NULL) AS kind FROM k GROUP BY 1)
SELECT f."column", coalesce(f.kind, 'skip') AS kind,
  count(*) FILTER (k.kind = f.kind OR (f.kind = 'string' AND k.kind IS NOT NULL)) AS n_agree,
  count(*) FILTER (k.kind <> f.kind AND f.kind <> 'string') AS n_disagree,
  count(*) FILTER (k.kind IS NULL) AS n_null
FROM k JOIN f ON k."column" = f."column" GROUP BY f."column", f.kind"""


def _loose(spark, sf):
    k = F.get_json_object("props", "$.k")
    return table(spark, sf, "events").select(
        "event_id", k.alias("k"), F.when((F.col("value") > 95) & (F.col("event_id") > 0), "high").otherwise(
            F.col("value").cast("string")).alias("value"), F.lit(None).cast("string").alias("none"))


def typed_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Text columns cast to the kind of their first value; other rows are set aside."""
    return validate.typed(_loose(spark, sf), ["k", "value", "none"], "event_id")[0]


TYPED_ROWS = """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, value FROM events
WHERE value <= 95 OR event_id = 0"""


def typed_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return validate.typed(_loose(spark, sf), ["k", "value", "none"], "event_id")[1]


TYPED_REJECTS = """
SELECT event_id, 'value' AS "column", 'float' AS expected, 'high' AS value FROM events
WHERE value > 95 AND event_id > 0"""


def null_profile(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "events").select(
        "event_id", F.nullif("event_type", F.lit("error")).alias("event_type"),
        F.when(F.col("value") < 10, F.lit(float("nan"))).when(
            F.col("value") < 90, F.col("value")).alias("value"))
    plan = roles.resolve(df, table="e", symbols=["event_type"], at=roles.SERVER_TIME)
    return validate.null_profile(df, plan)


NULL_PROFILE = """
SELECT 'event_type' AS "column", 'symbol' AS target, count(*) FILTER (event_type = 'error')
    AS n_null, CAST(0 AS BIGINT) AS n_nan, count(*) FILTER (event_type = 'error') AS n_elided,
  count(*) FILTER (event_type <> 'error') AS n_written FROM events
UNION ALL SELECT 'event_id', 'integer', 0, 0, 0, count(*) FROM events
UNION ALL SELECT 'value', 'float', count(*) FILTER (value >= 90), count(*) FILTER (value < 10),
  count(*) FILTER (value >= 90), count(*) FILTER (value < 90) FROM events"""


def version_loss(spark: SparkSession, sf: str) -> DataFrame:
    """What versions 1 and 2 lose of nanoseconds, arrays and decimals."""
    ev = roles.mark(table(spark, sf, "events").select(
        "event_id", (F.unix_micros(F.col("ts").cast("timestamp")) * 1000
                     + F.col("event_id") % 3).alias("ns")), "ns", unit="ns")
    em = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").alias("arr"))
    li = table(spark, sf, "lineitem").select(
        F.when(F.col("l_quantity") > 10, F.col("l_tax")).cast("decimal(9,4)").alias("dec"))
    out = None
    for df in (ev, em, li):
        plan = roles.resolve(df, table="t", at=roles.SERVER_TIME, version=3)
        for version in (1, 2):
            part = validate.version_loss(df, plan, version).withColumn("version", F.lit(version))
            out = part if out is None else out.unionByName(part)
    return out


VERSION_LOSS = """
WITH e AS (SELECT count(*) FILTER (event_id % 3 <> 0) AS r FROM events),
a AS (SELECT count(*) AS n FROM embeddings),
d AS (SELECT count(*) FILTER (l_quantity > 10) AS n FROM lineitem)
SELECT 'event_id' AS "column", 'integer' AS target, CAST(0 AS BIGINT) AS n_lost,
  CAST(0 AS BIGINT) AS n_reduced, v AS version FROM (VALUES (1), (2)) t(v)
UNION ALL SELECT 'vec_id', 'integer', 0, 0, v FROM (VALUES (1), (2)) t(v)
UNION ALL SELECT 'ns', 'timestamp', 0, r, 1 FROM e UNION ALL SELECT 'ns', 'timestamp', 0, 0, 2
UNION ALL SELECT 'arr', 'array', n, 0, 1 FROM a UNION ALL SELECT 'arr', 'array', 0, 0, 2
UNION ALL SELECT 'dec', 'decimal', n, 0, 1 FROM d UNION ALL SELECT 'dec', 'decimal', n, 0, 2 FROM d
"""


def utf8_check(spark: SparkSession, sf: str) -> DataFrame:
    """French documents get a stray byte; only those are found, and repaired."""
    raw = F.col("text").cast("binary")
    df = table(spark, sf, "documents").select("doc_id", F.when(
        F.col("lang") == "fr", F.concat(raw, F.lit(b"\xff"))).otherwise(raw).alias("raw"))
    return validate.utf8_errors(df, "raw", "doc_id")


UTF8_CHECK = """
SELECT doc_id, text || chr(65533) AS repaired, CAST(length(text) + 1 AS INTEGER) AS bad_char
FROM documents WHERE lang = 'fr'"""


def all_null_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows with nothing to write: left out of the lines, listed as rejects."""
    df = table(spark, sf, "events").select(
        "event_id", F.nullif("event_type", F.lit("error")).alias("kind"),
        F.when(F.col("value") > 50, F.col("value")).alias("value"))
    plan = roles.resolve(df, table="e", symbols=["kind"], at=roles.SERVER_TIME,
                         version=1).without({"event_id"})
    written = encode(df, plan, "event_id").select("event_id", F.lit("written").alias("fate"))
    empty = validate.rejects(df, plan, "event_id").select("event_id", F.col("rule").alias("fate"))
    return written.unionByName(empty)


ALL_NULL_ROWS = """
SELECT event_id, CASE WHEN event_type = 'error' AND value <= 50 THEN 'all_null_row'
  ELSE 'written' END AS fate FROM events"""


QUERIES = {f.__name__: f for f in (
    name_check, bool_strict_rejects, rejects, clean_rows, lines_and_rejects, first_error, strict_load, strict_refused,
    sniff_types,
    typed_rows, typed_rejects, null_profile, version_loss, utf8_check, all_null_rows)}
ORACLES = {name: globals()[name.upper()] for name in QUERIES}
