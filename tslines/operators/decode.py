"""Decode protocol lines back into rows.

Lines are taken apart by an Arrow function that works on whole buffers
(`functions.lines`): the cells of many lines at a time, and no Python per line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tslines.functions import lines
from tslines.functions.times import nanos_to_micros

SYMBOLS = T.ArrayType(T.StructType([
    T.StructField("name", T.StringType()), T.StructField("value", T.StringType())]))
FIELDS = T.ArrayType(T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("number", T.DoubleType()),
    T.StructField("numbers", T.ArrayType(T.DoubleType())),
    T.StructField("dims", T.ArrayType(T.IntegerType())),
]))


def split_text(payloads: DataFrame, column: str = "payload", *keep: str) -> DataFrame:
    """One row per line of each text payload; escaped line ends do not split."""
    lines = F.regexp_extract_all(
        F.col(column), F.lit(r"(?s)([^\\\n]*+(?:\\.[^\\\n]*+)*+)\n"), F.lit(1))
    return payloads.select(*keep, F.posexplode(lines).alias("line_no", "line"))


DECODED = T.StructType([
    T.StructField("tbl", T.StringType()),
    T.StructField("symbols", SYMBOLS),
    T.StructField("fields", FIELDS),
    T.StructField("at", T.LongType()),
    T.StructField("at_unit", T.StringType()),
    T.StructField("ok", T.BooleanType()),
])


TEXT_FIELDS = T.ArrayType(T.StructType(FIELDS.elementType.fields[:3]))
DECODED_TEXT = T.StructType([
    T.StructField("fields", TEXT_FIELDS) if f.name == "fields" else f for f in DECODED.fields])

# Declared non-deterministic so that a filter on the result does not run them twice.
_parsed = F.arrow_udf(lambda cells: lines.take_apart(cells, False), DECODED).asNondeterministic()
_parsed_text = F.arrow_udf(lambda cells: lines.take_apart(cells, True), DECODED_TEXT).asNondeterministic()
_framed = F.arrow_udf(lines.split, T.ArrayType(T.BinaryType())).asNondeterministic()


def text_lines(df: DataFrame, *keep: str, column: str = "line") -> DataFrame:
    """`keep`, `tbl`, `symbols`, `fields`, `at`, `at_unit` and `ok` for each text line.

    A line that is malformed, or holds a whole number or an instant of more than
    64 bits, is not `ok`; it has no cells.
    """
    return df.select(*keep, _parsed_text(F.col(column)).alias("_row")).select(*keep, "_row.*")


def binary_lines(df: DataFrame, *keep: str, column: str = "line") -> DataFrame:
    """The same columns as `text_lines` for version 2 and 3 lines, and binary cells in `fields`."""
    return df.select(*keep, _parsed(F.col(column)).alias("_row")).select(*keep, "_row.*")


def split_binary(payloads: DataFrame, column: str = "payload", *keep: str) -> DataFrame:
    """One row per line of each binary payload, hopping over binary cells by their length.

    A malformed line goes up to its first line end that is not escaped, and is a
    reject when it is decoded. A payload is at most one batch, so its size is
    bounded by the batch limit.
    """
    return payloads.select(*keep, F.posexplode(_framed(F.col(column))).alias("line_no", "line"))


def _first(cells: str, name: str) -> Column:
    """The first cell of a name, NULL if there is none.

    Looked up by position, which is compiled code over names that all lookups of a
    row share; a lambda would be interpreted and copy every cell for each of them.
    """
    place = F.array_position(F.col(cells)["name"], name)
    return F.get(F.col(cells), (place - 1).cast("int"))


def symbol(name: str) -> Column:
    """The value of a symbol in a decoded row, NULL when it was left out."""
    return _first("symbols", name)["value"]


def field(name: str, part: str = "text") -> Column:
    """A part of a field in a decoded row, NULL when it was left out."""
    return _first("fields", name)[part]


def wide(decoded: DataFrame, columns: dict[str, str], *keep: str) -> DataFrame:
    """Decoded rows as a table: `columns` maps symbol and field names to Spark types.

    A name is looked up among the fields first, then among the symbols; cells
    that were left out are null.
    """
    has_numbers = "number" in decoded.schema["fields"].dataType.elementType.names

    def cell(name: str, dtype: str) -> Column:
        if dtype.startswith("array"):
            return field(name, "numbers").cast(dtype)
        text = F.coalesce(field(name), symbol(name))
        if dtype == "boolean":
            return text == "t"
        if dtype in ("double", "float") and has_numbers:
            return F.coalesce(field(name, "number"), text.try_cast("double")).cast(dtype)
        if dtype == "timestamp":
            ns = field(name, "kind") == "timestamp_ns"
            count = text.try_cast("bigint")
            return F.timestamp_micros(F.when(ns, nanos_to_micros(count)).otherwise(count))
        return text.try_cast(dtype)

    at = F.col("at")
    us = F.when(F.col("at_unit") == "us", at).otherwise(nanos_to_micros(at))
    return decoded.filter("ok").select(
        *keep, "tbl", *[cell(n, d).alias(n) for n, d in columns.items()], us.alias("at_us"))


def rejects(decoded: DataFrame, *keep: str) -> DataFrame:
    return decoded.filter(~F.col("ok")).select(*keep)
