"""Escaping and number text of the line format, as column expressions."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What must be escaped outside and inside double quotes.
BARE_SPECIAL = "\\ ,=\n\r"
QUOTED_SPECIAL = '\\"\n\r'


def _escape(c: Column, special: str) -> Column:
    """A backslash before each special character; the backslash itself goes first.

    Most values hold none, which a byte search finds out quickest.
    """
    found = reduce(lambda x, y: x | y, [c.contains(ch) for ch in special])
    escaped = reduce(lambda x, ch: F.replace(x, F.lit(ch), F.lit("\\" + ch)), special, c)
    return F.when(found, escaped).otherwise(c)


def escape_bare(c: Column) -> Column:
    """Escape a table name, column name or symbol value."""
    return _escape(c, BARE_SPECIAL)


def escape_quoted(c: Column) -> Column:
    """Escape the inside of a quoted string."""
    return _escape(c, QUOTED_SPECIAL)


def escape_name(name: str) -> str:
    return reduce(lambda x, ch: x.replace(ch, "\\" + ch), BARE_SPECIAL, name)


def _shortest(values: pa.Array) -> pa.Array:
    if values.null_count == len(values):
        return pa.nulls(len(values), pa.string())
    out = [None if v is None else repr(v).replace("+", "") for v in values.to_pylist()]
    return pa.array(out, pa.string())


shortest_text = F.arrow_udf(_shortest, T.StringType())


def float_text(c: Column, jvm: Column) -> Column:
    """Shortest text that reads back as the same double; `jvm` is `c` cast to a string.

    The JVM text is already that text when the value lies in [1e-3, 1e7) and
    has at most 15 significant digits, because two different decimals of up to
    15 digits never name the same double. Only the other cells go to Python;
    the rest reach it as nulls.
    """
    size = F.abs(c)
    plain = (
        ((size >= 1e-3) & (size < 1e7) & (F.octet_length(jvm) <= F.when(c < 0, 17).otherwise(16)))
        | F.isnan(c) | (size == F.lit(float("inf"))) | (c == 0.0)
    )
    return F.when(plain, jvm).otherwise(shortest_text(F.when(~plain, c)))
