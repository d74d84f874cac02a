"""Instants: unit changes and checks. Nanoseconds travel as BIGINT."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


def micros(c: Column) -> Column:
    """Microseconds since the epoch; zone-free timestamps count as UTC."""
    return F.unix_micros(c.cast("timestamp"))


def nanos_to_micros(c: Column) -> Column:
    """Floor division by 1000, also below zero."""
    return F.call_function("div", c, F.lit(1000)) - F.when(c % 1000 < 0, 1).otherwise(0)


def micros_to_nanos_text(c: Column) -> Column:
    """`c * 1000` as text, without leaving 64 bits."""
    return F.when(c == 0, "0").otherwise(F.concat(c.cast("string"), F.lit("000")))


def instant_nanos(value) -> int:
    """A datetime or an integer of nanoseconds as nanoseconds; negatives are refused."""
    if isinstance(value, dt.datetime):
        if value.tzinfo is None:
            value = value.astimezone()
        delta = value - EPOCH
        value = ((delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds) * 1000
    if value < 0:
        raise ValueError("an instant must not lie before 1970-01-01 UTC")
    return value
