"""Integers and decimals in wire form."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tslines.functions import binary

MIN_64, MAX_64 = Decimal(-(1 << 63)), Decimal((1 << 63) - 1)


def guarded_int(c: Column) -> Column:
    """BIGINT of a decimal, or NULL where it does not fit 64 signed bits.

    A comparison instead of `try_cast`, which raises and catches per bad cell.
    """
    return F.when(c.between(F.lit(MIN_64), F.lit(MAX_64)), c.cast("bigint"))


def unscaled(c: Column, precision: int, scale: int) -> Column:
    """The integer behind a DECIMAL(precision, scale) cell, as DECIMAL(38, 0)."""
    if scale == 0:
        return c.cast("decimal(38,0)")
    if precision <= 18:
        # The product needs at most 38 digits, so it is exact.
        return (c * F.lit(Decimal(10**scale))).cast("decimal(38,0)")
    # A product could round digits beyond 38 away; shift the text instead.
    return F.regexp_replace(c.cast("string"), r"\.", "").cast("decimal(38,0)")


def decimal_width(precision: int) -> int:
    """Payload bytes: 4 up to 9 digits, 8 up to 18, 16 up to 38."""
    return 4 if precision <= 9 else 8 if precision <= 18 else 16


def decimal_bytes(c: Column, precision: int, scale: int) -> Column:
    """Big-endian two's complement of the unscaled value, in `decimal_width` bytes."""
    width = decimal_width(precision)
    if width == 16:
        return binary.decimal_be(c)
    whole = F.unhex(F.lpad(F.hex(unscaled(c, precision, scale).cast("bigint")), 16, "0"))
    return whole if width == 8 else F.substring(whole, 5, 4)
