"""Encode rows as protocol lines.

The line is one projection of built-in expressions. Only raw double bits
(versions 2 and 3) and rare float text (version 1) pass through Arrow functions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tslines.functions import binary, numbers, text, times
from tslines.operators import validate
from tslines.plans.roles import Cell, Roles


def _at(roles: Roles) -> Column | None:
    """Text of the designated timestamp, NULL for server time."""
    ns = roles.at_cell is None or roles.at_cell.unit == "ns"
    if roles.at_cell is None:
        if roles.at_nanos is None:
            return None
        return F.lit(str(roles.at_nanos) + ("" if roles.version == 1 else "n"))
    if roles.version == 1:
        return (roles.at_cell.col.cast("string") if ns
                else times.micros_to_nanos_text(roles.at_cell.micros()))
    if ns:
        return F.concat(roles.at_cell.col.cast("string"), F.lit("n"))
    return F.concat(roles.at_cell.micros().cast("string"), F.lit("t"))


def _symbol(cell: Cell) -> Column:
    return F.concat(F.lit("," + text.escape_name(cell.name) + "="), text.escape_bare(cell.col))


def _text_value(cell: Cell, version: int, jvm: dict[str, Column]) -> Column:
    c = cell.wire()
    if cell.target == "boolean":
        return F.when(c, "t").when(~c, "f")
    if cell.target == "integer":
        return F.concat(c.cast("string"), F.lit("i"))
    if cell.target == "float":
        # without exactness the JVM's own text stays, in one codegen stage
        return text.float_text(c, jvm[cell.name]) if cell.name in jvm else c.cast("string")
    if cell.target == "timestamp":
        if cell.unit == "ns" and version > 1:
            return F.concat(c.cast("string"), F.lit("n"))
        return F.concat(cell.micros().cast("string"), F.lit("t"))
    return F.concat(F.lit('"'), text.escape_quoted(c), F.lit('"'))


def _binary_value(cell: Cell) -> Column | None:
    """The bytes after `name=` for cells that are binary from version 2 on."""
    c = cell.wire()
    if cell.target == "float":
        return F.concat(F.lit(b"=" + bytes([binary.DOUBLE_TAG])), binary.double_le(c))
    if cell.target == "array":
        return F.concat(F.lit(b"="), binary.array_payload(c))
    if cell.target == "decimal":
        p, s = cell.dtype.precision, cell.dtype.scale
        head = bytes([binary.DECIMAL_TAG, s, numbers.decimal_width(p)])
        return F.concat(F.lit(b"=" + head), numbers.decimal_bytes(c, p, s))
    if cell.target == "decimal_text":
        return F.concat(F.lit(b"=" + bytes([binary.DECIMAL_TAG])), binary.text_decimal(c))
    return None


def _present(cells) -> Column:
    return reduce(lambda a, b: a | b, [c.col.isNotNull() for c in cells], F.lit(False))


def encode(df: DataFrame, roles: Roles, *keep: str, exact_floats: bool = True,
           strict: bool = True) -> DataFrame:
    """`keep` columns, `tbl`, `line` and `n_bytes` (with the line end).

    `line` is text for version 1 and binary above. Rows with nothing to write
    are left out, as a single-row append does; `validate.rejects` reports them.
    `exact_floats=False` keeps version 1 free of Python: floats are then the
    JVM's text, which names the same double but may not be the shortest one.

    A cell or name that `validate.rejects` lists fails the job with its column
    and value. With `strict=False` such rows are left out instead, so that the
    lines are those of the rows that `rejects` does not list.
    """
    broken = validate.broken_cell(roles)
    if broken and not strict:
        df = df.filter(~broken[0])
    df, jvm = df.filter(_present(roles.cells)), {}
    if roles.version == 1 and exact_floats:
        # the text is needed three times; as a column it is made once
        floats = [c for c in roles.fields if c.target == "float"]
        df = df.withColumns({f"_f{c.position}": c.wire().cast("string") for c in floats})
        jvm = {c.name: F.col(f"_f{c.position}") for c in floats}
    head = F.concat(text.escape_bare(roles.table_col()),
                    *[F.coalesce(_symbol(c), F.lit("")) for c in roles.symbols])
    at = _at(roles)
    tail = F.lit("") if at is None else F.coalesce(F.concat(F.lit(" "), at), F.lit(""))
    raw = {c.name: _binary_value(c) for c in roles.fields} if roles.version > 1 else {}
    pairs = {c.name: F.concat(F.lit(text.escape_name(c.name) + "="),
                              _text_value(c, roles.version, jvm))
             for c in roles.fields if raw.get(c.name) is None}
    if len(pairs) == len(roles.fields):
        body = F.concat(F.lit(" "), F.concat_ws(",", *pairs.values()))
        body = F.when(_present(roles.fields), body).otherwise("")
        line = F.concat(head, body, tail)
        line = line if roles.version == 1 else line.cast("binary")
    else:
        # runs of text cells become bytes together; the first comma becomes the
        # blank before the fields
        parts, run = [], []
        for c in roles.fields:
            if c.name in pairs:
                run.append(F.coalesce(F.concat(F.lit(","), pairs[c.name]), F.lit("")))
                continue
            if run:
                parts.append(F.concat(*run).cast("binary"))
            name = ("," + text.escape_name(c.name) + "=").encode()
            parts.append(F.coalesce(F.concat(F.lit(name), raw[c.name]), F.lit(b"")))
            run = []
        if run:
            parts.append(F.concat(*run).cast("binary"))
        body = F.concat(F.lit(b" "), F.substring(F.concat(*parts), 2, 2**31 - 1))
        body = F.when(_present(roles.fields), body).otherwise(F.lit(b""))
        line = F.concat(head.cast("binary"), body, tail.cast("binary"))
    if broken and strict:
        line = F.when(broken[0], F.raise_error(broken[1]).cast(
            "string" if roles.version == 1 else "binary")).otherwise(line)
    return (
        df.select(*keep, roles.table_col().alias("tbl"), line.alias("line"))
        .withColumn("n_bytes", F.octet_length("line").cast("bigint") + 1)
    )


def payload_size(lines: DataFrame, *by: str) -> DataFrame:
    """Rows and bytes per group (`tbl` by default), partially aggregated before the shuffle."""
    return lines.groupBy(*(by or ("tbl",))).agg(
        F.count("*").alias("n_rows"), F.sum("n_bytes").alias("n_bytes"))
