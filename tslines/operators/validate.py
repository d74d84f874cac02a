"""Row checks, reject tables and column reports, each in one pass over the input."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tslines.functions import binary, names
from tslines.plans.roles import Cell, Roles


def ragged(c: Column, dims: int) -> Column:
    """True for an array with rows of unequal size or a null inside."""
    bad, level = F.lit(False), c
    for _ in range(dims - 1):
        sizes = F.transform(level, lambda r: F.coalesce(F.size(r), F.lit(-1)))
        # equal sizes: the smallest is the largest, and no row is null
        bad = bad | (F.array_min(sizes) != F.array_max(sizes)) | (F.array_min(sizes) < 0)
        level = F.flatten(level)
    return F.coalesce(bad, F.lit(False)) | F.coalesce(
        F.exists(level, lambda v: v.isNull()), F.lit(False))


def _rules(roles: Roles) -> list[tuple[int, str, str, Column, Column, Column]]:
    """(line position, rule, column, broken?, value, message) in line order."""
    out = []

    def rule(pos, name, cell: Cell | None, broken, message):
        value = cell.col.cast("string") if cell is not None else F.lit(None).cast("string")
        out.append((pos, name, cell.name if cell else None, broken, value, message))

    if roles.table_cell:
        error = names.name_error(roles.table_cell.col, "table")
        rule(0, "table_name", roles.table_cell, error.isNotNull(), error)
    for pos, cell in enumerate(roles.cells, 1):
        if cell.target == "boolean":
            rule(pos, "null_boolean", cell, cell.col.isNull(), F.lit("a boolean must not be null"))
        elif cell.target == "integer" and not isinstance(
                cell.dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            rule(pos, "int_overflow", cell, cell.col.isNotNull() & cell.wire().isNull(),
                 F.lit("the value does not fit a signed 64-bit integer"))
        elif cell.target == "array":
            rule(pos, "ragged_array", cell, ragged(cell.col, binary.array_dims(cell.dtype)),
                 F.lit("all rows of an array must have one size and no nulls"))
        elif cell.target == "decimal_text":
            error = binary.decimal_text_error(cell.col)
            rule(pos, "decimal", cell, error.isNotNull(), error)
    last = len(roles.cells) + 1
    if roles.at_cell:
        negative = F.coalesce(roles.at_micros() < 0, F.lit(False))
        rule(last, "negative_at", roles.at_cell, negative, F.lit("the instant lies before 1970"))
    empty = reduce(lambda a, b: a & b, [c.col.isNull() for c in roles.cells], F.lit(True))
    rule(last + 1, "all_null_row", None, empty, F.lit("all values are nulls"))
    return out


def broken_cell(roles: Roles) -> tuple[Column, Column] | None:
    """(does a cell or name break a rule?, what the first one is), or None if none can.

    A row with nothing to write is not counted: it is left out, not refused.
    """
    rules = [r for r in _rules(roles) if r[1] != "all_null_row"]
    if not rules:
        return None
    known = [F.coalesce(r[3], F.lit(False)) for r in rules]
    text = [F.when(hit, F.concat(F.lit(f"column {r[2]!r}: "), r[5], F.lit(" (value "),
                                 F.coalesce(r[4], F.lit("NULL")), F.lit(")")))
            for hit, r in zip(known, rules)]
    return reduce(lambda a, b: a | b, known), F.coalesce(*text)


def rejects(df: DataFrame, roles: Roles, *key: str) -> DataFrame:
    """One row per broken rule: `key`, `pos`, `rule`, `column`, `value`, `message`.

    A plain filter drops clean rows first; only broken ones build their list.
    """
    rules = _rules(roles)
    df = df.filter(reduce(lambda a, b: a | b, [r[3] for r in rules]))
    found = [
        F.when(broken, F.struct(
            F.lit(pos).alias("pos"), F.lit(name).alias("rule"),
            F.lit(column).cast("string").alias("column"), value.alias("value"),
            message.alias("message")))
        for pos, name, column, broken, value, message in rules
    ]
    listed = F.filter(F.array(*found), lambda r: r.isNotNull())
    return df.select(*key, F.explode(listed).alias("_r")).select(*key, "_r.*")


def clean(df: DataFrame, roles: Roles) -> DataFrame:
    """Rows that break no rule; a plain filter, no join with the rejects."""
    broken = reduce(lambda a, b: a | b, [r[3] for r in _rules(roles)], F.lit(False))
    return df.filter(~broken)


def first_error(df: DataFrame, roles: Roles, *key: str) -> DataFrame:
    """The error a row-by-row load would stop at: smallest key, then line position."""
    bad = rejects(df, roles, *key)
    return bad.agg(
        F.min_by(F.struct(*bad.columns), F.struct(*key, "pos")).alias("_r")
    ).filter("_r is not null").select("_r.*")


class RejectedRows(ValueError):
    """A strict load met a bad row."""


def strict(df: DataFrame, roles: Roles, *key: str) -> DataFrame:
    """`df` itself when no row breaks a rule; otherwise the first error is raised."""
    row = first_error(df, roles, *key).first()
    if row is not None:
        raise RejectedRows(f"row {[row[k] for k in key]}, column {row['column']!r}: "
                           f"{row['message']} (value {row['value']!r})")
    return df


def text_kind(c: Column) -> Column:
    """What a loosely typed text cell holds."""
    return (
        F.when(c.isNull(), None)
        .when(c.rlike("^(true|false)$"), "boolean")
        .when(c.rlike("^[+-]?[0-9]+$"), "integer")
        .when(c.rlike(r"^[+-]?([0-9]+\.[0-9]*|\.[0-9]+|[0-9]+)([eE][+-]?[0-9]+)?$"), "float")
        .when(c.rlike("^(NaN|[+-]?Infinity)$"), "float")
        .otherwise("string")
    )


KINDS = ("boolean", "integer", "float", "string")


def sniff(df: DataFrame, columns: list[str], *order: str) -> DataFrame:
    """Per column: the kind of the first non-null value, and how many later values disagree."""
    kinds = df.select(*order, *[text_kind(F.col(c)).alias(f"_k{i}")
                                for i, c in enumerate(columns)])
    aggs = []
    for i in range(len(columns)):
        k = F.col(f"_k{i}")
        # struct order with nulls replaced by NULL keys: min_by skips NULL ordering values
        aggs.append(F.min_by(k, F.when(k.isNotNull(), F.struct(*order))).alias(f"first{i}"))
        aggs += [F.count_if(k == kind).alias(f"{kind}{i}") for kind in KINDS]
        aggs.append(F.count_if(k.isNull()).alias(f"null{i}"))
    row = kinds.agg(*aggs)
    parts = []
    for i, name in enumerate(columns):
        total = reduce(lambda a, b: a + b, [F.col(f"{k}{i}") for k in KINDS])
        agree = reduce(lambda a, k: a.when(F.col(f"first{i}") == k, F.col(f"{k}{i}")), KINDS[1:],
                       F.when(F.col(f"first{i}") == KINDS[0], F.col(f"{KINDS[0]}{i}")))
        agree = F.when(F.col(f"first{i}") == "string", total).otherwise(agree)
        parts.append(F.struct(
            F.lit(name).alias("column"),
            F.coalesce(F.col(f"first{i}"), F.lit("skip")).alias("kind"),
            F.coalesce(agree, F.lit(0).cast("bigint")).alias("n_agree"),
            (total - F.coalesce(agree, F.lit(0))).alias("n_disagree"),
            F.col(f"null{i}").alias("n_null")))
    return row.select(F.explode(F.array(*parts)).alias("r")).select("r.*")


# Spark types of the sniffed kinds.
KIND_TYPES = {"boolean": "boolean", "integer": "bigint", "float": "double", "string": "string"}


def typed(df: DataFrame, columns: list[str], *order: str) -> tuple[DataFrame, DataFrame]:
    """(typed rows, rejects) of loosely typed text columns.

    The first non-null value of a column decides its type; rows with a value of
    another kind are rejects (in a string column any value fits), as are
    integers beyond 64 bits, and columns without any value are dropped. One
    aggregate decides, its result is one row per column.
    """
    kinds = {r["column"]: r["kind"] for r in sniff(df, columns, *order).collect()}
    cell = {c: F.col(c).try_cast(KIND_TYPES[k]) for c, k in kinds.items() if k != "skip"}
    odd = [(c, F.col(c).isNotNull() & ((text_kind(F.col(c)) != kinds[c]) | cell[c].isNull()))
           for c in columns if kinds[c] not in ("skip", "string")]
    none = F.lit(False)
    broken = reduce(lambda a, b: a | b, [o for _, o in odd], none)
    broken = F.coalesce(broken, none)
    cols = [cell[c].alias(c) if c in cell else F.col(c)
            for c in df.columns if kinds.get(c) != "skip"]
    found = [F.when(o, F.struct(F.lit(c).alias("column"), F.lit(kinds[c]).alias("expected"),
                                F.col(c).alias("value"))) for c, o in odd]
    listed = F.filter(F.array(*found), lambda r: r.isNotNull()) if found else F.array()
    if found:
        bad = df.filter(broken).select(*order, F.explode(listed).alias("r")).select(*order, "r.*")
    else:
        bad = df.filter(none).select(*order, F.lit("").alias("column"),
                                     F.lit("").alias("expected"), F.lit("").alias("value"))
    return df.filter(~broken).select(*cols), bad


def _report(df: DataFrame, names_: list[str], measures: dict[str, list[Column]],
            labels: dict[str, list[str]] | None = None) -> DataFrame:
    """One aggregate for all columns, turned into one row per column."""
    aggs = [m.alias(f"{k}{i}") for k, ms in measures.items() for i, m in enumerate(ms)]
    row = df.agg(*aggs)
    parts = [F.struct(F.lit(n).alias("column"),
                      *[F.lit(v[i]).alias(k) for k, v in (labels or {}).items()],
                      *[F.col(f"{k}{i}").alias(k) for k in measures])
             for i, n in enumerate(names_)]
    return row.select(F.explode(F.array(*parts)).alias("r")).select("r.*")


def null_profile(df: DataFrame, roles: Roles) -> DataFrame:
    """Per column: nulls, NaNs, cells left out of the line and cells written."""
    cells = roles.cells
    nan = [F.count_if(F.isnan(c.wire())) if c.target == "float" else F.count_if(F.lit(False))
           for c in cells]
    nulls = [F.count_if(c.col.isNull()) for c in cells]
    written = [F.count(c.col) for c in cells]
    return _report(df, [c.name for c in cells],
                   {"n_null": nulls, "n_nan": nan, "n_elided": nulls, "n_written": written},
                   {"target": [c.target for c in cells]})


def version_loss(df: DataFrame, roles: Roles, version: int) -> DataFrame:
    """Per column: cells that `version` cannot carry, or carries with less precision."""
    lost, reduced = [], []
    never = F.count_if(F.lit(False))
    for c in roles.ordered:
        need = {"array": 2, "decimal": 3, "decimal_text": 3}.get(c.target, 1)
        lost.append(F.count(c.col) if version < need else never)
        coarse = c.target == "timestamp" and c.unit == "ns" and version < 2 and (
            c is not roles.at_cell)
        reduced.append(F.count_if(c.col % 1000 != 0) if coarse else never)
    return _report(df, [c.name for c in roles.ordered], {"n_lost": lost, "n_reduced": reduced},
                   {"target": [c.target for c in roles.ordered]})


def utf8_errors(df: DataFrame, column: str, *key: str) -> DataFrame:
    """Rows whose binary text is not UTF-8: the text repaired by U+FFFD, and where it first is."""
    raw = F.col(column)
    bad = df.filter(~F.is_valid_utf8(raw)).select(
        *key, F.make_valid_utf8(raw).alias("repaired"), F.col(column).cast("binary").alias("_raw"))
    # walk from one U+FFFD to the next until the bytes there are not its own
    start = F.struct(F.lit(0).alias("octets"), F.lit(0).alias("chars"), F.lit(None).cast("int").alias("at"))

    def step(acc, part):
        octets, chars = acc["octets"] + F.octet_length(part), acc["chars"] + F.length(part)
        genuine = F.substring(F.col("_raw"), octets + 1, F.lit(3)) == F.lit("\ufffd".encode())
        at = F.coalesce(acc["at"], F.when(~genuine, chars + 1))
        return F.struct((octets + 3).alias("octets"), (chars + 1).alias("chars"), at.alias("at"))

    parts = F.split("repaired", "\ufffd", -1)
    parts = F.slice(parts, F.lit(1), F.size(parts) - 1)
    return bad.withColumn("bad_char", F.aggregate(parts, start, step, lambda acc: acc["at"])).drop("_raw")
