"""Landing effects: deduplication, time order, arrival, schema evolution. `store` keeps the rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from itertools import zip_longest

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tslines.functions import times
from tslines.operators.ordered import running
from tslines.plans.roles import Roles


def dedup(df: DataFrame, keys: list[str], at: str, arrival: str, keep: str = "last") -> DataFrame:
    """Re-sent rows collapse to the last arrival; rows without `at` never do.

    An aggregate instead of a window: copies of a row shrink map-side, so a
    row with very many copies does not gather in one task. A known arrival
    counts as later than a NULL one, and ties go to the larger hash of the
    row. `keep="first"` is what `streaming.flows.dedup` does, which cannot wait
    for the last.
    """
    rest = [c for c in df.columns if c not in (*keys, at)]
    hashed = [c for c in rest if not isinstance(df.schema[c].dataType, T.MapType)]
    rank = F.struct(F.col(arrival).isNotNull(), F.col(arrival), F.xxhash64(*hashed))
    choose = {"last": F.max_by, "first": F.min_by}[keep]
    known = (df.filter(F.col(at).isNotNull())
             .groupBy(*keys, at)
             .agg(choose(F.struct(*rest), rank).alias("_r"))
             .select(*keys, at, "_r.*"))
    return known.select(*df.columns).unionByName(df.filter(F.col(at).isNull()))


def sort(df: DataFrame, at: str, *more: str, partitions: int | None = None) -> DataFrame:
    """Rows in time order: range partitions, sorted inside."""
    cols = [F.col(c) for c in (at, *more)]
    spread = df.repartitionByRange(partitions, *cols) if partitions else (
        df.repartitionByRange(*cols))
    return spread.sortWithinPartitions(*cols)


def lateness(df: DataFrame, keys: list[str], at_us: str, arrival: str,
             width: int = 1 << 20, **plan) -> DataFrame:
    """How far each row lies behind the newest instant that arrived before it, per key.

    `arrival` is a BIGINT; rows with the same arrival do not see each other.
    """
    out = running(df, keys, arrival, F.col(at_us), "max", "_newest", width, exclusive=True,
                  settle=False, **plan)
    late = F.greatest(F.coalesce(F.col("_newest") - F.col(at_us), F.lit(0)), F.lit(0))
    return out.withColumn("late_us", late).drop("_newest")


def stamp(df: DataFrame, at: str) -> DataFrame:
    """Arrival time for rows without an instant; in a stream, the time of the micro-batch."""
    return df.withColumn(at, F.coalesce(F.col(at), F.current_timestamp()))


def day(at_us: Column) -> Column:
    return F.to_date(F.timestamp_micros(at_us))


_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
# Significant decimal digits that always survive in a float and in a double.
_DIGITS = {T.FloatType: 6, T.DoubleType: 15}


def _text_changes(i: int, target: T.DataType) -> tuple[list[dict[str, Column]], Column]:
    """Does a text that can be converted say more than its conversion keeps?

    Steps, each of columns made from those before, and the answer made from them.
    """
    text, out = F.col(f"_text{i}"), F.col(f"_out{i}")
    if isinstance(target, (T.TimestampType, T.TimestampNTZType)):
        return [], text.rlike(r"\.[0-9]{6}[0-9]*[1-9]")
    if isinstance(target, T.DateType):
        return [], text.rlike("[T ].*[1-9]")
    if not isinstance(target, (T.DecimalType, T.FloatType, T.DoubleType)):
        return [], F.lit(False)
    mantissa, places, raised = F.col(f"_mantissa{i}"), F.col(f"_places{i}"), F.col(f"_power{i}")
    # patterns are asked only where they may find something, and so is `try_cast`,
    # which raises and catches where it fails
    scaled = F.contains(text, F.lit("e")) | F.contains(text, F.lit("E"))
    fraction = F.when(F.contains(mantissa, F.lit(".")), F.regexp_extract(mantissa, r"\.([0-9]*)$", 1)).otherwise("")
    power = F.coalesce(F.when(raised != "", raised.try_cast("int")), F.lit(0))
    steps = [{f"_mantissa{i}": F.when(scaled, F.regexp_replace(text, "[eE].*$", "")).otherwise(text),
              f"_power{i}": F.when(scaled, F.regexp_extract(text, r"[eE]([-+]?[0-9]+)$", 1)).otherwise("")},
             {f"_places{i}": F.length(F.rtrim(fraction, F.lit("0"))) - power}]
    if isinstance(target, T.DecimalType):
        return steps, (places > target.scale) & mantissa.rlike("[1-9]")
    said = text.rlike("(?i)^[-+]?(inf|infinity|nan)$")
    most = _DIGITS[type(target)] + 2
    digits = F.trim(F.regexp_replace(mantissa, "[^0-9]", ""), F.lit("0"))
    # beyond these digits the number must be the one that the double holds exactly
    exact = (places <= 15) & (out.cast("double").cast("decimal(38,15)") == text.try_cast("decimal(38,15)"))
    return steps, (((F.isnan(out) | (F.abs(out) == float("inf"))) & ~said) | ((out == 0) & mantissa.rlike("[1-9]"))
                   | ((F.length(mantissa) > most) & (F.length(digits) > most) & ~F.coalesce(exact, F.lit(False))))


def _fits(i: int, c: Column, source: T.DataType, target: T.DataType) -> list[dict[str, Column]]:
    """Steps to `_lost<i>`, was something lost, and `_cell<i>`, the converted cell."""
    out, lost = F.col(f"_out{i}"), F.col(f"_lost{i}")
    if isinstance(target, T.BooleanType) and not isinstance(source, (T.BooleanType, T.StringType)):
        return [{f"_lost{i}": c.isNotNull(), f"_cell{i}": F.lit(None).cast(target)}]
    if isinstance(source, (T.FloatType, T.DoubleType)) and isinstance(target, _INTEGERS):
        first = {f"_out{i}": F.when(c == F.floor(c), c).try_cast(target.simpleString())}
    elif isinstance(source, T.StringType) and isinstance(target, _INTEGERS):
        # no whole number has one of these
        first = {f"_out{i}": F.when(~c.rlike("[A-Za-z.]"), c).try_cast(target.simpleString())}
    else:
        first = {f"_out{i}": c.try_cast(target.simpleString())}
    if isinstance(source, T.StringType):
        steps, changes = _text_changes(i, target)
        gone = c.isNotNull() & (out.isNull() | F.coalesce(changes, F.lit(True)))
        return [first | {f"_text{i}": F.trim(c)}, *steps, {f"_lost{i}": gone}, {f"_cell{i}": F.when(~lost, out)}]
    if isinstance(target, T.StringType):
        return [first, {f"_lost{i}": c.isNotNull() & out.isNull(), f"_cell{i}": out}]
    # only values that come back unchanged have lost nothing
    same = F.coalesce(out.try_cast(source.simpleString()) == c, F.lit(False))
    return [first, {f"_lost{i}": c.isNotNull() & ~same}, {f"_cell{i}": F.when(~lost, out)}]


def _converted(df: DataFrame, target: T.StructType) -> tuple[DataFrame, list[tuple[str, Column, Column]]]:
    """Rows with their conversions, and (name, converted cell, was something lost?) of each column.

    What is needed more than once is a column of its own, so that it is made once
    for a row. A filter would be moved below those columns and bring all of them
    along for each use; callers drop rows by a generator, which is not.
    """
    known = {f.name: f.dataType for f in target.fields}
    parts, todo = [], []
    for i, f in enumerate(df.schema.fields):
        if f.name in known and f.dataType != known[f.name]:
            todo.append(_fits(i, F.col(f.name), f.dataType, known[f.name]))
            parts.append((f.name, F.col(f"_cell{i}"), F.col(f"_lost{i}")))
        else:
            parts.append((f.name, F.col(f.name), F.lit(False)))
    for step in zip_longest(*todo, fillvalue={}):
        df = df.withColumns({n: c for columns in step for n, c in columns.items()})
    return df, parts


def conform(df: DataFrame, target: T.StructType) -> DataFrame:
    """Rows cast to the types of an existing table; rows that would lose a value are left out."""
    wide, parts = _converted(df, target)
    kept = ~reduce(lambda a, b: a | b, [lost for _, _, lost in parts])
    return wide.select(*[c.alias(n) for n, c, _ in parts], F.explode(F.when(kept, F.array(F.lit(0)))).alias("_kept")
                       ).drop("_kept")


def conform_rejects(df: DataFrame, target: T.StructType, *key: str) -> DataFrame:
    """One row per value that `conform` could not keep."""
    wide, parts = _converted(df, target)
    found = [F.when(lost, F.struct(F.lit(n).alias("column"),
                                   F.col(n).cast("string").alias("value")))
             for n, _, lost in parts]
    return wide.select(*key, F.explode(F.filter(F.array(*found), lambda r: r.isNotNull())).alias("r")
                       ).select(*key, "r.*")


def spelling(df: DataFrame) -> Callable[[str], str]:
    """How the frame spells a column, names compared as the session does."""
    fold = (lambda s: s) if df.sparkSession.conf.get("spark.sql.caseSensitive") == "true" else str.lower
    known = {fold(c): c for c in df.columns}
    if len(known) < len(df.columns):
        raise ValueError(f"columns {df.columns} name one column twice")
    return lambda name: known.get(fold(name), name)


def named(df: DataFrame, known: T.StructType | None) -> DataFrame:
    """The frame with a table's spelling of its columns."""
    own = spelling(df)
    table = {own(n): n for n in known.names} if known else {}
    return df.toDF(*[table.get(c, c) for c in df.columns])


def evolve(existing: T.StructType, incoming: T.StructType) -> T.StructType:
    """The table after `incoming` rows: new columns are added, known ones keep their type.

    Decimals are never created on the fly.
    """
    known = set(existing.names)
    fresh = [f for f in incoming.fields if f.name not in known]
    for f in fresh:
        if isinstance(f.dataType, T.DecimalType):
            raise ValueError(f"decimal column {f.name!r} must exist before rows arrive")
    return T.StructType(existing.fields + fresh)


def append(table: DataFrame, incoming: DataFrame) -> DataFrame:
    """Existing rows plus conformed new ones under the evolved schema."""
    incoming = named(incoming, table.schema)
    schema = evolve(table.schema, incoming.schema)
    return table.unionByName(conform(incoming, schema), allowMissingColumns=True).select(
        *schema.names)


def long_rows(df: DataFrame, roles: Roles, *key: str) -> DataFrame:
    """One row per written cell: `key`, `tbl`, `at_us`, `role_pos`, `role`, `name`, `kind`."""
    kinds = {"symbol": "SYMBOL", "boolean": "BOOLEAN", "integer": "LONG", "float": "DOUBLE",
             "string": "VARCHAR", "timestamp": "TIMESTAMP", "array": "ARRAY",
             "decimal": "DECIMAL", "decimal_text": "DECIMAL"}
    cells = [F.when(c.col.isNotNull(), F.struct(
        F.lit(0 if c.target == "symbol" else 1).alias("role_pos"),
        F.lit("symbol" if c.target == "symbol" else "field").alias("role"),
        F.lit(c.name).alias("name"), F.lit(kinds[c.target]).alias("kind"))) for c in roles.cells]
    at = F.struct(F.lit(2).alias("role_pos"), F.lit("at").alias("role"),
                  F.lit("timestamp").alias("name"), F.lit("TIMESTAMP").alias("kind"))
    listed = F.filter(F.array(*cells, at), lambda c: c.isNotNull())
    return df.select(*key, roles.table_col().alias("tbl"), roles.at_micros().alias("at_us"),
                     F.explode(listed).alias("c")).select(*key, "tbl", "at_us", "c.*")


def catalogue(rows: DataFrame) -> DataFrame:
    """Tables and columns the rows create: type by first arrival, order symbols, fields, instant.

    The window at the end runs over one row per column of a table.
    """
    cols = rows.groupBy("tbl", "role_pos", "role", "name").agg(
        F.min_by("kind", F.struct("at_us", "kind")).alias("kind"),
        F.min("at_us").alias("first_us"), F.count("*").alias("n_cells"))
    order = Window.partitionBy("tbl").orderBy("role_pos", "first_us", "name")
    return cols.withColumn("position", F.row_number().over(order)).drop("role_pos")


def at_us(df: DataFrame, at: str, name: str = "at_us") -> DataFrame:
    return df.withColumn(name, times.micros(F.col(at)))
